"""Table schemas and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(text: str) -> StructType:
    kinds = {"text": StringType(), "double": DoubleType(), "int": IntegerType(), "bool": BooleanType()}
    pairs = (item.split(":") for item in text.split())
    return StructType([StructField(name, kinds[kind], True) for name, kind in pairs])


# Source file names, null tokens, allowed labels, defaults.
PRODUCT_FILE = "product_info.csv"
REVIEW_FILES = "reviews_*.csv"
CSV_NULL_TOKENS = ["NULL", "null", "", " ", "unknown", "UNKNOWN"]
CSV_DEFAULT_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TEXT_NULL_TOKENS = ["nan", "None", ""]
DEMOGRAPHIC_NULL_TOKENS = ["nan", "none", "unknown", ""]
UNKNOWN_PATTERN = r"^\s*unknown\s*$"
SENTIMENT_LABELS = ["positive", "neutral", "negative"]
FALLBACK_RATE = 950.0
# White space as text trimming understands it.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Columns a source must have.
PRODUCT_COLUMNS = [
    "product_id", "product_name", "brand_name", "price_usd", "rating", "loves_count", "primary_category",
]
REVIEW_COLUMNS = [
    "author_id", "rating", "is_recommended", "helpfulness", "total_feedback_count",
    "total_neg_feedback_count", "total_pos_feedback_count", "submission_time", "review_text",
    "review_title", "skin_tone", "eye_color", "skin_type", "hair_color", "product_id",
]
SENTIMENT_COLUMNS = ["review_text", "author_id", "is_recommended"]
FEEDBACK_COLUMNS = ["total_feedback_count", "total_neg_feedback_count", "total_pos_feedback_count"]
DEMOGRAPHIC_COLUMNS = ["skin_tone", "eye_color", "skin_type", "hair_color"]

# Columns left out of the feature table, and of outlier capping.
NON_FEATURE_COLUMNS = [
    "review_text", "review_title", "submission_time", "product_id", "product_name_x",
    "product_name_y", "ingredients", "highlights", "variation_value", "size", "author_id",
]
UNCAPPED_COLUMNS = [
    "author_id", "product_id", "brand_id", "is_recommended", "limited_edition", "new",
    "online_only", "out_of_stock", "store_exclusive",
]
JOIN_RENAMES = {
    "product_name_x": "product_name", "brand_name_x": "brand_name",
    "price_usd_x": "price_usd", "rating_x": "rating",
}
JOIN_LEFTOVERS = ["product_name_y", "brand_name_y", "price_usd_y", "rating_y"]

# The served tables, in column order.
PRODUCT_SCHEMA = _struct(
    "product_id:text product_name:text brand_id:int brand_name:text loves_count:double rating:double "
    "reviews:double size:text variation_type:text variation_value:text variation_desc:text "
    "price_usd:double value_price_usd:double sale_price_usd:double price_clp:double "
    "limited_edition:int new:int online_only:int out_of_stock:int store_exclusive:int "
    "highlights:text primary_category:text secondary_category:text tertiary_category:text "
    "child_count:int child_max_price:double child_min_price:double"
)
REVIEW_SCHEMA = _struct(
    "author_id:text product_id:text product_name:text brand_name:text rating:double "
    "is_recommended:double helpfulness:double total_feedback_count:double "
    "total_neg_feedback_count:double total_pos_feedback_count:double submission_time:text "
    "review_text:text review_title:text skin_tone:text eye_color:text skin_type:text "
    "hair_color:text price_usd:double"
)
SENTIMENT_SCHEMA = _struct(
    "author_id:text review_text:text is_recommended:int sentiment:text sentiment_score:double"
)
RATE_SCHEMA = _struct("date:text rate:double source:text loaded_at:text")
METRICS_SCHEMA = _struct(
    "model_name:text n_estimators:int max_depth:int learning_rate:double random_state:int "
    "accuracy:double f1:double precision:double recall:double roc_auc:double "
    "silhouette_score:double best_k:int final_inertia:double pca_variance_2d:double loaded_at:text"
)
