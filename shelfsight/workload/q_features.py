"""Learned steps, clean tables, samples, splits, folds (T, K05-K09)."""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfsight.operators import clean, features, relate, reports, sampling
from shelfsight.plans import transforms
from shelfsight.session import written
from shelfsight.workload import roles
from shelfsight.workload.q_reports import PRODUCT_NUMBERS, rounded
from shelfsight.workload.registry import query
from shelfsight.workload.roles import RATE, REVIEW_ORDER, sql

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"
KEYS = KEY.split(", ")
IDS = "product_id, listing"


def _tidy_products(spark, d):
    return clean.clean_text_columns(roles.raw_products(spark, d))


TIDY_SQL = """
    SELECT product_id, listing, nullif(nullif(nullif(trim(product_name, ' ' || chr(10)), 'nan'), 'None'), '') AS product_name,
      nullif(nullif(nullif(trim(brand_name), 'nan'), 'None'), '') AS brand_name, nullif(primary_category, '') AS primary_category,
      price_usd, rating, loves_count FROM raw_products"""


def _mode(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _median(c: str, table: str, q: float = 0.5) -> str:
    return f"(SELECT quantile_cont({c}, {q}) FROM {table})"


@query("T01_impute", sql(f"""
    SELECT {IDS}, coalesce(product_name, {_mode('product_name', 'tidy')}) AS product_name, coalesce(brand_name, {_mode('brand_name', 'tidy')}) AS brand_name,
      coalesce(primary_category, {_mode('primary_category', 'tidy')}) AS primary_category, coalesce(price_usd, {_median('price_usd', 'tidy')}) AS price_usd,
      coalesce(rating, {_median('rating', 'tidy')}) AS rating, coalesce(loves_count, {_median('loves_count', 'tidy')}) AS loves_count FROM tidy""", "raw_products", tidy=TIDY_SQL))
def _(spark, d):
    tidy = _tidy_products(spark, d)
    return features.Impute().fit(tidy.drop("listing")).transform(tidy).select(
        "product_id", "listing", "product_name", "brand_name", "primary_category", *PRODUCT_NUMBERS)


@query("T02_impute_with_override", sql(f"""
    SELECT {KEY}, coalesce(helpfulness, 0.0) AS helpfulness, coalesce(rating, {_median('rating', 'raw_reviews')}) AS rating, skin_tone FROM raw_reviews""", "raw_reviews"))
def _(spark, d):
    rows = roles.raw_reviews(spark, d).select(*KEYS, "helpfulness", "rating", "skin_tone")
    return features.Impute(overrides=json.dumps({"helpfulness": 0.0})).fit(rows.drop(*KEYS)).transform(rows)


@query("T02_null_share_classes", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", CASE WHEN share > 0.02 THEN 'complex' ELSE 'simple' END AS part FROM (SELECT (count(*) - count({c})) / count(*)::DOUBLE AS share FROM raw_reviews) WHERE share > 0"""
    for c in ("rating", "helpfulness", "author_id", "product_id")), "raw_reviews"))
def _(spark, d):
    rows = roles.raw_reviews(spark, d).select("rating", "helpfulness", "author_id", "product_id")
    fitted = features.Impute(lowThreshold=0.02).fit(rows)
    named = [(c, "simple") for c in fitted.simple_columns] + [(c, "complex") for c in fitted.complex_columns]
    return spark.createDataFrame(named, "column string, part string")


def _capped(c: str, low: str, high: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, {high}), {low}) END AS {c}"


@query("T03_cap_iqr", sql(f"SELECT {IDS}, " + ", ".join(
    f"round({_capped(c, f'(SELECT a - 1.5 * (b - a) FROM b_{c})', f'(SELECT b + 1.5 * (b - a) FROM b_{c})').split(' AS ')[0]}, 6) AS {c}" for c in PRODUCT_NUMBERS) + " FROM raw_products",
    "raw_products", **{f"b_{c}": f"SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM raw_products" for c in PRODUCT_NUMBERS}))
def _(spark, d):
    rows = roles.raw_products(spark, d).select("product_id", "listing", *PRODUCT_NUMBERS)
    return rounded(features.Cap(exclude=["listing"]).fit(rows).transform(rows))


@query("T04_cap_quantiles", sql(f"SELECT {IDS}, " + ", ".join(
    f"round({_capped(c, _median(c, 'raw_products', 0.01), _median(c, 'raw_products', 0.99)).split(' AS ')[0]}, 6) AS {c}" for c in PRODUCT_NUMBERS) + " FROM raw_products", "raw_products"))
def _(spark, d):
    rows = roles.raw_products(spark, d).select("product_id", "listing", *PRODUCT_NUMBERS)
    return rounded(features.Cap(method="quantile", exclude=["listing"]).fit(rows).transform(rows))


@query("T05_drop_sparse", sql(f"SELECT {KEY}, rating FROM raw_reviews WHERE (SELECT count(rating) FILTER (WHERE l_linenumber = 1) < 0.5 * count(*) FROM raw_reviews)", "raw_reviews"))
def _(spark, d):
    """The rating of an order's first line alone is a column with mostly gaps."""
    rows = roles.raw_reviews(spark, d).withColumn("first_rating", F.when(F.col("l_linenumber") == 1, F.col("rating")))
    rows = rows.select(*KEYS, "rating", "first_rating")
    return features.DropSparse(threshold=0.5).fit(rows).transform(rows)


@query("T06_drop_constant", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem")
def _(spark, d):
    line = roles.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    constant = line.withColumn("zero", F.col("l_suppkey") * 0).withColumn("one", F.lit(1.0))
    return features.DropConstant().fit(constant).transform(constant)


@query("T07_drop_empty", "SELECT c_custkey, c_name FROM customer")
def _(spark, d):
    rows = roles.table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") < 0, "x").alias("nothing"))
    return features.DropEmpty().fit(rows).transform(rows)


SCALED = ["rating", "total_feedback_count", "total_neg_feedback_count"]


@query("T08_scale", sql(f"SELECT {KEY}, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM reviews)) / (SELECT stddev_pop({c}) FROM reviews), 6) AS {c}" for c in SCALED) + " FROM reviews", "reviews"))
def _(spark, d):
    rows = roles.reviews(spark, d).select(*KEYS, *SCALED)
    return rounded(features.Scale(columns=SCALED).fit(rows).transform(rows), 6, *SCALED)


@query("T09_one_hot", """
    SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS place, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS width, 1.0::DOUBLE AS total FROM customer""")
def _(spark, d):
    from pyspark.ml import Pipeline

    rows = roles.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    hot = Pipeline(stages=features.one_hot_stages(["c_mktsegment"])).fit(rows).transform(rows)
    values = hot.select("c_custkey", vector_to_array("c_mktsegment_hot").alias("x"))
    return values.select(
        "c_custkey", (F.array_position("x", 1.0) - 1).alias("place"), F.size("x").cast("bigint").alias("width"),
        F.aggregate("x", F.lit(0.0), lambda a, b: a + b).alias("total"))


@query("T09_all_categories", """
    SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS place, (SELECT count(DISTINCT c_name) FROM customer) AS width FROM customer""")
def _(spark, d):
    """One indicator per customer name, more than a thousand."""
    from pyspark.ml import Pipeline

    rows = roles.table(spark, d, "customer").select("c_custkey", "c_name")
    hot = Pipeline(stages=features.one_hot_stages(["c_name"])).fit(rows).transform(rows)
    width = hot.schema["c_name_hot"].metadata["ml_attr"]["num_attrs"]
    return hot.select("c_custkey", F.col("c_name_index").alias("place"), F.lit(width).cast("bigint").alias("width"))


@query("T09_hashed", """
    SELECT c_mktsegment, count(*) AS n, 1 AS places, 2.0::DOUBLE AS total FROM customer GROUP BY 1""")
def _(spark, d):
    """Segments and names hashed into one vector: a value has the same place in all rows."""
    from pyspark.ml import Pipeline

    rows = roles.table(spark, d, "customer").select("c_mktsegment", (F.col("c_custkey") % 2).cast("string").alias("side"))
    ready = Pipeline(stages=features.hashing_stages(["c_mktsegment", "side"], 1 << 10)).fit(rows).transform(rows)
    seen = ready.select("c_mktsegment", "side", features.places("hashed_hot").alias("places"), features.total("hashed_hot").alias("total"))
    sides = seen.groupBy("c_mktsegment", "side").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("places").alias("p"), F.max("total").alias("total"))
    return sides.groupBy("c_mktsegment").agg(F.sum("n").alias("n"), F.max("p").cast("int").alias("places"), F.max("total").alias("total"))


@query("T10_keep_frequent", """
    SELECT value, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT CASE WHEN row_number() OVER (ORDER BY count(*) DESC, p_brand DESC) <= 19 THEN p_brand ELSE 'infrequent' END AS value, count(*) AS n FROM part GROUP BY p_brand)
    GROUP BY value""")
def _(spark, d):
    rows = roles.table(spark, d, "part").select("p_brand")
    kept = features.KeepFrequent(columns=["p_brand"], maxCategories=20).fit(rows).transform(rows)
    return kept.groupBy(F.col("p_brand").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("T11_route_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{route}' AS route, count({c}) AS given FROM lineitem"
    for route, names in {"numeric": ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"], "other": ["l_returnflag", "l_shipdate"]}.items() for c in names))
def _(spark, d):
    line = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
    routes = dict(zip(("numeric", "other"), clean.split_columns(line)))
    counts = line.agg(*[F.count(c).alias(c) for c in line.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(route).alias("route"), F.col(c).alias("given"))
        for route, names in routes.items() for c in names
    ])))


def _model_rows(spark, d):
    return roles.raw_reviews(spark, d).select("rating", "helpfulness", "skin_tone", "skin_type", F.col("l_linenumber").alias("id"), F.col("l_tax").alias("label"))


def _scaled_extremes(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round((min(v) - avg(v)) / stddev_pop(v), 6) AS low, round((max(v) - avg(v)) / stddev_pop(v), 6) AS high, count(*) AS n
      FROM (SELECT coalesce(v, (SELECT quantile_cont(v, 0.5) FROM capped_{c})) AS v FROM capped_{c})"""


@query("T12_preprocessor", sql(
    " UNION ALL ".join([_scaled_extremes(c) for c in ("rating", "helpfulness")] + [f"""
    SELECT '{c}_hot_' || {c} AS feature, 1.0::DOUBLE AS low, 1.0::DOUBLE AS high, count(*) AS n FROM filled_{c} GROUP BY {c}""" for c in ("skin_tone", "skin_type")]),
    "raw_reviews",
    **{f"capped_{c}": f"SELECT {_capped(c, _median(c, 'raw_reviews', 0.01), _median(c, 'raw_reviews', 0.99)).split(' AS ')[0]} AS v FROM raw_reviews" for c in ("rating", "helpfulness")},
    **{f"known_{c}": f"SELECT CASE WHEN lower(trim({c})) <> 'unknown' THEN {c} END AS {c} FROM raw_reviews" for c in ("skin_tone", "skin_type")},
    **{f"filled_{c}": f"SELECT coalesce({c}, {_mode(c, f'known_{c}')}) AS {c} FROM known_{c}" for c in ("skin_tone", "skin_type")}))
def _(spark, d):
    # Every step learns in passes of its own; the join behind the rows is made once.
    rows = written(_model_rows(spark, d), "model-rows")
    ready = features.preprocessor(rows, "label", ["id"]).fit(rows).transform(rows)
    names = features.feature_names(ready)
    cells = ready.select(F.posexplode(vector_to_array("features")).alias("i", "v"))
    shown = F.element_at(F.lit(names), F.col("i") + 1)
    given = cells.where((F.col("i") < 2) | (F.col("v") != 0))
    return given.groupBy(shown.alias("feature")).agg(
        F.round(F.min("v"), 6).alias("low"), F.round(F.max("v"), 6).alias("high"), F.count(F.lit(1)).alias("n"))


PRODUCT_OUT = "product_id, listing, product_name, brand_name, round(price_usd, 6) AS price_usd, rating, round(loves_count, 6) AS loves_count, primary_category, price_clp"


@query("T13_clean_products", sql(f"SELECT {PRODUCT_OUT} FROM clean_products", "clean_products"))
def _(spark, d):
    return rounded(transforms.clean_products(roles.raw_products(spark, d), RATE, ["listing"]), 6, "price_usd", "loves_count")


@query("T13_loved_brands", sql("""
    SELECT brand_name, round(avg(loves_count), 6) AS avg_loves, count(product_id) AS products FROM clean_products WHERE brand_name IS NOT NULL
    GROUP BY brand_name ORDER BY avg(loves_count) DESC, brand_name LIMIT 10""", "clean_products"))
def _(spark, d):
    return rounded(reports.loved_brands(transforms.clean_products(roles.raw_products(spark, d), RATE, ["listing"])))


REVIEW_OUT = ["author_id", "product_id", "rating", "is_recommended", "helpfulness", "total_feedback_count", "total_neg_feedback_count",
              "total_pos_feedback_count", "submission_time", "review_text", "review_title", "skin_tone", "eye_color", "skin_type", "hair_color"]


@query("T14_clean_reviews", sql(f"SELECT {', '.join(REVIEW_OUT)} FROM clean_reviews", "clean_reviews"))
def _(spark, d):
    return transforms.clean_reviews(roles.raw_reviews(spark, d), REVIEW_ORDER).select(*REVIEW_OUT)


@query("T15_clean_all", sql("""
    SELECT 'products' AS part, count(*) AS n, round(sum(price_clp), 2) AS total FROM clean_products
    UNION ALL SELECT 'reviews', count(*), round(sum(rating), 2) FROM clean_reviews
    UNION ALL SELECT 'sentiment', count(*), round(sum(sentiment_score), 2) FROM sentiment WHERE sentiment <> 'unknown'""", "clean_products", "clean_reviews", "sentiment"))
def _(spark, d):
    tables = transforms.clean_all(
        roles.raw_products(spark, d), roles.raw_reviews(spark, d), roles.raw_sentiment(spark, d), RATE, ["listing"], REVIEW_ORDER)
    parts = zip(("products", "reviews", "sentiment"), tables, ("price_clp", "rating", "sentiment_score"))
    return relate.union_by_name(
        df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum(c), 2).alias("total")) for name, df, c in parts)


# Samples -----------------------------------------------------------------------------------------


def _hash(*ids: str) -> str:
    return f"substr(md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in ids)})), 1, 15)"


@query("K05_balanced_sample", sql(f"""
    SELECT doc_id, label FROM (SELECT doc_id, coalesce(is_recommended, 0) AS label FROM document_reviews)
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY {_hash('doc_id')}, doc_id) <= 250""", "document_reviews"))
def _(spark, d):
    rows = roles.document_reviews(spark, d).select("doc_id", F.col("is_recommended").alias("label"))
    return sampling.balanced_sample(rows, "label", ["doc_id"], 500)


def _quotas(total: str) -> dict[str, str]:
    return {
        "classes": "SELECT o_orderstatus AS c, count(*) AS n, (SELECT count(*) FROM orders) AS rows FROM orders GROUP BY 1",
        "quotas": f"SELECT c, {total} AS wanted, {total}::DOUBLE * n / rows AS quota FROM classes",
        "targets": """SELECT c, floor(quota) + (row_number() OVER (ORDER BY quota - floor(quota) DESC, c)
                      <= wanted - sum(floor(quota)) OVER ())::INT AS target FROM quotas""",
        "placed": f"SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_hash('o_orderkey')}, o_orderkey) AS place FROM orders",
    }


@query("K06_stratified_split", sql("SELECT o_orderkey, o_orderstatus, place <= target AS is_test FROM placed JOIN targets ON o_orderstatus = c", **_quotas("ceil(0.2::DOUBLE * rows)")))
def _(spark, d):
    return sampling.stratified_split(roles.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"])


@query("K07_stratified_sample", sql("SELECT o_orderkey, o_orderstatus FROM placed JOIN targets ON o_orderstatus = c WHERE place <= target", **_quotas("least(1000, rows)")))
def _(spark, d):
    return sampling.stratified_sample(roles.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"], 1000)


@query("K08_uniform_sample", f"SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {_hash('o_orderkey')}, o_orderkey LIMIT 777")
def _(spark, d):
    return sampling.uniform_sample(roles.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 777)


@query("K08_repeated_ids", f"""
    SELECT l_suppkey, count(*) AS n FROM (SELECT l_suppkey FROM lineitem ORDER BY {_hash('l_suppkey')}, l_suppkey LIMIT 1001) GROUP BY 1""")
def _(spark, d):
    rows = roles.table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    return sampling.uniform_sample(rows, ["l_suppkey"], 1001).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("K05_no_usable_label", f"SELECT o_orderkey FROM orders ORDER BY {_hash('o_orderkey')}, o_orderkey LIMIT 300")
def _(spark, d):
    rows = roles.table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return sampling.balanced_sample(rows, "label", ["o_orderkey"], 300, missing=None).drop("label")


@query("K09_stratified_folds", f"""
    SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_hash('o_orderkey')}, o_orderkey) - 1) % 5 AS INT) AS fold FROM orders""")
def _(spark, d):
    return sampling.stratified_folds(roles.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"])
