"""Column renaming, dropping, null handling, filters and searches on whole frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructType,
)

from shelfsight.functions import numbers, text
from shelfsight.schemas import (
    CSV_NULL_TOKENS,
    DEMOGRAPHIC_COLUMNS,
    DEMOGRAPHIC_NULL_TOKENS,
    FEEDBACK_COLUMNS,
    JOIN_LEFTOVERS,
    JOIN_RENAMES,
    PRODUCT_SCHEMA,
    REVIEW_SCHEMA,
    TEXT_NULL_TOKENS,
)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, other) column names, in order."""
    numeric = numeric_columns(df)
    return numeric, [c for c in df.columns if c not in numeric]


def each(df: DataFrame, columns: Iterable[str], change: Callable[[Column], Column]) -> DataFrame:
    """``change`` applied to those of ``columns`` that exist."""
    return df.withColumns({c: change(F.col(c)) for c in columns if c in df.columns})


def rename_simple(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.simple_name(c) for c in df.columns])


def rename_full(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.full_name(c) for c in df.columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def rename_joined(
    df: DataFrame, renames: Mapping[str, str] = JOIN_RENAMES, leftovers: Iterable[str] = JOIN_LEFTOVERS
) -> DataFrame:
    """Drops the product-side copies of shared columns and gives the review-side ones their names back."""
    return df.drop(*leftovers).withColumnsRenamed(dict(renames))


def null_tokens(df: DataFrame, tokens: Sequence[str] = CSV_NULL_TOKENS) -> DataFrame:
    return each(df, text_columns(df), lambda c: text.null_if_in(c, tokens))


def clean_text_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    names = text_columns(df) if columns is None else columns
    # Two steps, so that each text is trimmed once although the second looks at it twice.
    return each(each(df, names, text.strip), names, lambda c: text.null_if_in(c, TEXT_NULL_TOKENS))


def unknown_to_null(df: DataFrame, columns: Iterable[str] | None = None, ignore_case: bool = True) -> DataFrame:
    names = text_columns(df) if columns is None else columns
    return each(df, names, lambda c: text.null_if_unknown(c, ignore_case))


def clean_demographics(df: DataFrame, columns: Iterable[str] = tuple(DEMOGRAPHIC_COLUMNS)) -> DataFrame:
    lowered = each(df, columns, lambda c: F.lower(text.strip(c)))
    return each(lowered, columns, lambda c: text.null_if_in(c, DEMOGRAPHIC_NULL_TOKENS))


def as_number(df: DataFrame, name: str) -> Column:
    """The column as double, null where it holds no number."""
    return numbers.to_number(F.col(f"`{name}`"), df.schema[name].dataType)


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_number(df, c) for c in columns if c in df.columns})


def fill_feedback(df: DataFrame, columns: Iterable[str] = tuple(FEEDBACK_COLUMNS)) -> DataFrame:
    return df.withColumns({c: F.coalesce(as_number(df, c), F.lit(0.0)) for c in columns if c in df.columns})


def add_catalog_columns(df: DataFrame) -> DataFrame:
    """Lengths and presence flags for whichever source columns exist."""
    derived = {
        "description": ("description_length", F.length),
        "img": ("has_image", Column.isNotNull),
        "shade_img": ("has_shade_image", Column.isNotNull),
    }
    return df.withColumns(
        {name: make(F.col(source)) for source, (name, make) in derived.items() if source in df.columns}
    )


def clean_catalog(df: DataFrame) -> DataFrame:
    """Cleaning of the older catalog layout."""
    named = df.toDF(*[c.strip().lower() for c in df.columns])
    typed = each(named, ["product_type"], text.clean_product_type)
    return add_catalog_columns(typed).drop("rating", "dupes", "price_site")


def as_served(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns and types of ``schema``; columns ``df`` lacks are null."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def served_products(df: DataFrame, sources: Mapping[str, str] | None = None) -> DataFrame:
    """The served product table; ``sources`` names, for served columns, the input columns they come from.

    Files call the flag of goods sold in one store only by the store's name, as in
    ``{"store_exclusive": "some_store_exclusive"}``.
    """
    return as_served(df.withColumns({to: F.col(f"`{source}`") for to, source in (sources or {}).items()}), PRODUCT_SCHEMA)


def served_reviews(df: DataFrame) -> DataFrame:
    return as_served(df, REVIEW_SCHEMA)


def narrow_types(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``df`` with the smallest fitting numeric types, report per column).

    The report also tells which text columns repeat so much that dictionary encoding pays.
    Integers that fit none of the smaller types stay long.
    """
    whole = [f.name for f in df.schema if isinstance(f.dataType, IntegralType)]
    fractions = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    texts = text_columns(df)
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(f"min_{c}") for c in whole], *[F.max(c).alias(f"max_{c}") for c in whole],
    ).first()

    def fit(name: str):
        low, high = stats[f"min_{name}"], stats[f"max_{name}"]
        if low is None:
            return df.schema[name].dataType
        for kind, bits in ((ByteType(), 7), (ShortType(), 15), (IntegerType(), 31)):
            if -(1 << bits) <= low and high < (1 << bits):
                return kind
        return LongType()

    target = {**{c: fit(c) for c in whole}, **{c: FloatType() for c in fractions}}
    # Distinct texts: one shuffle of (column, value) pairs, already collapsed per task.
    distinct = {c: 0 for c in texts}
    if texts:
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts
        ]))).where("value is not null")
        distinct.update(
            {r["column"]: r["n"] for r in pairs.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        )
    report = df.sparkSession.createDataFrame(
        [
            (
                c, df.schema[c].dataType.simpleString(), target.get(c, df.schema[c].dataType).simpleString(),
                distinct.get(c), c in texts and stats["n"] > 0 and distinct[c] / stats["n"] < 0.5,
            )
            for c in df.columns
        ],
        "column string, from_type string, to_type string, distinct_values long, category boolean",
    )
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in target.items()}), report


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


# Filters -----------------------------------------------------------------------------------------


def with_keys(df: DataFrame, keys: Sequence[str] = ("author_id", "product_id")) -> DataFrame:
    return df.dropna(subset=list(keys))


def with_label(df: DataFrame, label: str = "is_recommended") -> DataFrame:
    """Rows whose label is a number, with the label as a number."""
    return coerce_numbers(df, [label]).where(F.col(label).isNotNull())


def rating_in_range(df: DataFrame, fill: float | None, low: float = 1, high: float = 5) -> DataFrame:
    """Missing ratings take ``fill``; rows outside [low, high] go."""
    rating = F.coalesce(as_number(df, "rating"), F.lit(fill).cast("double"))
    return df.withColumn("rating", rating).where(F.col("rating").between(low, high))


def positive_price(df: DataFrame) -> DataFrame:
    return df.where(F.col("price_usd") > 0)


def known_sentiment(df: DataFrame) -> DataFrame:
    # A missing label is not 'unknown', so it stays.
    kept = df.where(F.coalesce(F.col("sentiment") != "unknown", F.lit(True)))
    if "sentiment_score" in df.columns:
        kept = kept.withColumn("sentiment_score", F.coalesce(as_number(kept, "sentiment_score"), F.lit(0.0)))
    return coerce_numbers(kept, ["is_recommended"])


def with_valid_text(df: DataFrame, column: str = "review_text", longer_than: int = 10) -> DataFrame:
    return df.where(F.length(text.strip(F.col(column))) > longer_than)


def _check(name: str, value, low: float | None = None, high: float | None = None) -> None:
    if value is None:
        return
    if (low is not None and value < low) or (high is not None and value > high):
        raise ValueError(f"{name}={value} must lie in [{low}, {high if high is not None else 'any'}]")


def check_page(limit: int, offset: int, max_limit: int) -> None:
    _check("limit", limit, 1, max_limit)
    _check("offset", offset, 0)


def _all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def find_products(
    df: DataFrame,
    category: str | None = None,
    brand: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Products meeting every given condition; names compare without case."""
    _check("min_price", min_price, 0)
    _check("max_price", max_price, 0)
    conditions = []
    if category:
        conditions.append(F.lower("primary_category") == category.lower())
    if brand:
        conditions.append(F.lower("brand_name") == brand.lower())
    if min_price is not None:
        conditions.append(F.col("price_usd") >= min_price)
    if max_price is not None:
        conditions.append(F.col("price_usd") <= max_price)
    return df.where(_all_of(conditions))


def product_by_id(df: DataFrame, product_id: str) -> DataFrame:
    return df.where(F.col("product_id") == product_id)


def find_reviews(
    df: DataFrame,
    product_id: str | None = None,
    min_rating: float | None = None,
    is_recommended: int | None = None,
) -> DataFrame:
    _check("min_rating", min_rating, 1, 5)
    _check("is_recommended", is_recommended, 0, 1)
    conditions = []
    if product_id:
        conditions.append(F.col("product_id") == product_id)
    if min_rating is not None:
        conditions.append(F.col("rating") >= min_rating)
    if is_recommended is not None:
        conditions.append(F.col("is_recommended") == float(is_recommended))
    return df.where(_all_of(conditions))


def catalog_slice(
    df: DataFrame,
    category: str | None = None,
    brand: str | None = None,
    low: float = 0.0,
    high: float | None = None,
) -> DataFrame:
    """Exact category and brand, and a price band (the top of the band defaults to the highest price)."""
    conditions = [F.col("price_usd") >= low]
    if high is not None:
        conditions.append(F.col("price_usd") <= high)
    if category:
        conditions.append(F.col("primary_category") == category)
    if brand:
        conditions.append(F.col("brand_name") == brand)
    return df.where(_all_of(conditions))


def brand_choices(df: DataFrame, category: str | None = None) -> DataFrame:
    """Brands to choose from, within a category if one is chosen."""
    chosen = df if not category else df.where(F.col("primary_category") == category)
    return chosen.where("brand_name is not null").select("brand_name").distinct().orderBy("brand_name")
