"""Joins, unions, keep-first and paging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.operators.clean import check_page, require_columns
from shelfsight.session import written


def _suffixed(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    shared = [c for c in left.columns if c in right.columns and c != key]
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in shared}),
        right.withColumnsRenamed({c: f"{c}_y" for c in shared}),
    )


def reviews_with_products(
    reviews: DataFrame, products: DataFrame, key: str = "product_id", salts: int = 0
) -> DataFrame:
    """Every review with its product; names both sides share end in ``_x`` and ``_y``.

    Spark broadcasts the products where its own size estimate allows it and otherwise shuffles, with
    adaptive execution splitting partitions that a hot product makes too long. ``salts`` > 1 splits
    every product's reviews into that many parts up front, for sessions without adaptive execution;
    the products are then repeated once per part.
    """
    require_columns(reviews, [key], "reviews")
    require_columns(products, [key], "products")
    left, right = _suffixed(reviews, products, key)
    if salts <= 1:
        return left.join(right, key, "left")
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, "_salt"], "left").drop("_salt")


def not_in_cache(df: DataFrame, cache: DataFrame, key: str = "author_id") -> DataFrame:
    """Rows whose key, read as text, the cache does not hold. A missing key is never cached."""
    known = cache.select(F.col(key).cast("string").alias("_known"))
    return df.join(known, df[key].cast("string") == known["_known"], "left_anti")


def with_rate(products: DataFrame, rates: DataFrame, rate: str = "rate") -> DataFrame:
    """Every product with the latest rate, looked up once as a scalar subquery."""
    latest = rates.agg(F.max_by("rate", "loaded_at").alias("rate"))
    return products.withColumn(rate, latest.scalar())


def compare_manifests(current: DataFrame, saved: DataFrame) -> DataFrame:
    """File by file: ok, changed, new, or gone."""
    now = current.select("file", F.col("sha256").alias("sha256"))
    then = saved.select("file", F.col("sha256").alias("saved_sha256"))
    status = (
        F.when(F.col("saved_sha256").isNull(), "new")
        .when(F.col("sha256").isNull(), "gone")
        .when(F.col("sha256") != F.col("saved_sha256"), "changed")
        .otherwise("ok")
    )
    return now.join(then, "file", "full_outer").withColumn("status", status)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``. Null keys form one group.

    Spark keeps one row per key in every task before it shuffles (the filter on the row number limits
    the groups early), so a key held by very many rows does not reach one task in full.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def attach(df: DataFrame, found: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` of ``found``, which has one row per ``key``; null where there is none.

    Serves cross-tables of cluster and label. Spark decides how to join from the sizes of both sides.
    """
    side = found.select(F.col(key).alias("_key"), *columns)
    return df.join(side, df[key] == side["_key"], "left").drop("_key")


SHALLOW = 10_000  # rows that one task may skip


def page(df: DataFrame, order: Sequence[str], limit: int = 50, offset: int = 0, max_limit: int = 500) -> DataFrame:
    """One page of a table in a fixed order, nulls first.

    Few rows are skipped in one task. For a deeper page, the order columns are put into ranges, the rows per range tell
    which of them holds the offset, and the key found there starts the page; no task gets more than a range.
    """
    check_page(limit, offset, max_limit)
    if offset <= SHALLOW:
        return df.orderBy(*order).offset(offset).limit(limit)
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(order))]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranged = written(counts.repartitionByRange(*names).withColumn("_part", F.spark_partition_id()), "page-ranges")
    below = 0
    for row in ranged.groupBy("_part").agg(F.sum("_n").alias("n")).orderBy("_part").collect():
        if offset < below + row["n"]:
            upto = Window.partitionBy("_part").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
            inside = ranged.where(F.col("_part") == row["_part"]).withColumn("_upto", F.sum("_n").over(upto) + below)
            first = inside.where(F.col("_upto") > offset).orderBy(*names).first()
            skip = offset - (first["_upto"] - first["_n"])
            return df.where(_from_key(order, [first[n] for n in names], df, True)).orderBy(*order).offset(skip).limit(limit)
        below += row["n"]
    return df.limit(0)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence | None = None, limit: int = 50, max_limit: int = 500) -> DataFrame:
    """The page after the row whose ``order`` columns have the values ``last`` (the first page without).

    ``order`` has to tell rows apart. A page costs the same at any depth: a filter that reaches the scan, and the first
    rows of what it leaves.
    """
    check_page(limit, 0, max_limit)
    rows = df if last is None else df.where(_from_key(order, list(last), df, False))
    return rows.orderBy(*order).limit(limit)


def _from_key(order: Sequence[str], key: Sequence, df: DataFrame, inclusive: bool) -> Column:
    """Rows whose order columns come after the key (or, ``inclusive``, are the key); nulls come first."""
    found = F.lit(inclusive)
    for name, value in reversed(list(zip(order, key, strict=True))):
        col, at = F.col(f"`{name}`"), F.lit(value).cast(df.schema[name].dataType)
        greater = col.isNotNull() if value is None else F.coalesce(col > at, F.lit(False))
        found = greater | (col.eqNullSafe(at) & found)
    return found


def most_loved(df: DataFrame, n: int = 100) -> DataFrame:
    return (
        df.select("product_name", "brand_name", "primary_category", "price_usd", "rating", "loves_count", "product_id")
        .orderBy(F.desc_nulls_last("loves_count"), "product_id")
        .limit(n)
        .drop("product_id")
    )
