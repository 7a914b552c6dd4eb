"""Column profiles. Wide statistics come from one aggregation per kind and are then laid out as rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.clean import numeric_columns, text_columns
from shelfsight.operators.quantiles import exact_quantiles

GRAM_ROWS = 2048  # rows that are multiplied at a time
GRAM_SHIFT = 1000  # rows that show where the values of a column lie


def _as_rows(stats: DataFrame, names: Sequence[str], parts: Mapping[str, str]) -> DataFrame:
    """A one-row frame with columns ``<part>_<i>`` as one row per name."""
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), *[F.col(f"{part}_{i}").alias(out) for part, out in parts.items()])
        for i, name in enumerate(names)
    ])))


def _number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _quantile_rows(df: DataFrame, names: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    found = exact_quantiles(df, {c: _number(c) for c in names}, list(probs.values()))
    return df.sparkSession.createDataFrame(
        [(c, *found[c]) for c in names], ", ".join(["column string", *[f"{p} double" for p in probs]])
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column."""
    names = list(columns or numeric_columns(df))
    makers = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    stats = df.agg(*[make(_number(c)).alias(f"{m}_{i}") for i, c in enumerate(names) for m, make in makers.items()])
    rows = _as_rows(stats, names, {m: m for m in makers})
    quartiles = _quantile_rows(df, names, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return rows.join(F.broadcast(quartiles), "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _absent(df: DataFrame) -> list[Column]:
    """Per column, whether a value is missing; NaN counts as missing."""
    columns = [(F.col(f"`{f.name}`"), f.dataType.simpleString()) for f in df.schema]
    return [col.isNull() | F.isnan(col) if kind in ("double", "float") else col.isNull() for col, kind in columns]


def missing_summary(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Missing values and their percentage per column, most first, with the total over all columns."""
    names = df.columns
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(absent).alias(f"missing_{i}") for i, absent in enumerate(_absent(df))])
    total = sum((F.col(f"missing_{i}") for i in range(len(names))), F.lit(0).cast("bigint"))
    rows = stats.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"missing_{i}").alias("missing"),
            F.round(F.col(f"missing_{i}") * 100.0 / F.when(F.col("n") > 0, F.col("n")), 2).alias("pct"),
            total.alias("total_missing"),
        )
        for i, c in enumerate(names)
    ])))
    ordered = rows.orderBy(F.desc("missing"), "column")
    return ordered if top_n is None else ordered.limit(top_n)


def text_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of every distinct non-null value: one shuffle of per-task counts."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])))
    return cells.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, most frequent value (smallest on ties) and its frequency per text column."""
    names = list(columns or text_columns(df))
    return text_values(df, names).groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"),
    )


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct non-null values per column; ``exact=False`` estimates without a shuffle of values."""
    names = list(columns or text_columns(df))
    if exact:
        return text_values(df, names).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    stats = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(f"distinct_{i}") for i, c in enumerate(names)])
    return _as_rows(stats, names, {"distinct": "distinct_values"})


def _row_digest(df: DataFrame) -> Column:
    """256 bits of a row's values; lengths and nulls are part of it, so that values cannot run together."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column, and their percentage. Digests of rows are shuffled, not rows."""
    distinct = df.groupBy(_row_digest(df).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    ).withColumn("pct", F.round(F.col("duplicates") * 100.0 / F.when(F.col("total_rows") > 0, F.col("total_rows")), 4))


def dataset_report(df: DataFrame, id_column: str) -> DataFrame:
    """Shape, duplicate rows, distinct ids and missing values as (metric, value) rows; the table is read once.

    Equal rows are equal in their id and in what they miss, so everything is counted over the digests of rows.
    """
    mask = F.concat(*[F.when(absent, "1").otherwise("0") for absent in _absent(df)])
    rows = df.groupBy(_row_digest(df).alias("_row"), F.col(f"`{id_column}`").alias("_id"), mask.alias("_mask")).agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(0).cast("bigint")
    counts = rows.agg(
        F.coalesce(F.sum("_n"), none).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), none).alias("duplicates"), F.count_distinct("_id").alias("ids"),
        *[F.coalesce(F.sum(F.when(F.substring("_mask", i + 1, 1) == "1", F.col("_n"))), none).alias(f"missing_{i}") for i in range(len(df.columns))],
    )
    metrics = [
        ("rows", F.col("rows")), ("columns", F.lit(len(df.columns)).cast("bigint")), ("duplicates", F.col("duplicates")), ("unique_ids", F.col("ids")),
        *[(f"missing:{c}", F.col(f"missing_{i}")) for i, c in enumerate(df.columns)],
    ]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics])))


def dataset_metadata(df: DataFrame, file: str) -> DataFrame:
    """Rows, columns and missing values per column of one dataset, a row per column."""
    missing = missing_summary(df).select("column", "missing")
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    place = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
    return missing.select(
        F.lit(file).alias("file"), rows.alias("rows"), F.lit(len(df.columns)).alias("columns"),
        place[F.col("column")].alias("position"), "column", "missing",
    )


def mixed_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: values that read as numbers, as dates, and as neither."""
    names = list(columns or text_columns(df))
    kinds = {}
    for i, c in enumerate(names):
        col = F.col(f"`{c}`")
        is_number = col.rlike(r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
        is_date = col.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}") & ~is_number
        kinds[f"numbers_{i}"] = F.count_if(is_number)
        kinds[f"dates_{i}"] = F.count_if(is_date)
        kinds[f"others_{i}"] = F.count_if(col.isNotNull() & ~is_number & ~is_date)
    stats = df.agg(*[agg.alias(name) for name, agg in kinds.items()])
    rows = _as_rows(stats, names, {"numbers": "numbers", "dates": "dates", "others": "others"})
    present = sum(((F.col(k) > 0).cast("int") for k in ("numbers", "dates", "others")), F.lit(0))
    return rows.withColumn("mixed", present > 1)


def _gram(names: int, shift: np.ndarray):
    """Per task, for every pair of columns over the rows where both are given: count, sum and sum of squares of the
    first, sum of products. Four matrix products per slice of rows; rows of the sums are what leaves the task."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, names, names))
        for batch in batches:
            for at in range(0, len(batch), GRAM_ROWS):
                x = np.array(batch["x"].iloc[at : at + GRAM_ROWS].to_list(), dtype=float) - shift
                given = ~np.isnan(x)
                x[~given] = 0.0
                mask = given.astype(float)
                total += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        if total[0].any():
            yield pd.DataFrame({"a": np.arange(names), **{k: list(total[i]) for i, k in enumerate(("n", "s", "q", "p"))}})

    return sums


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, each over the rows where both are given; null where one of them is constant.

    One pass, whatever the number of columns: tasks multiply blocks of rows with the mask of what is given, and the sums
    of all tasks are added by pair. Values are taken from a typical value of their column first, so that large ones
    lose no digits.
    """
    names = list(columns or numeric_columns(df))
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "a string, b string, r double")
    values = df.select(F.array(*[F.coalesce(_number(c), F.lit(float("nan"))) for c in names]).alias("x"))
    near = np.array([row["x"] for row in values.limit(GRAM_SHIFT).collect()], dtype=float).reshape(-1, len(names))
    # A value of the column itself, so that a constant one leaves exact zeros.
    shift = np.array([float(np.quantile(c[np.isfinite(c)], 0.5, method="lower")) if np.isfinite(c).any() else 0.0 for c in near.T])
    kind = "a int, n array<double>, s array<double>, q array<double>, p array<double>"
    rows = values.mapInPandas(_gram(len(names), shift), kind)
    cells = rows.select("a", F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("b", "v")).select("a", "b", "v.*")
    pairs = cells.groupBy("a", "b").agg(*[F.sum(k).alias(k) for k in ("n", "s", "q", "p")])
    # What the sums of the second column of a pair are stands at the pair turned round, so both go to one group.
    low, high = F.least("a", "b"), F.greatest("a", "b")
    first = F.col("a") <= F.col("b")
    both = pairs.groupBy(low.alias("i"), high.alias("j")).agg(
        F.max("n").alias("n"), F.max("p").alias("p"),
        *[F.sum(F.when(side, F.col(k))).alias(f"{k}{x}") for k in ("s", "q") for x, side in (("a", first), ("b", ~first))],
    )
    spread = (F.col("n") * F.col("qa") - F.col("sa") ** 2) * (F.col("n") * F.col("qb") - F.col("sb") ** 2)
    r = (F.col("n") * F.col("p") - F.col("sa") * F.col("sb")) / F.sqrt(F.when(spread > 0, spread))
    found = both.where("i < j").select("i", "j", F.when(spread > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
    place = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    ends = found.join(F.broadcast(place), "i").withColumnRenamed("name", "a").join(F.broadcast(place.toDF("j", "b")), "j")
    # Pairs without a common row leave no sums.
    every = place.select(F.col("i"), F.col("name").alias("a"), F.explode(F.lit(names)).alias("b"))
    turned = ends.select("a", "b", "r").unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    return every.join(turned, ["a", "b"], "left").select("a", "b", F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.col("r")).alias("r"))


def correlations_with(df: DataFrame, reference: str, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """The ``n`` highest and ``n`` lowest correlations with one column."""
    names = list(columns or numeric_columns(df))
    rows = correlations(df, names).where((F.col("a") == reference) & (F.col("b") != reference) & F.col("r").isNotNull())
    top = rows.orderBy(F.desc("r"), "b").limit(n).withColumn("side", F.lit("top"))
    bottom = rows.orderBy("r", "b").limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", F.col("b").alias("column"), "r")


def distribution_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, median and 99th percentile per numeric column."""
    names = list(columns or numeric_columns(df))
    means = _as_rows(df.agg(*[F.avg(_number(c)).alias(f"mean_{i}") for i, c in enumerate(names)]), names, {"mean": "mean"})
    return means.join(F.broadcast(_quantile_rows(df, names, {"median": 0.5, "p99": 0.99})), "column")


def outlier_summary(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    """Quartiles, fences, and how many values lie beyond them, per numeric column."""
    names = list(columns or numeric_columns(df))
    found = exact_quantiles(df, {c: _number(c) for c in names}, [0.25, 0.5, 0.75])
    rows, counts = [], []
    for i, c in enumerate(names):
        q1, q2, q3 = found[c]
        low, high = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        rows.append((c, q1, q2, q3, low, high))
        beyond = F.lit(False) if q1 is None else (_number(c) < low) | (_number(c) > high)
        counts.append(F.count_if(beyond).alias(f"outliers_{i}"))
    fences = df.sparkSession.createDataFrame(
        rows, "column string, q1 double, median double, q3 double, lower double, upper double"
    )
    counted = _as_rows(df.agg(*counts), names, {"outliers": "outliers"})
    return F.broadcast(fences).join(counted, "column")


def null_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Which columns are missing together: a string of 0/1 flags per row, counted."""
    names = list(columns or df.columns)
    flags = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in names])
    return df.groupBy(flags.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
