"""Exact interpolated quantiles without holding a column's values in one place.

All columns are melted into (column, value) pairs and counted per distinct value, so the input is computed
once and a value that many rows share is one row. The counts are put into value ranges, one per task, and
written. The driver gets one row count per range, which tells the range that holds each wanted rank; the values
at these ranks are then read off running counts inside those ranges. No task sees more than a range.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.session import written


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column] | Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column (nulls and NaN left out)."""
    if not isinstance(columns, Mapping):
        columns = {name: F.col(name) for name in columns}
    if not columns:
        return {}
    ranged = _value_ranges(df, list(columns.values()))
    totals: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for row in ranged.groupBy("i", "part").agg(F.sum("n").alias("n")).orderBy("i", "part").collect():
        totals[row["i"]].append((row["part"], row["n"]))
    sizes = {i: sum(n for _, n in parts) for i, parts in totals.items()}
    ranks = {(i, rank) for i, size in sizes.items() for p in probs for rank in ranks_of(p, size)}
    found = values_at(ranged, totals, ranks)
    return {
        name: [between(p, sizes[i], lambda rank, i=i: found[i, rank]) if i in sizes else None for p in probs]
        for i, name in enumerate(columns)
    }


def _value_ranges(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """(i, v, n, part): how often column ``i`` has the value; parts are in order of (i, v)."""
    values = df.select(F.posexplode(F.array(*[c.cast("double") for c in columns])).alias("i", "v"))
    # Adding zero makes one value of both zeros.
    counts = values.where("v is not null and not isnan(v)").groupBy("i", (F.col("v") + 0.0).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return written(counts.repartitionByRange("i", "v").withColumn("part", F.spark_partition_id()), "value-ranges")


def ranks_of(prob: float, size: int) -> tuple[int, int]:
    position = prob * (size - 1)
    return math.floor(position), math.ceil(position)


def between(prob: float, size: int, value) -> float:
    """The values at the ranks on both sides, weighted as the built-in percentile weighs them."""
    low, high = ranks_of(prob, size)
    weight = prob * (size - 1) - low
    return value(low) if low == high else (1 - weight) * value(low) + weight * value(high)


def values_at(ranged: DataFrame, totals: Mapping[int, list[tuple[int, int]]], ranks: set[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """The value of column ``i`` at each (i, rank), from (i, v, n, part) rows and the number of rows per part of each column."""
    wanted = []
    for i, rank in sorted(ranks):
        below = 0
        for part, n in totals[i]:
            if rank < below + n:
                wanted.append((i, part, rank, rank - below))
                break
            below += n
    if not wanted:
        return {}
    # An Arrow table becomes a local relation, which needs no Python worker.
    places = pa.table(dict(zip(("i", "part", "rank", "place"), zip(*wanted))))
    asked = F.broadcast(ranged.sparkSession.createDataFrame(places, "i int, part int, rank bigint, place bigint"))
    touched = sorted({part for _, part, _, _ in wanted})
    inside = Window.partitionBy("i", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.where(F.col("part").isin(touched)).withColumn("upto", F.sum("n").over(inside))
    hits = placed.join(asked, ["i", "part"]).where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
    return {(r["i"], r["rank"]): r["v"] for r in hits.select("i", "rank", "v").collect()}
