"""The most frequent values of columns, exactly, without a shuffle of all distinct values.

A first pass summarises the values of each task in a bounded number of counters; where these run full, all of them are
lowered by the same amount, which bounds what any value can have lost. Added up, the counters give each value a least
count, and the losses a common bound for what may be missing. Values whose bound cannot reach the k-th least count are out
for certain; the others are counted exactly in a second pass. Where the bound proves nothing, since values are too
even, more counters are tried, and in the end all values are counted.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.session import written

COUNTERS = 2_048  # values per column and task that are remembered
WIDER = 8
MOST_COUNTERS = 65_536
CANDIDATES = 20_000  # values that are sent to all tasks to be counted
LONGEST = 1_000  # longer values are never sent, so that what is sent is bounded


def _cells(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(column, value) of every value that is given, as text; columns by their place."""
    values = [F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in columns.items()]
    return df.select(F.inline(F.array(*values))).where("value is not null")


class Summary:
    """Counters of one column in one task. The count of any value is at most ``lost`` above its counter, and never below."""

    def __init__(self, counters: int):
        self.counters, self.kept, self.lost = counters, Counter(), 0

    def add(self, values: Iterator[str]) -> None:
        self.kept.update(values)
        if len(self.kept) > 2 * self.counters:
            counts = np.fromiter(self.kept.values(), np.int64)
            least = int(np.partition(counts, -self.counters - 1)[-self.counters - 1])
            self.lost += least
            self.kept = Counter({v: n - least for v, n in self.kept.items() if n > least})


def _summaries(places: Sequence[int], counters: int):
    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {place: Summary(counters) for place in places}
        for batch in batches:
            for place, summary in found.items():
                summary.add(batch[f"c{place}"].dropna())
        rows = [(c, v, n, 0) for c, s in found.items() for v, n in s.kept.items()]
        rows += [(c, None, 0, s.lost) for c, s in found.items()]
        yield pd.DataFrame(rows, columns=["column", "value", "n", "lost"])

    return summed


def top_values(df: DataFrame, columns: Sequence[str], k: int, first: str = "asc", counters: int | None = None) -> DataFrame:
    """(column, value, n, place) of the ``k`` most frequent values of each column, most frequent first.

    Values are text; of equally frequent ones the smallest comes first, or the largest with ``first="desc"``. Missing
    values are left out. Columns whose summary proves nothing are tried again, or counted, without the others.
    """
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(columns)), "i int, name string")
    open_, exact, counters = dict(enumerate(columns)), [], counters or COUNTERS
    while open_:
        texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in open_.items()])
        parts = texts.mapInPandas(_summaries(list(open_), counters), "column int, value string, n long, lost long")
        summary = written(parts.groupBy("column", "value").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")), "frequent")
        bounds = _bounds(summary, k)
        proven = [i for i in open_ if bounds[i].proven]
        if proven:
            exact.append(_counted(df, {i: open_[i] for i in proven}, summary, {i: bounds[i] for i in proven}))
        counters *= WIDER
        # With so many more counters the loss is so much smaller at least; if that does not help, counting does.
        again = {i: c for i, c in open_.items() if i not in proven and counters <= MOST_COUNTERS and bounds[i].lost < WIDER * bounds[i].kth}
        rest = {i: c for i, c in open_.items() if i not in proven and i not in again}
        if rest:
            exact.append(_cells(df, rest).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        open_ = again
    counts = reduce(DataFrame.unionAll, exact) if exact else spark.createDataFrame([], "column int, value string, n long")
    ordered = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value") if first == "asc" else F.desc("value"))
    ranked = counts.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k)
    return ranked.join(F.broadcast(names), F.col("column") == F.col("i")).select(F.col("name").alias("column"), "value", "n", "place")


class Bound(NamedTuple):
    """Of one column: what a value may have lost, the k-th largest least count, and whether there are k."""

    lost: int = 0
    kth: int = 0
    full: bool = False

    @property
    def proven(self) -> bool:
        """A value without a counter has at most what was lost; it must be fewer than the k-th has for certain."""
        return self.lost == 0 or (self.full and self.lost < self.kth)


def _bounds(summary: DataFrame, k: int) -> dict[int, Bound]:
    # Tasks keep k rows per column before the shuffle, so the k-th least count is cheap to find.
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n")))
    least = summary.where("value is not null").withColumn("_place", place).where(F.col("_place") <= k)
    kth = least.groupBy("column").agg(F.min("n").alias("kth"), F.count(F.lit(1)).alias("found"))
    rows = summary.where("value is null").select("column", "lost").join(kth, "column", "left").collect()
    return defaultdict(Bound, {r["column"]: Bound(r["lost"], r["kth"] or 0, r["found"] == k) for r in rows})


def _counted(df: DataFrame, columns: dict[int, str], summary: DataFrame, bounds: dict[int, Bound]) -> DataFrame:
    """Exact counts of all values that may be among the first ``k`` of proven columns."""
    least = summary.where("value is not null").select("column", "value", "n")
    whole = [i for i, bound in bounds.items() if bound.lost == 0]  # nothing was lost: the counters are the counts
    some = {i: c for i, c in columns.items() if i not in whole}
    sure = least.where(F.col("column").isin(whole))
    if not some:
        return sure
    reach = reduce(or_, [(F.col("column") == i) & (F.col("n") + bounds[i].lost >= bounds[i].kth) for i in some])
    asked = least.where(reach).select("column", "value")
    sent = asked.where(F.length("value") <= LONGEST).limit(CANDIDATES + 1).collect()
    if len(sent) > CANDIDATES or not asked.where(F.length("value") > LONGEST).isEmpty():
        wanted = asked
    else:
        wanted = F.broadcast(df.sparkSession.createDataFrame(sent, asked.schema))
    counted = _cells(df, some).join(wanted, ["column", "value"]).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return sure.unionAll(counted.select("column", "value", "n"))
