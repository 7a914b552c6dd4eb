"""Exact, repeatable samples, splits and folds.

Rows are ordered by a hash of a seed and their id columns, so a sample does not depend on file or
partition order. Taking the first n rows of a class never sorts the class: the hash is uniform, so
equal-width hash ranges split any class evenly, whatever its size. Counting rows per (class, range)
shows which range holds the n-th row; only the rows of that range are ordered. Everything below is
taken by a plain filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from shelfsight.session import broadcast_if_small

HASH_BITS = 60
RANGE_BITS = 16
# Up to so many classes, their cuts are part of the flag's expression.
FEW_CLASSES = 32


def sample_hash(ids: Sequence[str], seed: int = 42) -> Column:
    """A repeatable 60-bit number per row."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _hash_range(hash_name: str) -> Column:
    return F.shiftright(F.col(hash_name), HASH_BITS - RANGE_BITS).cast("int")


def mark_per_class(
    df: DataFrame,
    classes: Sequence[str],
    ids: Sequence[str],
    targets: Callable[[DataFrame], DataFrame],
    seed: int = 42,
    flag: str = "_taken",
    hashed_as: str | None = None,
) -> DataFrame:
    """``df`` with a flag that is true for exactly the first ``target`` rows of each class in hash order.

    ``targets`` gets one row per class (the class columns and ``n``) and adds ``target``. Rows may repeat an
    id: a cut among them goes by their other columns. That costs a second pass over ``df``, which unique ids do not.
    ``hashed_as`` names a column that already holds the rows' :func:`sample_hash`, for frames that are read often.
    """
    hash_of = sample_hash(ids, seed) if hashed_as is None else F.col(hashed_as)
    keyed = df.select(*classes, *ids, hash_of.alias("_h")).withColumn("_r", _hash_range("_h"))
    # At most 2 ** RANGE_BITS counts per class, looked at several times below.
    ranges = keyed.groupBy(*classes, "_r").agg(F.count(F.lit(1)).alias("_rows")).persist()
    upto = Window.partitionBy(*classes).orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    wanted = targets(ranges.groupBy(*classes).agg(F.sum("_rows").alias("n"))).select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(classes)], F.col("target").alias("_target")
    )
    placed = ranges.withColumn("_upto", F.sum("_rows").over(upto))
    cuts = (
        placed.join(wanted, _same_class(placed, wanted, classes))
        .where((F.col("_upto") >= F.col("_target")) & (F.col("_upto") - F.col("_rows") < F.col("_target")))
        .select(
            *[f"_c{i}" for i in range(len(classes))],
            F.col("_r").alias("_cut"),
            (F.col("_target") - F.col("_upto") + F.col("_rows")).alias("_need"),
        )
    )
    cuts = broadcast_if_small(cuts)
    ranges.unpersist()
    class_keys = [f"_c{i}" for i in range(len(classes))]
    by_hash = Window.partitionBy(*class_keys).orderBy("_h", *ids)
    # The id the cut falls on, how many rows have it, and how many of these are taken.
    last = broadcast_if_small(
        keyed.join(cuts, _same_class(keyed, cuts, classes) & (F.col("_r") == F.col("_cut")))
        .withColumn("_first", F.rank().over(by_hash)).withColumn("_place", F.row_number().over(by_hash))
        .withColumn("_equal", F.count(F.lit(1)).over(Window.partitionBy(*class_keys, "_h", *ids)))
        .withColumn("_alike", F.count(F.lit(1)).over(Window.partitionBy(*class_keys, "_h")))
        .where(F.col("_place") == F.col("_need"))
        .select(*class_keys, F.struct("_h", *ids).alias("_last"), "_equal", "_alike", (F.col("_need") - F.col("_first") + 1).alias("_of_last"))
    )
    ties = last.agg(F.max(F.col("_of_last") < F.col("_equal")).alias("ids"), F.max(F.col("_alike") > F.col("_equal")).alias("hashes")).first()
    if not ties["ids"] and not ties["hashes"]:
        # The hash alone tells the rows apart; the ids would be needed where another id has the hash the cut falls on.
        few = last.limit(FEW_CLASSES + 1).collect()
        if len(few) <= FEW_CLASSES:
            return df.select(*df.columns, F.coalesce(hash_of <= _last_hash(df, few, classes), F.lit(False)).alias(flag))
    hashed = df.withColumn("_h", hash_of)
    position = F.struct("_h", *[hashed[c] for c in ids])
    placed = hashed.join(last, _same_class(hashed, last, classes), "left")
    columns = [hashed[c] for c in df.columns]
    if not ties["ids"]:
        return placed.select(*columns, F.coalesce(position <= F.col("_last"), F.lit(False)).alias(flag))
    # Ids repeat where a class is cut: of the rows with that id, the first by all their columns are taken.
    split = F.coalesce((position == F.col("_last")) & (F.col("_of_last") < F.col("_equal")), F.lit(False))
    order = Window.partitionBy(*class_keys).orderBy(F.xxhash64(*columns), *columns)
    whole = placed.where(~split).select(*columns, F.coalesce(position <= F.col("_last"), F.lit(False)).alias(flag))
    return whole.unionByName(placed.where(split).select(*columns, (F.row_number().over(order) <= F.col("_of_last")).alias(flag)))


def _last_hash(df: DataFrame, few: Sequence[Row], classes: Sequence[str]) -> Column:
    """The last hash taken of a row's class, null where none is, without a join."""
    found = F.lit(None).cast("bigint")
    for row in few:
        same = F.lit(True)
        for i, c in enumerate(classes):
            same = same & F.col(c).eqNullSafe(F.lit(row[f"_c{i}"]).cast(df.schema[c].dataType))
        found = F.when(same, F.lit(row["_last"]["_h"])).otherwise(found)
    return found


def take_per_class(
    df: DataFrame,
    classes: Sequence[str],
    ids: Sequence[str],
    targets: Callable[[DataFrame], DataFrame],
    seed: int = 42,
) -> DataFrame:
    """Only the rows ``mark_per_class`` flags."""
    return mark_per_class(df, classes, ids, targets, seed).where("_taken").drop("_taken")


def _same_class(left: DataFrame, right: DataFrame, classes: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, c in enumerate(classes):
        condition = condition & left[c].eqNullSafe(right[f"_c{i}"])
    return condition


def balanced_sample(
    df: DataFrame, label: str, ids: Sequence[str], size: int = 500, seed: int = 42, missing: int | None = 0
) -> DataFrame:
    """Up to ``size // 2`` rows of each class; a label that is missing or no number counts as class ``missing``.

    With ``missing=None`` such rows are left out. If no row has a usable label there are no classes to
    balance, and the sample is uniform: ``size`` rows with a null label.
    """
    number = F.col(label).try_cast("double").cast("int")
    if missing is None:
        labelled = df.withColumn(label, number)
        known = labelled.where(F.col(label).isNotNull())
        if known.isEmpty():
            return uniform_sample(labelled, ids, size, seed)
        labelled = known
    else:
        labelled = df.withColumn(label, F.coalesce(number, F.lit(missing)))
    return take_per_class(
        labelled, [label], ids, lambda c: c.withColumn("target", F.least(F.col("n"), F.lit(size // 2))), seed
    )


def proportional(total: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """Class targets that add up to ``total(rows)``, each class in proportion.

    Whole parts first; the rows left over go to the largest remainders.
    """

    def add(classes: DataFrame) -> DataFrame:
        # All windows here run over one row per class.
        names = [c for c in classes.columns if c != "n"]
        sized = classes.withColumn("_rows", F.sum("n").over(Window.partitionBy()))
        quota = total(F.col("_rows")) * F.col("n") / F.col("_rows")
        split = sized.withColumn("_whole", F.floor(quota)).withColumn("_rest", quota - F.floor(quota))
        spare = total(F.col("_rows")) - F.sum("_whole").over(Window.partitionBy())
        order = Window.orderBy(F.desc("_rest"), *names)
        return split.withColumn(
            "target", F.col("_whole") + (F.row_number().over(order) <= spare).cast("bigint")
        )

    return add


def stratified_sample(df: DataFrame, label: str, ids: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (or all, if fewer) with the class shares of ``df``."""
    return take_per_class(df, [label], ids, proportional(lambda n: F.least(n, F.lit(size))), seed)


def stratified_split(
    df: DataFrame, label: str, ids: Sequence[str], test_size: float = 0.2, seed: int = 42, hashed_as: str | None = None
) -> DataFrame:
    """``df`` with ``is_test``; the test part is ``ceil(test_size * n)`` rows with the class shares."""
    share = proportional(lambda n: F.ceil(F.lit(test_size) * n))
    return mark_per_class(df, [label], ids, share, seed, flag="is_test", hashed_as=hashed_as)


def uniform_sample(df: DataFrame, ids: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (or all, if fewer), regardless of class."""
    one_class = df.withColumn("_all", F.lit(1))
    return take_per_class(
        one_class, ["_all"], ids, lambda c: c.withColumn("target", F.least(F.col("n"), F.lit(size))), seed
    ).drop("_all")


def stratified_folds(
    df: DataFrame, label: str, ids: Sequence[str], folds: int = 5, seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """``df`` with ``fold`` in 0..folds-1, dealt out in hash order within each class, over ``partitions`` if given."""
    # One text key per class, so that the join and the window agree on what to shuffle by; null is a class too.
    key = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    hashed = df.withColumn("_h", sample_hash(ids, seed)).withColumn("_r", _hash_range("_h")).withColumn("_c", key)
    ranges = hashed.groupBy("_c", "_r").agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy("_c").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    before = ranges.withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows")).drop("_rows")
    # Each (class, hash range) is an even slice of a class, so no task gets a whole class.
    within = Window.partitionBy("_c", "_r").orderBy("_h", *ids)
    dealt = hashed if partitions is None else hashed.repartition(partitions, "_c", "_r")
    return (
        dealt.join(before, ["_c", "_r"])
        .withColumn("fold", ((F.col("_before") + F.row_number().over(within) - 1) % folds).cast("int"))
        .select(*df.columns, "fold")
    )
