"""Key sets in buckets: answers equal those of a plain anti join, and stored keys are not moved."""

import os
import re

import pytest
from pyspark.sql import functions as F

from shelfsight.operators.relate import not_in_cache
from shelfsight.sources import keys
from shelfsight.sources.keys import KeySet
from shelfsight.sources.tables import Warehouse


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "it's a store"))


@pytest.fixture()
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(spark, start, end):
    """Keys of which one is held by a third of the rows, some are missing, and some repeat."""
    n = F.col("id")
    return spark.range(start, end).select(F.when(n % 3 == 0, "hot").when(n % 11 == 0, None).otherwise((n - n % 2).cast("string")).alias("author"), "id")


def _depth(line):
    return len(re.match(r"\W*", line)[0])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_answers_are_those_of_an_anti_join(spark, store, shuffled):
    held = KeySet(store, "known", per_bucket=50)
    asked = rows(spark, 0, 2000)
    assert held.missing(asked, "author").count() == 2000 and not held.exists()
    told = None
    for start in (100, 700, 650, 1500, 3000):
        more = rows(spark, start, start + 300)
        told = more if told is None else told.unionAll(more)
        held.add(more, "author")
        want = not_in_cache(asked, told, "author")
        got = held.missing(asked, "author")
        assert got.columns == asked.columns
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert sorted(r["key"] for r in store.read("known").collect()) == sorted(r[0] for r in told.where("author is not null").select("author").distinct().collect())


def test_stored_keys_are_not_moved(spark, store, shuffled):
    held = KeySet(store, "known", per_bucket=50)
    held.add(spark.range(1000).select(F.col("id").cast("string").alias("author")), "author")
    assert keys._buckets(store.parts("known")[0]) == 32
    text = plan(held.missing(spark.range(500, 1500).select(F.col("id").alias("author")), "author"))
    scan = text.index("Bucketed: true")
    assert "SelectedBucketsCount: 32 out of 32" in text
    # Between the scan of the stored keys and the join above it nothing is exchanged.
    start = text.rindex("\n", 0, scan) + 1
    depth, above = _depth(text[start:]), []
    for line in reversed(text[:start].splitlines()):
        if _depth(line) < depth:
            depth = _depth(line)
            above.append(line)
    first_join = next(n for n, line in enumerate(above) if "Join" in line)
    assert "LeftAnti" in above[first_join] and not any("Exchange" in line for line in above[:first_join])


def test_small_additions_leave_few_files(spark, store):
    held = KeySet(store, "known", per_bucket=50)
    for i in range(14):
        held.add(spark.range(i * 10, i * 10 + 12).select(F.col("id").alias("author")), "author")
    held.add(spark.range(0, 100).select(F.col("id").alias("author")), "author")  # nothing new
    runs = store.parts("known")
    assert len(runs) <= 6 and store.read("known").count() == 142
    files = [f for run in runs for f in os.listdir(f"{store.root}/{run}") if f.endswith(".parquet")]
    assert len(files) <= sum(keys._buckets(run) for run in runs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("keys_")]


def test_visible_with_the_table(spark, store):
    held, other = KeySet(store, "known"), KeySet(Warehouse(spark, store.root), "known")
    ids = spark.range(5).select(F.col("id").alias("author"))
    with pytest.raises(ZeroDivisionError), store.together():
        held.add(ids, "author")
        assert held.missing(ids, "author").count() == 0 and not other.exists()
        raise ZeroDivisionError
    assert not held.exists()
    with store.together():
        for i in range(keys.RUNS + 1):
            held.add(spark.range(i * 5, i * 5 + 5).select(F.col("id").alias("author")), "author")
    assert other.missing(spark.range(30).select(F.col("id").alias("author")), "author").count() == 5


def test_two_writers_both_count(spark, store, monkeypatch):
    monkeypatch.setattr(keys, "RUNS", 2)
    held, other = KeySet(store, "known"), KeySet(Warehouse(spark, store.root), "known")
    held.add(spark.range(3).select(F.col("id").alias("author")), "author")
    with store.together():
        held.add(spark.range(3, 6).select(F.col("id").alias("author")), "author")
        other.add(spark.range(4, 9).select(F.col("id").alias("author")), "author")
    assert other.missing(spark.range(12).select(F.col("id").alias("author")), "author").count() == 3


def test_empty_and_without_keys(spark, store):
    held = KeySet(store, "known")
    none = spark.createDataFrame([(None,), (None,)], "author string")
    held.add(none, "author")
    held.add(none.limit(0), "author")
    assert not held.exists()
    held.add(spark.createDataFrame([("a",), ("",)], "author string"), "author")
    assert held.missing(none.unionAll(spark.createDataFrame([("a",), ("b",), ("",)], "author string")), "author").count() == 3


def test_set_of_a_table_that_has_none(spark, store):
    store.write(spark.range(5).select(F.col("id").alias("author")), "cache")
    held = keys.keys_of(store, "cache", "author")
    assert held.missing(spark.range(7).select(F.col("id").alias("author")), "author").count() == 2
    assert keys.keys_of(store, "other", "author").exists() is False and keys.keys_of(Warehouse(spark, database="d"), "cache", "author") is None
