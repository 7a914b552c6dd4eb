"""Tables in a folder are replaced by commits: readers see the old or the new state, never a mixture."""

import os

import pytest
from pyspark.sql import functions as F

from shelfsight.sources import tables
from shelfsight.sources.tables import Warehouse


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def failing(spark):
    """A table that is lost after some of its rows have been written."""
    return spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("executor lost"))).otherwise(F.col("id")).cast("long").alias("id"))


def ids(store, name="t"):
    return sorted(r["id"] for r in store.read(name).collect())


def test_lost_replacement_leaves_the_old_table(spark, store):
    store.write(spark.range(5), "t")
    before = store.read("t")
    with pytest.raises(Exception, match="executor lost"):
        store.write(failing(spark), "t")
    assert ids(store) == list(range(5)) and before.count() == 5
    with pytest.raises(Exception, match="executor lost"):
        store.write(failing(spark), "t", "append")
    assert ids(store) == list(range(5))
    with pytest.raises(Exception, match="executor lost"):
        store.write(failing(spark), "never")
    assert not store.exists("never")


def test_a_reader_keeps_its_version(spark, store):
    store.write(spark.range(5), "t")
    old = store.read("t")
    store.write(spark.range(9), "t")
    assert old.count() == 5 and store.read("t").count() == 9
    store.write(store.read("t").where("id > 6"), "t")  # a table may be replaced by what is read from it
    assert ids(store) == [7, 8]


def test_tables_become_visible_together(spark, store):
    store.write(spark.range(1), "a")
    other = Warehouse(spark, store.root)
    with store.together():
        store.write(spark.range(2), "a")
        store.write(spark.range(3), "b")
        store.write(spark.range(3, 4), "b", "append")
        store.write(spark.range(1), "log", "append")
        store.write(spark.range(1), "log", "append")
        assert store.read("a").count() == 2 and store.read("b").count() == 4 and store.read("log").count() == 2
        assert other.read("a").count() == 1 and not other.exists("b") and not other.exists("log")
    assert other.read("a").count() == 2 and ids(other, "b") == [0, 1, 2, 3] and other.read("log").count() == 2
    with pytest.raises(Exception, match="executor lost"), store.together():
        store.write(spark.range(7), "a")
        store.write(failing(spark), "b")
    assert other.read("a").count() == 2 and other.read("b").count() == 4


def test_appends_of_two_writers_both_count(spark, store):
    store.write(spark.range(1), "t")
    other = Warehouse(spark, store.root)
    with store.together():
        store.write(spark.range(1, 2), "t", "append")
        other.write(spark.range(2, 3), "t", "append")
    assert ids(store) == [0, 1, 2]


def test_a_taken_number_is_passed_over(spark, store, monkeypatch):
    """Two commits with one number: the later one takes the next."""
    store.write(spark.range(1), "t")
    real, calls = Warehouse._published, []

    def late(self):
        state = real(self)
        calls.append(state[0])
        if len(calls) == 1:
            Warehouse(spark, self.root).write(spark.range(5), "other")
        return state

    monkeypatch.setattr(Warehouse, "_published", late)
    store.write(spark.range(2), "t")
    monkeypatch.undo()
    assert store.read("t").count() == 2 and store.read("other").count() == 5


def test_lost_commit_is_passed_over(spark, store):
    store.write(spark.range(1), "t")
    os.makedirs(f"{store.root}/{tables.COMMITS}/c-000000000002/_temporary/0")
    assert ids(store) == [0]
    store.write(spark.range(2), "t")
    assert ids(store) == [0, 1]


def test_many_appends_are_put_together(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "MOST_PARTS", 3)
    for i in range(8):
        store.write(spark.range(i, i + 1), "t", "append")
    assert ids(store) == list(range(8)) and len(store._parts("t")) <= 3


def test_old_versions_expire(spark, store):
    for i in range(1, 6):
        store.write(spark.range(i), "t")
    store.write(spark.range(1), "kept")
    gone = store.expire(kept=2)
    assert len(gone) == 4 and store.read("t").count() == 5 and store.read("kept").count() == 1
    assert len(os.listdir(f"{store.root}/t")) == 1 and store.expire(kept=2) == []
    store.write(spark.range(6), "t")
    assert store.read("t").count() == 6


def test_files_of_others_are_a_table(spark, store):
    spark.range(3).write.parquet(f"{store.root}/given")
    assert ids(store, "given") == [0, 1, 2]
    store.write(spark.range(3, 4), "given", "append")
    assert ids(store, "given") == [0, 1, 2, 3]
    store.write(spark.range(1), "given")
    assert ids(store, "given") == [0] and Warehouse(spark, store.root).read("given").count() == 1


def test_partitioned_parts(spark, store):
    rows = spark.range(6).withColumn("day", F.col("id") % 2)
    store.write(rows, "t", partition_by=["day"])
    store.write(rows, "t", "append", partition_by=["day"])
    assert store.read("t").where("day = 1").count() == 6


def test_scratch_goes_with_its_job(spark):
    from shelfsight.session import scratch, shared_folder, written

    root = shared_folder(spark, "x").rpartition("/")[0].removeprefix("file:")
    outside = written(spark.range(3), "outside")
    before = set(os.listdir(root))
    with pytest.raises(ZeroDivisionError), scratch(spark, "test"):
        assert written(spark.range(5), "inside").count() == 5
        with scratch(spark, "inner"):
            assert written(spark.range(2), "deep").count() == 2
        assert len(set(os.listdir(root)) - before) == 1
        raise ZeroDivisionError
    assert set(os.listdir(root)) == before and outside.count() == 3
