"""Sketches per file: exact counts, estimates within their bound, and no second look at files that have not changed."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfsight.sources.sketches import FolderSketches
from shelfsight.sources.tables import Warehouse

SCHEMA = "id long, word string, price double, late int"


def put(spark, folder, name, start, end):
    """One file, with a word in every third row and a column that later files have only."""
    rows = spark.range(start, end, numPartitions=1).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("w"), F.col("id") % 90)).alias("word"), (F.col("id") % 7 / 2).alias("price"))
    if start:
        rows = rows.withColumn("late", F.lit(1))
    rows.toPandas().to_parquet(f"{folder}/{name}")


@pytest.fixture()
def arriving(spark, tmp_path):
    folder = tmp_path / "in + [1]"
    folder.mkdir()
    return folder, FolderSketches(Warehouse(spark, str(tmp_path / "store")), "sketches", str(folder), SCHEMA)


def found(sketches):
    return {r["column"]: (r["rows"], r["missing"], r["distinct_values"]) for r in sketches.summary().collect()}


def spoil(path):
    """A file that cannot be read any more, though nothing shows from outside."""
    seen = os.stat(path)
    Path(path).write_bytes(b"x" * seen.st_size)
    os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))


def test_only_new_files_are_read(spark, arriving):
    folder, sketches = arriving
    put(spark, folder, "a b%20{c}.parquet", 0, 900)
    assert sketches.refresh() == 1
    assert found(sketches)["word"] == (900, 600, 30) and found(sketches)["price"] == (900, 0, 7) and found(sketches)["late"] == (900, 900, 0)
    spoil(folder / "a b%20{c}.parquet")
    put(spark, folder, "second.parquet", 800, 21_000)
    assert sketches.refresh() == 1 and sketches.refresh() == 0
    got = found(sketches)
    assert got["word"] == (21_100, 21_100 - 300 - 6733, 30) and got["late"] == (21_100, 900, 1) and got["price"][2] == 7
    assert got["id"][:2] == (21_100, 0) and abs(got["id"][2] - 21_000) <= 0.049 * 21_000


def test_changed_and_lost_files(spark, arriving):
    folder, sketches = arriving
    put(spark, folder, "a.parquet", 0, 30)
    put(spark, folder, "b.parquet", 30, 60)
    (folder / "deep").mkdir()
    put(spark, folder, "deep/a.parquet", 60, 90)
    assert sketches.refresh() == 3 and found(sketches)["id"] == (90, 0, 90)
    put(spark, folder, "b.parquet", 30, 130)
    assert sketches.refresh() == 1 and found(sketches)["id"] == (160, 0, 130)
    os.remove(folder / "a.parquet")
    assert sketches.refresh() == 0 and found(sketches)["id"] == (130, 0, 100)
    put(spark, folder, "c.parquet", 200, 210)
    os.remove(folder / "deep/a.parquet")
    assert sketches.refresh() == 1 and found(sketches)["id"] == (110, 0, 110)


def test_no_files_and_no_rows(spark, arriving):
    folder, sketches = arriving
    assert sketches.refresh() == 0 and found(sketches) == {}
    put(spark, folder, "none.parquet", 5, 5)
    assert sketches.refresh() == 1 and sketches.refresh() == 0
    assert found(sketches)["word"] == (0, 0, 0)
