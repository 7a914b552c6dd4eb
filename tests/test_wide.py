"""Steps that have to hold for many columns, many categories, deep pages and long files."""

import hashlib

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from shelfsight.operators import features, profile, relate
from shelfsight.sources import audit


def test_correlations_of_many_columns(spark, monkeypatch):
    """Against plain numbers, pair by pair over the rows where both are given; large values lose no digits."""
    monkeypatch.setattr(profile, "GRAM_ROWS", 7)
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (90, 60)) @ rng.normal(0, 1, (60, 60)) + rng.choice([0, 1e7, -1e9], 60)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 3.5
    x[:45, 8], x[45:, 9] = np.nan, np.nan
    names = [f"c{i}" for i in range(60)]
    rows = [[None if np.isnan(v) and j % 2 else float(v) for j, v in enumerate(r)] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df).collect()}
    assert len(got) == 3600
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if i == j:
                assert got[a, b] == 1.0
            elif 7 in (i, j) or both.sum() < 2:
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-8)
    assert profile.correlations(df.limit(0)).where("a <> b and r is not null").isEmpty()
    assert profile.correlations(spark.range(3).select(F.lit("t").alias("t")), []).count() == 0


def test_plan_does_not_grow_with_pairs(spark):
    df = spark.range(200).select(*[(F.xxhash64("id", F.lit(i)) % 100).cast("double").alias(f"c{i}") for i in range(200)])
    found = profile.correlations(df)
    assert len(found._jdf.queryExecution().toString()) < 400_000
    assert found.count() == 40_000


@pytest.mark.parametrize("offset", [0, 3, 57, 96, 99, 100, 500])
def test_deep_pages(spark, monkeypatch, offset):
    """Ties, nulls and repeated keys; the page found through ranges is the page of the whole order."""
    df = spark.range(100).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), "id").repartition(6)
    want = [tuple(r) for r in df.orderBy("a", "b").select("a", "b").collect()][offset : offset + 4]
    monkeypatch.setattr(relate, "SHALLOW", -1)
    assert [(r["a"], r["b"]) for r in relate.page(df, ["a", "b"], limit=4, offset=offset).collect()] == want
    whole = [r["id"] for r in df.orderBy("a", "b", "id").collect()]
    assert [r["id"] for r in relate.page(df, ["a", "b", "id"], limit=4, offset=offset).collect()] == whole[offset : offset + 4]


def test_pages_by_key(spark):
    df = spark.range(23).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("a"), "id").repartition(3)
    seen, last = [], None
    while rows := relate.page_after(df, ["a", "id"], last, limit=5).collect():
        seen += [r["id"] for r in rows]
        last = (rows[-1]["a"], rows[-1]["id"])
    assert seen == [r["id"] for r in df.orderBy("a", "id").collect()]
    with pytest.raises(ValueError):
        relate.page_after(df, ["id"], limit=0)


def test_long_files_are_hashed_as_streams(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "WHOLE_BYTES", 100)
    monkeypatch.setattr(audit, "PIECE", 64)
    given = {"short.csv": b"x\n1\n", "long one.csv": b"x\n" + b"1234567\n" * 999, "sub/long.csv": b"y" * 101}
    for name, content in given.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    got = {r["file"]: (r["sha256"], r["bytes"]) for r in audit.checksums(spark, str(tmp_path)).collect()}
    assert got == {n: (hashlib.sha256(c).hexdigest(), len(c)) for n, c in given.items()}


def test_ten_thousand_categories(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("c"), F.format_string("%05d", F.col("id") % 10_000)).alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    hot = Pipeline(stages=features.one_hot_stages(["c"])).fit(df).transform(df)
    assert hot.schema["c_hot"].metadata["ml_attr"]["num_attrs"] == 10_000
    assert hot.agg(F.count_distinct("c_index")).first()[0] == 10_000
    few = Pipeline(stages=features.one_hot_stages(["c"], most=20)).fit(df).transform(df)
    assert few.schema["c_hot"].metadata["ml_attr"]["num_attrs"] == 20
    hashed = features.preprocessor(df, "y", ["id"], hashed=512).fit(df)
    ready = hashed.transform(df.unionByName(df.limit(1).withColumn("c", F.lit("new"))))
    assert ready.first()["features"].size == 512 and ready.where("c = 'new'").first()["features"].numNonzeros() == 1


def test_report_of_one_scan(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (1, "a", float("nan")), (None, None, None), (2, "a", 1.0)], "id int, t string, x double")
    found = {r["metric"]: r["value"] for r in profile.dataset_report(df, "id").collect()}
    assert found == {"rows": 5, "columns": 3, "duplicates": 1, "unique_ids": 2, "missing:id": 1, "missing:t": 1, "missing:x": 2}
    assert profile.dataset_report(df, "id")._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2
    assert {r["value"] for r in profile.dataset_report(df.limit(0), "id").collect()} == {0, 3}
