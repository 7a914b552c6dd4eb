"""Quantiles, samples, splits and folds: exact on any distribution, and on both code paths."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfsight.operators import sampling
from shelfsight.operators.quantiles import exact_quantiles
from shelfsight.session import broadcast_if_small


@pytest.mark.parametrize("shape", ["uniform", "hot", "tail", "few"])
def test_quantiles_match_numpy(spark, shape):
    rng = random.Random(7)
    make = {
        "uniform": lambda: rng.uniform(-5, 5), "hot": lambda: 1.0 if rng.random() < 0.6 else rng.uniform(0, 2),
        "tail": lambda: rng.paretovariate(0.3), "few": lambda: float(rng.randint(1, 5)),
    }[shape]
    values = [make() for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.755, 0.99, 1.0]
    found = exact_quantiles(df, ["v"], probs)["v"]
    assert found == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_of_many_columns_over_many_ranges(spark):
    df = spark.range(20_000).repartition(9).selectExpr("id", "id % 7 as few", "if(id < 19000, 1.5D, id / 3.0D) as hot", "cast(null as int) as none", "-0.0D as zero")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_quantiles(df, ["id", "few", "hot", "none", "zero"], [0, 0.3, 0.951, 1])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = df.select("id", "few", "hot").toPandas()
    for c in rows:
        assert found[c] == pytest.approx(list(np.quantile(rows[c].astype(float), [0, 0.3, 0.951, 1])), rel=1e-12)
    assert found["none"] == [None] * 4 and found["zero"] == [0.0] * 4


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    assert exact_quantiles(df, [], [0.5]) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3).map(float), min_size=1, max_size=40), prob=st.floats(0, 1))
def test_quantiles_with_many_ties(spark, values, prob):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, ["v"], [prob])["v"][0] == pytest.approx(float(np.quantile(values, prob)), abs=1e-9)


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows; one is missing."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, "warm").when(F.col("id") % 10 == 8, "rare").alias("c")
    ).where("c is null or c <> 'rare' or id < 100")


def sizes(df):
    return {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}


def test_split_is_exact_and_proportional(spark, skewed):
    parts = sampling.stratified_split(skewed, "c", ["id"], 0.2)
    assert parts.count() == skewed.count() and parts.select("id").distinct().count() == skewed.count()
    n = skewed.count()
    test = parts.where("is_test")
    assert test.count() == math.ceil(0.2 * n)
    for c, size in sizes(skewed).items():
        assert abs(sizes(test).get(c, 0) - 0.2 * size) < 1


def test_split_repeats_whatever_the_partitions(skewed):
    first = {r["id"] for r in sampling.stratified_split(skewed, "c", ["id"]).where("is_test").collect()}
    again = {r["id"] for r in sampling.stratified_split(skewed.repartition(7), "c", ["id"]).where("is_test").collect()}
    other = {r["id"] for r in sampling.stratified_split(skewed, "c", ["id"], seed=1).where("is_test").collect()}
    assert first == again and first != other


@pytest.mark.parametrize("size", [1, 37, 500, 10_000])
def test_sample_sizes(skewed, size):
    n = skewed.count()
    assert sampling.uniform_sample(skewed, ["id"], size).count() == min(size, n)
    assert sampling.stratified_sample(skewed, "c", ["id"], size).count() == min(size, n)


def test_uniform_sample_is_the_smallest_hashes(skewed):
    wanted = {r["id"] for r in skewed.orderBy(sampling.sample_hash(["id"]), "id").limit(123).collect()}
    assert {r["id"] for r in sampling.uniform_sample(skewed, ["id"], 123).collect()} == wanted


def test_balanced_sample(spark):
    df = spark.range(1000).selectExpr("id", "case when id % 5 = 0 then 1 when id % 7 <> 0 then 0 end as y")
    taken = sampling.balanced_sample(df, "y", ["id"], 500)
    assert {r["y"]: r["count"] for r in taken.groupBy("y").count().collect()} == {0: 250, 1: 200}


def test_folds_are_even_within_classes(skewed):
    folded = sampling.stratified_folds(skewed, "c", ["id"], 5)
    assert folded.count() == skewed.count()
    for c, size in sizes(skewed).items():
        per = [r["count"] for r in folded.where(F.col("c").eqNullSafe(c)).groupBy("fold").count().collect()]
        assert max(per) - min(per) <= 1 and sum(per) == size


def test_broadcast_only_what_is_small(spark):
    small, large = spark.range(10), spark.range(100)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(small, 50)).lower()
    assert broadcast_if_small(large, 50) is large


@pytest.mark.parametrize("few", [32, 0])
def test_split_by_a_stored_hash(spark, skewed, monkeypatch, few):
    """A hash that is stored is not worked out again, and takes the same rows, with few classes and with many."""
    monkeypatch.setattr(sampling, "FEW_CLASSES", few)
    stored = skewed.withColumn("h", sampling.sample_hash(["id"])).localCheckpoint()
    parts = sampling.stratified_split(stored, "c", ["id"], hashed_as="h")
    assert "md5" not in parts._jdf.queryExecution().optimizedPlan().toString()
    plain = sampling.stratified_split(skewed, "c", ["id"])
    wanted = {r["id"] for c in ("hot", "warm", "rare", None) for r in skewed.where(F.col("c").eqNullSafe(F.lit(c))).orderBy(sampling.sample_hash(["id"])).limit(
        plain.where(F.col("c").eqNullSafe(F.lit(c)) & F.col("is_test")).count()).collect()}
    assert {r["id"] for r in parts.where("is_test").collect()} == {r["id"] for r in plain.where("is_test").collect()} == wanted


def test_split_where_hashes_meet(spark):
    """Different ids with one hash: the ids decide, and the size stays exact."""
    df = spark.range(100).select("id", F.lit(1.0).alias("c"), (F.col("id") % 3).alias("h"))
    taken = [r["id"] for r in sampling.stratified_split(df, "c", ["id"], hashed_as="h").where("is_test").collect()]
    assert sorted(taken) == list(range(0, 60, 3))


def test_small_broadcast_sides_need_no_python(spark):
    from shelfsight.session import broadcast_if_small

    side = spark.range(3).selectExpr("id", "named_struct('a', id, 't', timestamp_seconds(id)) s", "cast(null as string) n")
    small = broadcast_if_small(side)
    assert small.schema == side.schema and small.collect() == side.collect()
    assert "LocalRelation" in small._jdf.queryExecution().optimizedPlan().toString()
