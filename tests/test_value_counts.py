"""What is learned from counts of values is what the steps learn from the rows, in one pass over them."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfsight.operators import features
from shelfsight.operators.value_counts import ValueCounts


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).selectExpr(
        "id", "double(id % 2) y", "case when id % 7 = 0 then null when id = 5 then 9000D when id = 6 then -0.0D else id * 31 % 97 / 8 end x",
        "case when id % 5 > 0 then int(id % 11) end whole", "case when id % 50 = 1 then double('NaN') else double(id % 6) end odd",
        "case when id % 9 = 0 then ' UnKnown\\n' when id % 4 = 1 then null else concat('t', id % 3) end t",
        "case when id % 2 = 0 then 'other' else 'unknown of' end u", "case when id = 3 then 'q' end sparse", "case when id > 395 then 1.0D end few",
        "date'2024-01-01' + int(id) as day").repartition(5)


def one_by_one(df):
    """The same steps, each fitted to the rows that the ones before it have left."""
    rows = df.drop("id", "y", "day")
    steps = [
        features.UnknownToNull(columns=["t", "u", "sparse"]), features.DropSparse(threshold=0.8), features.Cap(method="quantile"), features.Impute(),
        features.Scale(), *features.one_hot_stages(["t", "u"]),
        VectorAssembler(inputCols=["x", "whole", "odd", "t_hot", "u_hot"], outputCol="features")]
    return Pipeline(stages=steps).fit(rows)


def test_learned_as_one_by_one(spark, rows, tmp_path):
    fitted, wanted = features.preprocessor(rows, "y", ["id"]).fit(rows), one_by_one(rows)
    assert [type(s).__name__ for s in fitted.stages] == [type(s).__name__ for s in wanted.stages]
    drop, cap, fill, scale, labels = fitted.stages[1:6]
    assert drop.learned == wanted.stages[1].learned == ["sparse", "few"]
    assert cap.learned == wanted.stages[2].learned and fill.learned["fills"] == wanted.stages[3].learned["fills"]
    assert set(scale.learned) == set(wanted.stages[4].learned) == {"x", "whole", "odd"}
    for c, numbers in scale.learned.items():
        assert numbers == pytest.approx(wanted.stages[4].learned[c], rel=1e-12)
    shown = [[list(names) for names in model.labelsArray] for model in (labels, wanted.stages[5])]
    assert shown[0] == shown[1] == [["t0", "t1", "t2"], ["other", "unknown of"]]
    ours, theirs = fitted.transform(rows), wanted.transform(rows)
    assert features.feature_names(ours) == features.feature_names(theirs)
    found = {r["id"]: r["features"].toArray().tolist() for r in ours.collect()}
    for r in theirs.collect():
        assert found[r["id"]] == pytest.approx(r["features"].toArray().tolist(), rel=1e-9)
    fitted.write().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p")).transform(rows)
    assert {r["id"]: r["features"].toArray().tolist() for r in again.collect()} == found


def test_rows_are_passed_over_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def noted(x):
        seen.add(1)
        return x

    watched = rows.withColumn("x", F.udf(noted, "double").asNondeterministic()("x"))
    features.preprocessor(watched, "y", ["id"]).fit(watched)
    assert seen.value == 400


def test_counts_of_nothing_and_of_gaps(spark):
    empty = spark.createDataFrame([], "x double, t string")
    counts = ValueCounts(empty)
    assert counts.null_shares() == {"x": 0.0, "t": 0.0} and counts.quantiles(["x"], [0.5]) == {"x": [None]} and counts.most_frequent(["t"]) == {}
    gaps = ValueCounts(spark.createDataFrame([(None, None), (float("nan"), "b"), (None, "a")], "x double, t string"))
    assert gaps.quantiles(["x"], [0.5]) == {"x": [None]} and gaps.most_frequent(["t"]) == {"t": "a"}
    assert gaps.null_shares() == {"x": pytest.approx(2 / 3), "t": pytest.approx(1 / 3)}
    assert math.isnan(gaps.moments(["x"], {}, {"x": None})["x"][0])
    assert sorted(r["t"] for r in gaps.distinct({"t": "z"}).collect()) == ["a", "b"]
