"""Boosted trees over sparse rows are the library's trees, and no task keeps a number per feature and row."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from shelfsight.operators import boosting, models


def mixed_rows(spark, n=1500):
    """Dense and sparse vectors: three columns of few values, some below zero, and indicators."""
    rng, rows = random.Random(4), []
    for i in range(n):
        a, b, c, kind = rng.randrange(30), rng.randrange(13) / 2, rng.randrange(-3, 4), rng.randrange(17)
        label = float((a > 14) + (b > 3) + (c < 0) + (kind > 8) + (rng.random() < 0.2) >= 3)
        v = Vectors.dense([a, b, c, *[float(kind == k) for k in range(17)]])
        rows.append((i, label, v if i % 2 else Vectors.sparse(20, {j: x for j, x in enumerate(v) if x})))
    return spark.createDataFrame(rows, ["id", "label", "features"]).repartition(5, "id")


@pytest.mark.parametrize("settings", [{"max_depth": 3, "n_estimators": 4}, {"max_depth": 4, "n_estimators": 2, "min_samples_leaf": 40}, {"max_depth": 0, "n_estimators": 2}])
def test_same_trees_as_the_library(spark, tmp_path, monkeypatch, settings):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    df, estimator = mixed_rows(spark).persist(), models.gradient_boosting(learning_rate=0.3, **settings)
    ours, theirs = models.fit(estimator, df), estimator.fit(df)
    assert ours.totalNumNodes == theirs.totalNumNodes and ours.treeWeights == theirs.treeWeights
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())
    ours.write().save(str(tmp_path / "m"))
    again = type(ours).load(str(tmp_path / "m"))
    chance = [[r["p"] for r in m.transform(df).orderBy("id").select(vector_to_array("probability")[1].alias("p")).collect()] for m in (ours, theirs, again)]
    assert np.allclose(chance[0], chance[1]) and chance[0] == chance[2]
    df.unpersist()


def test_rows_are_kept_by_what_differs_from_zeros(spark, monkeypatch):
    """A row of 400 indicators is a few bytes while trees grow, and nothing stays behind; MLlib would keep 1,600."""
    df = spark.createDataFrame([(float(i % 400 > 200), Vectors.sparse(400, {i % 400: 1.0})) for i in range(2000)], ["label", "features"])
    before, seen, real = spark.sparkContext._jsc.getPersistentRDDs().size(), [], boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda blocks, *rest: seen.append(blocks.map(lambda r: sum(len(r[c]) for c in ("good", "places", "bins", "starts"))).sum()) or real(blocks, *rest))
    model = models.fit(models.gradient_boosting(n_estimators=2, max_depth=2), df)
    assert max(seen) < 2000 * 20 and model.numFeatures == 400
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_bins_of_many_values_hold_as_many_rows_each():
    """Thinned values keep ranks to a thousandth or so; zeros, gaps and what is no number go where trees compare them to."""
    rng = np.random.default_rng(0)
    values, found = rng.normal(size=50_000), {}
    for part in np.split(values, 10):
        found = boosting.merged(found, boosting._counted(np.full(len(part), 3), part, np.ones(len(part), np.int64)))
    kept, counts = found[3]
    assert len(kept) <= boosting.KEPT_VALUES and counts.sum() == 50_000
    cuts = boosting.cuts_between(kept, counts, 31)
    shares = np.histogram(values, [-np.inf, *cuts, np.inf])[0] / 50_000
    assert len(cuts) == 31 and abs(shares - 1 / 32).max() < 0.004
    bins = boosting.Bins([[0.5], [], [-1.0, 0.0, 2.0]])
    got = bins.of(np.array([0, 0, 0, 1, 2, 2, 2, 2]), np.array([0.5, 0.6, np.nan, np.nan, -1.0, 0.0, 2.5, np.nan]))
    assert got.tolist() == [0, 1, 1, 2, 3, 4, 6, 6] and bins.zero.tolist() == [0, 2, 4]


def test_labels_of_more_classes_are_refused(spark):
    df = spark.createDataFrame([(float(i % 3), Vectors.dense([float(i)])) for i in range(9)], ["label", "features"])
    with pytest.raises(Exception, match="two classes"):
        models.fit(models.gradient_boosting(n_estimators=1), df)
