import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsight.operators import evaluate

ROW = "label double, prediction double, score double"


def make(spark, n=400, step=0.05, seed=3, positives=0.4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        label = float(rng.random() < positives)
        score = round(min(max(rng.gauss(0.45 + 0.2 * label, 0.2), 0), 1) / step) * step if step else rng.gauss(label, 2)
        rows.append((label, float(score >= 0.5), score))
    return rows, spark.createDataFrame(rows, ROW)


def pair_area(rows):
    pos = np.array([s for y, _, s in rows if y == 1])
    neg = np.array([s for y, _, s in rows if y != 1])
    return float((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("step", [0.05, 0.5, None])
def test_area_counts_pairs(spark, step):
    rows, df = make(spark, step=step)
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(pair_area(rows))


def brute_curve(rows):
    """Points at every distinct score, without those on the line between their neighbours."""
    scores = sorted({s for *_, s in rows}, reverse=True)
    tp = [sum(y == 1 and s >= t for y, _, s in rows) for t in scores]
    fp = [sum(y != 1 and s >= t for y, _, s in rows) for t in scores]
    keep = [
        i for i in range(len(scores))
        if i in (0, len(scores) - 1) or tp[i + 1] - 2 * tp[i] + tp[i - 1] or fp[i + 1] - 2 * fp[i] + fp[i - 1]
    ]
    points = [(fp[i] / fp[-1], tp[i] / tp[-1], scores[i]) for i in keep]
    return sorted([(0.0, 0.0, float("inf")), *points], key=lambda p: -p[2])


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_curve_points(spark, coalesce):
    """With all scores in one range, and with as many ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rows, df = make(spark, n=300, step=0.02)
        check_curve(rows, df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_curve(rows, df):
    found = sorted((tuple(r) for r in evaluate.roc_curve(df).collect()), key=lambda p: -p[2])
    assert np.allclose(np.array(found[1:]), np.array(brute_curve(rows)[1:])) and found[0] == (0.0, 0.0, float("inf"))


def test_area_without_negatives_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.3), (1.0, 1.0, 0.9)], ROW)
    assert evaluate.roc_auc(df).first()["roc_auc"] is None


def test_report_numbers(spark):
    # 3 true positives, 1 false positive, 2 false negatives, 4 true negatives
    cells = [(1.0, 1.0)] * 3 + [(0.0, 1.0)] + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 4
    df = spark.createDataFrame([(y, p, p) for y, p in cells], ROW)
    assert {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df).collect()} == {
        (1.0, 1.0): 3, (0.0, 1.0): 1, (1.0, 0.0): 2, (0.0, 0.0): 4}
    positive = evaluate.positive_class(df).first()
    assert (positive["precision"], positive["recall"]) == (0.75, 0.6)
    overall = evaluate.overall(df).first()
    assert overall["accuracy"] == pytest.approx(0.7)
    assert overall["f1"] == pytest.approx((5 * (6 / 9) + 5 * (8 / 11)) / 10)
    report = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert set(report) == {"0.0", "1.0", "accuracy", "macro avg", "weighted avg"}
    assert report["macro avg"]["recall"] == 0.7 and report["accuracy"]["support"] == 10
    shares = evaluate.confusion_share(df).collect()
    assert sum(r["share"] for r in shares if r["label"] == 1.0) == pytest.approx(1)


def test_a_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.1), (0.0, 0.0, 0.2)], ROW)
    scored = {r["class"]: r for r in evaluate.per_class(df).collect()}
    assert scored[1.0]["precision"] == 0 and scored[1.0]["recall"] == 0 and scored[1.0]["f1"] == 0


def test_several_models_do_not_mix(spark):
    a_rows, a = make(spark, seed=1)
    b_rows, b = make(spark, seed=2, positives=0.7)
    both = a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b")))
    found = {r["model"]: r["roc_auc"] for r in evaluate.roc_auc(both, 1, ["model"]).collect()}
    assert found == {"a": pytest.approx(pair_area(a_rows)), "b": pytest.approx(pair_area(b_rows))}
    assert {r["model"] for r in evaluate.compare_models(both).collect()} == {"a", "b"}


def test_one_vs_rest(spark):
    rng = random.Random(5)
    rows = [(i % 3, [rng.random() + (0.5 if i % 3 == c else 0) for c in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    parts = [(sum(y == c for y, _ in rows), pair_area([(float(y == c), 0, s[c]) for y, s in rows])) for c in range(3)]
    expected = sum(n * a for n, a in parts) / sum(n for n, _ in parts)
    assert evaluate.roc_auc_ovr(df, [0, 1, 2]).first()[0] == pytest.approx(expected)
