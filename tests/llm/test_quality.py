import random

import numpy as np
import pytest

from shelfsight.llm import quality as q
from shelfsight.llm.lm_scoring import crc32_part


def test_shapes():
    assert [q.shape_of(w) for w in ("word", "Word.", "WORD!!!", "A", "on%%%", "x12y", "|", "Élan")] == ["x", "Xx.", "X!!", "Xx", "x%%", "x9x", "|", "Xx"]


def test_grams_are_sets_of_the_whole_text():
    grams = q.Grams()
    assert len(grams.of(None)) == len(grams.of(" \n ")) == 0
    assert len(grams.of("one")) == 2  # the word, and its shape between the text's ends
    a, b = grams.of("a b a b a b"), grams.of("a b " * 500)
    assert np.isin(a, b).all() and (np.diff(b.astype(object)) > 0).all()
    assert not np.isin(q.Grams().of("rest " * 3000 + "last"), grams.of("rest " * 3000)).all()


def random_rows(seed, n=60, width=12):
    rng = np.random.default_rng(seed)
    lists = [np.unique(rng.integers(0, width, rng.integers(1, 8))) for _ in range(n)]
    good = np.array([(3 in g) or rng.random() < 0.3 for g in lists])
    starts = np.concatenate([[0], np.cumsum([len(g) for g in lists])])
    return lists, good, np.concatenate(lists), starts, width


def test_log_count_ratios():
    lists, good, columns, starts, width = random_rows(1)
    got = q.log_count_ratios(columns, starts, np.where(good, 1, -1), width)
    p, r = ([1 + sum(f in g for g, y in zip(lists, good) if y == side) for f in range(width)] for side in (True, False))
    want = [np.log((p[f] / sum(p)) / (r[f] / sum(r))) for f in range(width)]
    assert np.allclose(got, want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_descent_reaches_the_least_loss(seed, monkeypatch):
    """The dual value equals the primal one, which no other weights can undercut."""
    monkeypatch.setattr(q, "ENOUGH", 1e-6)
    lists, good, columns, starts, width = random_rows(seed)
    y = np.where(good, 1.0, -1.0)
    scale = q.log_count_ratios(columns, starts, y, width)
    w, b, duals = q.dual_coordinate_descent(columns, starts, y, scale, rounds=3000)
    x = np.zeros((len(lists), width + 1))
    for n, g in enumerate(lists):
        x[n, g], x[n, -1] = scale[g], 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    whole = np.append(w, b)
    assert np.allclose(whole, (duals * y) @ x) and (duals >= 0).all() and (duals <= q.COST).all()
    primal = lambda v: 0.5 * v @ v + q.COST * np.maximum(0, 1 - y * (x @ v)).sum()
    assert primal(whole) - (duals.sum() - 0.5 * whole @ whole) < 1e-3
    assert np.allclose(q.margins(columns, starts, w, scale, b), x @ whole)
    rng = np.random.default_rng(9)
    assert all(primal(whole + rng.normal(0, 0.1, width + 1)) > primal(whole) - 1e-3 for _ in range(50))


def test_sigmoid():
    rng = np.random.default_rng(5)
    margin = rng.normal(0, 1, 4000)
    good = rng.random(4000) < 1 / (1 + np.exp(-(2 * margin + 0.5)))
    slope, offset = q.sigmoid_of(margin, good)
    assert abs(slope - 2) < 0.2 and abs(offset - 0.5) < 0.2


def test_scores_agree_with_the_model():
    """Lookup by hash gives the margin of the fitted rows."""
    texts = [" ".join(random.Random(n).choices(["good", "fine", "BAD!!", "BAD!!", "the"][n % 2 * 2 :][:3], k=12)) for n in range(80)]
    grams = q.Grams()
    lists, good = [grams.of(t) for t in texts], np.arange(80) % 2 == 0
    model = q.Model.fit(lists, good)
    scores = np.array([model.score(g) for g in lists])
    assert (scores[good] > 0.7).all() and (scores[~good] < 0.3).all()
    assert q.Model.fit([], np.empty(0, bool)).score(lists[0]) == 0.5
    one = q.Model.fit(lists[:3], np.ones(3, bool))
    assert 0.5 < one.score(lists[0]) < 1 and 0 < one.score(np.empty(0, np.uint64)) <= 1


def labelled(spark, rows):
    return spark.createDataFrame([(i, None if i == 9 else int(len(text or "") > 200), 0) for i, text, *_ in rows], "doc_id long, quality int, toxic int")


def run(spark, frame, rows):
    return sorted((str(r.doc_id), r.held_out, round(r.score, 9), r.predicted) for r in q.good_documents(frame, labelled(spark, rows)).collect())


def test_odd_rows(spark, docs, rows, clashing, empty_docs):
    first = run(spark, docs, rows)
    assert len(first) == len(rows) and all(0 <= s <= 1 and p == (s >= 0.7) for _, _, s, p in first)
    assert first == run(spark, docs.repartition(7), rows) == run(spark, clashing.drop("score"), rows)
    assert set(clashing.columns) <= set(q.good_documents(clashing, labelled(spark, rows)).columns)
    assert run(spark, empty_docs, rows) == []


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.good_documents(docs, none).collect()} == {0.5}


def test_bounds(spark, docs, rows):
    """Rows and n-grams beyond the bounds are not fitted on; repeated ids do not lift them."""
    labels = labelled(spark, rows)
    few = q.fit(docs.unionAll(docs), labels, crc32_part("doc_id", 4) != 2, examples=10, entries=150)
    assert 0 < len(few.grams) <= 150


def test_held_out_documents():
    """On the given tables: nearly all held-out labels are met, by scores that never saw them."""
    import os

    from pyspark.sql import SparkSession

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("needs the given tables")
    spark = SparkSession.getActiveSession()
    found = q.op12(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(found) > 50 and sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)
