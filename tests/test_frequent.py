import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import features, frequent, reports


def table(spark, kind, n=4000):
    rng = random.Random(kind)
    draw = {
        "skewed": lambda: f"v{min(int(rng.paretovariate(0.6)), 3000)}", "flat": lambda: f"v{rng.randrange(900)}", "few": lambda: f"v{rng.randrange(7)}",
        "hot": lambda: "hot" if rng.random() < 0.4 else f"own{rng.random()}",
    }[kind]
    rows = [(i, None if rng.random() < 0.05 else draw(), rng.choice(["a", "b", "é"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, x string, y string").repartition(5)


@pytest.mark.parametrize("kind", ["skewed", "flat", "few", "hot"])
@pytest.mark.parametrize("first", ["asc", "desc"])
def test_same_as_counting_everything(spark, monkeypatch, kind, first):
    """Few counters, so that all ways are taken: nothing lost, candidates counted, and bounds that prove nothing."""
    monkeypatch.setattr(frequent, "MOST_COUNTERS", 200)
    rows, df = table(spark, kind)
    for k in (1, 5):
        got = [(r["column"], r["value"], r["n"]) for r in frequent.top_values(df, ["x", "y"], k, first, counters=20).orderBy("column", "place").collect()]
        want = []
        for place, column in ((1, "x"), (2, "y")):
            counts = Counter(r[place] for r in rows if r[place] is not None)
            ordered = sorted(sorted(counts.items(), reverse=first == "desc"), key=lambda c: -c[1])
            want += [(column, v, n) for v, n in ordered[:k]]
        assert got == want


def test_no_shuffle_of_all_values(spark, monkeypatch):
    """On skewed values the second pass counts a few candidates, and summaries stay bounded."""
    rows, df = table(spark, "hot", 8000)
    monkeypatch.setattr(frequent, "COUNTERS", 50)
    seen, real = [], frequent._bounds
    monkeypatch.setattr(frequent, "_bounds", lambda summary, k: seen.append((summary.count(), summary.where("lost > 0").count())) or real(summary, k))
    top = frequent.top_values(df, ["x"], 1).collect()
    assert [(r["value"], r["n"]) for r in top] == [("hot", sum(r[1] == "hot" for r in rows))]
    assert len(seen) == 1 and seen[0][0] <= 5 * 100 + 1 and seen[0][1] == 1


def test_many_candidates_are_joined(spark, monkeypatch):
    monkeypatch.setattr(frequent, "CANDIDATES", 0)
    rows, df = table(spark, "hot")
    assert frequent.top_values(df, ["x"], 1, counters=20).first()["n"] == sum(r[1] == "hot" for r in rows)


def test_empty_and_missing(spark):
    df = spark.createDataFrame([(1, None)], "id int, x string")
    assert frequent.top_values(df, ["x"], 3).count() == 0 and frequent.top_values(df.limit(0), ["x", "id"], 3).count() == 0


def test_reports_and_steps_use_it(spark):
    rows, df = table(spark, "flat")
    counts = Counter(r[1] for r in rows if r[1] is not None)
    assert [tuple(r) for r in reports.value_counts(df, "x", 4).collect()] == sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:4]
    kept = features.KeepFrequent(columns=["x"], maxCategories=5).fit(df).learned["x"]
    assert kept["more"] and kept["kept"] == [v for v, _ in sorted(sorted(counts.items(), reverse=True), key=lambda c: -c[1])[:4]]
    assert features.most_frequent(df, ["x", "y"])["x"] == min(v for v, n in counts.items() if n == max(counts.values()))
