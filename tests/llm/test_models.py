import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsight.llm import lm_scoring as lm
from shelfsight.llm import toxicity as tox


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w] + [None]


def check_base(rows, got):
    counts = Counter()
    for i, text, *_ in rows:
        if crc32(str("" if i is None else i).encode()) % 5 != 1:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((
        str(i), len(t := tokens(text)), sum(counts[w] > 0 for w in t), total,
        round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t), 6),
    ) for i, text, *_ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def scored(frame):
    return lm.score_texts(frame, lm.crc32_part("doc_id", 5) != 1).collect()


@pytest.mark.parametrize("near", [200_000, 3])
def test_base_scores(docs, rows, clashing, repeated, empty_docs, near, monkeypatch):
    """Also with most words left to the join with the table of counts."""
    monkeypatch.setattr(lm, "NEAR_WORDS", near)
    monkeypatch.setattr(lm, "STEPS", 5)
    check_base(rows, scored(docs))
    check_base(rows, scored(clashing))
    check_base(rows + rows, scored(repeated))
    assert scored(empty_docs) == []


def test_without_training_rows(docs):
    got = lm.score_texts(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-9 for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_add_up(docs, rows, monkeypatch):
    """Over all words of the training texts and one new word per class, in every context."""
    monkeypatch.setattr(lm, "STEPS", 20)
    caught = []
    share = lm.Shared.of.__func__
    monkeypatch.setattr(lm.Shared, "of", classmethod(lambda cls, spark, value: caught.append(value) or share(cls, spark, value)))
    lm.score_texts(docs, F.lit(True)).collect()
    lexicon, log10 = caught
    assert np.allclose((10.0 ** log10.astype(float)).sum(axis=1), 1, atol=1e-4)
    counts = Counter(w.encode() for _, text, *_ in rows for w in tokens(text)[:-1])
    inside = Counter({c: 0.5 for c in range(lm.CLASSES)})
    for word in set(counts) - set(lexicon.words[: lm.WORDS]):
        inside[lm.class_of(word)] += counts[word] + 0.5
    assert np.allclose([inside[c] for c in range(lm.CLASSES)], lexicon.mass)


def test_model_learns_what_follows_what(spark):
    """Two languages that never mix: the words before tell the language, which the baseline cannot know."""
    rng = random.Random(1)
    one, two = [f"a{n}" for n in range(30)], [f"b{n}" for n in range(30)]
    made = spark.createDataFrame([(n, " ".join(rng.choice(one if n % 2 else two) for _ in range(60))) for n in range(300)], "doc_id long, text string")
    got = scored(made)
    held = [r for r in got if crc32(str(r.doc_id).encode()) % 5 == 1]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.8 * math.log10(2)


def test_noise_contrastive_fit_approaches_the_shares():
    rng = np.random.default_rng(0)
    context = np.repeat([5 * (lm.CLASSES + 1) + 1, 9 * (lm.CLASSES + 1) + 2], 4)
    target = np.array([1, 2, 3, 4, 3, 4, 5, 6])
    n = rng.integers(50, 500, 8).astype(float)
    log10 = lm.LogBilinear().fit(context * lm.UNITS + target, n).log10_table()
    for c in set(context):
        shares = n[context == c] / n[context == c].sum()
        assert np.allclose(10.0 ** log10[c, target[context == c]], shares, atol=0.05)


INSULTS = ["grobian", "schuft", "lowlife"]


def labelled(seed=1, n=600):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("aeiou") + rng.choice("bcdfg") + rng.choice("aeiou") * rng.randrange(1, 3) for _ in range(rng.randrange(20, 200))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(len(words) // 20 + 1):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "", "en", "s!"]))
        docs.append((i, " ".join(words), "src"))
        labels.append((i, None if i % 31 == 0 else int(toxic), 1))
    docs += [(n, None, "src"), (n + 1, "", "src"), (n + 2, "nothing known 水", None), (None, "Ein GROBIAN, ein Schuft, ein Schuft!", "src"), (n + 3, "aba schuft " * 9000, "s")]
    labels += [(None, 1, 1), (99999, 1, 0), (3, 0, 1), (3, 0, 1)]
    return docs, labels


@pytest.fixture(scope="module")
def toxic_tables(spark):
    docs, labels = labelled()
    return spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_toxicity(toxic_tables):
    docs, labels = toxic_tables
    got = {r.doc_id: r for r in tox.toxic_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [r for i, r in got.items() if r.held_out and i is not None and i < 600]
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    assert sum(r.predicted == (r.doc_id % 7 == 0) for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[600].predicted == got[601].predicted == got[602].predicted == 0
    assert got[None].predicted == got[603].predicted == 1
    evidence = next(r.evidence for r in held if r.predicted)
    assert evidence and all(e.toxic in (0, 1) and 0 < e.cosine <= 1 + 1e-9 for e in evidence)


def test_score_needs_the_text_alone(toxic_tables, spark):
    docs, labels = toxic_tables
    more = docs.select("*", *[F.lit("x").alias(c) for c in ("score", "evidence", "toxic", "label")])
    a = {r.doc_id: r.score for r in tox.toxic_documents(docs, labels).collect()}
    found = tox.toxic_documents(more.unionAll(more), labels)
    assert found.columns.count("score") == 1
    rows = found.collect()
    assert len(rows) == 2 * len(a)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.score) == r.score


def test_toxicity_without_rows_or_labels(toxic_tables):
    docs, labels = toxic_tables
    assert tox.toxic_documents(docs.limit(0), labels).count() == 0
    none = tox.toxic_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0} and all(r.evidence == [] for r in none)


def test_nearest_is_exact(toxic_tables):
    docs, labels = toxic_tables
    index = tox.fit(docs, labels, F.lit(True))
    assert index.blocks > 3 and len(index.terms.places) >= 3
    dense = np.zeros((len(index.vectors), len(index.terms.places)))
    for n, v in enumerate(index.vectors):
        dense[n, list(v)] = list(v.values())
    rng = random.Random(8)
    queries = [dict(v) for v in index.vectors if v][:40]
    queries += [tox.weighted({t: rng.randrange(1, 4) for t in rng.sample(range(dense.shape[1]), min(3, dense.shape[1]))}, index.idf) for _ in range(40)]
    for q in queries:
        x = np.zeros(dense.shape[1])
        x[list(q)] = list(q.values())
        cosines = dense @ x
        places, found = index.nearest(q)
        want = np.sort(cosines[cosines > 0])[::-1][: tox.NEIGHBOURS]
        assert np.allclose(found, want) and np.allclose(cosines[places], found)
    assert len(index.nearest({})[0]) == 0


def test_frequencies_cover_all_documents(toxic_tables):
    docs, labels = toxic_tables
    index = tox.fit(docs, labels, F.col("doc_id") < 300, examples=100)
    assert len(index.ids) <= 100
    texts = [r.text for r in docs.collect()]
    for term, place in index.terms.places.items():
        df = sum(term in tox.terms_of(text) for text in texts)
        assert math.isclose(index.idf[place], math.log((len(texts) + 1) / (df + 1)) + 1)
