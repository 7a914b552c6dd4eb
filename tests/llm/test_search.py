import math
import re
from collections import Counter

import numpy as np
import pytest

from shelfsight.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "the Haus of ÉLAN"), (2, "a a a and to in"), (3, None), (4, ""), (5, "idiot 水 x1 ТЕСТ more"), (None, "foo-bar end"),
    (7, "nothing-of-this qqqq"), (8, "This line is long enough to count as shared text."), (5, "the second row of item five"),
]


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, top):
    bags = [(i, Counter(terms(text))) for i, text, *_ in rows if terms(text)]
    number, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    want = []
    for item, wanted in asked.items():
        found = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * number) // length
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in wanted if t in bag
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        want += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return Counter(want)


def run(spark, docs, top=50, items=ITEMS):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in ls.ranked_search(docs, asked, top).select("item_id", "rank", "doc_id", "score").collect())


def test_terms(rows):
    for _, text, *_ in rows:
        assert [t.decode() for t in ls.terms_of(text)] == terms(text)


@pytest.mark.parametrize("top", [50, 3])
def test_ranks(spark, docs, rows, top):
    got = run(spark, docs, top)
    assert got == brute(rows, ITEMS, top) and len({k[0] for k in got}) >= 5


def test_copies_and_other_columns(spark, repeated, clashing, rows):
    assert run(spark, repeated, 7) == brute(rows + rows, ITEMS, 7)
    assert run(spark, clashing, 7) == brute(rows, ITEMS, 7)


def test_blocks_slices_and_shuffled_classes(spark, docs, rows, monkeypatch):
    """Several passes, small slices, and winners that are too many to be sent."""
    monkeypatch.setattr(ls, "BLOCK_TERMS", 9)
    monkeypatch.setattr(ls, "NEAR_BYTES", 0)
    monkeypatch.setattr(ls, "CELLS", 40)
    assert run(spark, docs, 4) == brute(rows, ITEMS, 4)


def test_nothing_to_find(spark, docs, empty_docs):
    assert not run(spark, empty_docs)
    assert not run(spark, docs, items=[])
    assert not run(spark, docs, items=[(1, None), (2, " -- ")])


def test_one_large_class(spark):
    """A class of many copies gives its smallest ids, and one score."""
    docs = spark.range(3000).selectExpr("id * 7 % 3001 as doc_id", "if(id % 3 = 0, 'alpha beta', concat('alpha ', id)) as text")
    found = ls.ranked_search(docs, spark.createDataFrame([(1, "Beta")], "item_id long, text string")).orderBy("rank").collect()
    assert [r.doc_id for r in found] == sorted(i * 7 % 3001 for i in range(0, 3000, 3))[:50]
    assert len({r.score for r in found}) == 1


def test_sums_beyond_doubles():
    """Integers take over where sums of doubles would not be exact."""
    items = ls.Items([(0, 0), (1, 0), (0, 1)], 2, 2, np.array([2**40, 3]))
    assert not items.exact
    place, count = np.array([0, 1, 1]), np.array([5, 1, 2])
    gain = lambda w, tf, m: w * ((10**9 * tf) // (1000 * tf + 20 * m))
    (first, scores), = items.scores(place, count, np.array([2, 1]), np.array([50, 70]))
    assert first == 0
    assert scores.tolist() == [[gain(2**40, 5, 50) + gain(3, 1, 50), gain(2**40, 5, 50)], [gain(3, 2, 70), 0]]
