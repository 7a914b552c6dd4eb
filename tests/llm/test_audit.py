import re
from collections import Counter
from itertools import permutations

import pytest

from shelfsight.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = [(0, 1, 0), (3, 1, 1), (6, 0, 1), (9, None, 1), (12, 1, None), (None, 1, 1), (15, 0, 0), (15, 1, 0), (777777, 1, 1), *[(i, i % 2, i % 5 == 0) for i in range(30, 300, 9)]]
SCHEMA = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t and i is not None}
    docs = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if i is not None and least[text] < i else set()
        docs.append((lang or "", fails, i in good, i in bad))
    want = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        sums = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [d for d in mine if letter in d[1] and not d[1] & before]
                sums[letter] += len(removed)
                want[part, "".join(order), step] = [
                    sum(not d[1] & (before | {letter}) for d in mine), len(removed), sum(letter in d[1] and bool(d[1] & before) for d in mine),
                    sum(d[1] == {letter} for d in mine), sum(d[2] for d in removed), sum(d[3] for d in removed), letter,
                ]
        for key, counts in want.items():
            if key[0] == part:
                counts[-1] = sums[counts[-1]]
    return want


def more(rows):
    """Texts that fail C and D, languages, and copies under repeated and null ids."""
    shouted = "LOUD Words " * 60
    return [
        *((i, text, ["en", "de", None, ""][n % 4], *rest) for n, (i, text, _, *rest) in enumerate(rows)),
        (50_000, shouted, "de", "b", 1), (50_001, shouted + "#", "de", "b", 1), (50_001, shouted + "#", "de", "b", 1), (None, shouted, "de", "b", 1),
        (50_002, " ".join(f"w{n}" for n in range(200)), "fr", "b", 1), (50_003, "ÀÉ" * 60 + "\x1cX\x85y z", "fr", "b", 1), (50_002, None, "fr", "b", 1),
    ]


def run(spark, docs):
    found = fa.audit_filters(docs, spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in LABELS], SCHEMA))
    return {tuple(r[:3]): list(r[3:]) for r in found.collect()}


def test_all_orders(spark, rows, docs):
    from pyspark.sql import functions as F

    given = more(rows)
    frame = spark.createDataFrame(given, docs.schema).repartition(3)
    want = brute(given, LABELS)
    assert run(spark, frame) == want
    clashing = frame.select("*", *[F.lit(n).alias(n) for n in ("part", "bits", "n", "_hash", "good", "bad", "quality", "toxic", "step", "_least")])
    assert run(spark, clashing) == want
    assert run(spark, frame.unionAll(frame)) == brute(given + given, LABELS)


def test_empty(spark, empty_docs):
    assert run(spark, empty_docs) == {}


@pytest.mark.parametrize(("split", "near"), [(10, 100_000), (10_000, 0), (3, 0)])
def test_copies_are_split(spark, split, near):
    """One text of a third of all rows, dealt over many places, with and without hashes sent to tasks."""
    docs = spark.range(900).selectExpr("id * 7 % 901 as doc_id", "case when id % 3 = 0 then 'same text' when id % 3 = 1 then concat('pair ', id div 6) else concat('own ', id) end as text")
    got = sorted(r.doc_id for r in fa.later_copies(docs, split, near).collect())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.text, []).append(r.doc_id)
    assert got == sorted(i for ids in texts.values() for i in ids if i > min(ids))


def test_equal_hashes_of_different_texts(spark, monkeypatch):
    """The whole text decides where hashes agree."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "b"), (6, "d")], "doc_id long, text string")
    monkeypatch.setattr(fa.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    assert sorted(r.doc_id for r in fa.later_copies(docs).collect()) == [3, 5]
