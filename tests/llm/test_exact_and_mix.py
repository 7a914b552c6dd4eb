from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfsight.llm.exact_dedup import exact_duplicates
from shelfsight.llm.mixing import WORD, _key, mix, mixed, mixing_plan, ranked, water_fill, word_count


def expected_groups(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    out = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            out[i, keep, len(ids), i == keep] += 1
    return out


def groups_of(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect())


def test_exact(docs, rows, clashing, repeated, empty_docs):
    assert groups_of(exact_duplicates(docs)) == expected_groups(rows)
    assert groups_of(exact_duplicates(clashing)) == expected_groups(rows)
    assert groups_of(exact_duplicates(repeated)) == expected_groups(rows + rows)
    assert exact_duplicates(empty_docs).count() == 0


@pytest.mark.parametrize("weak", [lambda text: F.lit(b"same"), lambda text: F.substring(F.sha2(text, 256), 1, 1).cast("binary")])
def test_texts_with_one_digest_stay_apart(docs, rows, weak):
    assert groups_of(exact_duplicates(docs, digest=weak)) == expected_groups(rows)


def test_water_fill(spark):
    def targets(sizes, weights, budget, epochs=2.0):
        made = spark.createDataFrame([(str(n), s, float(w)) for n, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight double")
        return [r.target for r in water_fill(made, budget, epochs).orderBy("source").collect()]

    assert targets([100, 100, 100], [1, 1, 1], 300) == [100, 100, 100]
    # the first is clamped at 20; the rest share 280 as 1 to 2, and the last is clamped in the next round
    assert targets([10, 200, 60], [5, 1, 2], 300) == [20.0, 160.0, 120.0]
    assert targets([10, 10], [1, 1], 1000) == [20.0, 20.0]
    assert targets([0, 10], [3, 1], 15) == [0.0, 15.0]
    assert targets([5, 10], [0, 1], 15) == [0.0, 15.0]


def test_rank_over_ranges(spark):
    made = spark.createDataFrame([(s,) for s in ["b", "", None, "Z", "é", "a", "aa", "水"]], "source string").repartition(4)
    assert [r.source for r in ranked(made).orderBy("rank").collect()] == ["", "Z", "a", "aa", "b", "é", "水", None]


def brute_mix(spark, frame, seed="mix-1"):
    """Word counts and keys from the plan's own functions, everything after them by loops."""
    rows = frame.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(order)}
    budget, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        level = (budget - sum(target.values())) / (sum(weight[s] for s in free) or 1)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    out = Counter()
    for s in order:
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, before, unit = target[s] - whole * sizes[s], 0, Counter()
        for r in rows:
            if r.source == s:
                unit[r.key] += r["size"]
        drawn = set()
        for key in sorted(unit):
            if before + unit[key] / 2 <= rest:
                drawn.add(key)
            before += unit[key]
        for r in rows:
            if r.source == s:
                copies = whole + (r.key in drawn and r["size"] > 0)
                out[r.doc_id, s, r["size"], sizes[s], round(target[s], 6), copies * r["size"]] += 1
    return out


def mix_of(frame):
    return Counter((r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix(frame).collect())


def test_mix(spark, docs, clashing, repeated):
    want = brute_mix(spark, docs)
    assert mix_of(docs) == want
    assert mix_of(clashing) == want
    assert mix_of(repeated) == brute_mix(spark, repeated)
    by_source = defaultdict(lambda: [0, 0.0, 0])
    for (_, source, size, _, target, taken), n in want.items():
        assert taken <= 2 * size
        by_source[source] = [by_source[source][0] + n * taken, target, max(by_source[source][2], size)]
    for taken, target, largest in by_source.values():
        assert abs(taken - target) <= largest / 2 + 1e-6


def test_mixed_rows(docs, clashing):
    copies = Counter()
    for r in mix(docs).collect():
        copies[r.doc_id] += r.copies if r["size"] else 0
    got = Counter(r.doc_id for r in mixed(docs).where(F.col("text").rlike(WORD)).collect())
    assert got == +copies
    assert mixed(clashing).columns == clashing.columns
    assert mixed(clashing).count() == mixed(docs).count()


def test_mix_without_rows(empty_docs):
    assert mix(empty_docs).count() == 0 and mixed(empty_docs).count() == 0


def test_mix_of_blank_texts(spark):
    made = spark.createDataFrame([(1, None, "a"), (2, " \n", "b"), (3, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mix(made).collect()] == [(0, 0.0)] * 3


def test_fraction_that_ends_before_the_first_document_of_a_range(spark):
    made = spark.createDataFrame([(n, "w " * 10, s) for s in "abc" for n in range(7)], "doc_id long, text string, source string")
    for weights in [(3, 1, 2), (1, 1, 1), (9, 1, 1), (1, 20, 300)]:
        plan = {r.source: r for r in mixing_plan(
            made.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key("s").alias("key")), weights=weights).collect()}
        taken = Counter()
        for r in mix(made, seed="s", weights=weights).collect():
            taken[r.source] += r.taken
        assert all(abs(taken[s] - plan[s].target) <= 5 for s in "abc")


def test_words_in_use_stay_known_when_the_cache_is_full(monkeypatch):
    import public_tokenizers

    from shelfsight.llm import token_files

    monkeypatch.setattr(token_files, "CACHE", 200)
    path = public_tokenizers.path("byte_bpe_50k.json")
    made, learned = token_files.Encoder(path), []
    real = made._learn
    monkeypatch.setattr(made, "_learn", lambda new: learned.extend(new) or real(new))
    texts = [f"the common words{i} stay{i} known" + "".join(f" only{i}x{k}" for k in range(20)) for i in range(60)]
    found = [made.encode([text])[0] for text in texts]
    assert learned.count("common") == learned.count("known") == 1 and len(made.words) + len(made.earlier) <= 200
    assert found == made._whole(texts)
