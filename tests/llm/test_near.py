import random

import numpy as np
import pytest
import xxhash

from shelfsight.llm import embedding_dedup
from shelfsight.llm.components import connected_components
from shelfsight.llm.embedding_dedup import MultiIndex, embedding_groups
from shelfsight.llm.simhash import near_pairs, simhash, simhash_groups


def roots(n, edges):
    above = list(range(n))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("edges", [
    [], [(5, 5)], [(n, n + 1) for n in range(40)], [(n + 1, n) for n in range(0, 40, 2)] + [(3, 8), (20, 2), (20, 2)],
    [(0, n) for n in range(1, 50)], [(49, n) for n in range(49)], [(n, (n * 7) % 50) for n in range(50)],
])
def test_components(spark, edges):
    made = spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long")
    want = roots(60, edges)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert {(r.node, r.component) for r in connected_components(made).collect()} == {(x, want[x]) for x in touched}


def plain_simhash(text, length=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + length]) for i in range(len(words) - length + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows):
    prints = [plain_simhash(text) for _, text, *_ in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    where = roots(len(rows), edges)
    smallest = {}
    for (i, *_), root in zip(rows, where):
        smallest[root] = min((x for x in (smallest.get(root), i) if x is not None), default=None)
    return sorted(((i, p, smallest[root]) for (i, *_), p, root in zip(rows, prints, where)), key=str)


def test_simhash_groups(docs, rows, clashing, repeated, empty_docs):
    def got(frame):
        return sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash_groups(frame).collect()), key=str)

    want = groups(rows)
    assert got(docs) == want
    assert got(clashing) == want
    assert got(repeated) == sorted([*want, *want], key=str)
    assert got(empty_docs) == []


def test_long_texts_vote_in_pieces():
    text = " ".join(str(n % 70001) for n in range(140000))
    assert simhash(text) % (1 << 64) == plain_simhash(text)


@pytest.mark.parametrize(("bits", "spare"), [(3, 3), (3, 1), (2, 2), (4, 2)])
def test_block_join_finds_each_pair_once(spark, bits, spare):
    rng = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(8)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = near_pairs(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), bits, spare).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits}
    assert len(found) == len(want) and {(r.a, r.b) for r in found} == want


def vectors(seed=1, dimension=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for _ in range(60):
        base = rng.normal(size=dimension)
        for _ in range(rng.integers(1, 6)):
            rows.append((i, [float(x) for x in np.float32(base + rng.normal(scale=0.12 * rng.random() * 2, size=dimension))]))
            i += 1
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, []), (1004, [0.0] * dimension), (1005, [float("nan")] * dimension)]
    rows += [(1006, [float("inf")] + [1.0] * (dimension - 1)), (1007, [None] + [1.0] * (dimension - 1)), (1008, [1.0, 2.0]), (1009, [2.0, 4.0])]
    rows += [(None, rows[0][1]), (1010, [x * 1e-30 for x in rows[3][1]]), (1011, rows[5][1])]
    return rows


def brute_links(rows, threshold=0.9):
    unit = []
    for i, v in rows:
        good = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float64) / max(map(abs, v)) if good else None
        unit.append(x / np.linalg.norm(x) if good else None)
    edges = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
    ]
    where = roots(len(rows), edges)
    count = np.bincount(np.array(edges, int).ravel(), minlength=len(rows))
    smallest = {}
    for (i, _), root in zip(rows, where):
        smallest[root] = min((x for x in (smallest.get(root), i) if x is not None), default=None)
    return sorted(((i, int(count[n]), smallest[where[n]]) for n, (i, _) in enumerate(rows)), key=str)


def test_embedding_groups(spark):
    rows = vectors()
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in made.collect()]
    out = embedding_groups(made).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    from pyspark.sql import functions as F

    more = made.select("*", *[F.lit(1).alias(c) for c in ("label", "cell", "rep", "copies", "vector", "id", "walk", "n")])
    assert sorted(embedding_groups(more).collect(), key=str) == sorted(out, key=str)


def test_embedding_groups_of_nothing(spark):
    assert embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    blank = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in embedding_groups(blank).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_repeated_vector_rows(spark):
    rows = [(1, [1.0, 0.0, 0.1]), (1, [1.0, 0.0, 0.1]), (2, [1.0, 0.0, 0.1]), (3, [0.0, 1.0, 0.0])]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in embedding_groups(made).collect()) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_a_crowded_cell_is_cut_into_tiles(spark):
    """Near copies in numbers beyond one tile: all links are counted, and no pair leaves a tile."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=12)
    rows = [(n, [float(x) for x in base + rng.normal(scale=0.02, size=12)]) for n in range(1500)]
    rows += [(n + 5000, [float(x) for x in rng.normal(size=12)]) for n in range(300)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(made).collect()}
    want = {i: (n, c) for i, n, c in brute_links(rows)}
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.99 * links
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_rare_links_beside_a_dense_group(spark, monkeypatch):
    """The dense group has nearly all links and is met in the first cells; the rare pairs need more."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 16)
    rng = np.random.default_rng(11)
    base = rng.normal(size=32)
    dense = base + rng.normal(scale=0.02, size=(800, 32))
    ends = rng.normal(size=(200, 32))
    ends /= np.linalg.norm(ends, axis=1, keepdims=True)
    others = embedding_dedup._copies_at(ends, 0.905)
    x = np.concatenate([dense, rng.normal(size=(1300, 32)), ends, others])
    made = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in embedding_groups(made).collect()}
    assert sum(got[n] == 0 for n in range(800)) >= 0.99 * 800
    assert sum(got[2100 + n] == got[2300 + n] for n in range(200)) >= 0.97 * 200


def test_visits_are_measured_without_links(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    classes = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(x)], "rep long, vector array<double>")
    codes = rng.normal(size=(2, 12, 16)) / 6
    index = MultiIndex(*codes)
    visits = embedding_dedup.cells_to_visit(classes, index, np.arange(2000), x, 0.9, 0.99)
    ends = x[1000:]
    others = embedding_dedup._copies_at(ends, 0.9)
    met = (index.traverse(ends, visits) == index.cells(others)[:, None]).any(axis=1) | (index.traverse(others, visits) == index.cells(ends)[:, None]).any(axis=1)
    assert visits > 4 and met.mean() >= 0.97


def test_multi_sequence_order():
    rng = np.random.default_rng(2)
    index = MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(7, 3)))
    x = rng.normal(size=(20, 6))
    near, far = index.distances(x)
    every = (near[:, :, None] + far[:, None, :]).reshape(20, 49)
    for visits in (1, 4, 11, 49, 80):
        assert (index.traverse(x, visits) == every.argsort(axis=1, kind="stable")[:, : min(visits, 49)]).all()
