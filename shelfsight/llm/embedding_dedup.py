"""Near-duplicate embeddings by an inverted multi-index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.components import connected_components
from shelfsight.llm.registry import query, table
from shelfsight.session import written

THRESHOLD = 0.9
TARGET_RECALL = 0.99
SAMPLE_VALUES = 2_000_000  # numbers in the sample that the codebooks are fitted on
CANDIDATES = 2048  # vectors of the sample that are compared with every row to see which have partners
CHECKED = 256  # groups of these, or copies where there are fewer, that tell how many cells to visit
CELL_ROWS = 256
MAX_CODES = 1024
LEAST_CELLS = 4
MEMBERS, PROBES = 256, 512  # rows of each side in one tile
ROUNDS = 10


@dataclass(frozen=True)
class MultiIndex:
    """A codebook for each half of the vectors; cell ``i * codes + j`` is codeword i of the first and j of the second."""

    first: np.ndarray
    second: np.ndarray

    @property
    def codes(self) -> int:
        return len(self.first)

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return _squared(vectors[:, :cut], self.first), _squared(vectors[:, cut:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        near, far = self.distances(vectors)
        return near.argmin(axis=1) * self.codes + far.argmin(axis=1)

    def traverse(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        """The ``visits`` nearest cells of each vector, nearest first, as the multi-sequence order gives them.

        In that order the cell of the i-th nearest first code and the j-th nearest second code comes after the
        i * j cells whose codes are as near or nearer, so only cells with i * j <= visits need be looked at.
        """
        visits = min(visits, self.codes**2)
        near, far = self.distances(vectors)
        by_first, by_second = near.argsort(axis=1, kind="stable"), far.argsort(axis=1, kind="stable")
        ranks = [(i, j) for i in range(min(visits, self.codes)) for j in range(min(visits // (i + 1), self.codes))]
        i, j = np.array(ranks).T
        rows = np.arange(len(vectors))[:, None]
        a, b = by_first[:, i], by_second[:, j]
        order = (near[rows, a] + far[rows, b]).argsort(axis=1, kind="stable")[:, :visits]
        return np.take_along_axis(a * self.codes + b, order, axis=1)


def _squared(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)


def _codebook(x: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Codewords of ``x`` by Lloyd's rounds from a seeded start; a codeword without points stays where it is."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:codes]].copy()
    for _ in range(ROUNDS):
        nearest = _squared(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(classes: DataFrame, rows: int, dimension: int) -> tuple[MultiIndex, np.ndarray, np.ndarray]:
    """The index and the sample it was fitted on (ids and vectors): the rows with the smallest hashes, ``SAMPLE_VALUES`` numbers at most."""
    size = max(CANDIDATES, SAMPLE_VALUES // dimension)
    drawn = classes.select("rep", "vector").orderBy(F.xxhash64("rep"), "rep").limit(size).toPandas()
    sample = unit(drawn["vector"])
    codes = max(1, min(math.isqrt(math.ceil(rows / CELL_ROWS)), MAX_CODES, len(sample)))
    half = (dimension + 1) // 2
    return MultiIndex(_codebook(sample[:, :half], codes, 1), _codebook(sample[:, half:], codes, 2)), drawn["rep"].to_numpy(), sample


def _partners(classes: DataFrame, reps: np.ndarray, candidates: np.ndarray, threshold: float) -> np.ndarray:
    """How many other rows each candidate is linked to, by brute force."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for at in range(0, len(batch), MEMBERS):
                part = batch.iloc[at : at + MEMBERS]
                near = candidates @ unit(part["vector"]).T >= threshold
                n += (near & (reps[:, None] != part["rep"].to_numpy())).sum(axis=1)
        yield pd.DataFrame({"q": np.flatnonzero(n), "n": n[n > 0]})

    found = np.zeros(len(candidates), np.int64)
    for row in classes.select("rep", "vector").mapInPandas(counted, "q long, n long").groupBy("q").agg(F.sum("n").alias("n")).collect():
        found[row.q] = row.n
    return found


def _one_of_each_group(candidates: np.ndarray, partners: np.ndarray, threshold: float) -> np.ndarray:
    """The first of the candidates with partners in each group that their own links form."""
    linked = np.flatnonzero(partners)
    near = candidates[linked] @ candidates[linked].T >= threshold
    np.fill_diagonal(near, True)
    low = np.arange(len(linked))
    while len(linked):
        lower = np.where(near, low, len(linked)).min(axis=1)
        if (lower == low).all():
            break
        low = lower
    return linked[low == np.arange(len(linked))]


def _copies_at(vectors: np.ndarray, cosine: float) -> np.ndarray:
    """A seeded copy of each vector in a random direction, at just that cosine."""
    aside = np.random.default_rng(3).normal(size=vectors.shape)
    aside -= (aside * vectors).sum(axis=1, keepdims=True) * vectors
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    return cosine * vectors + math.sqrt(max(0.0, 1 - cosine * cosine)) * aside


def meeting_places(index: MultiIndex, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows of ``a`` and ``b``: the least number of visits with which either meets the other's cell."""
    sides = []
    home = index.cells(a), index.cells(b)
    places = np.ones(len(a), np.int64)
    apart = np.flatnonzero(home[0] != home[1])
    for x, target in ((a, home[1]), (b, home[0])):
        near, far = index.distances(x[apart])
        rows = np.arange(len(apart))
        reach = near[rows, target[apart] // index.codes] + far[rows, target[apart] % index.codes]
        far.sort(axis=1)
        sides.append([1 + int(f.searchsorted(r - n).sum()) for n, f, r in zip(near, far, reach, strict=True)])
    if len(apart):
        places[apart] = np.minimum(np.min(sides, axis=0), index.codes**2)
    return places


def _visits(places: np.ndarray, weights: np.ndarray, recall: float) -> int:
    """The least number of visits with which the share ``recall`` of the weights is met."""
    if not len(places):
        return LEAST_CELLS
    order = np.argsort(places, kind="stable")
    met = np.cumsum(weights[order])
    return int(places[order][np.searchsorted(met, min(recall, 1) * met[-1] * (1 - 1e-12))])


def cells_to_visit(classes: DataFrame, index: MultiIndex, reps: np.ndarray, sample: np.ndarray, threshold: float, recall: float) -> int:
    """How many cells to visit so that the share ``recall`` is found, measured by brute force; as many as that takes.

    ``CANDIDATES`` vectors of the sample are compared with every row to see which have partners; of each group among
    them one is checked, ``CHECKED`` at most. A link is found if either end meets the other's cell in time.
    The share has to be reached over all links of the checked vectors and as a mean of the shares of each, so that a
    group with most of the links does not speak for the small ones. Fewer groups than ``CHECKED`` say too little
    about rare links; other vectors then make up the number with copies at just the threshold, whose share counts
    by itself. The driver gets one row per position.
    """
    reps, candidates = reps[:CANDIDATES], sample[:CANDIDATES]
    partners = _partners(classes, reps, candidates, threshold)
    chosen = _one_of_each_group(candidates, partners, threshold)[:CHECKED]
    ids, checked, degree = reps[chosen], candidates[chosen], partners[chosen]
    rest = np.setdiff1d(np.arange(len(candidates)), chosen)
    rest = rest[np.argsort(partners[rest] > 0, kind="stable")][: CHECKED - len(chosen)]
    copied = meeting_places(index, candidates[rest], _copies_at(candidates[rest], min(max(threshold, -1.0), 1.0)))
    needed = [LEAST_CELLS, _visits(copied, np.ones(len(copied)), recall)]

    def positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), MEMBERS):
                part = batch.iloc[at : at + MEMBERS]
                x = unit(part["vector"])
                q, r = np.nonzero((checked @ x.T >= threshold) & (ids[:, None] != part["rep"].to_numpy()))
                if len(q):
                    found = pd.DataFrame({"place": meeting_places(index, checked[q], x[r]), "n": 1, "share": 1 / degree[q]})
                    yield found.groupby("place", as_index=False).sum()

    if len(chosen):
        places = classes.select("rep", "vector").mapInPandas(positions, "place long, n long, share double")
        met = places.groupBy("place").agg(F.sum("n").alias("n"), F.sum("share").alias("share")).toPandas()
        needed += [_visits(met["place"].to_numpy(), met[weight].to_numpy(np.float64), recall) for weight in ("n", "share")]
    return max(needed)


def _placed(index: MultiIndex, visits: int):
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                walks = index.traverse(unit(batch["vector"]), visits)
                yield batch.assign(cell=walks[:, 0].astype("int64"), walk=list(walks.astype("int64")))

    return placed


def _links(threshold: float):
    """Compares one tile. Gives ``(a, null, n)`` for n links of a, and edges ``(a, b, null)`` that span its components.

    A link is counted for the probing row. The member counts it as well, unless it meets the other's cell on
    its own walk and so counts it there.
    """

    def links(members: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"a": [], "b": [], "n": []}, dtype="Int64")
        if not len(members) or not len(probes):
            return out
        near = unit(members["vector"]) @ unit(probes["vector"]).T >= threshold
        ids, probing = members["rep"].to_numpy(), probes["rep"].to_numpy()
        near &= ids[:, None] != probing
        m, p = np.nonzero(near)
        if not len(m):
            return out
        walks, home = np.stack(members["walk"].to_numpy()), probes["home"].to_numpy()
        alone = ~(walks[m] == home[p][:, None]).any(axis=1)
        counts = pd.concat([
            pd.Series(members["copies"].to_numpy()[m]).groupby(probing[p]).sum(),
            pd.Series(probes["copies"].to_numpy()[p][alone]).groupby(ids[m][alone]).sum(),
        ])
        low, lowest = ids.copy(), probing.copy()
        while True:
            before = low.sum() + lowest.sum()
            np.minimum.at(lowest, p, low[m])
            np.minimum.at(low, m, lowest[p])
            if low.sum() + lowest.sum() == before:
                break
        a, b = np.concatenate([ids, probing]), np.concatenate([low, lowest])
        spans = pd.DataFrame({"a": a[a != b], "b": b[a != b]}).drop_duplicates()
        return pd.concat([pd.DataFrame({"a": counts.index.astype("int64"), "n": counts.to_numpy()}), spans]).astype("Int64")[["a", "b", "n"]]

    return links


def _compare(classes: DataFrame, dimension: int, threshold: float, recall: float) -> DataFrame:
    rows = classes.count()
    index, reps, sample = fit(classes, rows, dimension)
    visits = cells_to_visit(classes, index, reps, sample, threshold, recall)
    schema = "rep long, copies long, vector array<float>, cell long, walk array<long>"
    if dict(classes.dtypes)["vector"] != "array<float>":
        schema = schema.replace("array<float>", "array<double>")
    placed = written(classes.select("rep", "copies", "vector").mapInPandas(_placed(index, visits), schema), "vector-cells")
    # Renamed columns are new ones to Spark, which would take the two sides of the tiles for the same columns else.
    walks = placed.toDF("rep", "copies", "vector", "home", "walk").withColumn("cell", F.explode("walk")).drop("walk")
    members, probes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("members")), walks.select("cell").groupBy("cell").agg(F.count(F.lit(1)).alias("probes"))
    tiles = members.join(probes, "cell").select(
        "cell", F.ceil(F.col("members") / MEMBERS).alias("down"), F.ceil(F.col("probes") / PROBES).alias("across")
    )
    tiles = written(tiles, "vector-tiles")

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one strip of its own side, and in every strip of the other side."""
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return frame.join(tiles, "cell").withColumn(f"_{own}", F.pmod(F.xxhash64("rep"), F.col(own))).withColumn(f"_{other}", every).drop("down", "across")

    keys = ["cell", "_down", "_across"]
    tile = dealt(placed, "down", "across").groupBy(*keys).cogroup(dealt(walks, "across", "down").groupBy(*keys))
    return tile.applyInPandas(_links(threshold), "a long, b long, n long")


def embedding_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """One row per row of ``vectors``: ``(id, n_links, component_id, kept)``.

    Two ids are linked if the cosine of their vectors, in double precision, is at least ``threshold`` and the
    index brings them together. Equal vectors are one class, compared once. Independent codebooks on the two
    halves of the vectors, fitted on a bounded sample, give a grid of cells; every vector lies in one cell and
    visits the nearest ones in multi-sequence order, as many as a brute-force comparison of some vectors with
    all rows (and with copies at the threshold, where few have partners) needs for the target recall, per link
    and per vector. What meets in a cell is verified in tiles of bounded size, which
    return counts and spanning edges rather than pairs, so a crowded cell is spread over many tasks.

    ``component_id`` is the smallest id that links reach, and a row is kept if that is its own. Vectors that
    are null, empty, zero or hold null or non-finite numbers, and rows without an id, link with nothing and
    are kept. Vectors of different lengths are never linked. Rows that repeat an id are one vertex with the
    links of all its vectors. An empty table gives an empty result; other columns are not looked at.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    sound = F.coalesce(
        (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists("vector", lambda v: v != 0), F.lit(False),
    )
    rows = written(rows.withColumn("sound", sound & F.col("id").isNotNull()), "vectors")
    classes = written(
        rows.where("sound").select("id", "vector").distinct().groupBy("vector")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes"
    )
    found = None
    for (dimension,) in sorted(classes.select(F.size("vector")).distinct().collect()):
        part = _compare(classes.where(F.size("vector") == dimension), dimension, threshold, recall)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "vector-links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    labels = connected_components(found.where("b is not null").select("a", "b"))
    # Copies of one vector that are also copies of nothing else still form a class of their own.
    state = written(
        classes.join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")),
        "vector-state",
    )
    placed = rows.where("sound").join(state, "vector").select("id", "links", "component")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return placed.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


@query("op4_embedding_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups(table(spark, folder, "embeddings"))
