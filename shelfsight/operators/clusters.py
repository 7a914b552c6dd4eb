"""Clustering and dimension reduction on a feature vector column."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.features import _Learned
from shelfsight.operators.sampling import uniform_sample
from shelfsight.session import written

SEED_ROWS = 4096  # rows among which centres start
TILE_ROWS, TILE_BYTES = 1024, 1 << 20  # most rows and bytes of vectors that are compared at a time
TILES_AT_A_TIME = 8


class _Summary(NamedTuple):
    trainingCost: float


class Clusters(_Learned):
    """Fitted centres; ``transform`` adds the nearest one as ``prediction``."""

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.learned["centres"]]

    @property
    def summary(self) -> _Summary:
        return _Summary(self.learned["cost"])

    def _transform(self, df: DataFrame) -> DataFrame:
        centres = np.array(self.learned["centres"])

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            return pd.Series(_gaps(np.stack(x.to_numpy()).astype(float), centres).argmin(axis=1), dtype="int32")

        return df.withColumn("prediction", nearest(vector_to_array("features")))


def fit_kmeans(df: DataFrame, k: int, tries: int = 15, max_iter: int = 500, seed: int = 42, tol: float = 1e-4) -> Clusters:
    """The best of several starts by total squared distance.

    All starts share their passes: k to draw the centres they start from, far apart among all rows, and then as many as the
    slowest start needs.
    """
    rows = df.select(vector_to_array("features").alias("x")).persist()
    try:
        centres = _drawn(rows, k, tries, seed)
        sums = _converged(rows, centres, max_iter, tol)
    finally:
        rows.unpersist()
    costs = {i: float(found[:, -1].sum()) for i, found in sums.items()}
    best = min(costs, key=costs.get)
    return Clusters({"centres": centres[best].tolist(), "cost": costs[best]})


def _drawn(rows: DataFrame, k: int, tries: int, seed: int) -> dict[int, np.ndarray]:
    """Per try ``k`` rows, each drawn with a chance that grows with its squared distance from those before.

    Of exponential waiting times at these rates, the shortest one is that of a row drawn so; every task sends its
    shortest per try. The times follow from the seed and the rows of a batch, so the same layout gives the same draws.
    """
    chosen: dict[int, list[list[float]]] = {i: [] for i in range(tries)}
    for turn in range(k):
        before = {i: np.array(c) for i, c in chosen.items()}

        def shortest(batches, before=before, turn=turn):
            best = {}
            for batch in batches:
                x = _matrix(batch)
                if not len(x):
                    continue
                for i, centres in before.items():
                    rate = _gaps(x, centres).min(axis=1) if turn else np.ones(len(x))
                    rng = np.random.default_rng([seed, i, turn, zlib.crc32(x.tobytes())])
                    with np.errstate(divide="ignore"):
                        waits = rng.standard_exponential(len(x)) / rate
                    at = int(waits.argmin())
                    if i not in best or waits[at] < best[i][0]:
                        best[i] = (float(waits[at]), x[at].tolist())
            yield from _batches([(i, *found) for i, found in best.items()], ["try", "wait", "x"], ["int32", "float64", "vector"])

        found = rows.mapInArrow(shortest, "try int, wait double, x array<double>")
        for row in found.groupBy("try").agg(F.min_by("x", F.struct("wait", "x")).alias("x"), F.min("wait").alias("wait")).collect():
            # Nothing lies apart from the centres: one of them is taken again.
            chosen[row["try"]].append(row["x"] if np.isfinite(row["wait"]) else chosen[row["try"]][0])
    if not chosen[0]:
        raise ValueError("no rows to find clusters in")
    return {i: np.array(c) for i, c in chosen.items()}


def _converged(rows: DataFrame, centres: dict[int, np.ndarray], max_iter: int, tol: float) -> dict[int, np.ndarray]:
    """Moves all ``centres`` until they stay, and gives what :func:`_assigned` finds for them in the end.

    All of them share their passes, in which only those that still move take part.
    """
    moving, sums = set(centres), {}
    for _ in range(max_iter):
        found = _assigned(rows, {k: centres[k] for k in sorted(moving)})
        sums |= found
        for k in sorted(moving):
            n = found[k][:, -3:-2]
            moved = np.where(n > 0, found[k][:, :-3] / np.maximum(n, 1), centres[k])
            if ((moved - centres[k]) ** 2).sum(axis=1).max() <= tol**2:
                moving.discard(k)  # the sums are those of the centres that stay
            else:
                centres[k] = moved
        if not moving:
            break
    if moving:
        sums |= _assigned(rows, {k: centres[k] for k in sorted(moving)})
    return sums


def k_sweep(
    df: DataFrame, k_values: Sequence[int] = range(2, 11), seed: int = 42, max_iter: int = 300, tol: float = 1e-4, seed_rows: int = SEED_ROWS
) -> DataFrame:
    """Inertia and silhouette (of all rows, see :func:`silhouette_rows`) per k; the highest silhouette is the best.

    All k share their passes: in each one, a row goes to its nearest centre of every k whose centres still move, and
    tasks send a sum per centre. So there are as many passes as the slowest k needs, and one more for the silhouettes.
    Centres start far apart among ``seed_rows`` rows chosen by a hash; every pass covers all rows.
    """
    spark = df.sparkSession
    rows = df.select(vector_to_array("features").alias("x")).persist()
    try:
        start = np.array([r["x"] for r in rows.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(seed_rows).collect()], dtype=float)
        if not len(start):
            return spark.createDataFrame([], "k int, inertia double, silhouette double, is_best boolean")
        centres = {k: _far_apart(start, k, np.random.default_rng([seed, k])) for k in k_values}
        sums = _converged(rows, centres, max_iter, tol)
        shares = _silhouettes(rows, centres, sums)
    finally:
        rows.unpersist()
    found = [(k, float(sums[k][:, -1].sum()), shares[k]) for k in k_values]
    best = max(found, key=lambda row: row[2])[0]
    return spark.createDataFrame(
        [(*row, row[0] == best) for row in found], "k int, inertia double, silhouette double, is_best boolean"
    ).orderBy("k")


def _far_apart(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the points, each drawn with a chance that grows with its squared distance from those before."""
    chosen = [points[rng.integers(len(points))]]
    gaps = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        total = gaps.sum()
        chosen.append(points[rng.choice(len(points), p=gaps / total)] if total > 0 else chosen[0])
        gaps = np.minimum(gaps, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, from the middle of the centres so that far-off points lose no digits."""
    middle = centres.mean(axis=0)
    x, centres = x - middle, centres - middle
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0.0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of column ``x`` as rows of a matrix, without an object per row."""
    x = batch.column(batch.schema.get_field_index("x"))
    return np.asarray(x.flatten()).astype(float, copy=False).reshape(len(x), -1) if len(x) else np.empty((0, 0))


def _batches(rows: list[tuple], names: Sequence[str], kinds: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """``rows`` as one Arrow batch, if there are any."""
    types = [pa.list_(pa.float64()) if kind == "vector" else pa.type_for_alias(kind) for kind in kinds]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=list(names))


def _assigned(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per k a row for each centre: the sum of its points, their number, sum of squares, and sum of squared distances."""

    def sums(batches):
        total = {k: np.zeros((len(c), c.shape[1] + 3)) for k, c in centres.items()}
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            for k, c in centres.items():
                gaps = _gaps(x, c)
                own = gaps.argmin(axis=1)
                member = np.zeros((len(x), len(c)))
                member[np.arange(len(x)), own] = 1.0
                # The products that tell the nearest centre lose digits that a sum over all rows shows.
                more = np.column_stack([x, np.ones(len(x)), (x * x).sum(axis=1), ((x - c[own]) ** 2).sum(axis=1)])
                total[k] += member.T @ more
        yield from _batches([(k, i, row.tolist()) for k, t in total.items() for i, row in enumerate(t)], ["k", "c", "v"], ["int32", "int32", "vector"])

    cells = rows.mapInArrow(sums, "k int, c int, v array<double>").select("k", "c", F.posexplode("v").alias("i", "v"))
    found = {k: np.zeros((len(c), c.shape[1] + 3)) for k, c in centres.items()}
    for row in cells.groupBy("k", "c", "i").agg(F.sum("v").alias("v")).collect():
        found[row["k"]][row["c"], row["i"]] = row["v"]
    return found


def _silhouettes(rows: DataFrame, centres: dict[int, np.ndarray], sums: dict[int, np.ndarray]) -> dict[int, float]:
    """Mean silhouette of all rows for every k in one pass; centres without points do not count."""

    def scores(batches):
        total = {k: [0.0, 0] for k in centres}
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            for k, c in centres.items():
                there = np.flatnonzero(sums[k][:, -3] > 0)
                sizes, squares = sums[k][there, -3], sums[k][there, -2]
                own = np.searchsorted(there, _gaps(x, c).argmin(axis=1))
                total[k][0] += _silhouette_values(x, own, sums[k][there, :-3] / sizes[:, None], sizes, squares).sum()
                total[k][1] += len(x)
        yield from _batches([(k, float(s), n) for k, (s, n) in total.items()], ["k", "s", "n"], ["int32", "float64", "int64"])

    found = rows.mapInArrow(scores, "k int, s double, n long").groupBy("k").agg((F.sum("s") / F.sum("n")).alias("mean"))
    return {r["k"]: float(r["mean"]) for r in found.collect()}


def _silhouette_values(points: np.ndarray, own: np.ndarray, centres: np.ndarray, sizes: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Silhouettes of points in cluster ``own``, from each cluster's mean, size and sum of squared lengths."""
    row = np.arange(len(points))
    means = np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + squares / sizes, 0.0)
    inner = means[row, own] * sizes[own] / np.maximum(sizes[own] - 1, 1)
    means[row, own] = np.inf
    outer = means.min(axis=1)
    largest = np.maximum(inner, outer)
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.where(largest > 0, (outer - inner) / largest, 0.0)
    return np.where((sizes[own] == 1) | (len(sizes) == 1), 0.0, value)


def silhouette_rows(df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """``df`` with the silhouette of every row by squared Euclidean distance.

    The mean squared distance of a row to a cluster follows from the cluster's size, sum and sum of squares,
    so no two rows are compared: one aggregation of clusters times dimensions numbers, then one pass.
    A cluster of one row, or a single cluster, has silhouette 0.
    """
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    vector = vector_to_array(features) if is_vector else F.col(features).cast("array<double>")
    ready = df.withColumn("_x", vector)
    sums = ready.select(F.col(cluster).alias("c"), F.posexplode("_x").alias("i", "x")).groupBy("c", "i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares")
    ).toPandas()
    labels = sorted(sums["c"].unique().tolist())
    centres = sums.pivot(index="c", columns="i", values="total").loc[labels].to_numpy(float) if labels else np.empty((0, 0))
    by_label = sums.groupby("c")
    sizes, squares = by_label["n"].max().loc[labels].to_numpy(float), by_label["squares"].sum().loc[labels].to_numpy(float)
    centres = centres / sizes[:, None] if labels else centres

    @F.pandas_udf("double")
    def score(x: pd.Series, c: pd.Series) -> pd.Series:
        points = np.stack(x.to_numpy()).astype(float)
        return pd.Series(_silhouette_values(points, np.searchsorted(labels, c.to_numpy()), centres, sizes, squares))

    return ready.withColumn("silhouette", score("_x", F.col(cluster))).drop("_x")


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean silhouette of all rows by squared Euclidean distance; 0 for a single cluster."""
    return float(silhouette_rows(df, features, cluster).agg(F.avg("silhouette")).first()[0] or 0.0)


def sampled_silhouette_rows(
    df: DataFrame, ids: Sequence[str], sample: int, features: str = "features", cluster: str = "cluster", seed: int = 42
) -> DataFrame:
    """Silhouette by Euclidean distance of each row of a uniform sample of exactly ``sample`` rows (or all, if fewer).

    This measure compares every row with every other, so the caller has to say on how many: the work grows with the square
    of their number. Rows are put into tiles; a task compares its tiles with those of the other side one by one
    and keeps sums per row and cluster, so it never holds more than a few tiles and no pair of rows is ever emitted.
    """
    spark = df.sparkSession
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    vector = vector_to_array(features) if is_vector else F.col(features).cast("array<double>")
    taken = uniform_sample(df.select(*ids, F.col(cluster).cast("int").alias("cluster"), vector.alias("x")), ids, sample, seed)
    kinds = {c: df.schema[c].dataType.simpleString() for c in ids}
    tiles = written(taken.mapInArrow(_tiles(list(ids)), f"tile string, c binary, x binary, ids struct<{', '.join(f'`{c}`: array<{kind}>' for c, kind in kinds.items())}>"), "tiles")
    sizes = {r["cluster"]: r["n"] for r in taken.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = np.array(sorted(sizes), dtype=np.int32)
    counts = np.array([sizes[c] for c in labels.tolist()], dtype=float)

    def summed(batches):
        """Distances of a tile's rows to each cluster, added up over the tiles of the other side as long as these come together."""
        now, total = None, None
        for batch in batches:
            for tile, x, other, y, c in zip(batch["tile"], batch["x"], batch["other"], batch["y"], batch["c"], strict=True):
                if tile != now:
                    if now is not None:
                        yield pd.DataFrame([(now, total.tobytes())], columns=["tile", "sums"])
                    now, total = tile, 0.0
                total = total + _distance_sums(x, y, np.searchsorted(labels, np.frombuffer(c, np.int32)), len(labels), tile == other)
        if now is not None:
            yield pd.DataFrame([(now, total.tobytes())], columns=["tile", "sums"])

    def score(batches):
        for batch in batches:
            for c, sums, *values in zip(batch["c"], batch["sums"], *[batch[f"_{i}"] for i in range(len(ids))], strict=True):
                member = np.frombuffer(c, np.int32)
                total = np.sum([np.frombuffer(s).reshape(len(member), -1) for s in sums], axis=0)
                out = _distance_silhouettes(total, np.searchsorted(labels, member), counts)
                yield pd.DataFrame({**dict(zip(ids, values)), "cluster": member, "silhouette": out})

    with _records_per_batch(spark, TILES_AT_A_TIME):
        left = tiles.select("tile", "x").repartition(max(spark.sparkContext.defaultParallelism, 1))
        right = tiles.select(F.col("tile").alias("other"), F.col("x").alias("y"), "c")
        sums = written(left.crossJoin(right).mapInPandas(summed, "tile string, sums binary"), "tile-sums")
        whole = tiles.join(sums.groupBy("tile").agg(F.collect_list("sums").alias("sums")), "tile")
        schema = ", ".join([*[f"`{c}` {kind}" for c, kind in kinds.items()], "cluster int", "silhouette double"])
        given = whole.select("c", "sums", *[F.col(f"ids.`{c}`").alias(f"_{i}") for i, c in enumerate(ids)])
        return written(given.mapInPandas(score, schema), "silhouettes")


@contextmanager
def _records_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside hands Python workers at most ``rows`` rows at a time, as each row is a whole tile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _tiles(ids: list[str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            step = max(1, min(TILE_ROWS, TILE_BYTES // max(x[0].nbytes, 1)))
            for start in range(0, len(x), step):
                part, rows = batch.slice(start, step), x[start : start + step]
                members = np.asarray(part.column("cluster")).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), part.column(c)) for c in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([members.tobytes()]), pa.array([rows.tobytes()]), pa.StructArray.from_arrays(lists, names=ids)],
                    names=["tile", "c", "x", "ids"])

    return cut


def _distance_sums(x: bytes, y: bytes, group: np.ndarray, count: int, same: bool) -> np.ndarray:
    """For each row of tile ``x`` the sum of its distances to the rows of ``y`` in each cluster."""
    width = len(y) // 8 // len(group)
    points, others = np.frombuffer(x).reshape(-1, width), np.frombuffer(y).reshape(-1, width)
    member = np.zeros((len(others), count))
    member[np.arange(len(others)), group] = 1.0
    squares = (others**2).sum(axis=1)
    found = np.empty((len(points), count))
    for start in range(0, len(points), 256):
        own = points[start : start + 256]
        gaps = np.sqrt(np.maximum((own**2).sum(axis=1)[:, None] + squares[None, :] - 2 * own @ others.T, 0))
        if same:
            gaps[np.arange(len(own)), start + np.arange(len(own))] = 0.0
        found[start : start + 256] = gaps @ member
    return found


def _distance_silhouettes(sums: np.ndarray, mine: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    row = np.arange(len(sums))
    inner = sums[row, mine] / np.maximum(sizes[mine] - 1, 1)
    means = sums / sizes
    means[row, mine] = np.inf
    outer = means.min(axis=1)
    largest = np.maximum(inner, outer)
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.where(largest > 0, (outer - inner) / largest, 0.0)
    return np.where((sizes[mine] == 1) | (len(sizes) == 1), 0.0, value)


def _centred(df: DataFrame) -> DataFrame:
    centre = StandardScaler(inputCol="features", outputCol="_centred", withMean=True, withStd=False)
    return centre.fit(df.select("features")).transform(df)


def project(df: DataFrame, k: int = 2) -> tuple[DataFrame, float]:
    """(``df`` with PC1..PCk, share of variance they keep). The sign of a component is arbitrary."""
    centred = _centred(df)
    model = PCA(k=k, inputCol="_centred", outputCol="_pca").fit(centred)
    parts = vector_to_array("_pca")
    shown = model.transform(centred).withColumns({f"PC{i + 1}": parts[i] for i in range(k)})
    return shown.drop("_centred", "_pca"), float(model.explainedVariance.toArray().sum())


def explained_variance(df: DataFrame) -> DataFrame:
    """Share and running share of variance per component, largest first."""
    size = len(df.select(vector_to_array("features").alias("x")).first()["x"])
    shares = PCA(k=size, inputCol="_centred", outputCol="_pca").fit(_centred(df)).explainedVariance.toArray()
    rows = [(i + 1, float(s), float(shares[: i + 1].sum())) for i, s in enumerate(shares)]
    return df.sparkSession.createDataFrame(rows, "component int, share double, cumulative double")


def components_for(variance: DataFrame, share: float) -> int:
    """Fewest components that keep ``share`` of the variance."""
    row = variance.where(F.col("cumulative") >= share - 1e-12).agg(F.min("component")).first()
    return row[0]
