"""Gradient boosting over sparse rows: the trees of ``GBTClassifier``, without a number per feature and row.

MLlib keeps every indicator of every row, zeros too. Here a value becomes the number of its bin, and a row keeps only the
bins that differ from those of zeros; what zeros add to a node is its total without the others. Rows lie in blocks,
sorted by bin, so that all sums of a block are sums of slices. Each level of a tree is one pass over the blocks.

Loss, residuals, weights of trees, gains and limits are MLlib's. Bins are cut at the same kind of places, but all rows
are looked at for them instead of some 10,000.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 15
DEEPEST = 8
# Most values kept of a feature while its bins are looked for; more are replaced by so many quantiles.
KEPT_VALUES = 1024
# Gains below this share of a node's sum of squares are rounding.
NO_GAIN = 1e-12
# Tasks of a pass per core at least; blocks are few bytes, so that more tasks cost more than they spread.
PASS_TASKS = 1
# Sums of a pass that the driver adds up itself; more are added up by tasks first.
GATHERED_NUMBERS = 2_000_000
BLOCK = "part long, rows int, good binary, places binary, bins binary, starts binary"
Values = dict[int, tuple[np.ndarray, np.ndarray]]


def grows(estimator: Any) -> bool:
    """Whether :func:`fit` grows the trees that the estimator asks for."""
    return (
        isinstance(estimator, GBTClassifier) and not estimator.isSet("weightCol") and not estimator.isSet("validationIndicatorCol")
        and estimator.getMaxDepth() <= DEEPEST and estimator.getFeatureSubsetStrategy() == "all" and estimator.getMinWeightFractionPerNode() == 0.0
    )


# Values and bins -------------------------------------------------------------------------------------


def parts_of(features: str) -> list[Column]:
    """What tasks get of a vector: its size, the places of a sparse one, its values. Arrow is slow where inner arrays are null."""
    vector, nowhere = F.unwrap_udt(features), F.array().cast("array<int>")
    size = F.when(vector["type"] == 0, vector["size"]).otherwise(F.size(vector["values"]))
    return [(vector["type"] == 0).alias("sparse"), size.alias("size"), F.coalesce(vector["indices"], nowhere).alias("indices"), vector["values"].alias("values")]


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all elements other than zero."""
    kind, indices, values = batch.column(0), batch.column(2), batch.column(3)
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    features = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = np.repeat(kind.to_numpy(zero_copy_only=False), lengths)
    features[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    stored = flat != 0
    return rows[stored], features[stored], flat[stored]


def _thinned(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``KEPT_VALUES`` of the sorted values, each for as many rows as the ones it stands for."""
    if len(values) <= KEPT_VALUES:
        return values, counts
    upto = np.cumsum(counts)
    group = np.minimum((upto - counts / 2) * KEPT_VALUES // upto[-1], KEPT_VALUES - 1).astype(np.int64)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    middle = (first + np.r_[first[1:], len(values)] - 1) // 2
    return values[middle], np.add.reduceat(counts, first)


def _counted(features: np.ndarray, values: np.ndarray, counts: np.ndarray) -> Values:
    order = np.lexsort((values, features))
    features, values, counts = features[order], values[order], counts[order]
    if not len(values):
        return {}
    new = np.flatnonzero(np.r_[True, (features[1:] != features[:-1]) | (values[1:] != values[:-1])])
    features, values, counts = features[new], values[new], np.add.reduceat(counts, new)
    at = np.flatnonzero(np.r_[True, features[1:] != features[:-1]])
    return {int(features[a]): _thinned(values[a:b], counts[a:b]) for a, b in zip(at, np.r_[at[1:], len(features)])}


def merged(one: Values, other: Values) -> Values:
    out = dict(one)
    for f, (values, counts) in other.items():
        if f in out:
            values, counts = np.r_[out[f][0], values], np.r_[out[f][1], counts]
            out.update(_counted(np.zeros(len(values), int) + f, values, counts))
        else:
            out[f] = values, counts
    return out


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each feature has which value other than zero; ones, which indicators are, need no sort."""
    rows, width, found, ones = 0, 0, {}, np.zeros(0, np.int64)
    for batch in batches:
        _, features, values = entries(batch)
        rows, width = rows + batch.num_rows, max(width, pc.max(batch.column(1)).as_py() or 0)
        one = values == 1.0
        seen = np.bincount(features[one], minlength=len(ones))
        seen[: len(ones)] += ones
        ones = seen
        other = ~one & ~np.isnan(values)
        found = merged(found, _counted(features[other], values[other], np.ones(other.sum(), np.int64)))
    given = np.flatnonzero(ones)
    found = merged(found, {int(f): (np.array([1.0]), ones[f : f + 1]) for f in given})
    yield pa.RecordBatch.from_pydict({"found": [pickle.dumps((rows, width, found))]}, pa.schema([("found", pa.binary())]))


def cuts_between(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """At most ``most`` places between sorted values: all of them, or such that as many rows lie between any two."""
    if len(values) - 1 <= most:
        return ((values[:-1] + values[1:]) / 2).tolist()
    stride, cuts, upto = counts.sum() / (most + 1), [], float(counts[0])
    target = stride
    for i in range(1, len(values)):
        before, upto = upto, upto + float(counts[i])
        if abs(before - target) < abs(upto - target):
            cuts.append(float(values[i - 1] + values[i]) / 2)
            target += stride
    return cuts


@dataclass
class Bins:
    """Bins of all features in one row of numbers: those of feature f begin at ``first[f]``, and zeros are in ``zero[f]``."""

    cuts: list[list[float]]
    first: np.ndarray = field(init=False)
    zero: np.ndarray = field(init=False)

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])]).astype(np.int64)
        self.zero = self.first[:-1] + np.array([np.searchsorted(c, 0.0) for c in self.cuts], dtype=np.int64)
        self.single = np.array([c[0] if c else math.inf for c in self.cuts])
        self.sizes = np.diff(self.first)

    @property
    def total(self) -> int:
        return int(self.first[-1])

    def of(self, features: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The bins of values; one on a cut is below it, and what is no number is above all cuts, as trees compare."""
        bins = self.first[features] + (~(values <= self.single[features]) & (self.sizes[features] > 1))
        several = np.flatnonzero(self.sizes[features] > 2)
        order = several[np.argsort(features[several], kind="stable")]
        at = np.flatnonzero(np.r_[True, np.diff(features[order]) != 0]) if len(order) else np.zeros(0, int)
        for a, b in zip(at, np.r_[at[1:], len(order)]):
            some = order[a:b]
            f = features[some[0]]
            bins[some] = self.first[f] + np.searchsorted(self.cuts[f], values[some])
        return bins


def bins_of(rows: DataFrame, features: str, max_bins: int) -> Bins:
    found = rows.select(*parts_of(features)).mapInArrow(_values, "found binary").rdd.map(lambda r: pickle.loads(r["found"]))
    count, width, values = found.treeReduce(lambda a, b: (a[0] + b[0], max(a[1], b[1]), merged(a[2], b[2])))
    if not count:
        raise ValueError("there are no rows to learn from")
    cuts = []
    for f in range(width):
        given, counts = values.get(f, (np.zeros(0), np.zeros(0, np.int64)))
        zeros = count - counts.sum()
        if zeros > 0:
            at = np.searchsorted(given, 0.0)
            given, counts = np.insert(given, at, 0.0), np.insert(counts, at, zeros)
        cuts.append(cuts_between(given, counts, min(max_bins, count) - 1))
    return Bins(cuts)


# Blocks ---------------------------------------------------------------------------------------------


def _blocks(bins: Bins) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("part", pa.int64()), ("rows", pa.int32()), *[(c, pa.binary()) for c in ("good", "places", "bins", "starts")]])

    def block(number: int, labels: np.ndarray, places: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        if not np.isin(labels, (0.0, 1.0)).all():
            raise ValueError("boosted trees tell two classes apart: labels are 0 or 1")
        order = np.argsort(found, kind="stable")
        given, starts = np.unique(found[order], return_index=True)
        row = {
            "part": TaskContext.get().partitionId() << 24 | number, "rows": len(labels), "good": labels.astype(np.int8).tobytes(),
            "places": places[order].astype(np.uint16).tobytes(), "bins": given.astype(np.int32).tobytes(), "starts": np.r_[starts, len(found)].astype(np.int32).tobytes()}
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = 0, [], 0

        def taken() -> pa.RecordBatch:
            return block(number, *[np.concatenate(parts) for parts in zip(*waiting)])

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                if size + batch.num_rows > BLOCK_ROWS:
                    yield taken()
                    number, waiting, size = number + 1, [], 0
                rows, features, values = entries(batch)
                found = bins.of(features, values)
                other = found != bins.zero[features]
                labels = batch.column(4).to_numpy(zero_copy_only=False)
                waiting.append((labels, rows[other] + size, found[other]))
                size += batch.num_rows
        if size:
            yield taken()

    return run


class _Block:
    def __init__(self, row):
        self.part, self.rows = row["part"], row["rows"]
        self.label = np.frombuffer(row["good"], np.int8) * 2.0 - 1.0
        self.places = np.frombuffer(row["places"], np.uint16)
        self.bins, self.starts = np.frombuffer(row["bins"], np.int32), np.frombuffer(row["starts"], np.int32)

    def between(self, low: int, high: int) -> np.ndarray:
        """The rows that lie in a bin from ``low`` up to but not with ``high`` and have it stored."""
        a, b = np.searchsorted(self.bins, (low, high))
        return self.places[self.starts[a] : self.starts[b]]

    def nodes(self, tree: Tree, bins: Bins) -> np.ndarray:
        """The node each row has come to; the children of node i are 2i + 1 and 2i + 2."""
        at = np.zeros(self.rows, np.int16)
        level = [0] if 0 in tree.splits else []
        while level:
            turn = np.zeros(self.rows, np.int8)
            for node in level:
                f, b = tree.splits[node]
                low, high, cut = bins.first[f], bins.first[f + 1], bins.first[f] + b + 1
                here = at == node
                if bins.zero[f] < cut:
                    turn[here] = 1
                    turn[(rows := self.between(cut, high))[here[rows]]] = 2
                else:
                    turn[here] = 2
                    turn[(rows := self.between(low, cut))[here[rows]]] = 1
            at = np.where(turn > 0, 2 * at + turn, at)
            level = [c for node in level for c in (2 * node + 1, 2 * node + 2) if c in tree.splits]
        return at

    def margin(self, trees: list[Tree], bins: Bins, rate: float) -> np.ndarray:
        out = np.zeros(self.rows)
        for i, tree in enumerate(trees):
            out += tree.predictions[self.nodes(tree, bins)] * (rate if i else 1.0)
        return out


# Trees ----------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Splits by node: (feature, last bin that goes left); (rows, sum, sum of squares) and prediction of every node."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    sums: dict[int, np.ndarray] = field(default_factory=dict)
    gains: dict[int, float] = field(default_factory=dict)

    @property
    def predictions(self) -> np.ndarray:
        out = np.zeros(max(self.sums) + 1)
        for node, (n, total, _) in self.sums.items():
            out[node] = total / n if n else 0.0
        return out


def _residuals(block: _Block, trees: list[Tree], bins: Bins, rate: float) -> np.ndarray:
    """What is left to learn: the labels, then the negative gradient of the logistic loss."""
    if not trees:
        return block.label
    with np.errstate(over="ignore"):
        return 4.0 * block.label / (1.0 + np.exp(2.0 * block.label * block.margin(trees, bins, rate)))


def _sums(blocks: RDD, bins: Bins, trees: list[Tree], tree: Tree, nodes: list[int], rate: float, subsample: float, seed: int) -> np.ndarray:
    """By node and bin, and in place ``bins.total`` of all the node's rows: (rows, sum, sum of squares) of the residuals."""
    total = bins.total

    def run(rows) -> Iterator[np.ndarray]:
        out = np.zeros((len(nodes), total + 1, 3))
        for row in rows:
            block = _Block(row)
            left = _residuals(block, trees, bins, rate)
            at = block.nodes(tree, bins)
            taken = None if subsample >= 1.0 else np.random.default_rng((seed, len(trees), block.part)).random(block.rows) < subsample
            for i, node in enumerate(nodes):
                here = (at == node) if taken is None else (at == node) & taken
                if not here.any():
                    continue
                both, squares = here + 1j * np.where(here, left, 0.0), np.where(here, left * left, 0.0)
                out[i, total] += both.real.sum(), both.imag.sum(), squares.sum()
                if len(block.bins):
                    found = np.add.reduceat(both[block.places], block.starts[:-1])
                    out[i, block.bins, 0] += found.real
                    out[i, block.bins, 1] += found.imag
                    out[i, block.bins, 2] += np.add.reduceat(squares[block.places], block.starts[:-1])
        yield out

    tasks = blocks.getNumPartitions()
    depth = 1 if tasks * len(nodes) * (total + 1) <= GATHERED_NUMBERS else 2
    return blocks.mapPartitions(run).treeReduce(np.add, depth)


def _with_zeros(sums: np.ndarray, bins: Bins) -> np.ndarray:
    """The sums by bin, with what rows without a stored value add to the bins of zeros."""
    by_bin, total = sums[:-1].copy(), sums[-1]
    by_bin[bins.zero] += total - np.add.reduceat(by_bin, bins.first[:-1], axis=0)
    return by_bin


def _best(by_bin: np.ndarray, total: np.ndarray, bins: Bins, least: int, min_gain: float) -> tuple[float, int, int, np.ndarray] | None:
    """(gain, feature, last bin that goes left, sums of what goes left), or None if no split gains anything."""
    upto = np.cumsum(by_bin, axis=0)
    before = np.concatenate([[np.zeros(3)], upto])[bins.first[:-1]]
    sizes = np.diff(bins.first)
    left = upto - np.repeat(before, sizes, axis=0)
    n, s = left[:, 0], left[:, 1]
    m = total[0] - n
    n, m = np.round(n), np.round(m)
    last = np.zeros(bins.total, bool)
    last[bins.first[1:] - 1] = True
    may = ~last & (n >= max(1, least)) & (m >= max(1, least))
    if not may.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(may, (s * s / n + (total[1] - s) ** 2 / m - total[1] ** 2 / total[0]) / total[0], -np.inf)
    place = int(np.argmax(gain))
    if gain[place] <= NO_GAIN * total[2] / total[0] or gain[place] < min_gain:
        return None
    feature = int(np.searchsorted(bins.first, place, side="right") - 1)
    return float(gain[place]), feature, int(place - bins.first[feature]), left[place]


def _grown(blocks: RDD, bins: Bins, trees: list[Tree], settings: Mapping[str, Any]) -> Tree:
    tree, depth = Tree(), settings["depth"]
    known: dict[int, np.ndarray] = {}
    level = [0]
    for below in range(depth + 1):
        # Of two children one is summed up; the other is what is left of their parent.
        asked = [node for node in level if node == 0 or node % 2 == 1]
        if below < depth or below == 0:
            sums = _sums(blocks, bins, trees, tree, asked, settings["rate"], settings["subsample"], settings["seed"])
            fresh = {node: (_with_zeros(s, bins), s[-1]) for node, s in zip(asked, sums)}
            for node in level:
                if node not in fresh:
                    parent, twin = known[(node - 1) // 2], fresh[node - 1][0]
                    fresh[node] = parent - twin, tree.sums[node]
            known = {node: by_bin for node, (by_bin, _) in fresh.items()}
            if below == 0:
                tree.sums[0] = fresh[0][1]
        if below == depth:
            break
        following = []
        for node in level:
            found = _best(known[node], tree.sums[node], bins, settings["least"], settings["min_gain"])
            if found is None:
                continue
            gain, feature, place, left = found
            tree.splits[node], tree.gains[node] = (feature, place), gain
            tree.sums[2 * node + 1], tree.sums[2 * node + 2] = left, tree.sums[node] - left
            following += [2 * node + 1, 2 * node + 2]
        level = following
        if not level:
            break
    return tree


def fit(estimator: GBTClassifier, df: DataFrame) -> GBTClassificationModel:
    """The model of ``estimator`` for ``df``; its blocks are kept while the trees grow."""
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    rows = df.select(features, F.col(label).cast("double").alias(label))
    bins = bins_of(rows, features, estimator.getMaxBins())
    packed = rows.select(*parts_of(features), label).mapInArrow(_blocks(bins), BLOCK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        packed = packed.repartition(cores)
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)  # before its plan is made, which would go past the copy
    try:
        settings = {
            "depth": estimator.getMaxDepth(), "rate": estimator.getStepSize(), "subsample": estimator.getSubsamplingRate(), "seed": abs(estimator.getSeed()),
            "least": estimator.getMinInstancesPerNode(), "min_gain": estimator.getMinInfoGain()}
        partitions = packed.rdd.getNumPartitions()
        blocks = packed.rdd.coalesce(min(partitions, max(PASS_TASKS * cores, math.ceil(partitions / 8))))
        trees: list[Tree] = []
        for _ in range(estimator.getMaxIter()):
            trees.append(_grown(blocks, bins, trees, settings))
    finally:
        packed.unpersist()
    return _as_model(estimator, trees, bins, df)


def _as_model(estimator: GBTClassifier, trees: list[Tree], bins: Bins, df: DataFrame) -> GBTClassificationModel:
    """MLlib's own model of the trees, which transforms, saves and loads like one it has fitted."""
    spark = df.sparkSession
    ml, gateway = spark._jvm.org.apache.spark.ml, spark.sparkContext._gateway
    width = len(bins.cuts)

    def node(tree: Tree, i: int):
        n, total, squares = (float(x) for x in tree.sums[i])
        mean = total / n if n else 0.0
        stats = gateway.new_array(gateway.jvm.double, 3)
        stats[0], stats[1], stats[2] = n, total, squares
        calculator = spark._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(round(n)))
        impurity = max(0.0, squares / n - mean * mean) if n else 0.0
        if i not in tree.splits:
            return ml.tree.LeafNode(mean, impurity, calculator)
        feature, place = tree.splits[i]
        split = ml.tree.ContinuousSplit(feature, bins.cuts[feature][place])
        return ml.tree.InternalNode(mean, impurity, tree.gains[i], node(tree, 2 * i + 1), node(tree, 2 * i + 2), split, calculator)

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        made[i] = ml.regression.DecisionTreeRegressionModel(f"{estimator.uid}_{i}", node(tree, 0), width)
        weights[i] = estimator.getStepSize() if i else 1.0
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(estimator.uid, made, weights, width, 2))
    return estimator._copyValues(model)
