"""Quality of texts by naive Bayes support vectors: n-gram indicators scaled by log-count ratios, and a linear hinge loss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from shelfsight.llm.lm_scoring import crc32_part
from shelfsight.llm.registry import query, table, unused, whole_texts
from shelfsight.session import written

EXAMPLES = 4096  # labelled rows the classifier is fitted on: those with the smallest hashes ...
ENTRIES = 4_000_000  # ... as long as they have at most that many different n-grams, counted per row
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 60
ENOUGH = 0.01  # dual coordinate descent ends when no projected gradient is farther from 0
FOLDS = 3
THRESHOLD = 0.7
SEED = 11
CHUNK = 1 << 16  # n-grams in a row of the stored model
PACKED = {"grams": np.uint64, "weights": np.float32, "squares": np.float32}
REMEMBERED = 200_000  # words whose hashes a worker keeps

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_SAME_SIGNS = re.compile(r"([^\w\s])\1+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_REPEATED = np.uint64(0x27D4EB2F165667C5)


def shape_of(word: str) -> str:
    """How a word is written: runs of letters become ``X`` (capitals), ``Xx`` or ``x``, digits 9, and repeated signs one."""

    def letters(run: re.Match) -> str:
        found = run.group()
        return "x" if found.islower() else "X" if found.isupper() and len(found) > 1 else "Xx"

    return _SAME_SIGNS.sub(r"\1\1", _DIGITS.sub("9", _LETTERS.sub(letters, word)))


class Grams:
    """The different n-grams of texts as 64-bit hashes: one and two words in lower case, and three word shapes,
    where a word that repeats the one before is marked."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def _hashes(self, word: str) -> tuple[int, int]:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[word] = xxhash.xxh3_64_intdigest(word.lower()), xxhash.xxh3_64_intdigest(shape_of(word), seed=1)
        return found

    def of(self, text: str | None) -> np.ndarray:
        words, known = (text or "").split(), self.known
        if not words:
            return np.empty(0, np.uint64)
        pairs = [known.get(w) or self._hashes(w) for w in words]
        word, shape = np.array(pairs, np.uint64).T
        again = np.concatenate([[False], word[1:] == word[:-1]])
        shape = np.where(again, shape ^ _REPEATED, shape) * _MIX[0]
        edge = np.zeros(1, np.uint64)
        shape = np.concatenate([edge, shape, edge])
        three = (shape[:-2] * _MIX[1]) ^ (shape[1:-1] * _MIX[2] + _MIX[0]) ^ (shape[2:] >> np.uint64(7))
        two = (word[:-1] * _MIX[1]) ^ (word[1:] * _MIX[2] + _MIX[1])
        return np.unique(np.concatenate([word, two, three]))


def _cut(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries of ``rows`` stand, and the starts of their own lists."""
    sizes = np.diff(starts)[rows]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(ends[-1]) + np.repeat(starts[rows] - ends[:-1], sizes), ends


def log_count_ratios(columns: np.ndarray, starts: np.ndarray, labels: np.ndarray, width: int) -> np.ndarray:
    """For each n-gram: the log of its smoothed share among those of good texts, over its share among those of others."""
    good = np.repeat(labels > 0, np.diff(starts))
    shares = []
    for mine in (columns[good], columns[~good]):
        counts = np.bincount(mine, minlength=width) + SMOOTHING
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_coordinate_descent(
    columns: np.ndarray, starts: np.ndarray, labels: np.ndarray, scale: np.ndarray, cost: float = COST, rounds: int = ROUNDS
) -> tuple[np.ndarray, float, np.ndarray]:
    """``(weights, bias, duals)`` of least |w|^2 / 2 + cost * sum of max(0, 1 - label * w x).

    Row n has the values ``scale[columns]`` at ``columns[starts[n]:starts[n + 1]]`` and a 1 for the bias, all divided
    by the row's length, so that long and short texts count alike. One dual variable is solved for at a time, in a
    new seeded order each round.
    """
    rng = np.random.default_rng(SEED)
    weights, bias, duals = np.zeros(len(scale)), 0.0, np.zeros(len(labels))
    rows = []
    for first, last in zip(starts[:-1], starts[1:], strict=True):
        mine = columns[first:last]
        values = scale[mine]
        norm = np.sqrt(values @ values + 1)
        rows.append((mine, values / norm, 1 / norm))
    for _ in range(rounds):
        worst = 0.0
        for n in rng.permutation(len(labels)):
            mine, values, one = rows[n]
            slope = labels[n] * (weights[mine] @ values + bias * one) - 1
            old = duals[n]
            if (old <= 0 and slope >= 0) or (old >= cost and slope <= 0):
                continue
            worst = max(worst, abs(slope))
            duals[n] = min(max(old - slope, 0.0), cost)  # the rows have length 1
            step = labels[n] * (duals[n] - old)
            weights[mine] += step * values
            bias += step * one
        if worst < ENOUGH:
            break
    return weights, bias, duals


def margins(columns: np.ndarray, starts: np.ndarray, weights: np.ndarray, scale: np.ndarray, bias: float) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum((weights * scale)[columns])])
    squares = np.concatenate([[0.0], np.cumsum((scale * scale)[columns])])
    return (sums[starts[1:]] - sums[starts[:-1]] + bias) / np.sqrt(squares[starts[1:]] - squares[starts[:-1]] + 1)


def sigmoid_of(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, fitted to smoothed labels by Newton's method."""
    n_good, n_bad = good.sum(), (~good).sum()
    if not len(good):
        return 0.0, 0.0
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    at = np.array([0.0, np.log((n_good + 1) / (n_bad + 1))])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.logaddexp(0, z).sum() - target @ z + 1e-6 * b @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        slope = x.T @ (p - target) + 2e-6 * at
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(2), slope)
        size = 1.0
        while size > 1e-8 and loss(at - size * step) > loss(at) - 1e-4 * size * slope @ step:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(max(at[0], 0.0)), float(at[1])


@dataclass
class Model:
    """Weights by n-gram, ready for lookup, and the curve that turns margins into scores."""

    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # ascending
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))  # weight times ratio
    squares: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))  # of the ratio
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    @classmethod
    def fit(cls, lists: list[np.ndarray], good: np.ndarray) -> Model:
        """From the n-grams of the examples and whether each is good; the curve comes from margins of held-back thirds."""
        if not lists:
            return cls()
        starts = np.concatenate([[0], np.cumsum([len(g) for g in lists])])
        grams, columns = np.unique(np.concatenate(lists), return_inverse=True)
        columns = columns.astype(np.int32)
        labels = np.where(good, 1.0, -1.0)
        fold = np.random.default_rng(SEED).permutation(len(lists)) % FOLDS
        margin = np.zeros(len(lists))
        for part in range(FOLDS):
            rest, mine = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
            at, ends = _cut(starts, rest)
            scale = log_count_ratios(columns[at], ends, labels[rest], len(grams))
            w, b, _ = dual_coordinate_descent(columns[at], ends, labels[rest], scale)
            # N-grams seen in none of the others are unknown to that fit.
            known = np.bincount(columns[at], minlength=len(grams)) > 0
            at, ends = _cut(starts, mine)
            margin[mine] = margins(columns[at], ends, w, np.where(known, scale, 0.0), b)
        slope, offset = sigmoid_of(margin, good)
        scale = log_count_ratios(columns, starts, labels, len(grams))
        w, b, _ = dual_coordinate_descent(columns, starts, labels, scale)
        return cls(grams, (w * scale).astype(np.float32), (scale * scale).astype(np.float32), b, slope, offset)

    def score(self, grams: np.ndarray) -> float:
        total, square = self.bias, 1.0
        if len(grams) and len(self.grams):
            at = np.searchsorted(self.grams, grams)
            at[at == len(self.grams)] = 0
            at = at[self.grams[at] == grams]
            total += float(self.weights[at].sum(dtype=np.float64))
            square += float(self.squares[at].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(self.slope * total / np.sqrt(square) + self.offset, -500, 500))))


@F.pandas_udf(ArrayType(LongType()))
def _grams(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    grams = Grams()
    for batch in texts:
        yield pd.Series([grams.of(text).view(np.int64) for text in batch], dtype=object)


def _fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The model of all examples, which come to one task: rows of ``CHUNK`` n-grams each, packed, beside the curve."""
    lists, good = [], []
    for batch in batches:
        lists += [np.asarray(g, np.int64).view(np.uint64) for g in batch["grams"]]
        good += list(batch["good"] == 1)
    if not lists:
        return
    model = Model.fit(lists, np.array(good))
    arrays = dict(zip(PACKED, (model.grams, model.weights, model.squares), strict=True))
    for part, at in enumerate(range(0, max(1, len(model.grams)), CHUNK)):
        packed = {name: [array[at : at + CHUNK].tobytes()] for name, array in arrays.items()}
        yield pd.DataFrame({"part": [part], **packed, "curve": [[model.bias, model.slope, model.offset]]})


def fit(docs: DataFrame, labels: DataFrame, training: Column, examples: int = EXAMPLES, entries: int = ENTRIES) -> Model:
    """Learns from at most ``examples`` labelled rows where ``training`` holds, those whose ids have the smallest hashes.

    Their n-grams are taken in tasks; rows are used in the order of their hashes as long as they have at most
    ``entries`` n-grams together, which bounds the one task that fits the model and the model itself. An id that is labelled both ways counts as bad.
    Rows without an id, label or document teach nothing.
    """
    chosen = (
        labels.where(training & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    sample = docs.select("doc_id", "text").join(written(chosen, "quality-labels"), "doc_id")
    order = ["place", "doc_id", "digest"]
    found = written(
        sample.select(F.xxhash64("doc_id").alias("place"), "doc_id", F.xxhash64("text").alias("digest"), "good", _grams("text").alias("grams")),
        "quality-grams",
    )
    sizes = found.select(*order, F.size("grams").alias("n")).orderBy(*order).limit(examples).toPandas()
    used = int((sizes["n"].cumsum() <= entries).sum())
    rows = found.orderBy(*order).limit(used).select("good", "grams")
    fitted = written(rows.mapInPandas(_fitted, "part long, grams binary, weights binary, squares binary, curve array<double>"), "quality-model")
    parts = fitted.orderBy("part").collect()
    if not parts:
        return Model()
    arrays = [np.concatenate([np.frombuffer(part[name], kind) for part in parts]) for name, kind in PACKED.items()]
    return Model(*arrays, *parts[0]["curve"])


def score_quality(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """``docs`` with ``score`` added: 0 to 1, the estimated share of good texts among those like this one.

    A text becomes the set of its n-grams (:class:`Grams`). Each n-gram has the log-count ratio of the classes as its
    value, and a linear model of least hinge loss, fitted by dual coordinate descent, weighs them. The margins
    of texts held back while fitting give the logistic curve from margins to scores.

    Null and empty texts, and texts of unknown n-grams, get the score of the model's bias. Without labelled rows all
    scores are 0.5. Each row is scored by its whole text alone, so repeated rows agree. A column of ``docs`` named
    ``score`` is replaced; an empty table gives an empty result.
    """
    whole_texts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, grams = shared.value, Grams()
        for batch in texts:
            yield pd.Series([model.score(grams.of(text)) for text in batch], dtype=float)

    place = unused(docs, "_made")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    return docs.withColumn(place, scored("text")).select(*kept, F.col(place).alias("score"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; a fourth of the labels is held out."""
    found = score_quality(docs, labels.select("doc_id", "quality"), crc32_part("doc_id", 4) != 2)
    return found.withColumn("held_out", crc32_part("doc_id", 4) == 2).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


@query("op12_quality")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return good_documents(docs, table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted")
