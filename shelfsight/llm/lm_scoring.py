"""Scores texts with a log-bilinear language model next to a unigram baseline."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table, whole_texts
from shelfsight.session import written

WORDS = 192  # most frequent words, units of their own
CLASSES = 32  # units of all other words, by a hash of their first two bytes
END = WORDS + CLASSES
UNITS = END + 1
START = UNITS  # context before the first word
FAR_START = CLASSES
WIDTH = 24  # numbers in a unit's vector
NOISE = 10  # noise words for each word
STEPS = 200
RATE = 0.05
NEAR_WORDS = 150_000  # most frequent words whose counts every task gets
NEAR_BYTES = 64  # longer words are never among them, so what is sent is bounded
FLUSH = 200_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # of bytes: only A-Z change, only the six ASCII spaces split


def class_of(word: bytes) -> int:
    return crc32(word[:2]) % CLASSES


@dataclass(frozen=True)
class Lexicon:
    """What each task knows of the words: counts of the frequent ones, and the size of each class."""

    words: list[bytes]  # by falling count; the first WORDS are units
    counts: np.ndarray
    mass: np.ndarray  # of a class: the sum of count + 0.5 over its words, and 0.5 for a new one
    tokens: int
    distinct: int
    texts: int

    def places(self) -> dict[bytes, int]:
        return {word: n for n, word in enumerate(self.words)}

    def units(self) -> np.ndarray:
        return np.array([n if n < WORDS else WORDS + class_of(w) for n, w in enumerate(self.words)], np.int64)


@dataclass(frozen=True)
class Shared:
    """A broadcast lexicon; a worker unpacks it once, whatever number of tasks it runs."""

    key: str
    broadcast: Broadcast = field(compare=False)

    @classmethod
    def of(cls, spark: SparkSession, value) -> Shared:
        return cls(uuid.uuid4().hex, spark.sparkContext.broadcast(value))

    @lru_cache(maxsize=2)  # noqa: B019
    def ready(self) -> tuple[Lexicon, dict[bytes, int], np.ndarray]:
        lexicon = self.broadcast.value
        return lexicon, lexicon.places(), lexicon.units()


def _coded(words: list[bytes], places: dict[bytes, int], units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the frequent words (-1 for none) and unit of each word."""
    get = places.get
    found = np.array([get(w, -1) for w in words], np.int64)
    coded = units[found] if len(units) else np.zeros(len(found), np.int64)
    rare = np.flatnonzero(found < 0)
    coded[rare] = [WORDS + class_of(words[n]) for n in rare]
    return found, coded


def _contexts(words: list[bytes], coded: np.ndarray, far: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each token (words, then the end): the context as one number, and the unit."""
    for w in words:
        if w[:2] not in far:
            far[w[:2]] = class_of(w)
    classes = np.array([far[w[:2]] for w in words], np.int64)
    target = np.append(coded, END)
    near = np.concatenate([[START], coded])
    back = np.concatenate([[FAR_START, FAR_START], classes])[: len(target)]
    return near * (CLASSES + 1) + back, target


def _token_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()

    def flush() -> pd.DataFrame:
        frame = pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})
        counts.clear()
        return frame

    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text))
            if len(counts) > FLUSH:
                yield flush()
    if counts:
        yield flush()


def _context_counts(shared: Shared):
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, places, units = shared.ready()
        far: dict[bytes, int] = {}
        for batch in batches:
            codes = []
            for text in batch["text"]:
                words = words_of(text)
                context, target = _contexts(words, _coded(words, places, units)[1], far)
                codes.append(context * UNITS + target)
            if codes:
                code, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pd.DataFrame({"code": code, "n": n})

    return counted


class LogBilinear:
    """Predicts a unit from the one before and the class of the word before that.

    The vectors of the two contexts, each through a matrix of its place, add up to a predicted vector; its product
    with a unit's vector plus the unit's bias is the unit's score. Noise-contrastive estimation fits the scores
    as log-probabilities: words are told from noise drawn from the unigram distribution, whose expectation
    is taken over all units instead of a draw. Contexts are few enough to be visited all in each step.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        start = lambda *shape: rng.normal(0, 0.1, shape)
        self.parts = {
            "near": start(UNITS + 1, WIDTH), "far": start(CLASSES + 1, WIDTH), "turn": np.eye(WIDTH) + start(WIDTH, WIDTH),
            "turn_far": np.eye(WIDTH) + start(WIDTH, WIDTH), "units": start(UNITS, WIDTH), "bias": np.full(UNITS, -math.log(UNITS)),
        }

    def _scores(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.parts
        predicted = p["near"][context // (CLASSES + 1)] @ p["turn"] + p["far"][context % (CLASSES + 1)] @ p["turn_far"]
        return predicted, predicted @ p["units"].T + p["bias"]

    def fit(self, code: np.ndarray, n: np.ndarray) -> LogBilinear:
        if not len(code):
            return self
        context, at = np.unique(code // UNITS, return_inverse=True)
        seen = np.zeros((len(context), UNITS))
        seen[at, code % UNITS] = n
        total = seen.sum()
        noise = (seen.sum(axis=0) + 0.5) / (total + 0.5 * UNITS)
        self.parts["bias"] = np.log(noise)
        offset, mass = np.log(NOISE * noise), seen.sum(axis=1, keepdims=True)
        weight = 1 / total
        p = self.parts
        mean, spread = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            predicted, scores = self._scores(context)
            true = 1 / (1 + np.exp(-np.clip(scores - offset, -30, 30)))
            slope = (seen * (1 - true) - NOISE * mass * noise * true) * weight
            back = slope @ p["units"]
            near, far = context // (CLASSES + 1), context % (CLASSES + 1)
            gradient = {k: np.zeros_like(p[k]) for k in ("near", "far")}
            np.add.at(gradient["near"], near, back @ p["turn"].T)
            np.add.at(gradient["far"], far, back @ p["turn_far"].T)
            gradient |= {
                "turn": p["near"][near].T @ back, "turn_far": p["far"][far].T @ back, "units": slope.T @ predicted, "bias": slope.sum(axis=0)
            }
            rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
            for k, g in gradient.items():
                mean[k] += 0.1 * (g - mean[k])
                spread[k] += 0.01 * (g * g - spread[k])
                p[k] = p[k] + rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-9)
        return self

    def log10_table(self) -> np.ndarray:
        """Normalised log-probabilities of all units in all contexts, by batched matrix products."""
        contexts = np.arange((UNITS + 1) * (CLASSES + 1))
        rows = []
        for at in range(0, len(contexts), 1024):
            scores = self._scores(contexts[at : at + 1024])[1]
            top = scores.max(axis=1, keepdims=True)
            rows.append((scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / math.log(10))
        return np.concatenate(rows).astype(np.float32)


def _scored(shared: Shared, log10_shared: Shared):
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, places, units = shared.ready()
        known = np.log10(lexicon.counts + 0.5)
        class_mass = np.log10(lexicon.mass)
        log10 = log10_shared.broadcast.value
        end = math.log10(lexicon.texts + 0.5)
        far: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                found, coded = _coded(words, places, units)
                context, target = _contexts(words, coded, far)
                near = found[found >= 0]
                rare = Counter([words[n] for n in np.flatnonzero(found < 0)])
                others = target[(target >= WORDS) & (target < END)] - WORDS
                in_class = known[near[near >= WORDS]].sum() - class_mass[others].sum()
                rows.append((
                    len(target), len(near) + (lexicon.texts > 0), known[near].sum() + end,
                    float(log10[context, target].sum(dtype=np.float64) + in_class), list(rare.keys()), list(rare.values()),
                ))
            names = ["n_tokens", "near_known", "near_counts", "near_score", "rare", "rare_n"]
            yield pd.concat([batch.drop(columns="text").reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return scored


def _frequent(counts: DataFrame) -> pd.DataFrame:
    """At most ``NEAR_WORDS`` words, the most frequent ones, by falling count.

    Counts are put into steps of an eighth of a doubling; whole steps are taken from the top while they fit, so
    tasks send what is taken and no more. The topmost step that does not fit is left to the join.
    """
    step = F.floor(F.log2("c") * 8)
    short = counts.where(F.octet_length("word") <= NEAR_BYTES).withColumn("step", step)
    taken, lowest = 0, math.inf
    for row in short.groupBy("step").count().orderBy(F.desc("step")).collect():
        taken += row["count"]
        if taken > NEAR_WORDS:
            break
        lowest = row["step"]
    return short.where(F.col("step") >= lowest).select("word", "c").toPandas().sort_values(["c", "word"], ascending=[False, True])


def score_texts(docs: DataFrame, training: Column) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``.

    Tokens are the words (runs of other characters than the ASCII spaces, A-Z in lower case) and one end. Rows
    where ``training`` holds are learnt from. ``base_score`` adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the
    tokens, with counts c over all training tokens. ``score`` is the log10 probability under
    :class:`LogBilinear`: frequent words are units of their own, all others share the unit of their class, and
    within it a word has its share (c + 0.5) of the class, with one more share for a new word, so
    probabilities add up to 1.

    Word counts and the counts of units in their contexts cover all training rows. The model is fitted on the
    latter, of which there are at most ``(UNITS + 1) (CLASSES + 1) UNITS``, however many texts. Tasks get the counts
    of the ``NEAR_WORDS`` most frequent words; all other words of a text are joined with the table of counts.

    Null and empty texts are an end alone. Without training rows all counts are 0. Null ids and repeated rows
    are scored like any other row. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    whole_texts(spark)
    learnt = docs.where(training).select("text")
    counts = written(
        learnt.mapInPandas(_token_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "word-counts"
    )
    texts = learnt.select().count()
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = _frequent(counts)
    by_class = F.pmod(F.crc32(F.substring("word", 1, 2)), F.lit(CLASSES)).alias("class")
    mass = np.full(CLASSES, 0.5)
    for row in counts.groupBy(by_class).agg(F.sum(F.col("c") + 0.5).alias("mass")).collect():
        mass[row["class"]] += row["mass"]
    words = [bytes(w) for w in frequent["word"]]
    for word, c in zip(words[:WORDS], frequent["c"], strict=False):
        mass[class_of(word)] -= c + 0.5
    lexicon = Lexicon(words, frequent["c"].to_numpy(np.int64), mass, tokens + texts, distinct + (texts > 0), texts)
    shared = Shared.of(spark, lexicon)

    seen = learnt.mapInPandas(_context_counts(shared), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    seen = seen.sort_values("code")
    model = LogBilinear().fit(seen["code"].to_numpy(np.int64), seen["n"].to_numpy(np.float64))
    probabilities = Shared.of(spark, model.log10_table())

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kept = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    near = written(
        rows.mapInPandas(
            _scored(shared, probabilities),
            f"{kept}, n_tokens long, near_known long, near_counts double, near_score double, rare array<binary>, rare_n array<long>",
        ),
        "near-scores",
    )
    rare = near.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("n"))
    far = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("far_counts"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("far_known"),
    )
    far = written(far, "far-scores")
    norm = math.log10(lexicon.tokens + 0.5 * (lexicon.distinct + 1))
    more = F.coalesce("far_counts", F.lit(0.0))
    return near.drop("rare", "rare_n").join(far, "row", "left").select(
        "doc_id", "n_tokens", (F.col("near_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("near_counts") + more - F.col("n_tokens") * norm).alias("base_score"), (F.col("near_score") + more).alias("score"),
    )


def crc32_part(id_col: str, parts: int) -> Column:
    """The remainder of the id's CRC-32 as text; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


@query("op6_lm_scoring")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc32_part("doc_id", 5) == 1
    found = score_texts(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
