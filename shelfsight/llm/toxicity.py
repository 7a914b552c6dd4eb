"""Toxicity by the nearest labelled examples, found exactly in a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.lm_scoring import crc32_part
from shelfsight.llm.registry import query, table, unused, whole_texts
from shelfsight.session import written

EXAMPLES = 6144  # labelled rows the classifier is fitted on: those with the smallest hashes
TERMS = 1024
LEAST_GAIN = 24.0  # log-likelihood ratio that a term must have with the labels
PREFIXES = (3, 4, 5, 6, 7, 8)
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.3
SHOWN = 3
PRIOR_WEIGHT = 0.5

_WORD = re.compile(r"\w+")


def terms_of(text: str | None) -> Counter[str]:
    """The words of a text in lower case, and as terms of their own (marked by a star) how longer ones begin."""
    words = Counter(_WORD.findall((text or "").lower()))
    terms = words.copy()
    for word, n in words.items():
        for length in PREFIXES:
            if len(word) > length:
                terms[word[:length] + "*"] += n
    return terms


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[toxic].update(terms_of(text).keys())
        yield pd.DataFrame(
            [(term, label, n) for label, found in counts.items() for term, n in found.items()], columns=["term", "toxic", "n"]
        )


def _gain(a: Column, b: Column, total_a: int, total_b: int) -> Column:
    """Log-likelihood ratio of a term that a toxic and b other rows have, against the same share in both."""
    share = (a + b) / F.lit(total_a + total_b)

    def part(seen: Column, total: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (F.lit(total) * share))).otherwise(0.0)

    rest = (a + b) < total_a + total_b
    return 2 * (
        part(a, total_a) + part(b, total_b)
        + F.when(rest & (a < total_a), (total_a - a) * F.log((total_a - a) / (total_a * (1 - share)))).otherwise(0.0)
        + F.when(rest & (b < total_b), (total_b - b) * F.log((total_b - b) / (total_b * (1 - share)))).otherwise(0.0)
    )


class Terms:
    """The terms of an index, and their counts in texts."""

    def __init__(self, terms: list[str]):
        self.places = {term: n for n, term in enumerate(terms)}
        self.starts = {term.rstrip("*")[: PREFIXES[0]] for term in terms}

    def count(self, text: str | None) -> dict[int, int]:
        """As :func:`terms_of`, by place and for these terms only."""
        places, starts, found = self.places, self.starts, {}
        for word, n in Counter(_WORD.findall((text or "").lower())).items():
            if word[: PREFIXES[0]] in starts:
                for term in (word, *(word[:length] + "*" for length in PREFIXES if len(word) > length)):
                    place = places.get(term)
                    if place is not None:
                        found[place] = found.get(place, 0) + n
        return found


def weighted(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    """TF-IDF weights of length 1 by term."""
    weights = {t: (1 + np.log(n)) * idf[t] for t, n in sorted(counts.items())}
    norm = np.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()}


class Index:
    """Labelled examples in an inverted index whose lists are cut into blocks of ``BLOCK`` examples.

    For each term and block the largest weight is kept. A query adds up these maxima per block, which bounds
    the cosine of every example in it, and reads the lists of the blocks in falling order of the bound, until
    no bound can beat the k-th best cosine found. So the nearest examples are exact.
    """

    def __init__(self, terms: list[str], idf: np.ndarray, ids: list, labels: np.ndarray, vectors: list[dict[int, float]]):
        self.terms = Terms(terms)
        self.idf = idf
        # Examples with the same label and strongest term stand together, so that bounds are tight.
        order = sorted(range(len(ids)), key=lambda n: (labels[n], max(vectors[n], key=vectors[n].get, default=-1), n))
        self.ids, self.labels = [ids[n] for n in order], labels[order].astype(np.float64)
        self.blocks = -(-len(order) // BLOCK)
        self.most = np.zeros((len(terms), self.blocks))
        lists: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.vectors = [vectors[n] for n in order]
        for at, vector in enumerate(self.vectors):
            for term, weight in vector.items():
                lists.setdefault((term, at // BLOCK), []).append((at % BLOCK, weight))
        self.lists = {}
        for (term, block), pairs in lists.items():
            weights = np.array([w for _, w in pairs])
            self.lists[term, block] = (np.array([a for a, _ in pairs]), weights)
            self.most[term, block] = weights.max()
        self.prior = float((self.labels.sum() + 0.5) / (len(order) + 1)) if len(order) else 0.0
        self.levels, self.rates = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        self.calibrate()

    def nearest(self, vector: dict[int, float], k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest examples with any cosine above 0; ties go to the earlier place."""
        if not vector or not self.blocks:
            return np.empty(0, int), np.empty(0)
        terms, weights = list(vector), np.fromiter(vector.values(), float)
        bounds = weights @ self.most[terms]
        places, cosines, least = np.empty(0, int), np.empty(0), 0.0
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(places) == k and bounds[block] < least - 1e-12):
                break
            scores = np.zeros(BLOCK)
            for term, weight in zip(terms, weights, strict=True):
                found = self.lists.get((term, block))
                if found is not None:
                    scores[found[0]] += weight * found[1]
            some = np.flatnonzero(scores > 0)
            if 0 <= without - block * BLOCK < BLOCK:
                some = some[some != without - block * BLOCK]
            places = np.concatenate([places, some + block * BLOCK])
            cosines = np.concatenate([cosines, scores[some]])
            best = np.lexsort((places, -np.round(cosines, 12)))[:k]
            places, cosines = places[best], cosines[best]
            least = cosines[-1] if len(cosines) else 0.0
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """The share of toxic neighbours, nearer ones counting more, drawn a little to the overall share."""
        return float((cosines @ self.labels[places] + PRIOR_WEIGHT * self.prior) / (cosines.sum() + PRIOR_WEIGHT))

    def calibrate(self) -> None:
        """Turns votes into shares of toxic rows: a rising step function of the votes that examples get from the others."""
        votes = np.array([self.vote(*self.nearest(v, without=n)) for n, v in enumerate(self.vectors)])
        if not len(votes):
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # sum of labels, number, sum of votes
        for vote, label in zip(votes[order], self.labels[order], strict=True):
            pools.append([label, 1.0, vote])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.levels = np.array([v / n for _, n, v in pools])
        self.rates = np.array([(y + PRIOR_WEIGHT * self.prior) / (n + PRIOR_WEIGHT) for y, n, _ in pools])

    def score(self, text: str | None) -> tuple[float, list[tuple]]:
        """Calibrated score and the nearest examples as ``(id, cosine, label)``."""
        places, cosines = self.nearest(weighted(self.terms.count(text), self.idf))
        score = float(np.interp(self.vote(places, cosines), self.levels, self.rates))
        return score, [(self.ids[p], float(c), int(self.labels[p])) for p, c in zip(places[:SHOWN], cosines[:SHOWN], strict=True)]


def fit(docs: DataFrame, labels: DataFrame, training: Column, examples: int = EXAMPLES, terms: int = TERMS) -> Index:
    """Learns from at most ``examples`` labelled rows where ``training`` holds; document frequencies cover all ``docs``.

    Of the labelled ids those with the smallest hashes are taken. Their terms are counted in parallel, and the
    ``terms`` with the highest log-likelihood ratio with the label are the index's terms, so what the driver
    gets is bounded by ``examples * terms``. An id that is labelled both ways counts as toxic. Rows without an
    id, label or document teach nothing.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(training & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("long").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    sample = written(docs.select("doc_id", "text").join(written(chosen, "toxicity-labels"), "doc_id"), "toxicity-sample")
    toxic, total = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return Index([], np.empty(0), [], np.empty(0), [])
    counts = sample.select("text", "toxic").mapInPandas(_term_counts, "term string, toxic long, n long").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")
    )
    gain = _gain(F.col("a"), F.col("b"), toxic, total - toxic)
    best = [r.term for r in counts.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "term").limit(terms).collect()]
    known = Terms(best)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, rows = Counter(), 0
        for batch in batches:
            rows += len(batch)
            for text in batch["text"]:
                found.update(known.count(text).keys())
        yield pd.DataFrame({"term": [*found.keys(), -1], "n": [*found.values(), rows]})

    df = {r.term: r.n for r in docs.select("text").mapInPandas(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    rows = df.get(-1, 0)
    idf = np.array([np.log((rows + 1) / (df.get(t, 0) + 1)) + 1 for t in range(len(best))])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [known.count(text) for text in batch["text"]]
            yield batch[["doc_id", "toxic"]].assign(terms=[list(f) for f in found], n=[list(f.values()) for f in found])

    kind = docs.schema["doc_id"].dataType.simpleString()
    taught = sample.mapInPandas(vectors, f"doc_id {kind}, toxic long, terms array<int>, n array<int>").toPandas().sort_values("doc_id", kind="stable")
    rows = [weighted(dict(zip(ts, ns, strict=True)), idf) for ts, ns in zip(taught["terms"], taught["n"], strict=True)]
    return Index(best, idf, taught["doc_id"].tolist(), taught["toxic"].to_numpy(), rows)


def score_toxicity(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, the share of toxic rows among texts like this one) and ``evidence`` added.

    Texts become TF-IDF vectors over the index's terms (see :func:`fit`); the nearest labelled examples by
    exact cosine vote with their cosines as weights, and the votes are calibrated on the votes that examples
    get from each other. ``evidence`` lists the nearest examples with cosine and label. Null and empty texts, and
    texts without any of the terms, have no neighbours and get what examples without neighbours get. Without
    labelled rows all scores are 0. Each row is scored by its text alone, so repeated rows agree. Columns of
    ``docs`` named ``score`` or ``evidence`` are replaced; an empty table gives an empty result.
    """
    whole_texts(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training))
    kind = docs.schema["doc_id"].dataType.simpleString()

    @F.pandas_udf(f"score double, evidence array<struct<doc_id:{kind},cosine:double,toxic:int>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shared = index.value
        for batch in batches:
            rows = [shared.score(text) for text in batch]
            yield pd.DataFrame({
                "score": [s for s, _ in rows],
                "evidence": [[{"doc_id": i, "cosine": c, "toxic": y} for i, c, y in e] for _, e in rows],
            })

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "evidence")]
    place = unused(docs, "_made")
    return docs.withColumn(place, scored("text")).select(*kept, F.col(f"{place}.score").alias("score"), F.col(f"{place}.evidence").alias("evidence"))


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``evidence`` and ``predicted``; a fourth of the labels is held out."""
    found = score_toxicity(docs, labels.select("doc_id", "toxic"), crc32_part("doc_id", 4) != 2)
    return found.withColumn("held_out", crc32_part("doc_id", 4) == 2).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


@query("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxic_documents(docs, table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted", "evidence")
