"""Ranks documents for query texts by weighted terms; documents with equal bags of query terms are scored once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfsight.llm.registry import query, table, whole_texts
from shelfsight.session import written

TOP = 50
BLOCK_TERMS = 1 << 16  # (item, term) pairs searched for in one pass over the documents, about
BLOCK_BYTES = 1 << 22  # and bytes of these terms
CELLS = 2_000_000  # scores held at a time
NEAR_BYTES = 16 << 20  # winning classes up to this size are sent to all tasks
LAST = (1 << 63) - 1

# Letters and digits of ASCII and everything beyond ASCII belong to terms; A-Z become lower case.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | str | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(FOLD).split()


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [sorted(set(terms_of(text))) for text in batch["text"]]
        yield pd.DataFrame({"key": batch["key"], "term": found}).explode("term").dropna(subset=["term"])


def _bag(vocabulary: Broadcast):
    """Number of all terms of a text, and the vocabulary's terms in it (by place, ascending) with their counts."""

    @F.pandas_udf("n long, terms array<int>, counts array<long>")
    def bag(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        get = vocabulary.value.get
        for batch in texts:
            sizes, places, counts = [], [], []
            for text in batch:
                words = terms_of(text)
                found = [p for p in map(get, words) if p is not None]
                place, n = np.unique(np.array(found, np.int32), return_counts=True)
                sizes.append(len(words))
                places.append(place)
                counts.append(n)
            yield pd.DataFrame({"n": sizes, "terms": places, "counts": counts})

    return bag


class Items:
    """Which items ask for a term, as one list of items cut by ``starts``; and the weight of each term."""

    def __init__(self, pairs: list[tuple[int, int]], terms: int, items: int, weights: np.ndarray):
        term, item = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        order = np.lexsort((item, term))
        self.items, self.number, self.weights = item[order], items, weights
        self.starts = np.searchsorted(term[order], np.arange(terms + 1))
        longest = int(np.bincount(item, minlength=items).max())
        # A term adds less than its weight times a million; below 2^53 sums of doubles are exact.
        self.exact = int(weights.max(initial=0)) * 10**6 * longest < 2**53

    def scores(self, place: np.ndarray, count: np.ndarray, size: np.ndarray, m: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Scores of classes for all items, in slices ``(first class, classes x items)``; ``size`` is each class's number of terms."""
        row = np.repeat(np.arange(len(size)), size)
        gain = self.weights[place] * ((10**9 * count) // (1000 * count + 20 * m[row]))
        asked = self.starts[place + 1] - self.starts[place]
        ends = np.cumsum(np.bincount(row, weights=asked, minlength=len(size)).astype(np.int64))
        first, step = 0, max(1, CELLS // self.number)
        while first < len(size):
            done = ends[first - 1] if first else 0
            last = min(first + step, len(size), max(first + 1, int(np.searchsorted(ends, done + 2 * CELLS, "right"))))
            part = slice(*np.searchsorted(row, [first, last]))
            n = asked[part]
            each = np.repeat(np.arange(len(n)), n)
            item = self.items[self.starts[place[part]][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)]
            cell = (row[part][each] - first) * self.number + item
            if self.exact:
                flat = np.bincount(cell, weights=gain[part][each], minlength=(last - first) * self.number).astype(np.int64)
            else:
                flat = np.zeros((last - first) * self.number, np.int64)
                np.add.at(flat, cell, gain[part][each])
            yield first, flat.reshape(last - first, self.number)
            first = last


class Best:
    """The best ``top`` classes of each item: highest score first, then smallest first document."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)  # least: the score below which nothing can enter
        self.rows = [np.empty(0, np.int64)] * 4
        self.waiting: list[tuple[np.ndarray, ...]] = []

    def add(self, scores: np.ndarray, first_id: np.ndarray, class_id: np.ndarray) -> None:
        least = self.least
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, item = np.nonzero(scores >= least)
        self.waiting.append((item, scores[row, item], first_id[row], class_id[row]))
        if sum(len(w[0]) for w in self.waiting) > CELLS:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        item, score, first_id, class_id = (np.concatenate(x) for x in zip(self.rows, *self.waiting, strict=True))
        order = np.lexsort((class_id, first_id, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.top]
        full = place == self.top - 1
        self.least[item[full]] = np.maximum(1, score[order[full]])
        self.rows, self.waiting = [item[place < self.top], score[kept], first_id[kept], class_id[kept]], []
        return tuple(self.rows)


def _best_classes(shared: Broadcast, top: int):
    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: Items = shared.value
        found = Best(items.number, top)
        for batch in batches:
            size = batch["terms"].str.len().to_numpy(np.int64)
            place, count = (np.concatenate(batch[c].to_list()).astype(np.int64) for c in ("terms", "counts"))
            first_id, class_id = (batch[c].to_numpy(np.int64) for c in ("first_id", "class_id"))
            for first, scores in items.scores(place, count, size, batch["m"].to_numpy(np.int64)):
                rows = slice(first, first + len(scores))
                found.add(scores, first_id[rows], class_id[rows])
        yield pd.DataFrame(dict(zip(("item", "score", "first_id", "class_id"), found.settle(), strict=True)))

    return best


def _limited(frame: DataFrame, key: str, top: int, *order: Column) -> DataFrame:
    """The first ``top`` rows of each key, numbered; tasks drop what cannot be among them before the shuffle."""
    return frame.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, asked: pd.DataFrame, top: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` for ``asked``, rows of (item number, term)."""
    spark = docs.sparkSession
    places = {term: n for n, term in enumerate(sorted(set(asked["term"])))}
    vocabulary = spark.sparkContext.broadcast(places)
    bags = docs.select("doc_id", _bag(vocabulary)(F.coalesce("text", F.lit("")).cast("binary")).alias("b")).select("doc_id", "b.*")
    bags = written(bags.where("n > 0"), "search-bags")
    number, length = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    m = (F.lit(50) + F.expr(f"(50L * n * {number}L) div {length}L")).alias("m")
    bags = bags.where(F.size("terms") > 0).select("doc_id", m, "terms", "counts")
    bags = bags.withColumn("digest", F.xxhash64("m", "terms", "counts"))

    # The digest decides where a class is gathered; the class is what agrees in all of its columns.
    same = ["digest", "m", "terms", "counts"]
    classes = bags.groupBy(*same).agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").cast("long").alias("first_id"))
    classes = written(classes.withColumn("class_id", F.monotonically_increasing_id()), "search-classes")

    held = classes.select(F.explode("terms").alias("term"), "size").groupBy("term").agg(F.sum("size").alias("df")).toPandas()
    df = np.zeros(len(places), np.int64)
    df[held["term"].to_numpy(np.int64)] = held["df"]
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    pairs = [(places[term], item) for item, term in zip(asked["item"], asked["term"], strict=True)]
    items = spark.sparkContext.broadcast(Items(pairs, len(places), int(asked["item"].max()) + 1, weights))

    scored = classes.select("class_id", F.coalesce("first_id", F.lit(LAST)).alias("first_id"), "m", "terms", "counts")
    scored = scored.mapInPandas(_best_classes(items, top), "item long, score long, first_id long, class_id long")
    order = [F.desc("score"), F.asc("first_id"), F.asc("class_id")]
    winners = written(_limited(scored, "item", top, *order).select("item", "score", "class_id"), "search-winners")

    won = written(classes.join(winners.select("class_id").distinct(), "class_id").select("class_id", *same), "search-won")
    size = won.agg(F.coalesce(F.sum(F.size("terms") * 12 + 32), F.lit(0))).first()[0]
    members = bags.join(F.broadcast(won) if size <= NEAR_BYTES else won, same).select("class_id", "doc_id")
    smallest = _limited(members, "class_id", top, F.asc_nulls_last("doc_id")).drop("rank")
    return _limited(winners.join(smallest, "class_id"), "item", top, F.desc("score"), F.asc_nulls_last("doc_id"))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents with the highest scores above 0 for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. A term's weight
    is floor(1000 ln((2N + 2) / (2 df + 1))) over the N documents with any term; a document with n of all L terms has
    m = 50 + (50 n N) div L, and scores the sum of weight * ((10^9 tf) div (1000 tf + 20 m)) over the item's terms.

    Documents are cut down to their *bags*, the counts of terms that any item asks for. Documents whose bags and m
    are identical score alike for every item, so they form a class that is scored once; only the smallest ids of
    classes that win are looked up, and equal scores are ordered by them. Tasks keep ``top`` classes per item. Items
    are searched for in blocks of about ``BLOCK_TERMS`` terms, one pass over the documents each, which bounds the
    vocabulary that tasks get; counts cover all documents.

    Null and empty texts have no terms: such documents are never found and count for nothing, such items find
    nothing. Rows with the same item id, null included, are one item with the terms of all. Documents are rows:
    repeated ones are ranked one by one, null ids last among equal scores. Other columns are not looked at; an
    empty table gives an empty result. ``doc_id`` is a whole number, and 50 n N has to stay below 2^63.
    """
    spark = docs.sparkSession
    whole_texts(spark)
    keyed = items.select(F.to_json(F.struct("item_id")).alias("key"), "item_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    asked = written(keyed.select("key", "text").mapInPandas(_item_terms, "key string, term binary").distinct(), "search-terms")
    pairs, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    blocks = max(1, -(-pairs // BLOCK_TERMS), -(-size // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).toPandas()
        if mine.empty:
            continue
        keys = sorted(set(mine["key"]))
        mine = pd.DataFrame({"item": mine["key"].map({k: n for n, k in enumerate(keys)}), "term": mine["term"].map(bytes)})
        names = spark.createDataFrame(list(enumerate(keys)), "item long, key string")
        part = _search_block(docs, mine, top).join(F.broadcast(names), "item").select("key", "rank", "doc_id", "score")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = asked.limit(0).select("key", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    ids = keyed.groupBy("key").agg(F.first("item_id").alias("item_id"))
    return found.join(ids, "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = f"""
    WITH words AS (SELECT doc_id, unnest({TERMS_SQL}) AS term FROM documents),
    lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
    tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    dfs AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tfs, whole GROUP BY term),
    asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark)),
    scores AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
      FROM asked JOIN tfs USING (term) JOIN dfs USING (term) JOIN lengths USING (doc_id), whole GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {TOP}"""


@query("op11_lexical_search", ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
