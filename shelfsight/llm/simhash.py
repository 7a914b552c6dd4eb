"""SimHash near-duplicates: fingerprints that differ in a few bits, found through shared blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.components import connected_components
from shelfsight.llm.registry import query, table, unused, whole_texts
from shelfsight.session import written

SHINGLE = 3
MAX_BITS = 3
SPARE_BLOCKS = 3
CHUNK = 1 << 16


def shingle_hashes(text: str | None, length: int) -> list[int]:
    """XXH64 (seed 42) of each run of ``length`` words; of the whole sequence if there are fewer words."""
    words = (text or "").encode().lower().split()  # of bytes: only A-Z change, only the six ASCII spaces split
    if not words:
        return []
    if len(words) <= length:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    line = b" ".join(words)
    starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    return [xxhash.xxh64_intdigest(line[a : b - 1], 42) for a, b in zip(starts, starts[length:])]


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def simhash(text: str | None, length: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer; 0 for a text without words."""
    hashes = np.array(shingle_hashes(text, length), dtype="<u8")
    bits = (2 * _votes(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _simhashes(length: int):
    @F.pandas_udf("long")
    def simhashes(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash(text, length) for text in batch], dtype="int64")

    return simhashes


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of bits that together cover all 64, as signed integers."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS, spare: int = SPARE_BLOCKS) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of values in the distinct column ``fingerprint`` within ``max_bits`` bits.

    Fingerprints are cut into ``max_bits + spare`` blocks. A pair within ``max_bits`` bits agrees in at least
    ``spare`` of them, so each choice of ``spare`` blocks is a join key (32 bits for the defaults; a larger
    ``spare`` gives longer and more keys, for more fingerprints). A pair is verified and emitted only under
    the first choice of blocks it agrees in. Keys that many fingerprints share are split by adaptive execution.
    """
    masks = block_masks(max_bits + spare)
    choices = list(combinations(range(len(masks)), spare))
    together = [reduce(lambda x, y: x | y, (masks[i] for i in c)) for c in choices]
    keys = F.array(*[F.struct(F.lit(n).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(together)])
    rows = prints.select("fingerprint", F.explode(keys).alias("k")).select("fingerprint", "k.choice", "k.key")
    a, b = rows.alias("x"), rows.alias("y")
    differ = F.col("x.fingerprint").bitwiseXOR(F.col("y.fingerprint"))
    # Blocks before the last chosen one that are not chosen must differ; -1 stands for none, as a pair always differs.
    skipped = [[masks[i] for i in range(c[-1]) if i not in c] for c in choices]
    first = F.lit(True)
    for place in range(max(map(len, skipped))):
        must = F.array(*[F.lit(s[place] if place < len(s) else -1) for s in skipped])
        first = first & (differ.bitwiseAND(F.get(must, F.col("x.choice"))) != 0)
    near = (F.col("x.fingerprint") < F.col("y.fingerprint")) & (F.bit_count(differ) <= max_bits)
    on = (F.col("x.choice") == F.col("y.choice")) & (F.col("x.key") == F.col("y.key"))
    return a.join(b, on & near & first).select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))


def _placed(classes: DataFrame, max_bits: int, spare: int) -> DataFrame:
    """``classes`` (one row per fingerprint) with the component of each: a fingerprint that stands for it."""
    classes = written(classes, "fingerprint-classes")
    labels = connected_components(near_pairs(classes.select("fingerprint"), max_bits, spare))
    return classes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        *classes.columns, F.coalesce("component", "fingerprint").alias("component")
    )


def simhash_groups(docs: DataFrame, length: int = SHINGLE, max_bits: int = MAX_BITS, spare: int = SPARE_BLOCKS) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, fingerprint, component_id)``.

    Words are runs of other characters than the ASCII spaces, with A-Z in lower case; shingles are ``length``
    words, repeats included. A bit of the fingerprint is set if it is in over half of the shingles' hashes.
    Fingerprints within ``max_bits`` bits are linked, and ``component_id`` is the smallest id that links reach.

    Equal fingerprints are combined before the block join, so copies cost one row per task there. Null, empty
    and blank texts have fingerprint 0 and are linked like any other. Null ids get the component of their
    fingerprint (null if all ids of a component are). Repeated rows give repeated rows. An empty table gives an
    empty result; other columns are not looked at.
    """
    whole_texts(docs.sparkSession)
    prints = written(docs.select("doc_id", _simhashes(length)("text").alias("fingerprint")), "fingerprints")
    placed = _placed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")), max_bits, spare)
    smallest = placed.groupBy("component").agg(F.min("smallest").alias("component_id"))
    ids = written(placed.select("fingerprint", "component").join(smallest, "component").select("fingerprint", "component_id"), "fingerprint-ids")
    return prints.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each_group(docs: DataFrame, length: int = SHINGLE, max_bits: int = MAX_BITS, spare: int = SPARE_BLOCKS) -> DataFrame:
    """One row of ``docs`` from each group of near copies, as :func:`simhash_groups` links them.

    It is the row with the smallest id (null after all others); of rows that share it, the one with the smallest
    digest of all columns; and of rows equal in all columns just one. So ids may repeat, within groups and
    between them. Rows are counted by fingerprint, id and digest before they meet in a group.
    """
    whole_texts(docs.sparkSession)
    digest = unused(docs, "_digest")
    rows = docs.withColumn(digest, F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256)))
    prints = written(
        rows.select("doc_id", F.col(digest).alias("digest"), _simhashes(length)("text").alias("fingerprint")), "fingerprints"
    )
    counted = prints.groupBy("fingerprint", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "n")
    placed = _placed(counted.groupBy("fingerprint").agg(F.min(row).alias("first")), max_bits, spare)
    first = written(placed.groupBy("component").agg(F.min("first").alias("first")).select("first.*"), "fingerprint-firsts")
    kept_id, kept_digest = unused(rows, "_kept"), unused(rows, "_kept_digest")

    def chosen(firsts: DataFrame) -> DataFrame:
        keys = firsts.select(F.col("doc_id").alias(kept_id), F.col("digest").alias(kept_digest)).hint("merge")
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest)), "left_semi")

    found, several = chosen(first.where("n = 1")), first.where("n > 1")
    if not several.isEmpty():
        found = found.unionByName(chosen(several).dropDuplicates(["doc_id", digest]))
    return found.drop(digest)


@query("op1_simhash_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
