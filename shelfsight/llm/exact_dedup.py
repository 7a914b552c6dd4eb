"""Exact deduplication in three stages that never gather one group of copies in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table
from shelfsight.session import written

SALTS = 64


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """``(digest, _text, keep_id, group_size)``, one row per different text."""
    salt = F.pmod(F.xxhash64("_id"), F.lit(salts)).alias("_salt")
    # The map side of the first aggregation combines what one task holds, its shuffled side the salted groups.
    salted = rows.groupBy("digest", "_text", salt).agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    return salted.groupBy("digest", "_text").agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``: ``(id, keep_id, group_size, kept, digest)``.

    Copies are combined in each task, then among up to ``salts`` places chosen by a hash of the id, then
    globally. Every stage groups by the digest *and* the whole text, so different texts with the same digest
    stay apart. Rows learn their group by its digest alone, as long as that digest has a single text; rows of
    a digest with several texts (none is known for SHA-256) are joined by text as well.

    A null text counts as empty. The largest id of a group stays; null ids lose against any other, and a
    group of null ids only keeps them. Rows that repeat both id and text cannot be told apart: all of them are
    marked as kept if their id is. An empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("digest", digest(F.col("_text")))
    by_digest = (
        _winners(rows, salts).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    )
    by_digest = written(by_digest, "exact-groups")
    found = rows.select("_id", "digest").join(by_digest.where("texts = 1").drop("texts"), "digest")
    several = by_digest.where("texts > 1").select("digest")
    if not several.isEmpty():
        clashing = rows.join(several, "digest", "left_semi")
        found = found.unionByName(
            clashing.join(written(_winners(clashing, salts), "exact-clashes"), ["digest", "_text"]).drop("_text")
        )
    return found.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


@query("op10_exact_dedup", """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
      doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
