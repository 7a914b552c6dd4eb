"""Line deduplication over levelled, sorted runs of line hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table, unused, whole_texts
from shelfsight.session import shared_folder, written

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2


def line_key(line: str, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line without outer white space and with A-Z in lower case; None if too short."""
    line = line.strip(SPACE)
    return hashlib.blake2b(line.encode().lower(), digest_size=16).digest() if len(line) >= min_chars else None


def _keys(min_chars: int):
    @F.pandas_udf("array<binary>")
    def keys(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([list({k for line in (text or "").split("\n") if (k := line_key(line, min_chars))}) for text in batch])

    return keys


def _without(min_chars: int):
    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            rows = []
            for text, drop in zip(texts, drops, strict=True):
                lines = (text or "").split("\n")
                gone = {bytes(k) for k in drop} if drop is not None else ()
                kept = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
                rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
            yield pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return without


class LineRuns:
    """Hashes of all lines seen so far, as levelled runs in the shared folder.

    A run is a table of ``(key, docs, last)``, hash-partitioned and sorted by key. A key is in one run only:
    a new batch is merge-joined against all runs, and the keys that none of them holds (the anti-join) become
    a run of level 0. For keys that are known already the batch adds a tally of the same form. When a level
    has ``fanout`` runs, they are merged into one run of the next level, so a batch meets few runs, and a key
    is rewritten once per level.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.tallies: list[DataFrame] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``(key, doc_id)``, one row for each document that holds the key."""
        own = batch.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        known = _union(self.runs)
        if known is None:
            own = own.withColumn("known", F.lit(False))
        else:
            own = own.join(known.select("key", F.lit(True).alias("known")).hint("merge"), "key", "left")
            own = own.withColumn("known", F.coalesce("known", F.lit(False)))
        path = shared_folder(self.spark, "line-run")
        own.sortWithinPartitions("key").write.partitionBy("known").parquet(path)
        both = self.spark.read.schema(own.schema).parquet(path)
        self.levels[0].append(both.where("not known").drop("known"))
        if known is not None:
            self.tallies.append(both.where("known").drop("known"))
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = _union(self.levels[level]).repartition("key").sortWithinPartitions("key")
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(written(merged, "line-run"))

    def totals(self) -> DataFrame:
        """``(key, docs, last)`` over everything that was added."""
        rows = _union(self.runs + self.tallies)
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def _union(frames: list[DataFrame]) -> DataFrame | None:
    whole = None
    for frame in frames:
        whole = frame if whole is None else whole.unionByName(frame)
    return whole


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with lines that many documents share left in the largest ``doc_id`` only; other columns stay.

    Texts are split at ``\\n``. Lines are compared without outer white space and with A-Z in lower case; those
    of at least ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines except
    in the document with the largest id among them. ``text`` is replaced by the lines that stay;
    ``n_lines`` (before) and ``n_dropped`` are added.

    Hashes of all lines are written once and go through :class:`LineRuns` in ``batches`` batches, split by a
    hash of the id. Lines to drop are found by joining the hashes with the repeated keys, then gathered per
    document, never per line. Texts move once, to meet the lines they lose.

    Null and empty texts are one empty line and become empty text. Each row counts as a document of its own;
    rows with the same id keep or lose a line together, and null ids lose it against any other id. An empty
    table gives an empty result. Columns of ``docs`` named ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    whole_texts(spark)
    path = shared_folder(spark, "line-keys")
    keys = docs.select(
        "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), F.explode(_keys(min_chars)("text")).alias("key")
    )
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(f"doc_id {id_type}, key binary, batch int").parquet(path)
    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch).select("key", "doc_id"))
    repeated = written(runs.totals().where(F.col("docs") >= min_docs).select("key", "last"), "repeated-lines")
    drop_id, drop_keys, done = unused(docs, "_drop_id"), unused(docs, "_drops"), unused(docs, "_done")
    drops = (
        keys.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy(F.col("doc_id").alias(drop_id)).agg(F.collect_set("key").alias(drop_keys))
    )
    drops = written(drops, "line-drops").hint("merge")
    rest = docs.drop("n_lines", "n_dropped")
    cleaned = rest.join(drops, F.col("doc_id").eqNullSafe(F.col(drop_id)), "left").withColumn(done, _without(min_chars)("text", drop_keys))
    return cleaned.select(
        *[F.col(f"{done}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in rest.columns],
        F.col(f"{done}.n_lines").alias("n_lines"), F.col(f"{done}.n_dropped").alias("n_dropped"),
    )


@query("op8_line_dedup", r"""
    with lines as (
      select doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
              generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)),
    repeated as (
      select key, max(doc_id) as last from lines where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
    marked as (
      select doc_id, line, pos, r.key is not null and doc_id <> r.last as gone from lines left join repeated r using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from marked group by doc_id""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = drop_repeated_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
