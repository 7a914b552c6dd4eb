"""Rows, missing values and distinct values of a growing folder of files, kept per file so that only new files are read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, IntegerType, LongType, StringType, StructType

from shelfsight.sources.audit import relative_path, root_of
from shelfsight.sources.tables import Warehouse

PRECISION = 12  # the standard error of an estimate is 1.04 / sqrt(2 ** PRECISION), 1.6%

STORED = "file string, modified timestamp, bytes bigint, column string, rows bigint, given bigint, sketch binary"
FILE = ["file", "modified", "bytes"]


class FolderSketches:
    """One row per file and column in a table of the warehouse: counts and a mergeable sketch of the distinct values.

    Sketches have a fixed size of at most a few kilobytes, whatever the file holds. A file that has changed
    is read again, and one that is gone is forgotten. Columns that a file lacks are missing in all its rows.
    """

    def __init__(self, warehouse: Warehouse, name: str, folder: str, schema: StructType | str, pattern: str = "*.parquet", precision: int = PRECISION):
        self.spark, self.warehouse, self.name = warehouse.spark, warehouse, name
        self.folder, self.pattern, self.precision = folder.rstrip("/"), pattern, precision
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def refresh(self) -> int:
        """Brings the table up to the folder's files and returns how many of them had to be read."""
        stored = self.warehouse.read_or_empty(self.name, StructType.fromDDL(STORED))
        # A listing: the contents are not asked for.
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", self.pattern).option("recursiveFileLookup", True).load(_literal(self.folder))
        files = listed.select(
            F.substring_index("path", root_of(self.folder), -1).alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")
        )
        state = files.withColumn("there", F.lit(True)).join(stored.select(*FILE).distinct().withColumn("known", F.lit(True)), FILE, "full")
        # Names of changed files only; a scan of them keeps the same list on the driver.
        changes = state.where("there is null or known is null").select(*FILE, "there").collect()
        new, stale = [c for c in changes if c["there"]], [c for c in changes if not c["there"]]
        kept = stored
        if stale:
            kept = stored.join(F.broadcast(self.spark.createDataFrame([tuple(c)[:3] for c in stale], files.schema)), FILE, "left_anti")
        if new:
            rows = self._summaries(self.spark.createDataFrame([tuple(c)[:3] for c in new], files.schema), [c["file"] for c in new])
            self.warehouse.write(kept.unionByName(rows) if stale else rows, self.name, "replace" if stale else "append")
        elif stale:
            self.warehouse.write(kept, self.name)
        return len(new)

    def _summaries(self, files: DataFrame, names: list[str]) -> DataFrame:
        paths = [_literal(f"{self.folder}/{name}") for name in names]
        read = self.spark.read.schema(self.schema).parquet(*paths)
        values = {f"_{i}": _sketched(f"`{c.name}`", c.dataType) for i, c in enumerate(self.schema)}
        counts = read.select(relative_path("_metadata.file_path", self.folder).alias("file"), *[v.alias(k) for k, v in values.items()]).groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.struct(F.count(k).alias("given"), F.hll_sketch_agg(k, self.precision).alias("sketch")).alias(f"s{k}") for k in values],
        )
        none = F.lit(0).cast("bigint")
        columns = F.array(*[
            F.struct(F.lit(c.name).alias("column"), F.coalesce(f"s_{i}.given", none).alias("given"), F.col(f"s_{i}.sketch").alias("sketch"))
            for i, c in enumerate(self.schema)
        ])
        # Files without rows are kept too, so that they are not read again.
        return files.join(counts, "file", "left").select(*FILE, F.coalesce("rows", none).alias("rows"), F.inline(columns)).select(
            *FILE, "column", "rows", "given", "sketch")

    def summary(self) -> DataFrame:
        """Per column: rows, missing values, and an estimate of the distinct values, all from the stored rows."""
        stored = self.warehouse.read_or_empty(self.name, StructType.fromDDL(STORED))
        none = F.lit(0).cast("bigint")
        return stored.groupBy("column").agg(
            F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("given")).alias("missing"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), none).alias("distinct_values"),
        )


def _literal(path: str) -> str:
    """A path whose wildcard signs stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _sketched(name: str, kind: DataType) -> Column:
    """Sketches take whole numbers, texts and bytes; other values are sketched as text."""
    return F.col(name) if isinstance(kind, IntegerType | LongType | StringType | BinaryType) else F.col(name).cast("string")
