"""File integrity: checksums and row counts per file, compared with a saved record."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.relate import compare_manifests, union_by_name
from shelfsight.sources.csv import layouts
from shelfsight.sources.tables import Warehouse

WHOLE_BYTES = 256 << 20
PIECE = 4 << 20

MANIFEST = "file string, sha256 string, bytes bigint, rows bigint, cols int"


def relative_path(path: Column | str, folder: str) -> Column:
    """A file's path below the folder, which tells files of the same name in different folders apart."""
    return F.substring_index(F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B"))), root_of(folder), -1)


def root_of(folder: str) -> str:
    return folder.rstrip("/").split("://")[-1].removeprefix("file:") + "/"


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of files read piece by piece, so that a task never holds a whole one."""
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch["path"]:
            # Spark shows a path as it is, while a URI has its odd characters escaped.
            scheme, rest = path.split(":", 1) if re.match("[a-z0-9]+:/", path) else ("file", path)
            files, name = fs.FileSystem.from_uri(f"{scheme}:{'' if rest.startswith('//') else '//'}{quote(rest, safe='/:@')}")
            digest = hashlib.sha256()
            with files.open_input_stream(name, compression=None) as source:
                while piece := source.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield batch.assign(sha256=found)


def checksums(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(file, sha256, bytes) per file below the folder; files are hashed side by side.

    Spark hands over files of up to ``WHOLE_BYTES`` as one value; longer ones are read as a stream.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    whole = files.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    longer = files.where(F.col("length") > WHOLE_BYTES).select("path", F.col("length").alias("bytes"))
    streamed = longer.mapInPandas(_digests, "path string, bytes bigint, sha256 string").select("path", "sha256", "bytes")
    return whole.unionAll(streamed).select(F.substring_index("path", root_of(folder), -1).alias("file"), "sha256", "bytes")


def file_rows(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(file, rows, cols) per CSV file; files with the same header are counted together."""
    counts, listed = [], []
    for header, paths in layouts(spark, folder, pattern).items():
        rows = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(paths)
        counts.append(rows.groupBy(relative_path(F.col("_metadata.file_path"), folder).alias("file")).agg(F.count(F.lit(1)).alias("rows")))
        listed += [(path, len(header)) for path in paths]
    files = spark.createDataFrame([(path.split(root_of(folder), 1)[-1], cols) for path, cols in listed], "file string, cols int")
    # A file with nothing but a header has no rows to group.
    return files.join(union_by_name(counts), "file", "left").select(
        "file", F.coalesce("rows", F.lit(0)).alias("rows"), "cols"
    )


def manifest(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """The audit record of a folder of CSV files, by path below it."""
    return checksums(spark, folder, pattern).join(file_rows(spark, folder, pattern), "file", "left")


def audit_folder(warehouse: Warehouse, folder: str, pattern: str = "*.csv", name: str = "file_manifest") -> tuple[DataFrame, bool]:
    """Compares a folder with its stored record; the first run stores the record and finds every file new."""
    spark = warehouse.spark
    saved = warehouse.read_or_empty(name, MANIFEST)
    status, sound = audit(checksums(spark, folder, pattern), saved)
    if not warehouse.exists(name):
        warehouse.write(manifest(spark, folder, pattern).select(*[c.split()[0] for c in MANIFEST.split(", ")]), name)
        status = compare_manifests(checksums(spark, folder, pattern), saved.where("false"))
    return status, sound


def audit(current: DataFrame, saved: DataFrame) -> tuple[DataFrame, bool]:
    """(status per file, whether no file is new or changed). Files that are gone are listed only."""
    status = compare_manifests(current, saved)
    return status, status.where("status in ('new', 'changed')").isEmpty()
