"""Which keys a stored table holds, in buckets beside it: asking moves the asker's keys and none of the stored ones.

Each key is kept once, so however many rows share one, no bucket grows with them. Additions are written as sorted runs of
their own; whenever ``RUNS`` of them have the same number of buckets they are merged, so repeated small additions
leave few small files, and the number of runs grows with the logarithm of the number of keys.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.session import written
from shelfsight.sources.tables import Warehouse

KEYS_PER_BUCKET = 1_000_000
RUNS = 4


class KeySet:
    """The keys of one table of a warehouse folder, read as text. A missing key is never held."""

    def __init__(self, warehouse: Warehouse, name: str, per_bucket: int = KEYS_PER_BUCKET):
        if warehouse.root is None:
            raise ValueError("key sets are kept in warehouse folders")
        self.warehouse, self.name, self.per_bucket = warehouse, name, per_bucket

    def exists(self) -> bool:
        return bool(self._runs())

    def missing(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose key is not held, those without a key included.

        The distinct keys asked for, a row per key and task, are hashed to the buckets of the runs. The rows themselves
        meet only the keys that are left, by a join that adaptive execution broadcasts or cuts where a key is hot.
        """
        runs = self._runs()
        if not runs:
            return df
        asked = df.select(F.col(f"`{key}`").cast("string").alias("_asked")).distinct()
        for run in runs:
            held = self._bucketed(run)
            asked = asked.join(held, asked["_asked"] == held["key"], "left_anti")
        return df.join(asked, df[f"`{key}`"].cast("string").eqNullSafe(asked["_asked"]), "left_semi")

    def add(self, df: DataFrame, key: str) -> None:
        """Holds the keys of ``df`` from now on; becomes visible with the writes of ``Warehouse.together``."""
        text = F.col(f"`{key}`").cast("string").alias("key")
        keys = written(self.missing(df.select(text).where("key is not null").distinct(), "key"), f"keys-{self.name}")
        count = keys.count()
        if count:
            self.warehouse.change_parts(self.name, [self._write(keys, count)])
            self._merge()

    def _merge(self) -> None:
        while True:
            same = defaultdict(list)
            for run in self._runs():
                same[_buckets(run)].append(run)
            full = next((runs for _, runs in sorted(same.items()) if len(runs) >= RUNS), None)
            if full is None:
                return
            # Writers that met may both have added a key.
            keys = reduce(DataFrame.unionAll, [self._bucketed(run) for run in full]).distinct()
            self.warehouse.change_parts(self.name, [self._write(keys, keys.count())], full)

    def _runs(self) -> list[str]:
        return self.warehouse.parts(self.name)

    def _write(self, keys: DataFrame, count: int) -> str:
        """One sorted file per bucket; the number of buckets, a power of two, is part of the folder's name."""
        buckets = 1 << (-(-count // self.per_bucket) - 1).bit_length()
        run, table = f"{self.name}/v-{uuid.uuid4().hex}-b{buckets}", f"keys_{uuid.uuid4().hex}"
        spark = self.warehouse.spark
        writer = keys.repartition(buckets, "key").write.format("parquet").bucketBy(buckets, "key").sortBy("key")
        writer.option("path", f"{self.warehouse.root}/{run}").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay, as their place was given
        return run

    def _bucketed(self, run: str) -> DataFrame:
        """A run as a table that Spark knows to be bucketed. The catalog entry is needed only until the plan is made."""
        spark, table = self.warehouse.spark, f"keys_{uuid.uuid4().hex}"
        place = f"{self.warehouse.root}/{run}".replace("\\", "\\\\").replace("'", "\\'")
        n = _buckets(run)
        spark.sql(f"CREATE TABLE {table} (key STRING) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {n} BUCKETS LOCATION '{place}'")
        try:
            return spark.table(table).alias(table)
        finally:
            spark.sql(f"DROP TABLE {table}")


def keys_of(warehouse: Warehouse, table: str, key: str) -> KeySet | None:
    """The key set beside a table, made from its rows where there is none yet; databases have none."""
    if warehouse.root is None:
        return None
    held = KeySet(warehouse, f"{table}_keys")
    if not held.exists() and warehouse.exists(table):
        held.add(warehouse.read(table), key)
    return held


def _buckets(run: str) -> int:
    return int(re.search(r"-b(\d+)$", run)[1])
