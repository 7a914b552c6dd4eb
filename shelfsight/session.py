"""Session settings, the shared working folder, and the size-checked broadcast."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_JOB: ContextVar[str] = ContextVar("job", default="")

# Largest frame that may travel through the driver to become a broadcast side.
SMALL_ROWS = 20_000


def session(app_name: str = "shelfsight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM never compiles methods above 8000 bytecodes. Wide projections that would be fused into
        # a longer one run several times faster when Spark splits them instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor can reach.

    A local session without that setting works below its warehouse folder. On a cluster the
    setting is required, since a machine-local path would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/shelfsight/{_JOB.get()}{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[None]:
    """Deletes the working files that are made inside when it ends, whether it succeeds or not.

    For jobs whose results are stored elsewhere: frames that were made inside cannot be used any more.
    """
    outer = _JOB.get()
    mine = shared_folder(spark, f"job-{purpose}")
    token = _JOB.set(f"{outer}{mine.rpartition('/')[2]}/")
    try:
        yield
    finally:
        _JOB.reset(token)
        delete(spark, mine)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, root: str | None = None) -> None:
    """Delete the working files below ``root`` (all of this session's folder by default).

    Call it once no frame that reads them is needed any more, as at the end of a job.
    """
    delete(spark, root or shared_folder(spark, "any").rpartition("/")[0])


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark can reach it; there is no other way to do so from Python."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` as a broadcast side when it holds at most ``max_rows`` rows, else ``df`` itself.

    The rows are fetched once (one more than the bound proves it is exceeded), so a small side is
    computed once; a larger one goes through Spark's ordinary shuffled join.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    # An Arrow table becomes a local relation, which needs no job and no Python worker each time it is joined.
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))
