"""Where the modules of this subpackage register their queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_texts(spark: SparkSession, rows: int = 512) -> None:
    """Lets Python workers get at most ``rows`` rows at a time, since whole texts may be long.

    This is a setting of the session, as plans read it only when they run.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def unused(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
