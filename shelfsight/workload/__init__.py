"""Every operator as a query over the given tables, with its SQL twin where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfsight.workload import q_clean, q_evaluate, q_features, q_models, q_reports, q_sources  # noqa: F401
from shelfsight.workload.registry import ORACLES, QUERIES


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["T13_loved_brands"](spark, folder)


__all__ = ["ORACLES", "QUERIES", "flagship"]
