"""Data contracts: declared columns with types, nullability and value checks.

A contract turns into one expression per check. Validation is a single aggregation that counts the
failures of every check in one pass; the failing rows themselves are only listed on request.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.numbers import nan_to_null
from shelfsight.operators.clean import as_number


@dataclass(frozen=True)
class Check:
    name: str
    holds: Callable[[Column], Column]


def at_least(low: float) -> Check:
    return Check(f"greater_than_or_equal_to({low})", lambda c: c >= low)


def above(low: float) -> Check:
    return Check(f"greater_than({low})", lambda c: c > low)


def within(low: float, high: float) -> Check:
    return Check(f"in_range({low}, {high})", lambda c: c.between(low, high))


def one_of(*values: float) -> Check:
    return Check(f"isin({list(values)})", lambda c: c.isin(*values))


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # Spark type name
    nullable: bool = True
    checks: tuple[Check, ...] = ()

    def value(self, df: DataFrame) -> Column:
        """The column of ``df`` in the declared type, null where it does not convert."""
        return as_number(df, self.name) if self.kind == "double" else F.col(f"`{self.name}`").try_cast(self.kind)


class ContractError(ValueError):
    """Strict validation failed; ``failures`` maps (column, check) to its count."""

    def __init__(self, contract: str, failures: dict[tuple[str, str], int]):
        self.failures = failures
        super().__init__(f"{contract} breaks its contract: {failures}")


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def missing(self, df: DataFrame) -> list[str]:
        return [f.name for f in self.fields if f.name not in df.columns]

    def failing(self, df: DataFrame) -> list[tuple[Field, str, Column]]:
        """(field, check name, condition true on a failing row) of every check that applies."""
        found = []
        for f in self.fields:
            if f.name not in df.columns:
                continue
            raw, value = F.col(f"`{f.name}`"), f.value(df)
            given = nan_to_null(raw) if df.schema[f.name].dataType.simpleString() in ("double", "float") else raw
            if df.schema[f.name].dataType.simpleString() != f.kind:
                found.append((f, f"coerce_dtype({f.kind})", given.isNotNull() & value.isNull()))
            if not f.nullable:
                found.append((f, "not_nullable", given.isNull()))
            for check in f.checks:
                found.append((f, check.name, value.isNotNull() & ~check.holds(value)))
        return found

    def violations(self, df: DataFrame) -> DataFrame:
        """One row per failed check: schema_context, column, check, failure_case."""
        cases = [
            F.when(
                failing,
                F.struct(
                    F.lit("Column").alias("schema_context"), F.lit(f.name).alias("column"),
                    F.lit(check).alias("check"), F.col(f"`{f.name}`").cast("string").alias("failure_case"),
                ),
            )
            for f, check, failing in self.failing(df)
        ]
        spark = df.sparkSession
        schema = "schema_context string, column string, check string, failure_case string"
        absent = spark.createDataFrame(
            [("DataFrameSchema", c, "column_in_dataframe", c) for c in self.missing(df)], schema
        )
        if not cases:
            return absent
        rows = df.select(F.filter(F.array(*cases), lambda c: c.isNotNull()).alias("cases"))
        listed = rows.where(F.size("cases") > 0).select(F.inline("cases"))
        return listed.unionByName(absent) if self.missing(df) else listed

    def summary(self, df: DataFrame) -> DataFrame:
        """One row per check with its failure count, zero included; one pass, nothing shuffled but counts."""
        failures = self.failing(df)
        counted = df.agg(*[F.count_if(failing).alias(f"c{i}") for i, (_, _, failing) in enumerate(failures)])
        return counted.select(
            F.inline(F.array(*[
                F.struct(F.lit(f.name).alias("column"), F.lit(check).alias("check"), F.col(f"c{i}").alias("failures"))
                for i, (f, check, _) in enumerate(failures)
            ]))
        )

    def failure_counts(self, df: DataFrame) -> dict[tuple[str, str], int]:
        counts = {(r["column"], r["check"]): r["failures"] for r in self.summary(df).where("failures > 0").collect()}
        return counts | self.absent(df)

    def absent(self, df: DataFrame) -> dict[tuple[str, str], int]:
        return {(c, "column_in_dataframe"): 1 for c in self.missing(df)}

    def coerced(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f.name: f.value(df) for f in self.fields if f.name in df.columns})

    def validate(self, df: DataFrame, strict: bool = False) -> tuple[DataFrame, bool]:
        """(frame with declared types, True), or the frame as it came and False; strict raises instead."""
        failures = self.failure_counts(df)
        if not failures:
            return self.coerced(df), True
        if strict:
            raise ContractError(self.name, failures)
        return df, False


# The contracts.
RAW_PRODUCTS = Contract("raw_products", (
    Field("product_id", "string"),
    Field("product_name", "string"),
    Field("brand_name", "string"),
    Field("price_usd", "double", checks=(at_least(0),)),
    Field("rating", "double", checks=(within(0, 5),)),
    Field("loves_count", "double", checks=(at_least(0),)),
    Field("primary_category", "string"),
))
RAW_REVIEWS = Contract("raw_reviews", (
    Field("author_id", "string"),
    Field("rating", "double", checks=(within(1, 5),)),
    Field("is_recommended", "double", checks=(one_of(0.0, 1.0),)),
    Field("total_feedback_count", "double", checks=(at_least(0),)),
    Field("total_neg_feedback_count", "double", checks=(at_least(0),)),
    Field("total_pos_feedback_count", "double", checks=(at_least(0),)),
    Field("review_text", "string"),
    Field("product_id", "string"),
))
CLEAN_PRODUCTS = Contract("clean_products", (
    Field("product_id", "string", nullable=False),
    Field("product_name", "string", nullable=False),
    Field("brand_name", "string"),
    Field("price_usd", "double", nullable=False, checks=(above(0),)),
    Field("price_clp", "double", nullable=False, checks=(above(0),)),
    Field("rating", "double", nullable=False, checks=(within(0, 5),)),
    Field("loves_count", "double", nullable=False, checks=(at_least(0),)),
    Field("primary_category", "string"),
))
CLEAN_REVIEWS = Contract("clean_reviews", (
    Field("author_id", "string", nullable=False),
    Field("rating", "double", nullable=False, checks=(within(1, 5),)),
    Field("is_recommended", "double", nullable=False, checks=(one_of(0.0, 1.0),)),
    Field("review_text", "string"),
    Field("product_id", "string", nullable=False),
))
