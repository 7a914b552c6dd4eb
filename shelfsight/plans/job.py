"""The whole run: extract, validate, transform, validate, load."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.contracts import CLEAN_PRODUCTS, CLEAN_REVIEWS, RAW_PRODUCTS, RAW_REVIEWS, Contract
from shelfsight.operators.enrich import Scorer, clean_sentiment, current_rate, fresh_sentiment, lexicon_scorer
from shelfsight.operators.sampling import uniform_sample
from shelfsight.plans.transforms import clean_products, clean_reviews
from shelfsight.schemas import FALLBACK_RATE, RATE_SCHEMA, SENTIMENT_SCHEMA
from shelfsight.session import scratch
from shelfsight.sources.keys import KeySet, keys_of
from shelfsight.sources.tables import Warehouse, append_metrics, append_rate, load_raw


@dataclass
class Run:
    """What happened, stage by stage."""

    status: str = "running"
    stages: list[dict] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    def log(self, spark: SparkSession) -> DataFrame:
        """One row per (stage, detail)."""
        rows = [
            (s["stage"], s["status"], round(s["seconds"], 3), key, None if value is None else str(value))
            for s in self.stages for key, value in (s["details"] or {"": None}).items()
        ]
        return spark.createDataFrame(rows, "stage string, status string, seconds double, detail string, value string")


def _stage(run: Run, name: str, work: Callable[[], dict], stops: bool) -> bool:
    """Runs one stage; a failure is recorded and, if the stage ``stops``, ends the run."""
    started = time.monotonic()
    try:
        details, status = work(), "ok"
    except Exception as problem:
        details, status = {"error": str(problem)}, "error" if stops else "warning"
        run.errors.append(f"{name}: {problem}")
    run.stages.append({"stage": name, "status": status, "seconds": time.monotonic() - started, "details": details})
    if status == "error":
        run.status = "failed"
    return status != "error"


def _watched(df: DataFrame, name: str, contract: Contract | None) -> tuple[DataFrame, Callable[[], tuple[int, dict]]]:
    """``df``, and what gives its rows and failures per (column, check) once it has been written; the same pass counts them."""
    seen = Observation(f"{name}-{time.monotonic_ns()}")
    checks = [] if contract is None else contract.failing(df)
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(failing.cast("bigint")), F.lit(0)).alias(f"c{i}") for i, (_, _, failing) in enumerate(checks)],
    )

    def counted() -> tuple[int, dict]:
        counts = seen.get
        return counts["rows"], {(f.name, check): counts[f"c{i}"] for i, (f, check, _) in enumerate(checks) if counts[f"c{i}"]}

    return watched, counted


def _write_checked(warehouse: Warehouse, df: DataFrame, name: str, contract: Contract | None) -> dict:
    """Writes a table; its rows and contract failures are counted by the same pass."""
    watched, counted = _watched(df, name, contract)
    warehouse.write(watched, name)
    rows, found = counted()
    failed = {f"{column} {check}": n for (column, check), n in found.items()}
    return {"rows": rows, "valid": not failed and (contract is None or not contract.missing(df)), "failures": failed}


def run_job(
    spark: SparkSession,
    extract: Callable[[], tuple[DataFrame, DataFrame]],
    warehouse: Warehouse,
    scorer: Scorer | None = None,
    review_limit: int | None = None,
    review_ids: Sequence[str] = ("author_id", "product_id"),
    sentiment_size: int | None = None,
    use_cache: bool = True,
    fallback_rate: float = FALLBACK_RATE,
    product_order: Sequence[str] = (),
    review_order: Sequence[str] = (),
    metrics: DataFrame | None = None,
    clusters: DataFrame | None = None,
) -> Run:
    """Runs all stages. Validation only reports; a failing extract, transform or load ends the run.

    ``extract`` gives (raw products, raw reviews); ``review_limit`` keeps an exact sample of reviews,
    ``sentiment_size`` scores a balanced sample of that size instead of every usable text.
    Frames stay lazy between the stages: each output table is computed once, when it is written.
    """
    run, data = Run(), {}

    def take() -> dict:
        products, reviews = extract()
        # Raw rows are checked as they are stored.
        watched = {name: _watched(df, name, contract) for name, df, contract in (("raw_products", products, RAW_PRODUCTS), ("raw_reviews", reviews, RAW_REVIEWS))}
        loaded = load_raw(warehouse, *[df for df, _ in watched.values()])
        # What this run has just stored is read from the store: the sources are scanned once.
        products = warehouse.read("raw_products") if "raw_products" in loaded else products
        reviews = warehouse.read("raw_reviews") if "raw_reviews" in loaded else reviews
        data["checked"] = {name: counted for name, (_, counted) in watched.items() if name in loaded}
        if review_limit is not None:
            data["checked"].pop("raw_reviews", None)  # only the sample is checked
            reviews = uniform_sample(reviews, list(review_ids), review_limit)
        cache = None
        if use_cache:
            cache = data["cache"] = keys_of(warehouse, "sentiment_cache", "author_id") or warehouse.read_or_empty("sentiment_cache", SENTIMENT_SCHEMA)
        data["fresh"] = fresh_sentiment(
            reviews, scorer or lexicon_scorer(), sentiment_size, cache, ids=tuple({"review_text": 0, **dict.fromkeys(review_ids)})
        )
        rate = current_rate(warehouse.read_or_empty("exchange_rates", RATE_SCHEMA), fallback_rate).first()
        data.update(products=products, reviews=reviews, rate=rate)
        return {"raw tables written": ", ".join(loaded), "rate": rate["rate"], "rate source": rate["source"]}

    def check_raw() -> dict:
        details = {}
        for name, contract in (("products", RAW_PRODUCTS), ("reviews", RAW_REVIEWS)):
            counted = data["checked"].get(f"raw_{name}")
            failures = contract.failure_counts(data[name]) if counted is None else counted()[1] | contract.absent(data[name])
            details[f"{name} valid"] = not failures
            details.update({f"{name} {column} {check}": n for (column, check), n in failures.items()})
        return details

    def transform() -> dict:
        data["clean_products"] = clean_products(data["products"], data["rate"]["rate"], product_order)
        data["clean_reviews"] = clean_reviews(data["reviews"], review_order)
        return {}

    def load() -> dict:
        # Readers see all new tables or none of them.
        with warehouse.together():
            details = write_tables()
        warehouse.expire()
        return details

    def write_tables() -> dict:
        details = {}
        for name, contract in (("clean_products", CLEAN_PRODUCTS), ("clean_reviews", CLEAN_REVIEWS)):
            for key, value in _write_checked(warehouse, data[name], name, contract).items():
                details[f"{name} {key}"] = value
        # Scored once: the new scores are stored first, and the result table is read from the store.
        if use_cache:
            stored = warehouse.write(data["fresh"], "sentiment_cache", "append")
            if isinstance(data["cache"], KeySet):
                data["cache"].add(stored, "author_id")
            scored = warehouse.read("sentiment_cache")
        else:
            scored = data["fresh"]
        details["sentiment rows"] = _write_checked(warehouse, clean_sentiment(scored), "sentiment_results", None)["rows"]
        rate = data["rate"]
        append_rate(warehouse, spark.createDataFrame([(rate["date"], rate["rate"], rate["source"])], "date string, rate double, source string"))
        return details

    def extras() -> dict:
        if metrics is not None:
            append_metrics(warehouse, metrics)
        if clusters is not None:
            warehouse.write(clusters, "clusters")
        return {"metrics": metrics is not None, "clusters": clusters is not None}

    stages = [
        ("extract", take, True), ("validate_raw", check_raw, False), ("transform", transform, True),
        ("load", load, True), ("load_extras", extras, False),
    ]
    # All that a run leaves is in the warehouse, so its working files go with it.
    with scratch(spark, "run"):
        for name, work, stops in stages:
            if not _stage(run, name, work, stops):
                return run
    run.status = "success"
    return run

