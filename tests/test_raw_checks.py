"""Raw tables are checked by the pass that stores them."""

from shelfsight.operators.contracts import RAW_PRODUCTS, RAW_REVIEWS, Contract
from shelfsight.plans import job
from shelfsight.sources.tables import Warehouse


def test_raw_rows_are_checked_as_they_are_stored(spark, tmp_path, raw_products, raw_reviews, monkeypatch):
    wanted = {}
    for name, contract, df in (("products", RAW_PRODUCTS, raw_products), ("reviews", RAW_REVIEWS, raw_reviews)):
        failures = contract.failure_counts(df)
        wanted[f"{name} valid"] = not failures
        wanted.update({f"{name} {column} {check}": n for (column, check), n in failures.items()})
    assert len(wanted) > 2
    passes, real = [], Contract.failure_counts
    monkeypatch.setattr(Contract, "failure_counts", lambda self, df: passes.append(self.name) or real(self, df))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for limit, more in ((None, []), (None, ["products", "reviews"])):  # a second run finds the raw tables stored
        run = job.run_job(spark, lambda: (raw_products, raw_reviews), warehouse, review_limit=limit)
        assert run.status == "success" and next(s["details"] for s in run.stages if s["stage"] == "validate_raw") == wanted
        assert len(passes) == len(more)
