import hashlib

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import enrich
from shelfsight.plans.job import run_job
from shelfsight.schemas import REVIEW_COLUMNS
from shelfsight.sources import audit, csv, records, tables
from shelfsight.sources.tables import Warehouse


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


HEADER = "product_id,product_name,brand_name,price_usd,rating,loves_count,primary_category\n"


def test_products_scan(spark, tmp_path):
    put(tmp_path / "product_info.csv", HEADER + 'P1,"A ""fine""\nname",X,12.5,4,NA,Makeup\nP2,B,NULL,oops,,3,\n')
    found = {r["product_id"]: r for r in csv.read_products(spark, str(tmp_path)).collect()}
    assert found["P1"]["product_name"] == 'A "fine"\nname' and found["P1"]["price_usd"] == 12.5 and found["P1"]["loves_count"] is None
    assert found["P2"]["brand_name"] is None and found["P2"]["price_usd"] is None and found["P2"]["primary_category"] is None


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_products(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        csv.read_reviews(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        csv.read_folder(spark, str(tmp_path))
    put(tmp_path / "product_info.csv", "product_id,price_usd\nP1,1\n")
    with pytest.raises(ValueError, match="brand_name"):
        csv.read_products(spark, str(tmp_path))


def review_line(values):
    return ",".join(values.get(c, "") for c in REVIEW_COLUMNS)


def test_reviews_over_several_files(spark, tmp_path):
    for i in range(3):
        put(tmp_path / f"reviews_{i}.csv", ",".join(REVIEW_COLUMNS) + "\n" + review_line({"author_id": f"U{i}", "rating": "4", "is_recommended": "1"}) + "\n")
    found = csv.read_reviews(spark, str(tmp_path))
    assert sorted(r["author_id"] for r in found.collect()) == ["U0", "U1", "U2"] and dict(found.dtypes)["rating"] == "double"


def test_reviews_with_another_column_order(spark, tmp_path):
    put(tmp_path / "reviews_0.csv", ",".join(REVIEW_COLUMNS) + "\n" + review_line({"author_id": "U0", "rating": "4"}) + "\n")
    put(tmp_path / "reviews_1.csv", ",".join(reversed(REVIEW_COLUMNS)) + ",extra\n" + ",".join(reversed(review_line({"author_id": "U1", "rating": "5"}).split(","))) + ",e\n")
    with pytest.raises(Exception):
        csv.read_reviews(spark, str(tmp_path)).collect()
    found = {r["author_id"]: r for r in csv.read_reviews(spark, str(tmp_path), one_header=False).collect()}
    assert found["U0"]["rating"] == 4.0 and found["U1"]["rating"] == 5.0 and found["U1"]["extra"] == "e"


def test_folder_union(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,z\n3,4\n")
    assert sorted((r["x"] or "", r["y"], r["z"] or "") for r in csv.read_folder(spark, str(tmp_path)).collect()) == [("", "3", "4"), ("1", "2", "")]


@pytest.mark.parametrize("kind", ["folder", "database"])
def test_modes(spark, tmp_path, kind):
    if kind == "database":
        spark.sql(f"create database if not exists shop location '{tmp_path}/shop'")
    warehouse = Warehouse(spark, str(tmp_path / "w")) if kind == "folder" else Warehouse(spark, database="shop")
    df = spark.range(3)
    assert not warehouse.exists("t")
    with pytest.raises(LookupError):
        warehouse.read("t")
    warehouse.write(df, "t")
    warehouse.write(df, "t", "append")
    assert warehouse.read("t").count() == 6 and warehouse.read("t", limit=2, order=["id"]).count() == 2
    warehouse.write(df, "t", "keep")
    assert warehouse.read("t").count() == 6
    with pytest.raises(Exception):
        warehouse.write(df, "t", "fail")
    warehouse.write(df, "t")
    assert warehouse.read("t").count() == 3
    with pytest.raises(ValueError):
        Warehouse(spark)


def test_rates(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert tables.rate_history(warehouse).columns == ["date", "rate", "source", "loaded_at"]
    nothing = enrich.current_rate(tables.rate_history(warehouse), today="2025-01-01").first()
    assert tuple(nothing) == ("2025-01-01", 950.0, "fallback")
    for day, rate in (("2025-06-01", 950.0), ("2025-06-02", 940.5)):
        tables.append_rate(warehouse, spark.createDataFrame([(day, rate, "api")], "date string, rate double, source string"))
    assert [r["date"] for r in tables.rate_history(warehouse).collect()] == ["2025-06-02", "2025-06-01"]
    assert tuple(enrich.current_rate(tables.rate_history(warehouse)).first()) == ("2025-06-02", 940.5, "api")


def test_audit(spark, tmp_path):
    put(tmp_path / "a.csv", "x\n1\n2\n")
    put(tmp_path / "b.csv", "x,y\n1,2\n")
    saved = audit.manifest(spark, str(tmp_path)).collect()
    assert {(r["file"], r["rows"], r["cols"]) for r in saved} == {("a.csv", 2, 1), ("b.csv", 1, 2)}
    assert {r["sha256"] for r in saved if r["file"] == "a.csv"} == {hashlib.sha256(b"x\n1\n2\n").hexdigest()}
    record = spark.createDataFrame(saved)
    assert audit.audit(audit.checksums(spark, str(tmp_path)), record)[1]
    put(tmp_path / "b.csv", "x,y\n1,3\n")
    put(tmp_path / "c.csv", "x\n1\n")
    (tmp_path / "gone").mkdir()
    extra = record.unionByName(record.where("file = 'a.csv'").withColumn("file", F.lit("d.csv")))
    status, ok = audit.audit(audit.checksums(spark, str(tmp_path)), extra)
    assert not ok and {r["file"]: r["status"] for r in status.collect()} == {"a.csv": "ok", "b.csv": "changed", "c.csv": "new", "d.csv": "gone"}


def test_same_names_in_different_folders(spark, tmp_path):
    (tmp_path / "raw" / "sub").mkdir(parents=True)
    put(tmp_path / "raw" / "a.csv", "x\n1\n")
    put(tmp_path / "raw" / "sub" / "a.csv", "x\n1\n2\n3\n")
    saved = {r["file"]: r for r in audit.manifest(spark, str(tmp_path / "raw")).collect()}
    assert {f: r["rows"] for f, r in saved.items()} == {"a.csv": 1, "sub/a.csv": 3}
    assert saved["a.csv"]["sha256"] != saved["sub/a.csv"]["sha256"]


def test_audit_keeps_its_record(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    put(tmp_path / "raw" / "a.csv", "x\n1\n")
    put(tmp_path / "raw" / "b.csv", "x\n1\n")
    store = Warehouse(spark, str(tmp_path / "store"))
    status, sound = audit.audit_folder(store, str(tmp_path / "raw"))
    assert not sound and {r["status"] for r in status.collect()} == {"new"}
    put(tmp_path / "raw" / "b.csv", "x\n2\n")
    status, sound = audit.audit_folder(store, str(tmp_path / "raw"))
    assert not sound and {r["file"]: r["status"] for r in status.collect()} == {"a.csv": "ok", "b.csv": "changed"}
    assert {r["file"]: r["rows"] for r in store.read("file_manifest").collect()} == {"a.csv": 1, "b.csv": 1}


def test_rows_longer_than_the_header(spark, tmp_path):
    put(tmp_path / "a.csv", 'x,y\n1,2\n3,4,5\n6\n"7\n7",8\n')
    put(tmp_path / "b.csv", "x,y\n" + "\n".join(f"{n},{n}" for n in range(20)) + "\n")
    files = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    with pytest.raises(Exception, match="more than the 2 fields"):
        csv.read_csv(spark, files).select("x").collect()
    for multiline in (None, True):
        found = csv.read_csv(spark, files, bad_rows="lost", multiline=multiline)
        rows = {(r["x"], r["y"], r["lost"]) for r in found.collect()}
        assert rows >= {("1", "2", None), ("3", "4", "3,4,5"), ("6", None, None), ("7\n7", "8", None), ("19", "19", None)} and len(rows) == 24
        assert found.where("lost is not null").count() == 1
    assert records.broken_records(spark, files[1:]) is None and records.broken_records(spark, files).count() == 24


def test_half_written_tables_do_not_exist(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    (tmp_path / "t" / "_temporary" / "0").mkdir(parents=True)
    assert not store.exists("t") and not store.exists("never")
    store.write(spark.range(0), "empty")
    for mark in (tmp_path / "empty").rglob("_SUCCESS"):
        mark.unlink()
    assert store.exists("empty") and store.read("empty").count() == 0


def test_folder_with_small_types(spark, tmp_path):
    put(tmp_path / "a.csv", "n,x,t\n1,1.5,a\n300,2,b\n")
    put(tmp_path / "b.csv", "t,n\na,\n7,4\n")
    narrow, report = csv.read_narrow(spark, str(tmp_path))
    assert dict(narrow.dtypes) == {"n": "smallint", "x": "float", "t": "string"} and narrow.count() == 4
    assert {r["column"]: r["from_type"] for r in report.collect()} == {"n": "bigint", "x": "double", "t": "string"}


def test_scorer_failures_are_unknown(spark):
    def fussy(text):
        if "boom" in text:
            raise RuntimeError("no answer")
        return ("Positive", 0.123456) if "good" in text else ("weird", 0.5)

    df = spark.createDataFrame([("good one",), ("boom",), ("   ",), (None,), ("other",)], "review_text string")
    found = [(r["sentiment"], r["sentiment_score"]) for r in enrich.score_texts(df, enrich.text_scorer(fussy)).collect()]
    assert found == [("positive", 0.1235), ("unknown", 0.0), ("unknown", 0.0), ("unknown", 0.0), ("unknown", 0.5)]


def test_whole_text_reaches_the_scorer(spark):
    df = spark.createDataFrame([("x" * 5000,)], "review_text string")
    share = enrich.text_scorer(lambda t: ("positive", len(t) / 10_000))
    assert enrich.score_texts(df, share).first()["sentiment_score"] == 0.5
    assert enrich.score_texts(df, share, max_chars=500).first()["sentiment_score"] == 0.05


def test_batch_scorer_and_native_scorer(spark):
    import pandas as pd

    df = spark.createDataFrame([("GOOD good, bad!",), ("",), (None,), ("great",), ("goods",)], "review_text string")
    whole = enrich.batch_scorer(lambda texts: pd.DataFrame({"label": "negative", "score": texts.str.len() / 7}))
    assert [(r[1], r[2]) for r in enrich.score_texts(df, whole).collect()][3:] == [("negative", 0.7143), ("negative", 0.7143)]
    failing = enrich.batch_scorer(lambda texts: 1 / 0)
    assert {(r[1], r[2]) for r in enrich.score_texts(df, failing).collect()} == {("unknown", 0.0)}
    native = enrich.score_texts(df, enrich.lexicon_scorer())
    assert [(r[1], r[2]) for r in native.collect()] == [
        ("positive", 0.6667), ("unknown", 0.0), ("unknown", 0.0), ("positive", 1.0), ("neutral", 0.5)]
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()


def test_cache_is_not_scored_again(spark, raw_reviews):
    reviews = raw_reviews.select("author_id", "review_text", "is_recommended").where("author_id is not null").dropDuplicates(["author_id"])
    cache = spark.createDataFrame([("U001", "kept", 1, "neutral", 0.1)], "author_id string, review_text string, is_recommended int, sentiment string, sentiment_score double")
    found = enrich.add_sentiment(reviews, enrich.lexicon_scorer(), 500, cache)
    assert {r["author_id"]: r["sentiment"] for r in found.collect()} == {"U001": "neutral", "U002": "neutral", "U003": "negative"}
    with pytest.raises(ValueError):
        enrich.add_sentiment(reviews.drop("review_text"), enrich.lexicon_scorer())


def run(spark, folder, raw_products, raw_reviews, **options):
    warehouse = Warehouse(spark, str(folder))
    return warehouse, run_job(
        spark, lambda: (raw_products, raw_reviews), warehouse, review_ids=["seq"], product_order=["seq"], review_order=["seq"], **options)


def test_whole_run(spark, tmp_path, raw_products, raw_reviews):
    for round_ in (1, 2):
        warehouse, result = run(spark, tmp_path / "w", raw_products, raw_reviews)
        assert result.status == "success", result.errors
        assert warehouse.read("clean_products").count() == 3 and warehouse.read("clean_reviews").count() == 3
        assert warehouse.read("raw_reviews").count() == 5
        assert warehouse.read("exchange_rates").count() == round_
    log = {(r["stage"], r["detail"]): r["value"] for r in result.log(spark).collect()}
    assert log[("validate_raw", "products valid")] == "False"
    assert log[("load", "clean_products rows")] == "3" and log[("load", "clean_reviews valid")] == "True"
    # The second run found all its authors in the cache, but for the one without a name.
    assert warehouse.read("sentiment_cache").where("author_id = 'U002'").count() == 1


def test_run_limit_and_no_cache(spark, tmp_path, raw_products, raw_reviews):
    warehouse, result = run(spark, tmp_path / "w", raw_products, raw_reviews, review_limit=2, use_cache=False)
    assert result.status == "success" and warehouse.read("clean_reviews").count() <= 2
    assert not warehouse.exists("sentiment_cache")


def test_failing_extract_ends_the_run(spark, tmp_path):
    def broken():
        raise FileNotFoundError("no source")

    result = run_job(spark, broken, Warehouse(spark, str(tmp_path)))
    assert result.status == "failed" and [s["stage"] for s in result.stages] == ["extract"] and "no source" in result.errors[0]


def test_failing_extras_only_warn(spark, tmp_path, raw_products, raw_reviews):
    broken = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("model_name"))
    _, result = run(spark, tmp_path / "w", raw_products, raw_reviews, metrics=broken)
    assert result.status == "success" and result.stages[-1]["status"] == "warning"
