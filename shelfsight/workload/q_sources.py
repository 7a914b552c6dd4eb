"""Sources, sinks, audit, enrichment, the whole run (S, E, W).

The sources read files written from the given tables, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight.operators import clean, enrich, evaluate, profile, relate
from shelfsight.plans import job
from shelfsight.schemas import CSV_NULL_TOKENS
from shelfsight.session import shared_folder
from shelfsight.sources import audit, csv, tables
from shelfsight.sources.tables import Warehouse
from shelfsight.workload import roles
from shelfsight.workload.q_evaluate import COMPARE, PER_CLASS, AUC, first_model
from shelfsight.workload.q_reports import CLUSTERS_SQL, RAW_REVIEW_COLUMNS, clusters_table, each_column, rounded
from shelfsight.workload.registry import query
from shelfsight.workload.roles import REVIEW_ORDER, sql

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"
KEYS = KEY.split(", ")
PRODUCT_TEXTS = ["product_name", "brand_name", "primary_category"]
REVIEW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def raw_files(spark, d) -> str:
    """The raw roles as CSV: one product file, reviews over several files; compressed, as texts are many times the tables."""
    folder = shared_folder(spark, "raw")
    tables.export_csv(roles.raw_products(spark, d), f"{folder}/product_info.csv", "gzip")
    rows = roles.raw_reviews(spark, d)
    for name, part in (("a", "l_linenumber <= 3"), ("b", "l_linenumber > 3")):
        tables.export_csv(rows.where(part), f"{folder}/reviews_{name}.csv", "gzip")
    return folder


def _given(c: str, tokens=("nan", "None", "")) -> str:
    out = c
    for token in tokens:
        out = f"nullif({out}, '{token}')"
    return out


@query("S01_read_products", sql(f"SELECT product_id, CAST(listing AS VARCHAR) AS listing, {', '.join(f'{_given(c)} AS {c}' for c in PRODUCT_TEXTS)}, price_usd, rating, loves_count FROM raw_products", "raw_products"))
def _(spark, d):
    folder = shared_folder(spark, "raw")
    tables.export_csv(roles.raw_products(spark, d), f"{folder}/product_info.csv")
    return csv.read_products(spark, folder)


@query("S02_read_reviews", sql(f"""
    SELECT {', '.join(f"CAST({c} AS VARCHAR) AS {c}" for c in REVIEW_KEYS)}, author_id, product_id, rating, TRY_CAST(is_recommended AS DOUBLE) AS is_recommended,
      TRY_CAST(total_feedback_count AS DOUBLE) AS total_feedback_count, {_given('review_text')} AS review_text, {_given('hair_color')} AS hair_color FROM raw_reviews""", "raw_reviews"))
def _(spark, d):
    return csv.read_reviews(spark, raw_files(spark, d)).select(
        *REVIEW_KEYS, "author_id", "product_id", "rating", "is_recommended", "total_feedback_count", "review_text", "hair_color")


@query("S03_read_all", sql("""
    SELECT 'products' AS part, count(*) AS n, count(product_id) AS products, count(rating) AS ratings FROM raw_products
    UNION ALL SELECT 'reviews', count(*), count(product_id), count(rating) FROM raw_reviews""", "raw_products", "raw_reviews"))
def _(spark, d):
    parts = zip(("products", "reviews"), csv.read_all(spark, raw_files(spark, d)))
    return relate.union_by_name(df.agg(
        F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.count("product_id").alias("products"), F.count("rating").alias("ratings")) for part, df in parts)


@query("S04_null_tokens", sql(f"""
    SELECT {KEY}, CASE WHEN skin_tone NOT IN ('NULL', 'null', '', ' ', 'unknown', 'UNKNOWN') THEN skin_tone END AS skin_tone, review_text FROM
    (SELECT * REPLACE (CASE WHEN trim(skin_tone) = 'Unknown' THEN 'unknown' ELSE skin_tone END AS skin_tone) FROM raw_reviews)""", "raw_reviews"))
def _(spark, d):
    rows = roles.raw_reviews(spark, d)
    marked = rows.withColumn("skin_tone", F.when(F.trim("skin_tone") == "Unknown", "unknown").otherwise(F.col("skin_tone")))
    return clean.null_tokens(marked, CSV_NULL_TOKENS).select(*KEYS, "skin_tone", "review_text")


@query("S05_read_folder", sql("""
    SELECT (SELECT count(*) FROM raw_products) + (SELECT count(*) FROM raw_reviews) AS n, (SELECT count(author_id) FROM raw_reviews) AS authors,
      (SELECT count(price_usd) FROM raw_products) AS prices, (SELECT count(product_id) FROM raw_products) + (SELECT count(product_id) FROM raw_reviews) AS products""", "raw_products", "raw_reviews"))
def _(spark, d):
    everything = csv.read_folder(spark, raw_files(spark, d), "*.csv")
    return everything.agg(
        F.count(F.lit(1)).alias("n"), F.count("author_id").alias("authors"), F.count("price_usd").alias("prices"), F.count("product_id").alias("products"))


@query("S06_read_table", sql("SELECT * FROM products ORDER BY product_id LIMIT 500", "products"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    warehouse.write(roles.products(spark, d), "raw_products")
    return warehouse.read("raw_products", limit=500, order=["product_id"])


@query("S07_rate_history", sql("SELECT date, rate, source, loaded_at FROM rates", "rates"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    assert tables.rate_history(warehouse).isEmpty()
    warehouse.write(roles.rates(spark, d), "exchange_rates")
    return tables.rate_history(warehouse)


def _sizes(warehouse, names):
    return relate.union_by_name(
        warehouse.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name in names)


@query("S08_initial_load", sql("SELECT 'raw_products' AS name, count(*) AS n FROM raw_products UNION ALL SELECT 'raw_reviews', count(*) FROM raw_reviews", "raw_products", "raw_reviews"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    products, reviews = roles.raw_products(spark, d), roles.raw_reviews(spark, d)
    tables.load_raw(warehouse, products, reviews)
    tables.load_raw(warehouse, products.unionByName(products), reviews)  # already there: left alone
    return _sizes(warehouse, ["raw_products", "raw_reviews"])


@query("S09_write_modes", """
    SELECT 'replace' AS mode, count(*) AS n FROM part UNION ALL SELECT 'append', 2 * count(*) FROM part
    UNION ALL SELECT 'keep', count(*) FROM part UNION ALL SELECT 'fail', count(*) FROM part""")
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    part = roles.table(spark, d, "part")
    for mode in tables.MODES:
        warehouse.write(part, mode)
        try:
            warehouse.write(part, mode, mode)
        except Exception:
            assert mode == "fail"
    return _sizes(warehouse, list(tables.MODES)).withColumnRenamed("name", "mode")


@query("S10_clean_sinks", sql("""
    SELECT 'clean_products' AS name, count(*) AS n FROM products UNION ALL SELECT 'clean_reviews', count(*) FROM reviews
    UNION ALL SELECT 'sentiment_results', count(*) FROM sentiment""", "products", "reviews", "sentiment"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    made = {"clean_products": roles.products(spark, d), "clean_reviews": roles.reviews(spark, d), "sentiment_results": roles.sentiment(spark, d)}
    for name, df in made.items():
        warehouse.write(df, name)
    return _sizes(warehouse, made)


@query("S11_append_rate", sql("SELECT date, rate, source, 2 AS copies FROM rates WHERE loaded_at = (SELECT max(loaded_at) FROM rates)", "rates"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    now = enrich.current_rate(roles.rates(spark, d))
    for _ in range(2):
        tables.append_rate(warehouse, now)
    return tables.rate_history(warehouse).groupBy("date", "rate", "source").agg(F.count("loaded_at").alias("copies"))


@query("S12_append_metrics", sql("SELECT 'first' AS model_name, accuracy, f1, precision, recall, roc_auc, 3 AS best_k FROM (" + COMPARE + ") WHERE model = 'first'", "scores", per_class=PER_CLASS, areas=AUC))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    tables.append_metrics(warehouse, evaluate.metrics_row(first_model(spark, d), "first", best_k=3))
    kept = warehouse.read("model_metrics").select("model_name", "accuracy", "f1", "precision", "recall", "roc_auc", "best_k")
    return rounded(kept, 4)


@query("S13_cluster_sink", sql("SELECT k, inertia, silhouette, is_best FROM found", found=CLUSTERS_SQL))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    for _ in range(2):
        warehouse.write(clusters_table(spark, d), "clusters")
    return warehouse.read("clusters")


@query("S14_load_all", sql("""
    SELECT 'clean_products' AS name, count(*) AS n FROM products UNION ALL SELECT 'sentiment_results', count(*) FROM sentiment
    UNION ALL SELECT 'exchange_rates', 1 UNION ALL SELECT 'clusters', count(*) FROM found""", "products", "sentiment", found=CLUSTERS_SQL))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "store"))
    broken = roles.table(spark, d, "part").select(F.raise_error(F.lit("no metrics")).cast("string").alias("model_name"))
    tables.load_all(
        warehouse, {"clean_products": roles.products(spark, d), "sentiment_results": roles.sentiment(spark, d)},
        enrich.current_rate(roles.rates(spark, d)), metrics=broken, clusters=clusters_table(spark, d))
    return _sizes(warehouse, ["clean_products", "sentiment_results", "exchange_rates", "clusters"])


@query("S16_export_csv", sql("SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, brand_name, price_usd, loves_count FROM products", "products"))
def _(spark, d):
    path = f"{shared_folder(spark, 'export')}/clean.csv"
    tables.export_csv(roles.products(spark, d).select("product_id", "product_name", "brand_name", "price_usd", "loves_count"), path)
    return clean.coerce_numbers(csv.read_csv(spark, path), ["price_usd", "loves_count"])


def _audited(spark, d):
    """The orders as one CSV file per status; the record is of files that differ, are fewer, or more."""
    folder = f"{shared_folder(spark, 'audit')}/raw"
    rows = roles.table(spark, d, "orders").select("o_orderstatus", "o_orderkey")
    changed = rows.withColumn("o_orderkey", F.col("o_orderkey") + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    for part, frame, states in (("then", rows, ["F", "O"]), ("now", changed, ["F", "O", "P"])):
        for state in states:
            one = frame.where(F.col("o_orderstatus") == state).orderBy("o_orderkey").coalesce(1)
            one.write.option("header", True).csv(f"{folder}/{part}/{state}")
    return folder


@query("S17_audit", """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'changed' WHEN o_orderstatus = 'O' THEN 'ok' ELSE 'new' END AS status, count(*) AS rows, 2 AS cols FROM orders GROUP BY 1""")
def _(spark, d):
    folder = _audited(spark, d)
    state = F.substring_index("file", "/", 1).alias("state")
    saved = audit.manifest(spark, f"{folder}/then").select(state, F.col("sha256").alias("saved_sha256")).toDF("file", "sha256")
    now = audit.manifest(spark, f"{folder}/now").select(state, "sha256", "rows", "cols").toDF("file", "sha256", "rows", "cols")
    return audit.audit(now, saved)[0].join(now.select("file", "rows", "cols"), "file").select("status", "rows", "cols")


@query("S18_dataset_metadata", sql(" UNION ALL ".join(
    f"SELECT 'reviews' AS file, count(*) AS rows, {len(RAW_REVIEW_COLUMNS)} AS columns, {i} AS position, '{c}' AS \"column\", count(*) - count({c}) AS missing FROM raw_reviews"
    for i, c in enumerate(RAW_REVIEW_COLUMNS)), "raw_reviews"))
def _(spark, d):
    return profile.dataset_metadata(roles.raw_reviews(spark, d).select(*RAW_REVIEW_COLUMNS), "reviews")


# Enrichment --------------------------------------------------------------------------------------

GOOD, BAD = ["en", "er", "la", "on", "the"], ["de", "is", "le", "les", "un"]


def _count(words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(regexp_extract_all(lower(review_text), '[a-z]+'), lambda w: w IN ({listed})))"


SCORED = f"""
    SELECT *, CASE WHEN ups = downs THEN 'neutral' WHEN ups > downs THEN 'positive' ELSE 'negative' END AS sentiment,
      CASE WHEN ups = downs THEN 0.5::DOUBLE ELSE round_even(greatest(ups, downs) / (ups + downs)::DOUBLE, 4) END AS sentiment_score
    FROM (SELECT *, {_count(GOOD)} AS ups, {_count(BAD)} AS downs FROM document_reviews)"""


@query("E01_add_sentiment", sql("""
    SELECT author_id, is_recommended, sentiment, sentiment_score FROM (
      SELECT * REPLACE (coalesce(is_recommended, 0) AS is_recommended) FROM scored WHERE length(trim(review_text, ' ' || chr(9) || chr(10) || chr(13))) > 10
      QUALIFY row_number() OVER (PARTITION BY coalesce(is_recommended, 0) ORDER BY substr(md5(concat_ws('|', '42', author_id)), 1, 15), author_id) <= 150)
    WHERE author_id NOT IN (SELECT author_id FROM document_reviews WHERE toxic = 1)
    UNION ALL SELECT author_id, quality, 'negative', 1.0 FROM document_reviews WHERE toxic = 1""", "document_reviews", scored=SCORED))
def _(spark, d):
    rows = roles.document_reviews(spark, d)
    cache = rows.where("toxic = 1").select(
        "author_id", "review_text", F.col("quality").alias("is_recommended"), F.lit("negative").alias("sentiment"), F.lit(1.0).alias("sentiment_score"))
    reviews = rows.select("author_id", "review_text", "is_recommended")
    scorer = enrich.lexicon_scorer(GOOD, BAD)
    return enrich.add_sentiment(reviews, scorer, 300, cache, ids=("author_id",)).drop("review_text")


@query("E02_score_texts", sql("SELECT doc_id, sentiment, sentiment_score FROM scored", "document_reviews", scored=SCORED))
def _(spark, d):
    rows = roles.document_reviews(spark, d).select("doc_id", "review_text")
    return enrich.score_texts(rows, enrich.lexicon_scorer(GOOD, BAD)).drop("review_text")


@query("E03_current_rate", sql("""
    SELECT 'stored' AS part, date, rate, 'api' AS source FROM rates WHERE loaded_at = (SELECT max(loaded_at) FROM rates)
    UNION ALL SELECT 'empty', '2024-01-01', 950.0, 'fallback'""", "rates"))
def _(spark, d):
    stored = roles.rates(spark, d)
    parts = {"stored": enrich.current_rate(stored), "empty": enrich.current_rate(stored.where("rate < 0"), today="2024-01-01")}
    return relate.union_by_name(df.select(F.lit(part).alias("part"), "*") for part, df in parts.items())


@query("W01_whole_run", sql(f"""
    SELECT 'raw_products' AS name, count(*) AS n FROM raw_products UNION ALL SELECT 'raw_reviews', count(*) FROM raw_reviews
    UNION ALL SELECT 'clean_products', count(*) FROM clean_products UNION ALL SELECT 'clean_reviews', count(*) FROM clean_reviews
    UNION ALL SELECT 'sentiment_results', (SELECT count(*) FROM raw_reviews WHERE length(trim(review_text, ' ' || chr(10))) > 10)
    UNION ALL SELECT 'exchange_rates', 1""", "clean_products", "clean_reviews"))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "run"))
    run = job.run_job(
        spark, lambda: (roles.raw_products(spark, d), roles.raw_reviews(spark, d)), warehouse,
        review_ids=REVIEW_ORDER, product_order=["listing"], review_order=REVIEW_ORDER)
    if run.status != "success":
        raise RuntimeError(str(run.errors))
    return _sizes(warehouse, ["raw_products", "raw_reviews", "clean_products", "clean_reviews", "sentiment_results", "exchange_rates"])
