"""Reports, profiles, contracts (A, P, V)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from shelfsight.operators import contracts, profile, reports
from shelfsight.session import shared_folder
from shelfsight.sources.sketches import FolderSketches
from shelfsight.sources.tables import Warehouse
from shelfsight.workload import roles
from shelfsight.workload.registry import query
from shelfsight.workload.roles import RATE, sql


def rounded(df, digits=6, *columns):
    """Computed doubles rounded, so that summation order cannot show."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})


@query("A01_sentiment_summary", sql("""
    SELECT sentiment, count(*) AS total_reviews, round(avg(is_recommended) * 100, 2) AS pct_recommended, round(avg(sentiment_score), 4) AS avg_sentiment_score
    FROM sentiment WHERE sentiment <> 'unknown' GROUP BY sentiment""", "sentiment"))
def _(spark, d):
    return reports.sentiment_summary(roles.sentiment(spark, d))


@query("A02_recommendation_by_sentiment", sql("SELECT sentiment, round(avg(is_recommended), 3) AS recommendation_rate FROM sentiment GROUP BY sentiment", "sentiment"))
def _(spark, d):
    return reports.recommendation_by_sentiment(roles.sentiment(spark, d))


@query("A03_catalog_kpis", sql("""
    SELECT count(*) AS products, round(avg(price_usd), 6) AS avg_price_usd, round(avg(price_usd) * 950, 4) AS avg_price_local, round(avg(rating), 6) AS avg_rating,
      (SELECT round(avg(is_recommended) * 100, 6) FROM reviews) AS pct_recommended FROM products""", "products", "reviews"))
def _(spark, d):
    kpis = reports.catalog_kpis(roles.products(spark, d), roles.reviews(spark, d), RATE)
    return rounded(rounded(kpis, 6, "avg_price_usd", "avg_rating", "pct_recommended"), 4, "avg_price_local")


@query("A04_loved_brands", sql("""
    SELECT brand_name, round(avg(loves_count), 6) AS avg_loves, count(product_id) AS products FROM products WHERE brand_name IS NOT NULL
    GROUP BY brand_name ORDER BY avg(loves_count) DESC NULLS LAST, brand_name LIMIT 10""", "products"))
def _(spark, d):
    return rounded(reports.loved_brands(roles.products(spark, d)))


@query("A05_products_per_category", sql("SELECT primary_category, count(*) AS n FROM products GROUP BY 1", "products"))
def _(spark, d):
    return reports.value_counts(roles.products(spark, d), "primary_category")


@query("A06_prices_by_category", sql("""
    SELECT primary_category, round_even(min(price_usd * 950), 0) AS min_price, round_even(max(price_usd * 950), 0) AS max_price, round_even(avg(price_usd * 950), 0) AS avg_price
    FROM products WHERE primary_category IS NOT NULL GROUP BY 1""", "products"))
def _(spark, d):
    return reports.prices_by_category(roles.products(spark, d), RATE)


@query("A07_median_price", sql("SELECT round(quantile_cont(price_usd * 950, 0.5), 4) AS median_local, round(quantile_cont(price_usd * 950, 0.5) / 950, 6) AS median_usd FROM products", "products"))
def _(spark, d):
    return rounded(rounded(reports.median_price(roles.products(spark, d), RATE), 4, "median_local"), 6, "median_usd")


@query("A08_slice_kpis", sql("""
    SELECT count(*) AS products, round(avg(price_usd), 6) AS avg_price, round(avg(rating), 6) AS avg_rating, count(DISTINCT brand_name) AS brands
    FROM products WHERE primary_category = 'ECONOMY' AND price_usd BETWEEN 910 AND 990""", "products"))
def _(spark, d):
    return rounded(reports.slice_kpis(roles.products(spark, d), category="ECONOMY", low=910, high=990))


@query("A09_price_histogram", sql("""
    SELECT bin, round(low + (bin - 1) * ((high - low) / 40), 6) AS from_value, round(low + bin * ((high - low) / 40), 6) AS to_value, count(*) AS n FROM (
      SELECT CAST(least(floor((v - low) / (high - low) * 40) + 1, 40) AS INT) AS bin, low, high
      FROM (SELECT price_usd * 950 AS v FROM products) CROSS JOIN (SELECT min(price_usd * 950) AS low, max(price_usd * 950) AS high FROM products))
    GROUP BY bin, low, high""", "products"))
def _(spark, d):
    return rounded(reports.histogram(roles.products(spark, d), F.col("price_usd") * RATE))


@query("A10_sentiment_distribution", sql("SELECT sentiment, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM sentiment), 4) AS pct FROM sentiment GROUP BY 1", "sentiment"))
def _(spark, d):
    return reports.sentiment_distribution(roles.sentiment(spark, d))


@query("A11_class_distribution", sql("SELECT is_recommended, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM document_reviews), 4) AS pct FROM document_reviews GROUP BY 1", "document_reviews"))
def _(spark, d):
    return reports.class_distribution(roles.document_reviews(spark, d), "is_recommended")


@query("A12_reviewed_brands", sql("SELECT brand_name, count(*) AS n FROM reviews JOIN products USING (product_id) GROUP BY 1 ORDER BY n DESC, brand_name LIMIT 10", "reviews", "products"))
def _(spark, d):
    joined = roles.reviews(spark, d).select("product_id").join(roles.products(spark, d).select("product_id", "brand_name"), "product_id")
    return reports.value_counts(joined, "brand_name", 10)


@query("A13_cluster_profile", sql("""
    SELECT cluster, count(is_recommended) AS total, CAST(sum(is_recommended) AS BIGINT) AS recommended,
      round(sum(is_recommended) * 100.0::DOUBLE / count(is_recommended), 2) AS pct_recommended,
      round(count(is_recommended) * 100.0::DOUBLE / (SELECT count(is_recommended) FROM reviews), 2) AS pct_of_total
    FROM (SELECT l_linenumber % 3 AS cluster, is_recommended FROM reviews) GROUP BY cluster""", "reviews"))
def _(spark, d):
    return reports.cluster_profile(roles.reviews(spark, d).select((F.col("l_linenumber") % 3).alias("cluster"), "is_recommended"))


@query("A15_latest_rate", sql("SELECT date, rate, source, loaded_at FROM rates ORDER BY loaded_at DESC LIMIT 1", "rates"))
def _(spark, d):
    return reports.latest_rate(roles.rates(spark, d))


CLUSTERS_SQL = """
    SELECT label + 2 AS k, round(sum(embedding[1]::DOUBLE * embedding[1]::DOUBLE) * 10000, 4) AS inertia, round(avg(embedding[2]::DOUBLE), 6) AS silhouette,
      round(avg(embedding[2]::DOUBLE), 6) = max(round(avg(embedding[2]::DOUBLE), 6)) OVER () AS is_best FROM embeddings GROUP BY label"""


def clusters_table(spark, d):
    """A stored k-sweep, one row per label of the embeddings."""
    first, second = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    table = roles.table(spark, d, "embeddings").groupBy("label").agg(
        F.round(F.sum(first * first) * 10000, 4).alias("inertia"), F.round(F.avg(second), 6).alias("silhouette"))
    best = table.agg(F.max("silhouette")).scalar()
    return table.select((F.col("label") + 2).cast("int").alias("k"), "inertia", "silhouette", (F.col("silhouette") == best).alias("is_best"))


@query("A16_clusters_by_k", sql("SELECT k, inertia, silhouette, is_best FROM found", found=CLUSTERS_SQL))
def _(spark, d):
    return reports.clusters_by_k(clusters_table(spark, d))


@query("A16_best_cluster", sql("SELECT k, inertia, silhouette, is_best FROM found WHERE is_best ORDER BY k LIMIT 1", found=CLUSTERS_SQL))
def _(spark, d):
    return reports.best_cluster(clusters_table(spark, d))


@query("A16_clusters_for_display", sql("""
    SELECT k, format('{:,}', CAST(round_even(inertia, 0) AS BIGINT)) AS inertia, round(silhouette, 4) AS silhouette, CASE WHEN is_best THEN '★ Óptimo' ELSE '' END AS chosen FROM found""", found=CLUSTERS_SQL))
def _(spark, d):
    return reports.clusters_for_display(clusters_table(spark, d))


METRICS_SQL = """
    SELECT source AS model_name, round(avg(quality), 6) AS accuracy, count(*) AS rows, max(doc_id) AS loaded_at FROM documents JOIN labels USING (doc_id) GROUP BY 1"""


@query("A17_latest_metrics", sql("SELECT * FROM found ORDER BY loaded_at DESC LIMIT 1", found=METRICS_SQL))
def _(spark, d):
    rows = roles.table(spark, d, "documents").join(roles.table(spark, d, "labels"), "doc_id").groupBy(F.col("source").alias("model_name")).agg(
        F.round(F.avg("quality"), 6).alias("accuracy"), F.count(F.lit(1)).alias("rows"), F.max("doc_id").alias("loaded_at"))
    return reports.latest_metrics(rows)


@query("A18_rating_price_points", sql("SELECT price_usd, rating, primary_category, product_name, brand_name FROM raw_products WHERE price_usd IS NOT NULL AND rating IS NOT NULL", "raw_products"))
def _(spark, d):
    return reports.rating_price_points(roles.raw_products(spark, d))


# Profiles ----------------------------------------------------------------------------------------

PRODUCT_NUMBERS = ["price_usd", "rating", "loves_count"]
REVIEW_NUMBERS = ["rating", "helpfulness", "total_feedback_count", "total_neg_feedback_count", "total_pos_feedback_count"]
REVIEW_TEXTS = ["review_text", "skin_tone", "eye_color", "skin_type", "hair_color", "is_recommended"]
RAW_REVIEW_COLUMNS = ["author_id", "product_id", "rating", "is_recommended", "helpfulness", "total_neg_feedback_count", "skin_tone", "hair_color"]


def each_column(template: str, names, joiner=" UNION ALL ") -> str:
    return joiner.join(template.replace("{c}", c) for c in names)


@query("P01_describe_numeric", sql(each_column("""
    SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS "min",
      round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c})::DOUBLE AS "max" FROM raw_products""", PRODUCT_NUMBERS), "raw_products"))
def _(spark, d):
    return rounded(profile.describe_numeric(roles.raw_products(spark, d), PRODUCT_NUMBERS), 6, "mean", "std", "q25", "q50", "q75")


@query("P02_missing_summary", sql("SELECT *, CAST(sum(missing) OVER () AS BIGINT) AS total_missing FROM (" + each_column("""
    SELECT '{c}' AS "column", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS pct FROM raw_reviews""", RAW_REVIEW_COLUMNS) + ")", "raw_reviews"))
def _(spark, d):
    return profile.missing_summary(roles.raw_reviews(spark, d).select(*RAW_REVIEW_COLUMNS))


@query("P03_describe_text", sql("SELECT \"column\", CAST(sum(n) AS BIGINT) AS \"count\", count(*) AS \"unique\", arg_max(value, (n, -r)) AS top, max(n) AS freq FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY value) AS r FROM (" + each_column("""
    SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM raw_reviews WHERE {c} IS NOT NULL GROUP BY {c}""", REVIEW_TEXTS) + ")) GROUP BY \"column\"", "raw_reviews"))
def _(spark, d):
    return profile.describe_text(roles.raw_reviews(spark, d), REVIEW_TEXTS)


@query("P04_duplicate_rows", sql("""
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates, round(sum(n - 1) * 100.0::DOUBLE / sum(n), 4) AS pct
    FROM (SELECT count(*) AS n FROM raw_reviews GROUP BY author_id, product_id, rating, is_recommended)""", "raw_reviews"))
def _(spark, d):
    return profile.duplicate_rows(roles.raw_reviews(spark, d).select("author_id", "product_id", "rating", "is_recommended"))


@query("P05_dataset_report", sql("""
    SELECT 'rows' AS metric, count(*) AS value FROM raw_products UNION ALL SELECT 'columns', 8
    UNION ALL SELECT 'duplicates', (SELECT count(*) FROM raw_products) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_products))
    UNION ALL SELECT 'unique_ids', count(DISTINCT product_id) FROM raw_products UNION ALL """ + each_column(
    "SELECT 'missing:{c}', count(*) - count({c}) FROM raw_products",
    ["product_id", "listing", "product_name", "brand_name", "price_usd", "rating", "loves_count", "primary_category"]), "raw_products"))
def _(spark, d):
    return profile.dataset_report(roles.raw_products(spark, d), "product_id")


@query("P06_mixed_types", sql("SELECT *, (numbers > 0)::INT + (dates > 0)::INT + (others > 0)::INT > 1 AS mixed FROM (" + each_column(r"""
    SELECT '{c}' AS "column", count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NOT NULL) AS numbers, count(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NOT NULL) AS dates,
      count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL AND TRY_CAST({c} AS DATE) IS NULL) AS others FROM raw_reviews""",
    ["is_recommended", "total_feedback_count", "submission_time", "author_id", "skin_tone"]) + ")", "raw_reviews"))
def _(spark, d):
    return profile.mixed_types(roles.raw_reviews(spark, d), ["is_recommended", "total_feedback_count", "submission_time", "author_id", "skin_tone"])


@query("P07_cardinality", sql(each_column("SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM raw_reviews", ["author_id", "product_id", *REVIEW_TEXTS]), "raw_reviews"))
def _(spark, d):
    return profile.cardinality(roles.raw_reviews(spark, d), ["author_id", "product_id", *REVIEW_TEXTS])


SKETCHED = "author_id string, product_id string, rating double, skin_tone string"


@query("P07_stored_sketches", sql(each_column(
    "SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, true AS near FROM raw_reviews", ["author_id", "product_id", "rating", "skin_tone"]), "raw_reviews"))
def _(spark, d):
    """Two files arrive one after the other; estimates are held against exact counts, to three standard errors."""
    folder, rows = shared_folder(spark, "arriving"), roles.raw_reviews(spark, d).selectExpr("author_id", "product_id", "cast(rating as double) rating", "skin_tone")
    sketches = FolderSketches(Warehouse(spark, shared_folder(spark, "sketches")), "columns", folder, SKETCHED)
    half = F.xxhash64("author_id") % 2 == 0
    for part in (half, ~half | half.isNull()):
        rows.where(part).write.mode("append").parquet(folder)
        sketches.refresh()
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in rows.columns])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in rows.columns])))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 3 * 1.04 / 2 ** 6 * F.col("exact")
    return sketches.summary().join(F.broadcast(exact), "column").select("column", "rows", "missing", near.alias("near"))


PAIRS_SQL = " UNION ALL ".join(
    [f"SELECT '{c}' AS a, '{c}' AS b, 1.0::DOUBLE AS r" for c in REVIEW_NUMBERS]
    + [f"SELECT '{x}', '{y}', round(corr({a}, {b}), 6) FROM raw_numbers" for a, b in combinations(REVIEW_NUMBERS, 2) for x, y in ((a, b), (b, a))]
)
NUMBERS_SQL = """SELECT rating, helpfulness, TRY_CAST(total_feedback_count AS DOUBLE) AS total_feedback_count, total_neg_feedback_count, total_pos_feedback_count FROM raw_reviews"""


def _review_numbers(spark, d):
    rows = roles.raw_reviews(spark, d)
    return rows.withColumn("total_feedback_count", F.col("total_feedback_count").try_cast("double")).select(*REVIEW_NUMBERS)


@query("P08_correlations", sql(PAIRS_SQL, "raw_reviews", raw_numbers=NUMBERS_SQL))
def _(spark, d):
    return rounded(profile.correlations(_review_numbers(spark, d)))


@query("P08_correlations_with", sql("""
    SELECT 'top' AS side, b AS "column", r FROM (SELECT * FROM pairs WHERE a = 'rating' AND b <> 'rating' ORDER BY r DESC, b LIMIT 3)
    UNION ALL SELECT 'bottom', b, r FROM (SELECT * FROM pairs WHERE a = 'rating' AND b <> 'rating' ORDER BY r, b LIMIT 3)""",
    "raw_reviews", raw_numbers=NUMBERS_SQL, pairs=PAIRS_SQL))
def _(spark, d):
    return rounded(profile.correlations_with(_review_numbers(spark, d), "rating", n=3))


@query("P09_distribution_stats", sql(each_column("""
    SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.99), 6) AS p99 FROM raw_products""", PRODUCT_NUMBERS), "raw_products"))
def _(spark, d):
    return rounded(profile.distribution_stats(roles.raw_products(spark, d), PRODUCT_NUMBERS))


@query("P10_outlier_summary", sql(each_column("""
    SELECT '{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
      (SELECT count(*) FROM raw_products WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM raw_products)""", PRODUCT_NUMBERS), "raw_products"))
def _(spark, d):
    return rounded(profile.outlier_summary(roles.raw_products(spark, d), PRODUCT_NUMBERS))


@query("P11_null_patterns", sql("SELECT " + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in RAW_REVIEW_COLUMNS) + " AS pattern, count(*) AS n FROM raw_reviews GROUP BY 1", "raw_reviews"))
def _(spark, d):
    return profile.null_patterns(roles.raw_reviews(spark, d), RAW_REVIEW_COLUMNS)


# Contracts ---------------------------------------------------------------------------------------


def _wide_reviews(spark, d):
    """Raw reviews with numbers out of range as well as out of type."""
    return roles.raw_reviews(spark, d).withColumn("total_neg_feedback_count", F.col("total_neg_feedback_count") - 1.5)


WIDE_SQL = "SELECT * REPLACE (total_neg_feedback_count - 1.5 AS total_neg_feedback_count) FROM raw_reviews"


def failures(conditions: dict[tuple[str, str], str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{check}' AS "check", count(*) FILTER (WHERE {sql_condition}) AS failures FROM {source}"""
        for (c, check), sql_condition in conditions.items()
    )


RAW_PRODUCT_CHECKS = {
    ("price_usd", "greater_than_or_equal_to(0)"): "price_usd < 0",
    ("rating", "in_range(0, 5)"): "rating NOT BETWEEN 0 AND 5",
    ("loves_count", "greater_than_or_equal_to(0)"): "loves_count < 0",
}
RAW_REVIEW_CHECKS = {
    ("rating", "in_range(1, 5)"): "rating NOT BETWEEN 1 AND 5",
    ("is_recommended", "coerce_dtype(double)"): "is_recommended IS NOT NULL AND TRY_CAST(is_recommended AS DOUBLE) IS NULL",
    ("is_recommended", "isin([0.0, 1.0])"): "TRY_CAST(is_recommended AS DOUBLE) NOT IN (0, 1)",
    ("total_feedback_count", "coerce_dtype(double)"): "total_feedback_count IS NOT NULL AND TRY_CAST(total_feedback_count AS DOUBLE) IS NULL",
    ("total_feedback_count", "greater_than_or_equal_to(0)"): "TRY_CAST(total_feedback_count AS DOUBLE) < 0",
    ("total_neg_feedback_count", "greater_than_or_equal_to(0)"): "total_neg_feedback_count < 0",
    ("total_pos_feedback_count", "greater_than_or_equal_to(0)"): "total_pos_feedback_count < 0",
}
CLEAN_PRODUCT_CHECKS = {
    ("product_id", "not_nullable"): "product_id IS NULL", ("product_name", "not_nullable"): "product_name IS NULL",
    ("price_usd", "not_nullable"): "price_usd IS NULL", ("price_usd", "greater_than(0)"): "NOT price_usd > 0",
    ("price_clp", "not_nullable"): "price_clp IS NULL", ("price_clp", "greater_than(0)"): "NOT price_clp > 0",
    ("rating", "not_nullable"): "rating IS NULL", ("rating", "in_range(0, 5)"): "rating NOT BETWEEN 0 AND 5",
    ("loves_count", "not_nullable"): "loves_count IS NULL", ("loves_count", "greater_than_or_equal_to(0)"): "loves_count < 0",
}
CLEAN_REVIEW_CHECKS = {
    ("author_id", "not_nullable"): "author_id IS NULL",
    ("rating", "not_nullable"): "rating IS NULL", ("rating", "in_range(1, 5)"): "rating NOT BETWEEN 1 AND 5",
    ("is_recommended", "coerce_dtype(double)"): "is_recommended IS NOT NULL AND TRY_CAST(is_recommended AS DOUBLE) IS NULL",
    ("is_recommended", "not_nullable"): "is_recommended IS NULL",
    ("is_recommended", "isin([0.0, 1.0])"): "TRY_CAST(is_recommended AS DOUBLE) NOT IN (0, 1)",
    ("product_id", "not_nullable"): "product_id IS NULL",
}


@query("V01_raw_products", sql(failures(RAW_PRODUCT_CHECKS, "raw_products"), "raw_products"))
def _(spark, d):
    return contracts.RAW_PRODUCTS.summary(roles.raw_products(spark, d))


@query("V02_raw_reviews", sql(failures(RAW_REVIEW_CHECKS, "wide"), "raw_reviews", wide=WIDE_SQL))
def _(spark, d):
    return contracts.RAW_REVIEWS.summary(_wide_reviews(spark, d))


@query("V03_clean_products", sql(failures(CLEAN_PRODUCT_CHECKS, "priced"), "raw_products", priced="SELECT *, price_usd * 950 AS price_clp FROM raw_products"))
def _(spark, d):
    return contracts.CLEAN_PRODUCTS.summary(roles.raw_products(spark, d).withColumn("price_clp", F.col("price_usd") * RATE))


@query("V04_clean_reviews", sql(failures(CLEAN_REVIEW_CHECKS, "raw_reviews"), "raw_reviews"))
def _(spark, d):
    return contracts.CLEAN_REVIEWS.summary(roles.raw_reviews(spark, d))


@query("V05_violations", sql(" UNION ALL ".join(
    f"""SELECT 'Column' AS schema_context, '{c}' AS "column", '{check}' AS "check", CAST({c} AS VARCHAR) AS failure_case FROM wide WHERE {condition}"""
    for (c, check), condition in RAW_REVIEW_CHECKS.items()), "raw_reviews", wide=WIDE_SQL))
def _(spark, d):
    return contracts.RAW_REVIEWS.violations(_wide_reviews(spark, d))


@query("V06_lenient_validation", sql("""
    SELECT 'clean' AS part, TRUE AS valid, count(*) AS n FROM products
    UNION ALL SELECT 'raw', (SELECT count(*) FROM raw_products WHERE price_usd < 0) = 0, count(*) FROM raw_products""", "products", "raw_products"))
def _(spark, d):
    parts = {"clean": roles.products(spark, d), "raw": roles.raw_products(spark, d)}
    rows = []
    for part, df in parts.items():
        kept, valid = contracts.RAW_PRODUCTS.validate(df)
        rows.append(kept.agg(F.lit(part).alias("part"), F.lit(valid).alias("valid"), F.count(F.lit(1)).alias("n")))
    return rows[0].unionByName(rows[1])


@query("V07_missing_columns", """
    SELECT 'DataFrameSchema' AS schema_context, c AS "column", 'column_in_dataframe' AS "check", c AS failure_case
    FROM (VALUES ('brand_name'), ('primary_category')) t(c) WHERE EXISTS (SELECT 1 FROM part)""")
def _(spark, d):
    lacking = roles.products(spark, d).drop("brand_name", "primary_category")
    return contracts.RAW_PRODUCTS.violations(lacking).where("schema_context = 'DataFrameSchema'")
