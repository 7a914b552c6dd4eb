"""Cleaning, filters, joins, keep-first, paging (C, F, J, U, K01-K04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight.functions import numbers, text
from shelfsight.operators import clean, relate, reports
from shelfsight.schemas import CSV_NULL_TOKENS, PRODUCT_SCHEMA, REVIEW_SCHEMA
from shelfsight.session import shared_folder
from shelfsight.sources.keys import KeySet
from shelfsight.sources.tables import Warehouse
from shelfsight.workload import roles
from shelfsight.workload.registry import query
from shelfsight.workload.roles import RATE, REVIEW_ORDER, sql

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"
KEYS = KEY.split(", ")


@query("C01_simple_names", 'SELECT p_partkey AS part_key, p_name AS product_name FROM part')
def _(spark, d):
    part = roles.table(spark, d, "part").select(F.col("p_partkey").alias(" Part Key "), F.col("p_name").alias("Product Name"))
    return clean.rename_simple(part)


@query("C02_full_names", "SELECT p_partkey AS part_key_, p_retailprice AS price_usd_net FROM part")
def _(spark, d):
    part = roles.table(spark, d, "part").select(F.col("p_partkey").alias(" Part  Key#"), F.col("p_retailprice").alias("Price (USD) / net"))
    return clean.rename_full(part)


@query("C03_drop_columns", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def _(spark, d):
    return clean.drop_columns(roles.table(spark, d, "part"), ["p_size", "p_retailprice", "no_such_column"])


@query("C04_rename_joined", sql(f"""
    SELECT {KEY}, r.product_id, r.rating, p.product_name, p.brand_name, p.price_usd
    FROM reviews r LEFT JOIN products p ON r.product_id = p.product_id""", "reviews", "products"))
def _(spark, d):
    reviews = roles.reviews(spark, d).select(*KEYS, "product_id", "rating")
    joined = relate.reviews_with_products(reviews, roles.products(spark, d))
    return clean.rename_joined(joined).select(*KEYS, "product_id", "rating", "product_name", "brand_name", "price_usd")


@query("C05_clean_text", sql("""
    SELECT product_id, listing, nullif(nullif(nullif(trim(product_name, ' ' || chr(10)), 'nan'), 'None'), '') AS product_name,
      nullif(nullif(nullif(trim(brand_name), 'nan'), 'None'), '') AS brand_name, nullif(primary_category, '') AS primary_category
    FROM raw_products""", "raw_products"))
def _(spark, d):
    return clean.clean_text_columns(roles.raw_products(spark, d)).select(
        "product_id", "listing", "product_name", "brand_name", "primary_category")


@query("C06_unknown_to_null", sql(f"""
    SELECT {KEY}, CASE WHEN NOT regexp_full_match(skin_tone, '(?i)\\s*unknown\\s*') THEN skin_tone END AS skin_tone FROM raw_reviews""",
    "raw_reviews"))
def _(spark, d):
    return clean.unknown_to_null(roles.raw_reviews(spark, d), ["skin_tone"]).select(*KEYS, "skin_tone")


@query("C07_demographics", sql(f"""
    SELECT {KEY}, {', '.join(f"CASE WHEN lower(trim({c})) NOT IN ('nan', 'none', 'unknown', '') THEN lower(trim({c})) END AS {c}"
                             for c in ("skin_tone", "eye_color", "skin_type", "hair_color"))}
    FROM raw_reviews""", "raw_reviews"))
def _(spark, d):
    return clean.clean_demographics(roles.raw_reviews(spark, d)).select(*KEYS, "skin_tone", "eye_color", "skin_type", "hair_color")


@query("C08_review_text", sql(f"""
    SELECT {KEY}, nullif(nullif(nullif(trim(review_text, ' ' || chr(10)), 'nan'), 'None'), '') AS review_text FROM raw_reviews""",
    "raw_reviews"))
def _(spark, d):
    return clean.clean_text_columns(roles.raw_reviews(spark, d), ["review_text"]).select(*KEYS, "review_text")


@query("C09_plain_words", r"""
    SELECT doc_id, regexp_replace(regexp_replace(trim(lower(text), ' ' || chr(9) || chr(10) || chr(13)), '\s+', ' ', 'g'), '[^a-z0-9\s]', '', 'g') AS words
    FROM documents""")
def _(spark, d):
    return roles.table(spark, d, "documents").select("doc_id", text.plain_words(F.col("text")).alias("words"))


@query("C10_price_text", """
    SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice * 10 END AS price FROM part""")
def _(spark, d):
    part = roles.table(spark, d, "part")
    shown = F.when(F.col("p_partkey") % 7 == 0, "on request").otherwise(
        F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") * 10, 2)))
    return part.select("p_partkey", F.round(numbers.parse_price(shown), 2).alias("price"))


@query("C11_numbers", sql(f"""
    SELECT {KEY}, TRY_CAST(is_recommended AS DOUBLE) AS is_recommended, coalesce(TRY_CAST(total_feedback_count AS DOUBLE), 0) AS total_feedback_count,
      coalesce(total_neg_feedback_count, 0) AS total_neg_feedback_count, total_pos_feedback_count FROM raw_reviews""", "raw_reviews"))
def _(spark, d):
    rows = clean.coerce_numbers(roles.raw_reviews(spark, d), ["is_recommended"])
    return clean.fill_feedback(rows).select(
        *KEYS, "is_recommended", "total_feedback_count", "total_neg_feedback_count", "total_pos_feedback_count")


@query("C12_product_type", """
    SELECT p_partkey, trim(replace(coalesce(CASE WHEN p_partkey % 11 <> 0 THEN ' ' || p_type || chr(10) || ' line ' END, 'Unknown'), chr(10), '')) AS product_type
    FROM part""")
def _(spark, d):
    raw = F.when(F.col("p_partkey") % 11 != 0, F.concat(F.lit(" "), "p_type", F.lit("\n"), F.lit(" line ")))
    return roles.table(spark, d, "part").select("p_partkey", text.clean_product_type(raw).alias("product_type"))


CATALOG = """
    SELECT doc_id AS id, source AS brand, lang AS product_type, CAST(n_chars AS DOUBLE) AS rating, text AS description,
      CASE WHEN doc_id % 3 <> 0 THEN 'i' END AS img, CASE WHEN doc_id % 4 = 0 THEN 's' END AS shade_img, 1 AS dupes, 2 AS price_site
    FROM documents"""


def _catalog(spark, d):
    return roles.table(spark, d, "documents").select(
        F.col("doc_id").alias("ID"), F.col("source").alias(" Brand"), F.col("lang").alias("Product_Type"),
        F.col("n_chars").cast("double").alias("rating"), F.col("text").alias("description"),
        F.when(F.col("doc_id") % 3 != 0, "i").alias("img"), F.when(F.col("doc_id") % 4 == 0, "s").alias("shade_img"),
        F.lit(1).alias("dupes"), F.lit(2).alias("price_site"),
    )


@query("C13_catalog_columns", f"""
    SELECT id, length(description) AS description_length, img IS NOT NULL AS has_image, shade_img IS NOT NULL AS has_shade_image
    FROM ({CATALOG})""")
def _(spark, d):
    return clean.add_catalog_columns(_catalog(spark, d)).select(
        F.col("ID").alias("id"), F.col("description_length").cast("bigint").alias("description_length"), "has_image", "has_shade_image")


@query("C14_clean_catalog", f"""
    SELECT id, brand, coalesce(product_type, 'Unknown') AS product_type, description, img, shade_img, length(description) AS description_length,
      img IS NOT NULL AS has_image, shade_img IS NOT NULL AS has_shade_image FROM ({CATALOG})""")
def _(spark, d):
    return clean.clean_catalog(_catalog(spark, d)).withColumn("description_length", F.col("description_length").cast("bigint"))


@query("C15_local_price", "SELECT p_partkey, round_even(p_retailprice * 950, 0) AS price_clp FROM part")
def _(spark, d):
    return roles.table(spark, d, "part").select("p_partkey", numbers.convert(F.col("p_retailprice"), F.lit(RATE)).alias("price_clp"))


@query("C16_scorer_text", "SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS scorer_text FROM documents")
def _(spark, d):
    return roles.table(spark, d, "documents").select("doc_id", text.scorer_text(F.col("text")).alias("scorer_text"))


def _response():
    key = F.col("doc_id")
    return F.when(key % 9 == 0, "no json at all").otherwise(F.concat(
        F.lit('{"label": "'), F.when(key % 7 == 0, "angry").when(key % 2 == 0, "Positive").otherwise("negative"),
        F.lit('", "score": '), (key % 1000 / 1000).cast("string"), F.lit("}")))


@query("C17_parse_score", """
    SELECT doc_id, CASE WHEN doc_id % 9 = 0 OR doc_id % 7 = 0 THEN 'unknown' WHEN doc_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS label,
      CASE WHEN doc_id % 9 = 0 THEN 0.0::DOUBLE ELSE round((doc_id % 1000) / 1000.0::DOUBLE, 4) END AS score FROM documents""")
def _(spark, d):
    rows = roles.table(spark, d, "documents").select("doc_id", text.parse_score(_response()).alias("s"))
    return rows.select("doc_id", "s.label", "s.score")


@query("C18_narrow_types", """
    SELECT 'l_orderkey' AS "column", 'bigint' AS from_type, CASE WHEN max(l_orderkey) <= 127 THEN 'tinyint' WHEN max(l_orderkey) <= 32767 THEN 'smallint' ELSE 'int' END AS to_type, CAST(NULL AS BIGINT) AS distinct_values, FALSE AS category FROM lineitem
    UNION ALL SELECT 'l_linenumber', 'int', 'tinyint', NULL, FALSE
    UNION ALL SELECT 'l_quantity', 'double', 'float', NULL, FALSE
    UNION ALL SELECT 'l_returnflag', 'string', 'string', count(DISTINCT l_returnflag), count(DISTINCT l_returnflag) < 0.5 * count(*) FROM lineitem""")
def _(spark, d):
    line = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return clean.narrow_types(line)[1]


@query("C18_narrow_folder", """
    SELECT 'l_linenumber' AS "column", 'bigint' AS from_type, 'tinyint' AS to_type, CAST(NULL AS BIGINT) AS distinct_values, FALSE AS category
    UNION ALL SELECT 'l_quantity', 'double', 'float', NULL, FALSE
    UNION ALL SELECT 'l_returnflag', 'string', 'string', count(DISTINCT l_returnflag), count(DISTINCT l_returnflag) < 0.5 * count(*) FROM lineitem""")
def _(spark, d):
    from shelfsight.session import shared_folder
    from shelfsight.sources import csv, tables

    folder = shared_folder(spark, "narrow")
    line = roles.table(spark, d, "lineitem").select("l_linenumber", "l_quantity", "l_returnflag")
    tables.export_csv(line.where("l_linenumber <= 3"), f"{folder}/a.csv")
    tables.export_csv(line.where("l_linenumber > 3").select("l_returnflag", "l_quantity", "l_linenumber"), f"{folder}/b.csv")
    return csv.read_narrow(spark, folder)[1]


@query("C19_display", sql("""
    SELECT sentiment, CASE sentiment WHEN 'positive' THEN 'Positivo' WHEN 'negative' THEN 'Negativo' WHEN 'neutral' THEN 'Neutral' END AS shown,
      CASE WHEN sentiment = 'positive' THEN '★' ELSE '' END AS best, '$' || format('{:,}', CAST(sum(n_chars) AS BIGINT)) AS amount
    FROM (SELECT s.*, n_chars FROM sentiment s JOIN documents USING (doc_id)) GROUP BY sentiment""", "sentiment"))
def _(spark, d):
    rows = roles.sentiment(spark, d).join(roles.table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.groupBy("sentiment").agg(F.sum("n_chars").alias("chars")).select(
        "sentiment", text.display_label(F.col("sentiment")).alias("shown"),
        text.best_flag(F.col("sentiment") == "positive").alias("best"), text.money(F.col("chars")).alias("amount"))


def _served_sql(schema, have: dict[str, str], source: str) -> str:
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}
    cols = ", ".join(f'CAST({have.get(f.name, "NULL")} AS {kinds[f.dataType.simpleString()]}) AS "{f.name}"' for f in schema)
    return f"SELECT {cols} FROM {source}"


@query("C20_served_products", sql(_served_sql(
    PRODUCT_SCHEMA, {c: c for c in ("product_id", "product_name", "brand_name", "loves_count", "rating", "price_usd", "primary_category")}
    | {"price_clp": "round_even(price_usd * 950, 0)"}, "products"), "products"))
def _(spark, d):
    return clean.served_products(roles.products(spark, d).withColumn("price_clp", numbers.convert(F.col("price_usd"), F.lit(RATE))))


@query("C20_served_reviews", sql(_served_sql(
    REVIEW_SCHEMA, {f.name: f.name for f in REVIEW_SCHEMA if f.name not in ("product_name", "brand_name", "price_usd")}, "reviews"), "reviews"))
def _(spark, d):
    return clean.served_reviews(roles.reviews(spark, d))


# Filters -----------------------------------------------------------------------------------------


@query("F01_with_keys", sql(f"SELECT {KEY}, author_id, product_id FROM raw_reviews WHERE author_id IS NOT NULL AND product_id IS NOT NULL", "raw_reviews"))
def _(spark, d):
    return clean.with_keys(roles.raw_reviews(spark, d)).select(*KEYS, "author_id", "product_id")


@query("F02_with_label", sql(f"""
    SELECT {KEY}, CAST(is_recommended AS DOUBLE) AS is_recommended FROM raw_reviews WHERE TRY_CAST(is_recommended AS DOUBLE) IS NOT NULL""", "raw_reviews"))
def _(spark, d):
    return clean.with_label(roles.raw_reviews(spark, d)).select(*KEYS, "is_recommended")


@query("F03_rating_range", sql(f"""
    SELECT {KEY}, rating FROM (SELECT * REPLACE (coalesce(rating, (SELECT quantile_cont(rating, 0.5) FROM raw_reviews)) AS rating) FROM raw_reviews)
    WHERE rating BETWEEN 1 AND 5""", "raw_reviews"))
def _(spark, d):
    from shelfsight.operators.quantiles import exact_quantiles

    rows = roles.raw_reviews(spark, d)
    return clean.rating_in_range(rows, exact_quantiles(rows, ["rating"], [0.5])["rating"][0]).select(*KEYS, "rating")


@query("F04_positive_price", sql("SELECT product_id, listing, price_usd FROM raw_products WHERE price_usd > 0", "raw_products"))
def _(spark, d):
    return clean.positive_price(roles.raw_products(spark, d)).select("product_id", "listing", "price_usd")


@query("F05_known_sentiment", sql("""
    SELECT doc_id, sentiment, coalesce(TRY_CAST(sentiment_score AS DOUBLE), 0.0) AS sentiment_score, is_recommended
    FROM raw_sentiment WHERE sentiment <> 'unknown'""", "raw_sentiment"))
def _(spark, d):
    return clean.known_sentiment(roles.raw_sentiment(spark, d)).select("doc_id", "sentiment", "sentiment_score", "is_recommended")


@query("F06_valid_text", sql(f"""
    SELECT {KEY}, review_text FROM raw_reviews WHERE length(trim(review_text, ' ' || chr(10))) > 10""", "raw_reviews"))
def _(spark, d):
    return clean.with_valid_text(roles.raw_reviews(spark, d)).select(*KEYS, "review_text")


@query("F07_find_products", sql("""
    SELECT * FROM products WHERE lower(primary_category) = 'economy' AND lower(brand_name) = 'brand#7' AND price_usd >= 910 AND price_usd <= 990""", "products"))
def _(spark, d):
    return clean.find_products(roles.products(spark, d), category="Economy", brand="BRAND#7", min_price=910, max_price=990)


@query("F08_product_by_id", sql("SELECT * FROM products WHERE product_id = '17'", "products"))
def _(spark, d):
    return clean.product_by_id(roles.products(spark, d), "17")


@query("F09_find_reviews", sql(f"""
    SELECT {KEY}, author_id, product_id, rating, is_recommended FROM reviews WHERE product_id = '17' AND rating >= 3 AND is_recommended = 1""", "reviews"))
def _(spark, d):
    found = clean.find_reviews(roles.reviews(spark, d), product_id="17", min_rating=3, is_recommended=1)
    return found.select(*KEYS, "author_id", "product_id", "rating", "is_recommended")


@query("F10_catalog_slice", sql("""
    SELECT * FROM products WHERE primary_category = 'ECONOMY' AND brand_name = 'Brand#2' AND price_usd >= 905 AND price_usd <= 995""", "products"))
def _(spark, d):
    return clean.catalog_slice(roles.products(spark, d), "ECONOMY", "Brand#2", 905, 995)


@query("F10_brand_choices", sql("SELECT DISTINCT brand_name FROM products WHERE primary_category = 'ECONOMY'", "products"))
def _(spark, d):
    return clean.brand_choices(roles.products(spark, d), "ECONOMY")


@query("F11_checked_page", sql("SELECT * FROM products WHERE price_usd >= 950 ORDER BY product_id LIMIT 500", "products"))
def _(spark, d):
    return relate.page(clean.find_products(roles.products(spark, d), min_price=950), ["product_id"], limit=500)


# Joins, unions, keep-first, paging ---------------------------------------------------------------


@query("J01_reviews_with_products", sql(f"""
    SELECT {KEY}, r.product_id, r.rating AS rating_x, p.rating AS rating_y, p.product_name, p.brand_name, p.price_usd, p.loves_count
    FROM reviews r LEFT JOIN products p ON r.product_id = p.product_id""", "reviews", "products"))
def _(spark, d):
    reviews = roles.reviews(spark, d).select(*KEYS, "product_id", "rating")
    return relate.reviews_with_products(reviews, roles.products(spark, d)).drop("primary_category")


@query("J02_not_in_cache", sql(f"""
    SELECT {KEY}, author_id FROM raw_reviews WHERE author_id IS NULL OR author_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 4000)""",
    "raw_reviews"))
def _(spark, d):
    cache = roles.table(spark, d, "customer").where("c_acctbal > 4000").select(F.col("c_custkey").alias("author_id"))
    return relate.not_in_cache(roles.raw_reviews(spark, d).select(*KEYS, "author_id"), cache)


@query("J02_not_in_key_set", sql(f"""
    SELECT {KEY}, author_id FROM raw_reviews WHERE author_id IS NULL OR author_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 2000)""",
    "raw_reviews"))
def _(spark, d):
    held = KeySet(Warehouse(spark, shared_folder(spark, "key-set")), "known")
    for more in ("c_acctbal > 4000", "c_acctbal > 2000"):
        held.add(roles.table(spark, d, "customer").where(more), "c_custkey")
    return held.missing(roles.raw_reviews(spark, d).select(*KEYS, "author_id"), "author_id")


@query("J03_with_rate", sql("SELECT product_id, price_usd, (SELECT arg_max(rate, loaded_at) FROM rates) AS rate FROM products", "products", "rates"))
def _(spark, d):
    return relate.with_rate(roles.products(spark, d).select("product_id", "price_usd"), roles.rates(spark, d))


@query("J04_label_beside_cluster", "SELECT vec_id, label % 3 AS cluster, label FROM embeddings")
def _(spark, d):
    rows = roles.table(spark, d, "embeddings")
    assigned = rows.select("vec_id", (F.col("label") % 3).alias("cluster"))
    return relate.attach(rows.select("vec_id", "label"), assigned, "vec_id", ["cluster"])


@query("J05_compare_manifests", """
    SELECT coalesce(a.file, b.file) AS file, a.sha256, b.saved_sha256,
      CASE WHEN b.saved_sha256 IS NULL THEN 'new' WHEN a.sha256 IS NULL THEN 'gone' WHEN a.sha256 <> b.saved_sha256 THEN 'changed' ELSE 'ok' END AS status
    FROM (SELECT CAST(page_id AS VARCHAR) AS file, sha256(html) AS sha256 FROM pages) a
    FULL JOIN (SELECT CASE WHEN page_id % 9 = 0 THEN 'old ' ELSE '' END || CAST(page_id AS VARCHAR) AS file,
      sha256(html || CASE WHEN page_id % 4 = 0 THEN ' ' ELSE '' END) AS saved_sha256 FROM pages) b ON a.file = b.file""")
def _(spark, d):
    pages = roles.table(spark, d, "pages")
    name = F.col("page_id").cast("string")
    now = pages.select(name.alias("file"), F.sha2("html", 256).alias("sha256"))
    before = F.concat("html", F.when(F.col("page_id") % 4 == 0, " ").otherwise(""))
    renamed = F.concat(F.when(F.col("page_id") % 9 == 0, "old ").otherwise(""), name)
    return relate.compare_manifests(now, pages.select(renamed.alias("file"), F.sha2(before, 256).alias("sha256")))


@query("U01_union_by_name", """
    SELECT CAST(c_custkey AS VARCHAR) AS author_id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS nation FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, s_nationkey FROM supplier""")
def _(spark, d):
    customers = roles.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("author_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = roles.table(spark, d, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("author_id"))
    return relate.union_by_name([customers, suppliers])


@query("K01_keep_first_product", sql("SELECT product_id, listing, product_name, price_usd FROM raw_products QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY listing) = 1", "raw_products"))
def _(spark, d):
    return relate.keep_first(roles.raw_products(spark, d), ["product_id"], ["listing"]).select("product_id", "listing", "product_name", "price_usd")


@query("K01_keep_first_review", sql(f"""
    SELECT author_id, product_id, {', '.join(REVIEW_ORDER[:-1])} FROM raw_reviews
    QUALIFY row_number() OVER (PARTITION BY author_id, product_id ORDER BY {', '.join(REVIEW_ORDER)}) = 1""", "raw_reviews"))
def _(spark, d):
    rows = roles.raw_reviews(spark, d).select("author_id", "product_id", *REVIEW_ORDER)
    return relate.keep_first(rows, ["author_id", "product_id"], REVIEW_ORDER).drop("l_shipdate")


@query("K02_page", sql("SELECT * FROM products ORDER BY product_id LIMIT 50 OFFSET 100", "products"))
def _(spark, d):
    return relate.page(roles.products(spark, d), ["product_id"], limit=50, offset=100)


@query("K02_deep_page", "SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50 OFFSET 30000")
def _(spark, d):
    return relate.page(roles.table(spark, d, "lineitem"), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], limit=50, offset=30_000)


@query("K02_page_after", """
    SELECT * FROM orders WHERE (o_orderdate, o_orderkey) > (SELECT (o_orderdate, o_orderkey) FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1 OFFSET 999)
    ORDER BY o_orderdate, o_orderkey LIMIT 50""")
def _(spark, d):
    orders, order = roles.table(spark, d, "orders"), ["o_orderdate", "o_orderkey"]
    last = relate.page(orders, order, limit=1, offset=999).select(*order).first()
    return relate.page_after(orders, order, last, limit=50)


@query("K03_most_loved", sql("""
    SELECT product_name, brand_name, primary_category, price_usd, rating, loves_count FROM products ORDER BY loves_count DESC NULLS LAST, product_id LIMIT 100""", "products"))
def _(spark, d):
    return relate.most_loved(roles.products(spark, d))


SEARCH_SQL = """
    SELECT CAST(l_tax AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS params, l_tax AS learning_rate, l_linenumber AS max_depth,
      round(avg(is_recommended), 6) AS mean_score, round(stddev_samp(is_recommended), 6) AS std_score FROM reviews GROUP BY ALL"""


def search_results(spark, d):
    """Scores per setting, in the form a search leaves them."""
    return roles.reviews(spark, d).groupBy(F.col("l_tax").alias("learning_rate"), F.col("l_linenumber").alias("max_depth")).agg(
        F.round(F.avg("is_recommended"), 6).alias("mean_score"), F.round(F.stddev_samp("is_recommended"), 6).alias("std_score"),
    ).withColumn("params", F.concat(F.col("learning_rate").cast("string"), F.lit("/"), F.col("max_depth").cast("string")))


@query("K04_top_results", sql("SELECT params, mean_score, std_score FROM found ORDER BY mean_score DESC, params LIMIT 15", "reviews", found=SEARCH_SQL))
def _(spark, d):
    from shelfsight.operators.models import top_results

    return top_results(search_results(spark, d))


@query("A14_score_pivot", sql("""
    SELECT learning_rate, """ + ", ".join(f'round(avg(mean_score) FILTER (WHERE max_depth = {k}), 6) AS "{k}"' for k in range(1, 8)) + """
    FROM found GROUP BY learning_rate""", "reviews", found=SEARCH_SQL))
def _(spark, d):
    pivot = reports.score_pivot(search_results(spark, d), "learning_rate", "max_depth", "mean_score", range(1, 8))
    return pivot.select("learning_rate", *[F.round(str(k), 6).alias(str(k)) for k in range(1, 8)])
