"""The given tables in the roles of catalog, reviews, sentiment and rates.

``raw_*`` add the defects the cleaning steps exist for, as expressions of the keys. Each role has a
twin in SQL; a query's SQL is put together from the twins it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATE = 950.0
REVIEW_ORDER = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part; loves are the quantities sold."""
    loves = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("loves_count"))
    part = table(spark, folder, "part")
    return part.join(loves, part["p_partkey"] == loves["l_partkey"], "left").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand_name"), F.col("p_type").alias("primary_category"),
        F.col("p_retailprice").alias("price_usd"), (F.col("p_size") % 5 + 1).cast("double").alias("rating"), "loves_count",
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (part, supplier) listing, so products repeat; with gaps, junk and extremes."""
    sold = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("sold"))
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    listed = part.join(sold, part["p_partkey"] == sold["l_partkey"], "left")
    return listed.select(
        key.cast("string").alias("product_id"),
        F.coalesce("l_suppkey", F.lit(-1).cast("bigint")).alias("listing"),
        F.when(key % 41 == 0, "nan").when(key % 5 == 0, F.concat(F.lit("  "), "p_name", F.lit("\n"))).otherwise(F.col("p_name")).alias("product_name"),
        F.when(key % 53 == 0, "None").otherwise(F.concat("p_brand", F.lit(" "))).alias("brand_name"),
        F.when(key % 97 == 0, -F.col("p_retailprice")).when(key % 31 == 0, None).when(key % 89 == 0, F.col("p_retailprice") * 10)
        .otherwise(F.col("p_retailprice") + F.coalesce("l_suppkey", F.lit(0)) % 7).alias("price_usd"),
        F.when(key % 29 != 0, (F.col("p_size") % 5 + 1).cast("double")).alias("rating"),
        F.when(key % 37 != 0, F.col("sold")).alias("loves_count"),
        F.when(key % 47 == 0, "").otherwise(F.col("p_type")).alias("primary_category"),
    )


def review_lines(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    """Order lines with their order and buyer.

    The buyers join the orders, so that the many lines are shuffled once. ``key`` names a digest of ``REVIEW_ORDER``,
    which is made before that, so that it moves in their place.
    """
    line, orders, customer = (table(spark, folder, t) for t in ("lineitem", "orders", "customer"))
    if key:
        line = line.withColumn(key, F.md5(F.concat_ws("|", *REVIEW_ORDER)))
    buyers = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    return line.join(buyers, line["l_orderkey"] == buyers["o_orderkey"])


def reviews(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    """One row per order line; the buyer is the author. ``key`` as in :func:`review_lines`."""
    quantity = F.col("l_quantity").cast("int")
    return review_lines(spark, folder, key).select(
        F.col("o_custkey").cast("string").alias("author_id"), F.col("l_partkey").cast("string").alias("product_id"),
        (quantity % 5 + 1).cast("double").alias("rating"),
        F.when(F.col("l_returnflag") == "R", 0.0).otherwise(1.0).alias("is_recommended"),
        F.when(F.col("l_tax") != 0, F.col("l_discount") * 10).alias("helpfulness"),
        (quantity * F.col("l_linenumber")).cast("double").alias("total_feedback_count"),
        F.col("l_linenumber").cast("double").alias("total_neg_feedback_count"),
        (quantity * F.col("l_linenumber") - F.col("l_linenumber")).cast("double").alias("total_pos_feedback_count"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("submission_time"),
        F.concat("o_orderpriority", F.lit(" "), "l_linestatus").alias("review_text"),
        F.col("o_orderstatus").alias("review_title"), F.concat(F.lit("tone "), (F.col("c_nationkey") % 4).cast("string")).alias("skin_tone"),
        F.col("l_linestatus").alias("eye_color"), F.col("c_mktsegment").alias("skin_type"),
        F.col("o_orderpriority").alias("hair_color"), *REVIEW_ORDER, *([key] if key else []),
    )


def raw_reviews(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    plain = reviews(spark, folder, key)
    return plain.withColumns({
        "author_id": F.when(order % 101 != 0, F.col("author_id")),
        "product_id": F.when(order % 103 != 0, F.col("product_id")),
        "rating": F.when((F.col("l_linenumber") == 7) & (order % 3 == 0), None).when(order % 71 == 0, 9.0).otherwise(F.col("rating")),
        "is_recommended": F.when(order % 13 == 0, "n/a").when(F.col("l_returnflag") == "R", "0").otherwise("1"),
        "total_feedback_count": F.when(supplier % 17 == 0, "?").otherwise(F.col("total_feedback_count").cast("string")),
        "total_neg_feedback_count": F.when(supplier % 17 != 0, F.col("total_neg_feedback_count")),
        "review_text": F.when(supplier % 19 == 0, "nan").when(supplier % 19 == 1, "   ")
        .otherwise(F.concat(F.lit("  "), "review_text", F.lit("\n"))),
        "skin_tone": F.when(supplier % 11 == 0, " Unknown ").otherwise(F.upper("skin_tone")),
        "eye_color": F.when(F.col("eye_color") == "O", " Brown").otherwise("BLUE "),
        "hair_color": F.when(order % 23 == 0, "None").otherwise(F.col("hair_color")),
    })


def document_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document; its quality label, if it has one, is the recommendation."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("author_id"), F.col("text").alias("review_text"),
        F.col("quality").alias("is_recommended"), "quality", "toxic", "lang", "source", "n_chars",
    )


def raw_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment told by the labels; unlabelled documents are unknown."""
    rows = document_reviews(spark, folder)
    label = (
        F.when(F.col("quality").isNull(), "unknown").when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive").otherwise("neutral")
    )
    return rows.select(
        "doc_id", "author_id", "review_text", F.col("is_recommended").cast("double").alias("is_recommended"),
        label.alias("sentiment"),
        F.when(F.col("doc_id") % 17 == 0, "?").otherwise(((F.col("doc_id") % 100) / 100).cast("string")).alias("sentiment_score"),
    )


def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return raw_sentiment(spark, folder).withColumn("sentiment_score", F.coalesce(F.col("sentiment_score").try_cast("double"), F.lit(0.0)))


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """One rate per day of events."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("date")
    daily = table(spark, folder, "events").groupBy(day).agg(F.round(F.avg("value"), 4).alias("rate"))
    return daily.select("date", "rate", F.lit("api").alias("source"), F.concat("date", F.lit("T06:00:00")).alias("loaded_at"))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """A deterministic classifier's output: label, score, prediction, for two models."""
    base = reviews(spark, folder).select(
        F.col("is_recommended").alias("label"),
        ((F.col("l_partkey") % 89 + F.col("is_recommended") * 40 + F.col("l_suppkey") % 7) / 150).alias("first"),
        ((F.col("l_partkey") % 53 + F.col("is_recommended") * 20) / 100).alias("second"),
    )
    return base.select("label", F.inline(F.array(
        F.struct(F.lit("first").alias("model"), F.col("first").alias("score")),
        F.struct(F.lit("second").alias("model"), F.col("second").alias("score")),
    ))).withColumn("prediction", (F.col("score") >= 0.4).cast("double"))


# The twins in SQL. Each names the twins it is built on.
SQL = {
    "products": ((), """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS brand_name,
               p_type AS primary_category, p_retailprice AS price_usd, CAST(p_size % 5 + 1 AS DOUBLE) AS rating, loves_count
        FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS loves_count FROM lineitem GROUP BY l_partkey)
          ON p_partkey = l_partkey"""),
    "raw_products": ((), r"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, coalesce(l_suppkey, -1) AS listing,
          CASE WHEN p_partkey % 41 = 0 THEN 'nan' WHEN p_partkey % 5 = 0 THEN '  ' || p_name || chr(10) ELSE p_name END AS product_name,
          CASE WHEN p_partkey % 53 = 0 THEN 'None' ELSE p_brand || ' ' END AS brand_name,
          CASE WHEN p_partkey % 97 = 0 THEN -p_retailprice WHEN p_partkey % 31 = 0 THEN NULL
               WHEN p_partkey % 89 = 0 THEN p_retailprice * 10 ELSE p_retailprice + coalesce(l_suppkey, 0) % 7 END AS price_usd,
          CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_size % 5 + 1 AS DOUBLE) END AS rating,
          CASE WHEN p_partkey % 37 <> 0 THEN sold END AS loves_count,
          CASE WHEN p_partkey % 47 = 0 THEN '' ELSE p_type END AS primary_category
        FROM part LEFT JOIN (SELECT l_partkey, l_suppkey, sum(l_quantity) AS sold FROM lineitem GROUP BY l_partkey, l_suppkey)
          ON p_partkey = l_partkey"""),
    "reviews": ((), """
        SELECT CAST(o_custkey AS VARCHAR) AS author_id, CAST(l_partkey AS VARCHAR) AS product_id,
          CAST(CAST(l_quantity AS INT) % 5 + 1 AS DOUBLE) AS rating,
          CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS is_recommended,
          CASE WHEN l_tax <> 0 THEN l_discount * 10 END AS helpfulness,
          CAST(CAST(l_quantity AS INT) * l_linenumber AS DOUBLE) AS total_feedback_count,
          CAST(l_linenumber AS DOUBLE) AS total_neg_feedback_count,
          CAST(CAST(l_quantity AS INT) * l_linenumber - l_linenumber AS DOUBLE) AS total_pos_feedback_count,
          strftime(l_shipdate, '%Y-%m-%d') AS submission_time, o_orderpriority || ' ' || l_linestatus AS review_text,
          o_orderstatus AS review_title, 'tone ' || CAST(c_nationkey % 4 AS VARCHAR) AS skin_tone, l_linestatus AS eye_color,
          c_mktsegment AS skin_type, o_orderpriority AS hair_color, lineitem.*
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""),
    "raw_reviews": (("reviews",), """
        SELECT * REPLACE (
          CASE WHEN l_orderkey % 101 <> 0 THEN author_id END AS author_id,
          CASE WHEN l_orderkey % 103 <> 0 THEN product_id END AS product_id,
          CASE WHEN l_linenumber = 7 AND l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 71 = 0 THEN 9.0::DOUBLE ELSE rating END AS rating,
          CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' WHEN l_returnflag = 'R' THEN '0' ELSE '1' END AS is_recommended,
          CASE WHEN l_suppkey % 17 = 0 THEN '?' ELSE CAST(total_feedback_count AS VARCHAR) END AS total_feedback_count,
          CASE WHEN l_suppkey % 17 <> 0 THEN total_neg_feedback_count END AS total_neg_feedback_count,
          CASE WHEN l_suppkey % 19 = 0 THEN 'nan' WHEN l_suppkey % 19 = 1 THEN '   ' ELSE '  ' || review_text || chr(10) END AS review_text,
          CASE WHEN l_suppkey % 11 = 0 THEN ' Unknown ' ELSE upper(skin_tone) END AS skin_tone,
          CASE WHEN eye_color = 'O' THEN ' Brown' ELSE 'BLUE ' END AS eye_color,
          CASE WHEN l_orderkey % 23 = 0 THEN 'None' ELSE hair_color END AS hair_color)
        FROM reviews"""),
    "document_reviews": ((), """
        SELECT d.doc_id, 'a' || CAST(d.doc_id AS VARCHAR) AS author_id, text AS review_text, quality AS is_recommended,
               quality, toxic, lang, source, n_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "raw_sentiment": (("document_reviews",), """
        SELECT doc_id, author_id, review_text, CAST(is_recommended AS DOUBLE) AS is_recommended,
          CASE WHEN quality IS NULL THEN 'unknown' WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
          CASE WHEN doc_id % 17 = 0 THEN '?' ELSE CAST((doc_id % 100) / 100.0::DOUBLE AS VARCHAR) END AS sentiment_score
        FROM document_reviews"""),
    "sentiment": (("raw_sentiment",), """
        SELECT * REPLACE (coalesce(TRY_CAST(sentiment_score AS DOUBLE), 0.0::DOUBLE) AS sentiment_score) FROM raw_sentiment"""),
    "rates": ((), """
        SELECT strftime(ts, '%Y-%m-%d') AS date, round(avg(value), 4) AS rate, 'api' AS source,
               strftime(ts, '%Y-%m-%d') || 'T06:00:00' AS loaded_at
        FROM events GROUP BY ALL"""),
    "scores": (("reviews",), """
        SELECT model, label, score, CASE WHEN score >= 0.4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM (
          SELECT 'first' AS model, is_recommended AS label, (l_partkey % 89 + is_recommended * 40 + l_suppkey % 7) / 150 AS score FROM reviews
          UNION ALL
          SELECT 'second', is_recommended, (l_partkey % 53 + is_recommended * 20) / 100 FROM reviews)"""),
    # Cleaned tables, step by step as the cleaning is defined.
    "product_first": (("raw_products",), """
        SELECT product_id, listing, nullif(nullif(nullif(trim(product_name, ' ' || chr(10)), 'nan'), 'None'), '') AS product_name,
          nullif(nullif(nullif(trim(brand_name), 'nan'), 'None'), '') AS brand_name, price_usd, rating, loves_count,
          nullif(primary_category, '') AS primary_category
        FROM raw_products QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY listing) = 1"""),
    "product_filled": (("product_first",), """
        SELECT * REPLACE (coalesce(price_usd, (SELECT quantile_cont(price_usd, 0.5) FROM product_first)) AS price_usd,
          coalesce(rating, (SELECT quantile_cont(rating, 0.5) FROM product_first)) AS rating,
          coalesce(loves_count, 0) AS loves_count) FROM product_first"""),
    "product_fences": (("product_filled",), """
        SELECT quantile_cont(price_usd, 0.25) AS p1, quantile_cont(price_usd, 0.75) AS p3,
               quantile_cont(loves_count, 0.25) AS l1, quantile_cont(loves_count, 0.75) AS l3 FROM product_filled"""),
    "clean_products": (("product_filled", "product_fences"), """
        SELECT *, round_even(price_usd * 950, 0) AS price_clp FROM (
          SELECT * REPLACE (
            greatest(least(price_usd, (SELECT p3 + 1.5 * (p3 - p1) FROM product_fences)), (SELECT p1 - 1.5 * (p3 - p1) FROM product_fences)) AS price_usd,
            greatest(least(loves_count, (SELECT l3 + 1.5 * (l3 - l1) FROM product_fences)), (SELECT l1 - 1.5 * (l3 - l1) FROM product_fences)) AS loves_count)
          FROM product_filled) WHERE price_usd > 0"""),
    "review_labelled": (("raw_reviews",), """
        SELECT * REPLACE (TRY_CAST(is_recommended AS DOUBLE) AS is_recommended) FROM raw_reviews
        WHERE author_id IS NOT NULL AND product_id IS NOT NULL AND TRY_CAST(is_recommended AS DOUBLE) IS NOT NULL"""),
    "clean_reviews": (("review_labelled",), """
        SELECT * REPLACE (
          nullif(nullif(nullif(trim(review_text, ' ' || chr(10)), 'nan'), 'None'), '') AS review_text,
          coalesce(TRY_CAST(total_feedback_count AS DOUBLE), 0) AS total_feedback_count,
          coalesce(total_neg_feedback_count, 0) AS total_neg_feedback_count,
          CASE WHEN lower(trim(skin_tone)) NOT IN ('nan', 'none', 'unknown', '') THEN lower(trim(skin_tone)) END AS skin_tone,
          CASE WHEN lower(trim(eye_color)) NOT IN ('nan', 'none', 'unknown', '') THEN lower(trim(eye_color)) END AS eye_color,
          CASE WHEN lower(trim(skin_type)) NOT IN ('nan', 'none', 'unknown', '') THEN lower(trim(skin_type)) END AS skin_type,
          CASE WHEN lower(trim(hair_color)) NOT IN ('nan', 'none', 'unknown', '') THEN lower(trim(hair_color)) END AS hair_color)
        FROM (SELECT * REPLACE (coalesce(rating, (SELECT quantile_cont(rating, 0.5) FROM review_labelled)) AS rating) FROM review_labelled)
        WHERE rating BETWEEN 1 AND 5
        QUALIFY row_number() OVER (PARTITION BY author_id, product_id ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
          l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1"""),
}


def sql(select: str, *names: str, **extra: str) -> str:
    """``select`` after the twins it needs; ``extra`` adds further named steps in order."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        bases, text = SQL[name]
        for base in bases:
            add(base)
        needed.setdefault(name, text.strip())

    for name in names:
        add(name)
    needed.update(extra)
    if not needed:
        return select.strip()
    steps = ",\n".join(f"{name} AS ({text})" for name, text in needed.items())
    return f"WITH {steps}\n{select.strip()}"
