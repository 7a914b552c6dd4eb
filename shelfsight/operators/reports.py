"""Catalog, review and sentiment reports: the numbers behind the served queries and charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfsight.operators.clean import catalog_slice
from shelfsight.operators.frequent import top_values
from shelfsight.operators.quantiles import exact_quantiles


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part * 100.0 / F.when(whole != 0, whole), digits)


def sentiment_summary(sentiment: DataFrame) -> DataFrame:
    """Reviews, share recommended and mean score per sentiment, best first."""
    return (
        sentiment.where(F.col("sentiment") != "unknown")
        .groupBy("sentiment")
        .agg(
            F.count(F.lit(1)).alias("total_reviews"),
            F.round(F.avg("is_recommended") * 100, 2).alias("pct_recommended"),
            F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment_score"),
        )
        .orderBy(F.desc("pct_recommended"), "sentiment")
    )


def recommendation_by_sentiment(sentiment: DataFrame) -> DataFrame:
    return sentiment.groupBy("sentiment").agg(F.round(F.avg("is_recommended"), 3).alias("recommendation_rate"))


def catalog_kpis(products: DataFrame, reviews: DataFrame, rate: float) -> DataFrame:
    """Catalog size, mean prices, mean rating, and the share of reviews that recommend."""
    recommended = reviews.agg((F.avg("is_recommended") * 100).alias("pct")).scalar()
    return products.agg(
        F.count(F.lit(1)).alias("products"), F.avg("price_usd").alias("avg_price_usd"),
        (F.avg("price_usd") * rate).alias("avg_price_local"), F.avg("rating").alias("avg_rating"),
    ).withColumn("pct_recommended", recommended)


def loved_brands(products: DataFrame, n: int = 10) -> DataFrame:
    """Brands by mean loves per product."""
    return (
        products.where("brand_name is not null")
        .groupBy("brand_name")
        .agg(F.avg("loves_count").alias("avg_loves"), F.count("product_id").alias("products"))
        .orderBy(F.desc_nulls_last("avg_loves"), "brand_name")
        .limit(n)
    )


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """How often each value occurs, most frequent first; missing values left out."""
    if n is not None and df.schema[column].dataType == StringType():
        return top_values(df, [column], n).select(F.col("value").alias(column), "n").orderBy(F.desc("n"), column)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), column)
    return ordered if n is None else ordered.limit(n)


def prices_by_category(products: DataFrame, rate: float) -> DataFrame:
    """Lowest, highest and mean local price per category, whole units, dearest first."""
    local = F.col("price_usd") * rate
    return (
        products.where("primary_category is not null")
        .groupBy("primary_category")
        .agg(
            F.bround(F.min(local), 0).alias("min_price"), F.bround(F.max(local), 0).alias("max_price"),
            F.bround(F.avg(local), 0).alias("avg_price"),
        )
        .orderBy(F.desc("avg_price"), "primary_category")
    )


def median_price(products: DataFrame, rate: float) -> DataFrame:
    local = exact_quantiles(products, {"local": F.col("price_usd") * rate}, [0.5])["local"][0]
    return products.sparkSession.createDataFrame(
        [(local, None if local is None else local / rate)], "median_local double, median_usd double"
    )


def slice_kpis(products: DataFrame, **choice) -> DataFrame:
    """Size, mean price, mean rating and brands of a catalog slice."""
    return catalog_slice(products, **choice).agg(
        F.count(F.lit(1)).alias("products"), F.avg("price_usd").alias("avg_price"),
        F.avg("rating").alias("avg_rating"), F.count_distinct("brand_name").alias("brands"),
    )


def histogram(df: DataFrame, value: Column, bins: int = 40) -> DataFrame:
    """Counts in ``bins`` equal ranges from the smallest to the largest value; empty ranges left out."""
    given = df.select(value.cast("double").alias("v")).where("v is not null and not isnan(v)")
    bounds = given.agg(F.min("v").alias("low"), F.max("v").alias("high")).select(F.struct("low", "high"))
    placed = given.withColumn("b", bounds.scalar())
    low, high = F.col("b.low"), F.col("b.high")
    # The last range includes its upper bound; a single value makes one range.
    number = F.when(low == high, F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - low) / (high - low) * bins) + 1, F.lit(bins))
    ).cast("int")
    width = (high - low) / bins
    return (
        placed.groupBy(number.alias("bin"), "b").agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (low + (F.col("bin") - 1) * width).alias("from_value"), (low + F.col("bin") * width).alias("to_value"), "n")
        .orderBy("bin")
    )


def sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    """Reviews per sentiment with their share of all."""
    return class_distribution(sentiment, "sentiment", 4)


def class_distribution(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Rows and percentage per value; missing is a value of its own."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per class; the table is read once
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, digits))


def cluster_profile(df: DataFrame, cluster: str = "cluster", label: str = "is_recommended") -> DataFrame:
    """Size, recommended rows, their share, and the cluster's share of all rows."""
    totals = df.groupBy(cluster).agg(F.count(label).alias("total"), F.sum(label).cast("bigint").alias("recommended"))
    everything = F.sum("total").over(Window.partitionBy())  # over one row per cluster
    return totals.select(
        cluster, "total", "recommended",
        percent(F.col("recommended"), F.col("total")).alias("pct_recommended"),
        percent(F.col("total"), everything).alias("pct_of_total"),
    ).orderBy(cluster)


def score_pivot(results: DataFrame, rows: str, columns: str, score: str, values: Sequence | None = None) -> DataFrame:
    """Mean score per (rows, columns) pair, one column per value of ``columns``."""
    grouped = results.groupBy(rows).pivot(columns, None if values is None else list(values))
    return grouped.agg(F.avg(score)).orderBy(rows)


def latest_rate(rates: DataFrame) -> DataFrame:
    """The rate loaded last, as one row; no rows if none is stored."""
    last = F.max_by(F.struct(*rates.columns), "loaded_at").alias("r")
    return rates.agg(last).where("r is not null").select("r.*")


def clusters_by_k(clusters: DataFrame) -> DataFrame:
    return clusters.select("k", "inertia", "silhouette", "is_best").orderBy("k")


def best_cluster(clusters: DataFrame) -> DataFrame:
    return clusters.where("is_best").orderBy("k").limit(1)


def clusters_for_display(clusters: DataFrame) -> DataFrame:
    return clusters.select(
        "k", F.format_number("inertia", 0).alias("inertia"), F.round("silhouette", 4).alias("silhouette"),
        F.when(F.col("is_best"), F.lit("★ Óptimo")).otherwise(F.lit("")).alias("chosen"),
    ).orderBy("k")


def latest_metrics(metrics: DataFrame) -> DataFrame:
    last = F.max_by(F.struct(*metrics.columns), "loaded_at").alias("m")
    return metrics.agg(last).where("m is not null").select("m.*")


def rating_price_points(products: DataFrame) -> DataFrame:
    return products.select("price_usd", "rating", "primary_category", "product_name", "brand_name").dropna(
        subset=["price_usd", "rating"]
    )
