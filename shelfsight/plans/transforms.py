"""From raw tables to clean ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.numbers import clip, convert
from shelfsight.operators import clean
from shelfsight.operators.enrich import clean_sentiment
from shelfsight.operators.quantiles import exact_quantiles
from shelfsight.operators.relate import keep_first


def clean_products(raw: DataFrame, rate: float | Column = 1.0, order: Sequence[str] = ()) -> DataFrame:
    """One row per product, gaps filled, price and loves capped at the quartile fences, local price added.

    ``order`` says which of several rows of a product comes first (all columns, if not given).
    Caps apply before the price filter, as the fences are part of the price's definition.
    """
    named = clean.rename_simple(raw)
    first = keep_first(named, ["product_id"], order or named.columns)
    typed = clean.coerce_numbers(clean.clean_text_columns(first), ["price_usd", "rating", "loves_count"])

    # The statistics read three narrow columns several times, so those are kept; the rest is not.
    learned = typed.select("price_usd", "rating", "loves_count").persist()
    try:
        medians = exact_quantiles(learned, ["price_usd", "rating"], [0.5])
        fill = {
            "price_usd": F.coalesce("price_usd", F.lit(medians["price_usd"][0])),
            "rating": F.coalesce("rating", F.lit(medians["rating"][0])),
            "loves_count": F.coalesce("loves_count", F.lit(0.0)),
        }
        quartiles = exact_quantiles(learned, {c: fill[c] for c in ("price_usd", "loves_count")}, [0.25, 0.75])
    finally:
        learned.unpersist()

    def capped(name: str) -> Column:
        q1, q3 = quartiles[name]
        return fill[name] if q1 is None else clip(fill[name], q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))

    filled = typed.withColumns(
        {"price_usd": capped("price_usd"), "rating": fill["rating"], "loves_count": capped("loves_count")}
    )
    priced = clean.positive_price(filled)
    return priced.withColumn("price_clp", convert(F.col("price_usd"), rate if isinstance(rate, Column) else F.lit(float(rate))))


def clean_reviews(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Identified, labelled reviews with a rating in 1..5, one per author and product.

    Cleaning text and counts touches neither keys nor which rows stay, so it waits until the repeats
    are gone.
    """
    named = clean.rename_simple(raw)
    labelled = clean.with_label(clean.with_keys(named))
    if "rating" in labelled.columns:
        median = exact_quantiles(labelled, {"rating": clean.as_number(labelled, "rating")}, [0.5])["rating"][0]
        labelled = clean.rating_in_range(labelled, median)
    first = keep_first(labelled, ["author_id", "product_id"], order or named.columns)
    return clean.clean_demographics(clean.fill_feedback(clean.clean_text_columns(first, ["review_text"])))


def clean_all(
    products: DataFrame, reviews: DataFrame, sentiment: DataFrame, rate: float | Column = 1.0,
    product_order: Sequence[str] = (), review_order: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        clean_products(products, rate, product_order),
        clean_reviews(reviews, review_order),
        clean_sentiment(sentiment),
    )
