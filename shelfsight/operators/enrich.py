"""Scores from outside the tables: sentiment by a pluggable scorer, and exchange rates with a fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.text import SENTIMENT_LABELS, scorer_text
from shelfsight.operators.clean import known_sentiment, require_columns, with_valid_text
from shelfsight.operators.relate import not_in_cache, union_by_name
from shelfsight.operators.sampling import balanced_sample
from shelfsight.schemas import FALLBACK_RATE, SENTIMENT_COLUMNS, SENTIMENT_SCHEMA
from shelfsight.sources.keys import KeySet

# Word lists of the offline scorer.
POSITIVE_WORDS = ["amazing", "best", "excellent", "good", "great", "happy", "love", "nice", "perfect", "recommend"]
NEGATIVE_WORDS = ["awful", "bad", "disappointed", "hate", "horrible", "poor", "return", "terrible", "waste", "worst"]

# A scorer turns a text column into a ``struct<label, score>`` column.
Scorer = Callable[[Column], Column]


def lexicon_scorer(positive: list[str] | None = None, negative: list[str] | None = None) -> Scorer:
    """Counts listed words: more good than bad is positive; the score is the larger side's share."""
    good, bad = list(positive or POSITIVE_WORDS), list(negative or NEGATIVE_WORDS)

    def score(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
        ups, downs = F.size(F.filter(words, lambda w: w.isin(good))), F.size(F.filter(words, lambda w: w.isin(bad)))
        share = F.greatest(ups, downs) / F.nullif(ups + downs, F.lit(0))
        return F.struct(
            F.when(ups == downs, "neutral").when(ups > downs, "positive").otherwise("negative").alias("label"),
            F.when(ups == downs, F.lit(0.5)).otherwise(share).alias("score"),
        )

    return score


def batch_scorer(score: Callable[["pd.Series"], "pd.DataFrame"]) -> Scorer:
    """A scorer that gets a whole Arrow batch of texts and answers with columns ``label`` and ``score``.

    A batch that fails is unknown / 0 as a whole; ``text_scorer`` keeps failures to single texts.
    """

    def run(parts: Iterator["pd.Series"]) -> Iterator["pd.DataFrame"]:
        import pandas as pd

        for part in parts:
            try:
                yield score(part)[["label", "score"]].reset_index(drop=True)
            except Exception:
                yield pd.DataFrame({"label": ["unknown"] * len(part), "score": [0.0] * len(part)})

    import pandas as pd

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "label string, score double")


def text_scorer(score: Callable[[str], tuple[str, float]]) -> Scorer:
    """A scorer that is asked text by text; a text that fails is unknown / 0."""

    def one(text: str | None) -> tuple[str, float]:
        try:
            label, value = score(text) if text else ("unknown", 0.0)
            return str(label), float(value)
        except Exception:
            return "unknown", 0.0

    def run(texts: "pd.Series") -> "pd.DataFrame":
        import pandas as pd

        return pd.DataFrame([one(t) for t in texts], columns=["label", "score"])

    return batch_scorer(run)


def score_texts(df: DataFrame, scorer: Scorer, column: str = "review_text", max_chars: int | None = None) -> DataFrame:
    """``df`` with ``sentiment`` and ``sentiment_score`` (4 decimals); a text that is empty or fails is unknown / 0."""
    text = scorer_text(F.col(column), max_chars)
    label, usable = F.lower("_scored.label"), F.coalesce(F.length(text) > 0, F.lit(False))
    return (
        df.withColumn("_scored", scorer(text))
        .withColumn("sentiment", F.when(usable & label.isin(SENTIMENT_LABELS), label).otherwise("unknown"))
        .withColumn("sentiment_score", F.when(usable, F.bround(F.coalesce("_scored.score", F.lit(0.0)), 4)).otherwise(0.0))
        .drop("_scored")
    )


def fresh_sentiment(
    reviews: DataFrame,
    scorer: Scorer,
    size: int | None = None,
    cache: DataFrame | KeySet | None = None,
    ids: tuple[str, ...] = ("author_id", "review_text"),
    cache_key: str = "author_id",
    seed: int = 42,
    max_chars: int | None = None,
) -> DataFrame:
    """Scores of every review with usable text, leaving out what the cache holds.

    The cache is its rows, or the set of its keys, which are not moved then. With a ``size``, of a class-balanced
    sample of that many reviews.
    """
    require_columns(reviews, SENTIMENT_COLUMNS, "reviews")
    usable = with_valid_text(reviews)
    if size is None:
        chosen = usable.withColumn(
            "is_recommended", F.coalesce(F.col("is_recommended").try_cast("double"), F.lit(0.0)).cast("int")
        )
    else:
        chosen = balanced_sample(usable, "is_recommended", list(ids), size, seed)
    if isinstance(cache, KeySet):
        fresh = cache.missing(chosen, cache_key)
    else:
        fresh = chosen if cache is None else not_in_cache(chosen, cache, cache_key)
    return score_texts(fresh, scorer, max_chars=max_chars).select(*SENTIMENT_SCHEMA.names)


def add_sentiment(
    reviews: DataFrame, scorer: Scorer, size: int | None = None, cache: DataFrame | None = None, **options
) -> DataFrame:
    """The cached scores and the fresh ones together."""
    fresh = fresh_sentiment(reviews, scorer, size, cache, **options)
    return fresh if cache is None else union_by_name([cache.select(*SENTIMENT_SCHEMA.names), fresh])


def clean_sentiment(df: DataFrame) -> DataFrame:
    return known_sentiment(df)


def current_rate(rates: DataFrame, fallback: float = FALLBACK_RATE, today: str | None = None) -> DataFrame:
    """The latest stored rate as one row (date, rate, source), or the fallback if none is stored."""
    today = today or date.today().isoformat()
    last = rates.where("rate is not null").agg(F.max_by(F.struct("date", "rate"), "loaded_at").alias("r"))
    return last.select(
        F.coalesce("r.date", F.lit(today)).alias("date"),
        F.coalesce("r.rate", F.lit(float(fallback))).alias("rate"),
        F.when(F.col("r").isNull(), "fallback").otherwise("api").alias("source"),
    )
