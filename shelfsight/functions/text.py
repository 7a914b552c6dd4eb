"""Text columns: trimming, null tokens, normalising, labels for display."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsight.schemas import (
    SENTIMENT_LABELS,
    TEXT_NULL_TOKENS,
    UNKNOWN_PATTERN,
    WHITESPACE,
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def null_if_in(col: Column, tokens: Iterable[str]) -> Column:
    return F.when(~col.isin(list(tokens)), col)


def clean_text(col: Column) -> Column:
    """Trimmed text, null where nothing but a null token is left."""
    return null_if_in(strip(col), TEXT_NULL_TOKENS)


def null_if_unknown(col: Column, ignore_case: bool = True) -> Column:
    pattern = f"(?i){UNKNOWN_PATTERN}" if ignore_case else UNKNOWN_PATTERN
    # Few texts hold the word at all, and looking for it costs less than matching.
    near = (F.lower(col) if ignore_case else col).contains("unknown")
    return F.when(~(near & col.rlike(pattern)), col)


def plain_words(col: Column) -> Column:
    """Lower case, single spaces, only a-z and 0-9."""
    spaced = F.regexp_replace(strip(F.lower(col)), r"(?U)\s+", " ")
    return F.regexp_replace(spaced, r"[^a-z0-9\s]", "")


def clean_product_type(col: Column) -> Column:
    return strip(F.replace(F.coalesce(col, F.lit("Unknown")), F.lit("\n"), F.lit("")))


def scorer_text(col: Column, max_chars: int | None = None) -> Column:
    """Text handed to a scorer. Whole by default; ``max_chars`` serves scorers with a size limit."""
    return strip(col if max_chars is None else F.substring(col, 1, max_chars))


def parse_score(response: Column) -> Column:
    """A scorer's JSON answer as ``struct<label, score>``; anything unusable is unknown / 0."""
    parsed = F.from_json(strip(response), "label string, score double")
    label = F.lower(parsed["label"])
    broken = parsed["label"].isNull() & parsed["score"].isNull()
    return F.struct(
        F.when(~broken & label.isin(SENTIMENT_LABELS), label).otherwise("unknown").alias("label"),
        F.when(~broken, F.round(F.coalesce(parsed["score"], F.lit(0.0)), 4)).otherwise(0.0).alias("score"),
    )


# Display names of sentiment labels.
DISPLAY_LABELS = {"positive": "Positivo", "negative": "Negativo", "neutral": "Neutral"}


def display_label(col: Column) -> Column:
    pairs = [F.lit(text) for pair in DISPLAY_LABELS.items() for text in pair]
    return F.create_map(*pairs)[col]


def best_flag(col: Column) -> Column:
    return F.when(col, F.lit("★")).otherwise(F.lit(""))


def money(col: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(col, 0))


def simple_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def full_name(name: str) -> str:
    """Lower case with every run of other characters (spaces included) as one underscore."""
    return re.sub("_+", "_", re.sub("[^a-z0-9]", "_", name.strip().lower()))
