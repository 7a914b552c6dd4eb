"""All queries of this subpackage."""

from __future__ import annotations

from shelfsight.llm import (  # noqa: F401
    embedding_dedup,
    exact_dedup,
    filter_audit,
    html_extract,
    lexical_search,
    line_dedup,
    lm_scoring,
    mixing,
    piece_codec,
    quality,
    simhash,
    token_files,
    toxicity,
)
from shelfsight.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
