"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import (
    conversations,
    decontaminate,
    exact_copies,
    hard_negatives,
    language_model,
    line_dedup,
    quality_classifier,
    quality_rules,
    sentence_pieces,
    simhash,
    toxicity,
    urls,
    warc,
)
from .common import Run

_MODULES = (
    simhash,
    decontaminate,
    urls,
    language_model,
    sentence_pieces,
    quality_rules,
    warc,
    line_dedup,
    toxicity,
    quality_classifier,
    exact_copies,
    conversations,
    hard_negatives,
)

QUERIES: dict[str, Run] = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
SQL: dict[str, str] = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
