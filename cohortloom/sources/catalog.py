"""Catalogues of files: what a file holds, judged by its name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    CELL_TABLE_RULES,
    CELL_TABLE_UNKNOWN,
    EXPRESSION_WORDS,
    FORMAT_RULES,
    FORMAT_UNKNOWN,
    NOT_EXPRESSION_WORDS,
)
from ..functions.text import contains_any


def expression_format(path: Column, rules: Sequence[tuple[str, str]] = FORMAT_RULES) -> Column:
    """Measurement format guessed from a file name; the first rule that hits counts."""
    name = F.lower(path)
    guesses = [F.when(name.contains(word), F.lit(kind)) for word, kind in rules]
    return F.coalesce(*guesses, F.lit(FORMAT_UNKNOWN))


def is_expression_file(path: Column) -> Column:
    name = F.lower(path)
    return (
        name.endswith(".txt")
        & contains_any(name, EXPRESSION_WORDS)
        & ~contains_any(name, NOT_EXPRESSION_WORDS)
    )


def is_clinical_file(path: Column) -> Column:
    name = F.lower(path)
    return name.endswith(".txt") & name.contains("clinical")


def classify_files(catalog: DataFrame) -> DataFrame:
    """Add ``format``, ``is_expression`` and ``is_clinical`` to a catalogue (path)."""
    path = F.col("path")
    return catalog.withColumns(
        {
            "format": expression_format(path),
            "is_expression": is_expression_file(path),
            "is_clinical": is_clinical_file(path),
        }
    )


def classify_cell_tables(catalog: DataFrame) -> DataFrame:
    """The .csv and .tsv files of a catalogue with their kind, format and number of rows to preview."""
    name = F.lower("path")
    kind, fmt, rows = (F.when(F.lit(False), F.lit(None)) for _ in range(3))
    for word, kind_value, fmt_value, row_value in CELL_TABLE_RULES:
        hit = name.contains(word)
        kind = kind.when(hit, F.lit(kind_value))
        fmt = fmt.when(hit, F.lit(fmt_value))
        rows = rows.when(hit, F.lit(row_value))
    default_kind, default_fmt, default_rows = CELL_TABLE_UNKNOWN
    return catalog.filter(name.endswith(".csv") | name.endswith(".tsv")).withColumns(
        {
            "kind": kind.otherwise(F.lit(default_kind)),
            "format": fmt.otherwise(F.lit(default_fmt)).cast("string"),
            "preview_rows": rows.otherwise(F.lit(default_rows)).cast("int"),
        }
    )


def pick_member(catalog: DataFrame, pattern: str, order: str = "ord") -> DataFrame:
    """One row: the first file whose name contains the pattern, and how many do."""
    return (
        catalog.filter(F.lower("path").contains(pattern.lower()))
        .agg(F.min_by("path", order).alias("path"), F.count(F.lit(1)).alias("n_matches"))
    )
