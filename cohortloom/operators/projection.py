"""Column-level operators: fixed column lists, optional columns, melting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    INVALID_SAMPLES,
    PORTAL_OPTIONAL_COLUMNS,
    STANDARD_COLUMNS,
    TECHNICAL_COLUMNS,
)
from ..functions.text import clean_text


def column_or_null(df: DataFrame, name: str, type_name: str = "string") -> Column:
    """The column when the table has it, else a typed NULL."""
    if name in df.columns:
        return F.col(f"`{name}`").cast(type_name)
    return F.lit(None).cast(type_name)


def conform(df: DataFrame, columns: Iterable[tuple[str, str]] = STANDARD_COLUMNS) -> DataFrame:
    """Fixed columns in fixed order; absent ones are NULL, others are dropped."""
    return df.select(*[column_or_null(df, name, kind).alias(name) for name, kind in columns])


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str:
    """First candidate among the columns, else the first column."""
    return next((c for c in candidates if c in columns), columns[0])


def prefer_order(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Named columns first, in their order, then the rest."""
    lead = [c for c in first if c in df.columns]
    return df.select(*[f"`{c}`" for c in lead + [c for c in df.columns if c not in lead]])


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def drop_technical(df: DataFrame, names: Sequence[str] = TECHNICAL_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in names])


def carry_optional(df: DataFrame, taken: Sequence[str]) -> list[Column]:
    """Optional clinical columns of a portal study, lower-cased.

    A name that the standard part already uses comes out with the prefix
    ``raw_``, so that the standardised value is not lost.
    """
    return [
        F.col(f"`{name}`").alias(f"raw_{name.lower()}" if name.lower() in taken else name.lower())
        for name in PORTAL_OPTIONAL_COLUMNS
        if name in df.columns
    ]


def drop_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Rows with all the named columns present, and an observation of the rows before and after.

    The counts (``rows_before``, ``rows_after``) are taken while the rows pass
    by; they are there once an action on the result has run.
    """
    present = F.lit(True)
    for name in columns:
        present = present & F.col(f"`{name}`").isNotNull()
    seen = Observation()
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows_before"), F.count_if(present).alias("rows_after")
    )
    return observed.dropna(subset=list(columns)), seen


def melt(df: DataFrame, ids: Sequence[str], name: str = "gene", value: str = "value") -> DataFrame:
    """Wide to long: every column that is not an id becomes rows."""
    values = [c for c in df.columns if c not in ids]
    return df.unpivot([f"`{c}`" for c in ids], [f"`{c}`" for c in values], name, value)


def valid_sample(sample: Column) -> Column:
    """False for blank, unassigned and ambiguous (``a/b``) samples."""
    cleaned = F.upper(clean_text(sample))
    return cleaned.isNotNull() & ~cleaned.isin(*INVALID_SAMPLES) & ~cleaned.contains("/")
