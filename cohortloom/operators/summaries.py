"""Counts, frequencies and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of
from ..functions.text import contains_any
from ..session import settle

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "n_samples") -> DataFrame:
    """Rows per key; a row with a NULL key belongs to no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, with_nulls: bool = False) -> DataFrame:
    """(value, n), most frequent first."""
    kept = df if with_nulls else df.dropna(subset=[column])
    return (
        kept.groupBy(F.col(f"`{column}`").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("value"))
    )


def label_counts(label: Column, prefix: str = "n_response") -> list[Column]:
    """Number of samples labelled 0, labelled 1 and without label."""
    return [
        F.count_if(label == 0).alias(f"{prefix}_0"),
        F.count_if(label == 1).alias(f"{prefix}_1"),
        F.count_if(label.isNull()).alias(f"{prefix}_missing"),
    ]


def distinct_texts(column: Column) -> Column:
    """The distinct present texts of a small category column, sorted and joined by ``; ``."""
    return F.array_join(F.array_sort(F.collect_set(column)), "; ")


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells. One pass over the table."""
    missing = F.lit(0).cast("bigint")
    for name in df.columns:
        missing = missing + F.count_if(F.col(f"`{name}`").isNull())
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        missing.alias("n_missing"),
    )


def column_types(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, type, numeric) of a table, from its schema alone."""
    return [(name, kind, kind.split("(")[0] in NUMERIC_TYPES) for name, kind in df.dtypes]


def matrix_profile(cells: DataFrame) -> DataFrame:
    """Per study of a raw long matrix: rows, genes, missing genes, samples, missing cells.

    ``cells`` is (study, gene, gene_row, sample_id, raw) before any cleaning by gene.
    """
    rows = (
        cells.groupBy("study", "gene_row", "gene")
        .agg(F.count_if(F.col("raw").isNull()).alias("missing"))
        .groupBy("study", "gene")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("missing").alias("missing"))
        .groupBy("study")
        .agg(
            F.sum("rows").alias("n_rows"),
            F.count("gene").alias("n_unique_genes"),
            F.sum(F.when(F.col("gene").isNull(), F.col("rows")).otherwise(0)).alias("n_missing_genes"),
            F.sum("missing").alias("n_missing_cells"),
        )
    )
    samples = (
        cells.select("study", "sample_id").distinct()
        .groupBy("study").agg(F.count(F.lit(1)).alias("n_samples"))
    )
    return merge_rows("study", [rows, samples])


def broken_cell() -> Column:
    """True for a cell of a raw matrix that holds a text that is no number."""
    return F.col("raw").isNotNull() & F.col("value").isNull()


def numeric_samples(cells: DataFrame) -> DataFrame:
    """(study, sample_id, is_numeric): no cell of the sample holds a text that is no number."""
    return cells.groupBy("study", "sample_id").agg((F.count_if(broken_cell()) == 0).alias("is_numeric"))


def mean_of_numeric_samples(cells: DataFrame) -> DataFrame:
    """One mean per sample and gene; a sample with at least one text that is no number is left out.

    The cells are aggregated and stored once, so that finding the samples to
    leave out does not read the raw matrix again.
    """
    means = settle(
        cells.groupBy("study", "sample_id", "gene").agg(
            mean_of(cells, "value").alias("value"), F.count_if(broken_cell()).alias("n_broken")
        ),
        "means",
    )
    broken = means.filter("n_broken > 0").select("study", "sample_id").distinct()
    return means.join(broken, ["study", "sample_id"], "left_anti").drop("n_broken")


def distinct_values(df: DataFrame, columns: Sequence[str], first: int = 12) -> DataFrame:
    """Per column: number of distinct values, and the first ones in sorted order.

    Values are made distinct before they are ranked, and ranked within tasks
    before the shuffle, so no task gathers all the values of a column.
    """
    values = (
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        .unpivot([], [f"`{c}`" for c in columns], "column", "value")
        .dropna()
        .distinct()
    )
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    examples = (
        values.withColumn("_rank", rank)
        .filter(F.col("_rank") <= first)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("examples"))
    )
    return counts.join(examples, "column")


def matches_keywords(name: Column, keywords: Sequence[str]) -> Column:
    """True for a column name that contains one of the keywords, whatever its case."""
    return contains_any(F.lower(name), keywords)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(n)


def merge_rows(key: str, summaries: Sequence[DataFrame]) -> DataFrame:
    """Figures of several summaries side by side, one row per key value.

    Summaries are stacked and grouped instead of joined: a join on a key that
    is one constant would be planned as a cross join.
    """
    table = stack(summaries)
    return table.groupBy(key).agg(*[F.max(c).alias(c) for c in table.columns if c != key])


def stack(summaries: Sequence[DataFrame]) -> DataFrame:
    """Summary rows of several datasets in one table; a figure a dataset lacks is NULL."""
    table = summaries[0]
    for other in summaries[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    return table
