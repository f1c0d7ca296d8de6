"""Profiles of unknown inputs: what a table or matrix holds, and how it meets the main genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import NA_TOKENS
from ..functions.numeric import missing_to_null
from ..operators.genes import gene_overlap
from ..operators.sketches import described, merge_sketches, sketch_values
from ..operators.summaries import (
    column_types,
    distinct_values,
    matches_keywords,
    matrix_profile,
    merge_rows,
    numeric_samples,
    table_shape,
)
from ..session import settle
from ..sources.many import by_separator, headers_of, lines_of, list_files, literal_path
from ..sources.tables import unquote, without_comment
from .inspection import profile_files


def profile_table(df: DataFrame, dataset: str) -> DataFrame:
    """One row: shape, missing cells, number of numeric columns."""
    numeric = sum(is_numeric for _, _, is_numeric in column_types(df))
    return table_shape(df).select(
        F.lit(dataset).alias("dataset"), "*", F.lit(numeric).cast("bigint").alias("n_numeric_cols")
    )


def relevant_columns(df: DataFrame, keywords: Sequence[str]) -> list[str]:
    """Columns whose name contains one of the keywords, in table order."""
    return [c for c in df.columns if any(k in c.lower() for k in keywords)]


def relevant_names(names: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """The same for names held as rows, for instance distinct attribute names."""
    return names.filter(matches_keywords(F.col(column), keywords))


def profile_relevant(
    df: DataFrame, keywords: Sequence[str], max_columns: int | None = None, first: int = 12
) -> DataFrame:
    """Number and first examples of the distinct values of the relevant columns, of all unless told otherwise."""
    return distinct_values(df, relevant_columns(df, keywords)[:max_columns], first)


def profile_matrix(cells: DataFrame, main_genes: DataFrame, first: int = 20) -> DataFrame:
    """Per study: shape of a scanned matrix, numeric samples among the first ones, overlap with the main genes.

    The first samples are those that stand first in the header, if the cells
    have a ``column``; else those with the smallest ids.
    """
    overlap = gene_overlap(main_genes, cells.filter(F.col("gene").isNotNull()))
    flags, order = numeric_samples(cells), ["sample_id"]
    if "column" in cells.columns:
        places = cells.groupBy("study", "sample_id").agg(F.min("column").alias("_place"))
        flags, order = flags.join(places, ["study", "sample_id"]), ["_place", "sample_id"]
    heads = (
        flags.withColumn("_rank", F.row_number().over(Window.partitionBy("study").orderBy(*order)))
        .filter(F.col("_rank") <= first)
        .groupBy("study")
        .agg(F.count_if("is_numeric").alias("n_numeric_samples"))
    )
    return merge_rows("study", [matrix_profile(cells), heads, overlap])


def profile_matrix_file(
    spark: SparkSession, path: str, dataset: str, main_genes: DataFrame, comment: str | None = None
) -> DataFrame:
    """Summary row of a matrix file of unknown separator, from one pass over its lines; no cell is stored."""
    listed = spark.createDataFrame([(dataset, path, "expression", None)], "dataset string, path string, file_type string, format string")
    row = settle(profile_files(spark, listed, main_genes, comment=comment), "profile")
    error = row.first()["error"]
    if error:
        raise ValueError(f"{path}: {error}")
    figures = [c for c in row.columns if c.startswith("n_") and c not in ("n_cols", "n_missing", "n_numeric_cols")]
    return row.select(F.col("dataset").alias("study"), *figures, F.col("path").alias("file"), "separator")


def sketch_files(
    spark: SparkSession, paths: Sequence[str], keywords: Sequence[str] | None = None, comment: str | None = None, na_tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """(path, column, ...) sketches of the columns of many text files, of the relevant ones if ``keywords`` are given.

    All headers are read in one scan and all lines in another. Stored, they give the profile of a folder by
    ``profile_of_sketches``; a new file is sketched by itself and added to them. Missing files are left out, unreadable
    ones fail.
    """
    catalog = spark.createDataFrame([(p,) for p in paths], "path string").distinct()
    listed = settle(list_files(spark, catalog).dropna(subset=["file"]), "files")
    names = [literal_path(row["name"]) for row in listed.select("name").distinct().collect()]
    if not names:
        raise ValueError("no such file")
    headers = settle(headers_of(spark, names, comment), "headers")
    chosen = headers if keywords is None else headers.filter(matches_keywords(F.col("name"), keywords))
    seps = headers.groupBy("file").agg(F.first("sep").alias("sep"), F.count(F.lit(1)).cast("int").alias("width"))
    lines = lines_of(spark, names, comment)
    if comment:
        lines = lines.withColumn("value", without_comment(F.col("value"), comment))
    # a value that a line lacks is missing, one beyond the header is no value
    fields = by_separator(F.col("sep"), F.col("value"))
    padded = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.get("fields", i))
    cells = lines.join(seps, "file").withColumn("fields", fields).select("file", F.posexplode(padded).alias("idx", "field"))
    values = (
        cells.join(chosen.select("file", "idx", F.col("name").alias("column")), ["file", "idx"])
        .join(listed.select("path", "file"), "file")
        .select("path", "column", missing_to_null(unquote(F.col("field")), na_tokens).alias("value"))
    )
    return sketch_values(values, ["path", "column"])


def profile_of_sketches(sketches: DataFrame, by: Sequence[str] = ("column",), top: int = 5) -> DataFrame:
    """Profile of the columns of all sketched files together, or by further keys of the sketches; no file is read."""
    return described(merge_sketches(sketches, by), by, top)
