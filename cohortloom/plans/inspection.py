"""Inspection of unknown files: catalogue, kind of each file, profile of each file, one summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import GENE_COLUMN_CANDIDATES, NA_TOKENS, PORTAL_KEYWORDS
from ..functions.numeric import missing_to_null, to_number
from ..functions.text import clean_gene_id
from ..operators.summaries import matches_keywords
from ..session import settle
from ..sources.catalog import classify_files
from ..sources.many import by_separator, headers_of, lines_of, list_files, set_aside_unreadable
from ..sources.tables import unquote, without_comment

#: Samples whose numbers are looked at, the first ones of the header.
FIRST_SAMPLES = 20


def catalogue(spark: SparkSession, files: Mapping[str, Sequence[str]]) -> DataFrame:
    """(dataset, path, format, is_expression, is_clinical) of the listed files of every dataset."""
    rows = [(dataset, path) for dataset, paths in files.items() for path in paths]
    return classify_files(spark.createDataFrame(rows, "dataset string, path string"))


def inspect_files(
    spark: SparkSession,
    files: Mapping[str, Sequence[str]],
    main_genes: DataFrame,
    keywords: Sequence[str] = PORTAL_KEYWORDS,
    comment: str | None = None,
) -> DataFrame:
    """One summary row per file, of whatever kind; a file that cannot be read has a row with its ``error``.

    An expression file is profiled as a matrix and against the main genes, a
    clinical one as a table with its relevant columns; other files are listed
    with their kind alone. All headers are read in one scan and all lines in
    another, whatever the number of files. A path may be a folder of files
    with the same columns in any order.
    """
    kind = F.when(F.col("is_expression"), "expression").when(F.col("is_clinical"), "clinical").otherwise("other")
    known = catalogue(spark, files).select("dataset", "path", kind.alias("file_type"), "format")
    return profile_files(spark, known, main_genes, keywords, comment).withColumnRenamed("path", "file")


def profile_files(
    spark: SparkSession,
    catalog: DataFrame,
    main_genes: DataFrame,
    keywords: Sequence[str] = PORTAL_KEYWORDS,
    comment: str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """The catalogue (dataset, path, file_type, format) with the figures of every file, or its ``error``.

    Figures of a matrix are those of ``profile_matrix``; values that a line lacks are missing cells. No cell becomes a
    row but those of the first samples and of clinical tables. Stored on the way: headers, and counts per gene and column.
    """
    listed = settle(catalog.join(list_files(spark, catalog.select("path").distinct()), "path", "left"), "files")
    read = listed.filter((F.col("file_type") != "other") & F.col("file").isNotNull())
    # a reader takes names, so these reach the driver
    names = {row["file"]: row["name"] for row in read.select("file", "name").distinct().collect()}

    headers, bad = set_aside_unreadable(names, lambda paths: settle(headers_of(spark, paths, comment), "headers"))
    counts = None
    if headers is not None:
        heads = settle(_heads(headers, read), "heads")
        good = {file: name for file, name in names.items() if file not in bad}
        counts, later = set_aside_unreadable(
            good, lambda paths: settle(_counts(lines_of(spark, paths, comment), heads, comment, na_tokens), "counts")
        )
        bad |= later
    errors = spark.createDataFrame(list(bad.items()), "file string, why string")
    troubles = listed.join(errors, "file", "left").withColumn(
        "error", F.when(F.col("file").isNull() & (F.col("file_type") != "other"), "no such file").otherwise(F.col("why"))
    )
    if headers is None or counts is None:
        return troubles.groupBy("dataset", "path", "file_type", "format").agg(F.min("error").alias("error"))
    found = troubles.join(_header_figures(read, headers, heads, keywords), "path", "left")
    described = found.groupBy("dataset", "path", "file_type", "format").agg(
        F.min("error").alias("error"), *[F.first(c).alias(c) for c in ("separator", "n_cols", "relevant_columns", "differ")]
    )
    matrix, table = F.col("file_type") == "expression", F.col("file_type") == "clinical"
    error = F.coalesce(
        "error",
        F.when(F.col("file_type") == "other", None)
        .when(F.col("n_cols").isNull(), "no line")
        .when(F.col("differ"), "the files have different columns")
        .when(matrix & (F.col("n_cols") < 2), "no sample column"),
    )
    n_main = main_genes.select("gene").distinct().agg(F.count(F.lit(1))).scalar()
    figures = _gene_figures(listed, counts, main_genes).withColumn("n_main_genes", n_main)
    rows = described.withColumn("error", error).join(figures, "path", "left").join(_column_figures(read, headers, heads, counts), "path", "left")

    def shown(of: Column, value: str | Column, name: str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.when(of & F.col("error").isNull(), value).alias(name)

    zero = F.lit(0).cast("bigint")

    def count(of: Column, value: str, name: str | None = None) -> Column:
        return shown(of, F.coalesce(value, zero), name or value)

    return rows.select(
        "dataset", "path", "file_type", "format",
        shown(matrix | table, "separator", "separator"),
        count(matrix | table, "n_rows"),
        count(matrix, "n_unique_genes"), count(matrix, "n_missing_genes"),
        shown(matrix, F.col("n_cols") - 1, "n_samples"),
        count(matrix, "n_missing", "n_missing_cells"), count(matrix, "n_numeric_samples"),
        count(matrix, "n_unique_genes", "n_extra_genes"), count(matrix, "n_common_genes"),
        shown(matrix, F.coalesce("n_main_genes", n_main), "n_main_genes"),
        shown(table, "n_cols", "n_cols"), count(table, "n_missing"), count(table, "n_numeric_cols"),
        shown(table, "relevant_columns", "relevant_columns"),
        "error",
    )


def _heads(headers: DataFrame, read: DataFrame) -> DataFrame:
    """(file, sep, n_names, gene_at, is_matrix): one row per file; the gene column is the first candidate, else the first column."""
    rank = F.array_position(F.array(*[F.lit(c) for c in GENE_COLUMN_CANDIDATES]), F.col("name"))
    first = F.min(F.struct(F.when(rank > 0, rank).otherwise(len(GENE_COLUMN_CANDIDATES) + 1), "idx"))
    kinds = read.groupBy("file").agg(F.max(F.col("file_type") == "expression").alias("is_matrix"))
    return (
        headers.groupBy("file").agg(F.first("sep").alias("sep"), F.count(F.lit(1)).cast("int").alias("n_names"), first.alias("first"))
        .select("file", "sep", "n_names", F.col("first.idx").alias("gene_at"))
        .join(kinds, "file")
    )


def _counts(lines: DataFrame, heads: DataFrame, comment: str | None, na_tokens: Sequence[str]) -> DataFrame:
    """(file, idx, gene, n, a, b) in one pass over the lines.

    ``idx`` -1: lines of a gene and their missing cells (a). Else: of a column, cells that are no number (a) and cells
    that are present (b); of a matrix only the columns that can be among the first samples.
    """
    if comment:
        lines = lines.withColumn("value", without_comment(F.col("value"), comment))
    split = lines.join(heads, "file").withColumn("fields", by_separator(F.col("sep"), F.col("value")))
    cells = split.withColumn(
        "raw", F.transform(F.slice("fields", 1, F.col("n_names")), lambda f: missing_to_null(unquote(f), na_tokens))
    )
    own = F.get("raw", F.col("gene_at"))
    named = cells.select(
        "file", "is_matrix", "raw",
        F.when(F.col("is_matrix"), clean_gene_id(own)).alias("gene"),
        (F.col("n_names") - F.size(F.filter("raw", lambda f: f.isNotNull())) - F.when(F.col("is_matrix") & own.isNull(), 1).otherwise(0))
        .cast("bigint").alias("missing"),
    )
    watched = F.when(F.col("is_matrix"), F.slice("raw", 1, FIRST_SAMPLES + 1)).otherwise(F.col("raw"))
    whole = F.struct(F.lit(-1).alias("idx"), F.col("gene"), F.col("missing").alias("a"), F.lit(0).cast("bigint").alias("b"))

    def cell(text: Column, i: Column) -> Column:
        broken = (text.isNotNull() & to_number(text).isNull()).cast("bigint")
        return F.struct(i.alias("idx"), F.lit(None).cast("string").alias("gene"), broken.alias("a"), text.isNotNull().cast("bigint").alias("b"))

    items = F.concat(F.array(whole), F.transform(watched, cell))
    return (
        named.select("file", F.explode(items).alias("item")).select("file", "item.*")
        .groupBy("file", "idx", "gene")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    )


def _header_figures(read: DataFrame, headers: DataFrame, heads: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(path, separator, n_cols, relevant_columns, differ) from the headers alone."""
    named = read.select("path", "file").join(headers, "file")
    per_name = named.groupBy("path", "name").agg(
        F.count(F.lit(1)).alias("files"), F.min("idx").alias("place"), F.min("sep").alias("separator")
    )
    n_files = read.groupBy("path").agg(F.count(F.lit(1)).alias("n_files"))
    relevant = F.array_sort(F.collect_list(F.when(matches_keywords(F.col("name"), keywords), F.struct("place", "name"))))
    return (
        per_name.join(n_files, "path").groupBy("path")
        .agg(
            F.min("separator").alias("separator"),
            F.count(F.lit(1)).alias("n_cols"),
            F.array_join(relevant["name"], "; ").alias("relevant_columns"),
            F.max(F.col("files") < F.col("n_files")).alias("differ"),
        )
    )


def _gene_figures(listed: DataFrame, counts: DataFrame, main_genes: DataFrame) -> DataFrame:
    """Per path: lines, missing cells, genes, and genes that are main genes too."""
    main = main_genes.select("gene").distinct().withColumn("in_main", F.lit(1))
    genes = (
        counts.filter("idx = -1").join(listed.select("path", "file"), "file").groupBy("path", "gene")
        .agg(F.sum("n").alias("n"), F.sum("a").alias("missing"))
    )
    # genes of NULL meet nothing, and are one row per path
    return (
        genes.join(main, "gene", "left").groupBy("path")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum("missing").alias("n_missing"),
            F.count("gene").alias("n_unique_genes"),
            F.sum(F.when(F.col("gene").isNull(), F.col("n")).otherwise(0)).alias("n_missing_genes"),
            F.count("in_main").alias("n_common_genes"),
        )
    )


def _column_figures(read: DataFrame, headers: DataFrame, heads: DataFrame, counts: DataFrame) -> DataFrame:
    """Per path: numeric samples among the first ones of a matrix, numeric columns of a table."""
    sample = F.col("idx") - F.when(F.col("idx") > F.col("gene_at"), 1).otherwise(0)
    first = F.col("is_matrix") & (F.col("idx") != F.col("gene_at")) & (sample < FIRST_SAMPLES)
    columns = (
        counts.filter("idx >= 0").join(headers.select("file", "idx", "name"), ["file", "idx"]).join(heads, "file")
        .join(read.select("path", "file"), "file").groupBy("path", "name")
        .agg(F.sum("a").alias("broken"), F.sum("b").alias("present"), F.max(first).alias("is_first"))
    )
    return columns.groupBy("path").agg(
        F.count_if(F.col("is_first") & (F.col("broken") == 0)).alias("n_numeric_samples"),
        F.count_if((F.col("broken") == 0) & (F.col("present") > 0)).alias("n_numeric_cols"),
    )
