"""Wide gene x sample matrices, melted while they are scanned.

A matrix is read line by line and exploded to one row per cell, so that a
matrix of any width gives a table of a few columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import GENE_COLUMN_CANDIDATES, NA_TOKENS, TECHNICAL_COLUMNS
from ..functions.numeric import missing_to_null, to_number
from ..functions.text import clean_gene_id, strip
from ..cohort import Cohort
from .tables import data_lines, header_groups, split_fields, unquote, whole_line, without_comment


def matrix_columns(spark: SparkSession, path: str, sep: str = ",", comment: str | None = None) -> DataFrame:
    """(idx, cell_id) of all columns of a text table, from its first line alone and without leaving Spark.

    Names are cleaned as ``header_names`` does: stripped, empty ones named, repeated ones (in any case) numbered.
    """
    # only first blocks hold headers; which block's lines a limit takes is up to the shuffle
    lines = spark.read.text(path).filter((F.col("_metadata.file_block_start") == 0) & (F.btrim("value") != ""))
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    named = (
        lines.limit(1)
        .select(F.posexplode(split_fields(F.col("value"), sep)).alias("idx", "field"))
        .select("idx", strip(unquote(F.col("field"))).alias("name"))
        .withColumn("name", F.when(F.col("name") == "", F.concat(F.lit("Unnamed: "), F.col("idx").cast("string"))).otherwise(F.col("name")))
    )
    again = F.row_number().over(Window.partitionBy(F.lower("name")).orderBy("idx")) - 1
    return named.select(
        "idx", F.when(again > 0, F.concat("name", F.lit("."), again.cast("string"))).otherwise(F.col("name")).alias("cell_id")
    )


def place_of(columns: DataFrame, name: str) -> int:
    """Place of a named column."""
    row = columns.filter(F.col("cell_id") == name).agg(F.min("idx")).first()
    if row is None or row[0] is None:
        raise ValueError(f"no column {name}")
    return row[0]


def gene_column_of(columns: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate that is a column, else the first column."""
    wanted = columns.filter(F.col("cell_id").isin(*candidates) | (F.col("idx") == 0))
    found = {row["cell_id"]: row["idx"] for row in wanted.collect()}
    for name in candidates:
        if name in found:
            return name
    return next(name for name, at in found.items() if at == 0)


def scan_matrix_long(
    spark: SparkSession,
    path: str,
    study: str,
    sep: str = ",",
    gene_column: str | None = None,
    sample_pattern: str | None = None,
    drop_columns: Sequence[str] = TECHNICAL_COLUMNS,
    skip_gene_pattern: str | None = None,
    clean_gene: Callable[[Column], Column] = clean_gene_id,
    na_tokens: Sequence[str] = NA_TOKENS,
    relabel: DataFrame | None = None,
    keep_unnamed: bool = False,
    comment: str | None = None,
    gene_candidates: Sequence[str] = GENE_COLUMN_CANDIDATES,
    min_fields: int = 1,
    with_column: bool = False,
) -> DataFrame:
    """(study, sample_id, gene, raw, value, gene_row) of a gene x sample matrix.

    The gene column is the first of ``gene_candidates`` in the header, else the
    first column. Columns named in ``drop_columns`` (any case) and columns not
    matching ``sample_pattern`` are left out. A gene that is a missing-value
    token is none. Lines without a gene (unless ``keep_unnamed``), lines whose
    gene matches ``skip_gene_pattern`` and lines of fewer than ``min_fields``
    fields are skipped; values beyond the header are ignored, values that a
    line lacks are missing. ``raw`` is the text, NULL where missing.
    ``relabel`` (cell_id, sample_id) replaces column names, and drops columns
    it lacks, once per column instead of once per value. Files of a folder
    that order their columns differently are matched by name. ``with_column``
    adds the place of the sample in the header as ``column``.
    """
    parts = []
    for number, files in enumerate(header_groups(spark, path, sep, comment)):
        one = files if isinstance(files, str) else files[0]
        columns = matrix_columns(spark, one, sep, comment)
        gene_name = gene_column or gene_column_of(columns, gene_candidates)
        gene_at = place_of(columns, gene_name)
        header = columns.filter((F.col("idx") != gene_at) & ~F.lower("cell_id").isin(*drop_columns))
        if sample_pattern is not None:
            header = header.filter(F.col("cell_id").rlike(sample_pattern))
        if header.isEmpty():
            raise ValueError(f"no sample column in {path}")
        if relabel is None:
            header = header.withColumnRenamed("cell_id", "sample_id")
        else:
            header = header.join(relabel, "cell_id").select("idx", "sample_id")

        gene = missing_to_null(unquote(F.get("fields", F.lit(gene_at))), na_tokens)
        lines = _field_lines(spark, files, sep, comment, min_fields).withColumn("gene", clean_gene(gene))
        if not keep_unnamed:
            lines = lines.filter(F.col("gene").isNotNull() & (F.col("gene") != ""))
        if skip_gene_pattern:
            lines = lines.filter(~F.coalesce(F.col("gene").rlike(skip_gene_pattern), F.lit(False)))
        raw = missing_to_null(unquote(F.col("field")), na_tokens)
        # line numbers of the groups must differ; there are as many groups as orders of the columns
        line = F.col("line") + F.lit(number << 56).cast("long")
        parts.append(
            lines.select("gene", line.alias("gene_row"), F.posexplode("fields").alias("idx", "field"))
            .join(header, "idx")
            .select(
                F.lit(study).alias("study"),
                "sample_id",
                "gene",
                raw.alias("raw"),
                "gene_row",
                *([F.col("idx").alias("column")] if with_column else []),
            )
            .withColumn("value", to_number(F.col("raw")))
        )
    return reduce(DataFrame.unionByName, parts)


def _field_lines(
    spark: SparkSession, files: str | Sequence[str], sep: str, comment: str | None = None, min_fields: int = 1
) -> DataFrame:
    """(line, fields) of the lines after the header; ``line`` numbers them.

    A gzip file is one task, so its lines are spread before they are split. A quoted line break is refused.
    """
    lines = data_lines(spark, files, comment).withColumn("line", F.monotonically_increasing_id())
    names = [files] if isinstance(files, str) else files
    if any(name.endswith(".gz") for name in names) or any(f.endswith(".gz") for f in lines.inputFiles()):
        lines = lines.hint("rebalance")
    if comment:
        lines = lines.withColumn("value", without_comment(F.col("value"), comment))
    lines = lines.withColumn("value", whole_line(F.col("value"), sep))
    split = lines.select("line", split_fields(F.col("value"), sep).alias("fields"))
    return split.filter(F.size("fields") >= min_fields) if min_fields > 1 else split


def scan_wide_dataset(
    spark: SparkSession,
    path: str,
    metadata: Sequence[str],
    sample: str = "sample_id",
    study: str | None = None,
    sep: str = ",",
    na_tokens: Sequence[str] = NA_TOKENS,
) -> Cohort:
    """A sample x gene text as a cohort: the named columns describe samples, all others are genes.

    ``study`` is a constant, or the column ``study`` of the file. Sample ids are stripped.
    """
    sample_parts, expr_parts = [], []
    for files in header_groups(spark, path, sep):
        columns = matrix_columns(spark, files if isinstance(files, str) else files[0], sep)
        described = {r["cell_id"]: r["idx"] for r in columns.filter(F.col("cell_id").isin(*metadata)).collect()}
        if sample not in described:
            raise ValueError(f"{path} has no metadata column {sample}")
        lines = _field_lines(spark, files, sep)

        def field(name: str, at=described) -> Column:
            text = missing_to_null(unquote(F.get("fields", F.lit(at[name]))), na_tokens)
            return strip(text) if name == sample else text

        samples = lines.select(*[field(name).alias(name) for name in sorted(described, key=described.get)])
        if study is not None:
            samples = samples.withColumn("study", F.lit(study))
        study_of = F.lit(study) if study is not None else field("study")
        header = columns.filter(~F.col("cell_id").isin(*metadata)).withColumnRenamed("cell_id", "gene")
        sample_parts.append(samples)
        expr_parts.append(
            lines.select(
                study_of.alias("study"), field(sample).alias("sample_id"), F.posexplode("fields").alias("idx", "field")
            )
            .join(header, "idx")
            .select("study", "sample_id", "gene", missing_to_null(unquote(F.col("field")), na_tokens).alias("raw"))
            .withColumn("value", to_number(F.col("raw")))
            .drop("raw")
        )
    return Cohort(reduce(DataFrame.unionByName, sample_parts), reduce(DataFrame.unionByName, expr_parts))


def cell_columns(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(idx, cell_id) of the columns of a matrix after the gene column, from its header alone; idx counts from 0."""
    return matrix_columns(spark, path, sep).filter("idx > 0").withColumn("idx", F.col("idx") - 1)


def scan_cell_matrix(
    spark: SparkSession,
    path: str,
    study: str,
    cell_samples: DataFrame,
    sep: str = ",",
    skip_gene_pattern: str | None = None,
    min_fields: int = 1,
) -> DataFrame:
    """(study, sample_id, gene, raw, value) of a gene x cell text, cells under their sample.

    ``cell_samples`` is (cell_id, sample_id); cells without a sample are left
    out. A TPM text has visit rows under its header (``Pre_``, ``Post_``) and
    lines of one field: they are skipped on request, as a count text may have
    genes of such names.
    """
    first = matrix_columns(spark, path, sep).filter("idx = 0").first()
    return scan_matrix_long(
        spark,
        path,
        study,
        sep=sep,
        gene_column=first["cell_id"],
        drop_columns=(),
        skip_gene_pattern=skip_gene_pattern,
        clean_gene=strip,
        na_tokens=(),
        relabel=cell_samples,
        min_fields=min_fields,
    )
