"""Single-cell matrices aggregated to one profile per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    RESPONSE_COLUMN_WORDS,
    SAMPLE_COLUMN_CANDIDATES,
    SAMPLE_COLUMN_WORDS,
)
from ..functions.labels import add_label
from ..functions.numeric import log2_cpm, mean_with_zeros, total_of
from ..functions.text import normalise_sample_id, patient_from_cell_id, strip
from ..operators.genes import SAMPLE_KEYS, common_genes, on_genes, require_genes
from ..operators.matching import (
    cell_to_sample,
    choose_key,
    join_by_position,
    patient_to_sample,
)
from ..operators.ordering import first_per_key
from ..operators.projection import valid_sample
from ..operators.summaries import label_counts
from ..session import settle
from ..sources.matrix import cell_columns, scan_cell_matrix
from . import Cohort


def choose_sample_column(columns: list[str]) -> str:
    """Column of cell metadata that names the sample or patient."""
    known = [c for c in SAMPLE_COLUMN_CANDIDATES if c in columns]
    likely = [
        c
        for c in columns
        if any(w in c.lower() for w in SAMPLE_COLUMN_WORDS)
        and not any(w in c.lower() for w in RESPONSE_COLUMN_WORDS)
    ]
    if not known + likely:
        raise ValueError(f"no sample column among {columns}")
    return (known + likely)[0]


def choose_response_column(columns: list[str]) -> str:
    """Column of cell metadata that holds the response."""
    exact = [c for c in columns if c.lower() == RESPONSE_COLUMN_WORDS[0]]
    likely = [c for c in columns if any(w in c.lower() for w in RESPONSE_COLUMN_WORDS)]
    if not exact + likely:
        raise ValueError(f"no response column among {columns}")
    return (exact + likely)[0]


def identify_cells(metadata: DataFrame, header: DataFrame, order: str = "row") -> DataFrame:
    """Add ``cell_id`` to cell metadata.

    It is the column that matches most header cells; when none matches any,
    rows and header (idx, cell_id) are matched by position if equally long.
    """
    best = choose_key(metadata, [c for c in metadata.columns if c != order], header, "cell_id")
    if best is not None:
        return metadata.withColumn("cell_id", F.col(f"`{best[0]}`").cast("string"))
    if "idx" not in header.columns:
        raise ValueError("no metadata column matches the cells, and the cells have no position")
    return join_by_position(header, metadata, [order]).drop("idx")


def label_cells(metadata: DataFrame, header: DataFrame, order: str = "row") -> DataFrame:
    """(cell_id, sample_id, response, response_binary, row) of the measured cells of valid samples."""
    columns = [c for c in metadata.columns if c != order]
    sample = strip(F.col(f"`{choose_sample_column(columns)}`").cast("string"))
    response = F.col(f"`{choose_response_column(columns)}`").cast("string")
    return (
        identify_cells(metadata, header, order)
        .select(
            "cell_id",
            sample.alias("sample_id"),
            response.alias("response"),
            F.col(order).alias("row"),
        )
        .filter(valid_sample(F.col("sample_id")))
        .transform(add_label, "response", "recist")
        .join(header.select("cell_id"), "cell_id", "left_semi")
        .select("cell_id", "sample_id", "response", "response_binary", "row")
    )


def roll_up_cells(cells: DataFrame, order: Column) -> DataFrame:
    """Per sample: number of cells, first present response and first present label."""
    response, binary = F.col("response"), F.col("response_binary")
    return cells.groupBy("sample_id").agg(
        F.count("cell_id").alias("n_cells"),
        F.min_by(response, F.when(response.isNotNull(), order)).alias("response"),
        F.min_by(binary, F.when(binary.isNotNull(), order)).alias("response_binary"),
    )


def pseudobulk_sum(cells: DataFrame) -> DataFrame:
    """Sum of the cells of a sample per gene; a value that is no number adds nothing.

    ``cells`` is (study, sample_id, gene, value).
    """
    return cells.groupBy(*SAMPLE_KEYS, "gene").agg(total_of(cells, "value").alias("value"))


def pseudobulk_mean(cells: DataFrame) -> DataFrame:
    """Mean of the cells of a sample per gene; a value that is no number counts as 0.0."""
    return cells.groupBy(*SAMPLE_KEYS, "gene").agg(mean_with_zeros(cells, "value").alias("value"))


def library_sizes(counts: DataFrame) -> DataFrame:
    """Total per sample; NULL for an empty sample."""
    total = F.nullif(total_of(counts, "value"), F.lit(0.0))
    return counts.groupBy(*SAMPLE_KEYS).agg(total.alias("library"))


def log_cpm(counts: DataFrame) -> DataFrame:
    """log2(CPM + 1) of pseudobulk counts; totals are joined, not gathered in a window."""
    value = F.coalesce("value", F.lit(0.0))
    return counts.join(library_sizes(counts), list(SAMPLE_KEYS)).select(
        *SAMPLE_KEYS, "gene", log2_cpm(value, F.col("library")).alias("value")
    )


def assign_cells(cells: DataFrame, cell_samples: DataFrame) -> DataFrame:
    """Measurements under the sample of their cell; unassigned cells drop out."""
    return cells.join(cell_samples, "cell_id").select("study", "sample_id", "gene", "value")


def sum_cohort(labelled: DataFrame, counts: DataFrame, study: str) -> Cohort:
    """Summed counts, stored, with the response and number of cells of their samples."""
    counts = settle(counts, "counts")
    if counts.isEmpty():
        raise ValueError(f"no cell of {study} belongs to a sample, or no gene has a row")
    rolled = roll_up_cells(labelled, F.col("row")).select(
        F.lit(study).alias("study"),
        "sample_id",
        "response",
        "response_binary",
        "n_cells",
        F.lit("pseudobulk RNA counts from single-cell counts").alias("expression_format"),
        F.lit("single_cell_pseudobulk").alias("dataset_role"),
    )
    return Cohort(rolled.join(counts.select("sample_id").distinct(), "sample_id", "left_semi"), counts)


def sum_cells(cells: DataFrame, metadata: DataFrame, study: str, order: str = "row") -> Cohort:
    """Counts of a long cell table (study, cell_id, gene, value) summed per sample."""
    # the ids choose the key and filter the metadata: they are made distinct once
    header = settle(cells.select("cell_id").distinct(), "cell-ids")
    labelled = label_cells(metadata, header, order)
    placed = assign_cells(cells, cell_to_sample(labelled, F.col("row")))
    return sum_cohort(labelled, pseudobulk_sum(placed), study)


def sum_cell_file(
    spark: SparkSession, path: str, metadata: DataFrame, study: str, sep: str = ",", order: str = "row"
) -> Cohort:
    """Counts of a gene x cell text summed per sample."""
    labelled = label_cells(metadata, cell_columns(spark, path, sep), order)
    cells = scan_cell_matrix(spark, path, study, cell_to_sample(labelled, F.col("row")), sep)
    return sum_cohort(labelled, pseudobulk_sum(cells), study)


def to_log_cpm(cohort: Cohort) -> Cohort:
    """The cohort with log2(CPM + 1) instead of counts."""
    named = F.lit("pseudobulk log2(CPM + 1) from single-cell counts")
    return Cohort(cohort.samples.withColumn("expression_format", named), log_cpm(cohort.expr))


def cohort_summary(cohort: Cohort, dataset: str) -> DataFrame:
    """One row: samples, cells, genes and labels of a cohort."""
    n_genes = cohort.expr.select("gene").distinct().agg(F.count(F.lit(1))).scalar()
    cells = [F.sum("n_cells").alias("n_cells_used")] if "n_cells" in cohort.samples.columns else []
    return cohort.samples.agg(
        F.lit(dataset).alias("dataset"),
        F.count(F.lit(1)).alias("n_samples"),
        *cells,
        *label_counts(F.col("response_binary")),
    ).select("*", n_genes.alias("n_genes"))


def cells_of_patients(cell_ids: DataFrame, samples: DataFrame, order: Column) -> DataFrame:
    """(cell_id, sample_id): the patient in the cell id, then that patient's first sample."""
    first = patient_to_sample(samples, order)
    patient = patient_from_cell_id(F.col("cell_id"))
    return (
        cell_ids.select("cell_id", patient.alias("patient_id"))
        .dropna()
        .join(first, "patient_id")
        .select("cell_id", "sample_id")
    )


def normalise_samples(samples: DataFrame) -> DataFrame:
    return samples.withColumns(
        {c: normalise_sample_id(F.col(c)) for c in ("sample_id", "patient_id")}
    )


def mean_cohort(samples: DataFrame, means: DataFrame, order: str = "row") -> Cohort:
    """Averaged measurements, stored, with the first metadata row of their samples."""
    means = settle(means, "means")
    if means.isEmpty():
        raise ValueError("no cell belongs to a sample, or no gene has a row")
    described = first_per_key(
        samples.select(
            "sample_id", "patient_id", "response", "response_binary", "dataset_role", "notes", order
        ).dropna(subset=["sample_id"]),
        ["sample_id"],
        F.col(order),
    ).drop(order)
    return Cohort(described.join(means.select("sample_id").distinct(), "sample_id", "left_semi"), means)


def mean_cells(cells: DataFrame, samples: DataFrame, order: str = "row") -> Cohort:
    """A long cell table (study, cell_id, gene, value) averaged per sample.

    A cell belongs to the first sample of the patient named in its id.
    """
    samples = normalise_samples(samples)
    assigned = cells_of_patients(cells.select("cell_id").distinct(), samples, F.col(order))
    return mean_cohort(samples, pseudobulk_mean(assign_cells(cells, assigned)), order)


def mean_cell_file(
    spark: SparkSession, path: str, samples: DataFrame, study: str, sep: str = "\t", order: str = "row"
) -> Cohort:
    """A gene x cell text averaged per sample, cells found through the patient in their id."""
    samples = normalise_samples(samples)
    assigned = cells_of_patients(cell_columns(spark, path, sep), samples, F.col(order))
    # visit rows and lines of one field stand under the header of such a text
    cells = scan_cell_matrix(spark, path, study, assigned, sep, skip_gene_pattern="^(Pre|Post)_", min_fields=2)
    return mean_cohort(samples, pseudobulk_mean(cells), order)


def fuse_pseudobulk(
    cohorts: dict[str, Cohort], allow_mixed: bool = False
) -> tuple[Cohort, DataFrame]:
    """Union of pseudobulk cohorts on their common genes, and a summary with the total.

    The measures may differ (log CPM of sums, mean TPM), so mixing formats has
    to be allowed by the caller.
    """
    if not allow_mixed and len(cohorts) > 1:
        formats = {
            row[0]
            for cohort in cohorts.values()
            if "expression_format" in cohort.samples.columns
            for row in cohort.samples.select("expression_format").distinct().limit(2).collect()
        }
        undeclared = any("expression_format" not in c.samples.columns for c in cohorts.values())
        if len(formats) != 1 or undeclared:
            raise ValueError("cohorts differ in expression format; pass allow_mixed=True to fuse them")
    sample_parts, expr_parts = [], []
    for source, cohort in cohorts.items():
        key = normalise_sample_id(F.col("sample_id"))
        sample_parts.append(
            cohort.samples.select(
                key.alias("sample_id"), "response", "response_binary", F.lit(source).alias("dataset_source")
            )
        )
        expr_parts.append(
            cohort.expr.select(F.lit(source).alias("study"), key.alias("sample_id"), "gene", "value")
        )
    samples = sample_parts[0]
    expr = expr_parts[0]
    for more_samples, more_expr in zip(sample_parts[1:], expr_parts[1:]):
        samples, expr = samples.unionByName(more_samples), expr.unionByName(more_expr)
    genes = require_genes(common_genes(expr, list(cohorts)), ", ".join(cohorts))
    n_genes = F.lit(genes.count()).cast("bigint")
    n_samples = F.count(F.lit(1)).alias("n_samples")
    summary = (
        samples.groupBy("dataset_source").agg(n_samples)
        .unionByName(samples.agg(F.lit("TOTAL_FUSION").alias("dataset_source"), n_samples))
        .withColumn("n_genes", n_genes)
    )
    return Cohort(samples, on_genes(expr, genes)), summary
