"""Whole runs from raw files to stored datasets, one per family of cohorts.

Each run takes the paths of its inputs by name and an output folder, writes
its tables below that folder and returns what the next run needs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cohort import Cohort
from ..functions.fixed_values import (
    ATTRIBUTE_KEYWORDS,
    EXTRA_GENE_COLUMNS,
    PORTAL_GENE_COLUMNS,
    TARGETED_GENE_COLUMNS,
)
from ..functions.numeric import to_number
from ..functions.text import clean_gene_symbol, clean_text, strip
from ..operators.genes import SAMPLE_KEYS, gene_index, gene_overlap, mean_duplicates
from ..operators.summaries import group_sizes, matches_keywords, merge_rows, stack
from ..session import settle
from ..sinks.features import to_features
from ..sinks.tables import read_cohort, summary_rows, write_cohort, write_table
from ..sources.attributes import named_attributes, pivot_attributes, scan_attribute_lines
from ..sources.matrix import scan_matrix_long, scan_wide_dataset
from ..sources.tables import detect_separator, read_alias, scan_table
from .cells import cohort_summary, fuse_pseudobulk, mean_cell_file, sum_cell_file, to_log_cpm
from .clinical import build_clinical, clinical_from_attributes, clinical_from_table
from .cohorts import (
    align_to_genes,
    attach_metadata,
    convert_gene_ids,
    merge_cohorts,
    merge_labelled_studies,
    reconcile_samples,
    visit_cohort,
)
from .metadata import (
    COHORT_SPECS,
    metadata_summary,
    standardise_metadata,
    union_metadata,
)
from .portal import PORTAL_GROUPS, PORTAL_SPECS, prepare_portal_study

# The two cohorts of the main dataset, the pre/post cohort, the two single-cell sources.
MAIN_STUDIES = ("GSE91061", "GSE78220")
VISIT_STUDY = "GSE77940"
CELL_STUDIES = ("MENDELEY", "GSE120575")
# Fixed value: the study column of the first single-cell source; its name as a dataset is shorter.
CELL_STUDY = "MENDELEY_MELANOMA_CITESEQ"
# Fixed value: the extra cohort whose gene column has its own name.
TARGETED_STUDY = "GSE196434"


def main_dataset(spark: SparkSession, paths: Mapping[str, str], out: str) -> DataFrame:
    """Two cohorts on their common genes with label; returns the stored gene index.

    Paths: ``clinical_table``, ``clinical_attributes``, ``numeric_matrix`` (samples in
    rows, numeric gene ids), ``symbol_matrix`` (genes in rows), ``alias``, ``score``.
    """
    first, second = MAIN_STUDIES
    table = scan_table(spark, paths["clinical_table"], with_row=True).withColumnRenamed("_row", "row")
    clinical = build_clinical(
        {
            first: clinical_from_table(table, first),
            second: clinical_from_attributes(scan_attribute_lines(spark, paths["clinical_attributes"]), second),
        }
    )
    write_table(clinical, f"{out}/clinical")
    numeric = scan_wide_dataset(spark, paths["numeric_matrix"], ["patient_id"], "patient_id", first)
    symbols = scan_matrix_long(
        spark, paths["symbol_matrix"], second, detect_separator(spark, paths["symbol_matrix"]),
        clean_gene=strip,
    )
    converted = convert_gene_ids(numeric.expr, read_alias(spark, paths["alias"]), "drop")
    expr = settle(converted.unionByName(mean_duplicates(symbols)), "expr")
    score = scan_table(spark, paths["score"], sep="\t").toDF("patient_id", "cytolytic_score")
    score = score.select(
        strip(F.replace(F.col("patient_id"), F.lit('"'), F.lit(""))).alias("patient_id"),
        to_number(F.col("cytolytic_score")).alias("cytolytic_score"),
    )
    merged = merge_cohorts(expr, spark.read.parquet(f"{out}/clinical"), score, MAIN_STUDIES)
    write_cohort(Cohort(merged.samples, merged.expr), f"{out}/main")
    write_table(gene_index(merged.genes), f"{out}/main_genes")
    genes = spark.read.parquet(f"{out}/main_genes")
    write_ml_ready(Cohort(merged.ml_ready(), read_cohort(spark, f"{out}/main").expr), genes, f"{out}/main_ml_ready")
    return genes


def write_ml_ready(cohort: Cohort, genes: DataFrame, path: str) -> None:
    """One row per sample with its describing columns and its values on the genes (``features``, by gene index)."""
    features = to_features(cohort.expr, genes)
    write_table(cohort.samples.join(features, list(SAMPLE_KEYS)), path)


def visit_dataset(spark: SparkSession, path: str, main_genes: DataFrame, out: str) -> DataFrame:
    """The pre/post cohort, whole and on the main genes; returns the samples per visit and therapy."""
    cells = scan_matrix_long(
        spark, path, VISIT_STUDY, detect_separator(spark, path), "Gene Symbol",
        sample_pattern=r"^\s*Patient\s+\d+\s+(Pre|Post)-", clean_gene=clean_gene_symbol,
    )
    write_cohort(visit_cohort(cells, VISIT_STUDY), f"{out}/visits")
    cohort = read_cohort(spark, f"{out}/visits")
    aligned, _ = align_to_genes(cohort.expr, main_genes)
    write_cohort(Cohort(cohort.samples, aligned), f"{out}/visits_aligned")
    write_ml_ready(Cohort(cohort.samples, aligned), main_genes, f"{out}/visits_ml_ready")
    return group_sizes(
        cohort.samples, ["study", "treatment_category", "therapy_type", "treatment_phase"]
    )


def metadata_tables(spark: SparkSession, paths: Mapping[str, list[str]], out: str) -> DataFrame:
    """Standard metadata of the extra cohorts from their attribute files; returns the stored union.

    ``paths`` lists the attribute files of each study. All files of a study
    are read in one scan; what becomes columns and figures is read from its
    stored result.
    """
    tables, summaries = [], []
    for study, files in paths.items():
        named = settle(named_attributes(scan_attribute_lines(spark, files)), "attributes")
        relevant = F.when(matches_keywords(F.col("name"), ATTRIBUTE_KEYWORDS), F.col("name"))
        summaries.append(
            named.groupBy(F.lit(study).alias("dataset"), "file").agg(
                F.count_distinct("sample_idx").alias("n_samples"),
                F.count_distinct("name").alias("n_columns"),
                F.array_join(F.array_sort(F.collect_set(relevant)), "; ").alias("relevant_columns"),
            )
        )
        tables.append(standardise_metadata(pivot_attributes(named), COHORT_SPECS[study]))
    write_table(union_metadata(tables), f"{out}/metadata", partition_by=["study"])
    stored = spark.read.parquet(f"{out}/metadata")
    write_table(stack(summaries), f"{out}/metadata_files")
    write_table(metadata_summary(stored), f"{out}/metadata_summary")
    return stored


def extra_dataset(
    spark: SparkSession, path: str, study: str, metadata: DataFrame, main_genes: DataFrame, out: str,
    alias: DataFrame | None = None,
) -> DataFrame:
    """One extra bulk cohort, whole and on the main genes; returns its summary row.

    With an alias table, Ensembl ids become symbols where one is known.
    """
    candidates = TARGETED_GENE_COLUMNS if study == TARGETED_STUDY else EXTRA_GENE_COLUMNS
    scanned = scan_matrix_long(
        spark, path, study, detect_separator(spark, path), drop_columns=(), gene_candidates=candidates
    )
    cells = scanned.drop("raw", "gene_row")
    converted = convert_gene_ids(cells, alias, "keep") if alias is not None else mean_duplicates(cells)
    expr = settle(converted, "expr")
    described = metadata.filter(F.col("study") == study)
    write_cohort(attach_metadata(expr, described), f"{out}/{study}")
    cohort = read_cohort(spark, f"{out}/{study}")
    aligned, _ = align_to_genes(cohort.expr, main_genes)
    write_cohort(Cohort(cohort.samples, aligned), f"{out}/{study}_aligned")
    write_ml_ready(Cohort(cohort.samples, aligned), main_genes, f"{out}/{study}_ml_ready")
    dataset, n_rows = F.lit(study).alias("dataset"), F.count(F.lit(1))
    return merge_rows(
        "dataset",
        [
            described.agg(dataset, n_rows.alias("n_metadata_samples")),
            cohort.samples.agg(dataset, n_rows.alias("n_clean_samples")),
            scanned.agg(
                dataset,
                F.count_distinct("gene_row").alias("n_expression_rows_raw"),
                (F.count_distinct("sample_id") + 1).alias("n_expression_cols_raw"),
            ),
            reconcile_samples(described, expr).agg(
                dataset,
                F.count_if(~F.col("in_right")).alias("n_missing_samples_from_expression"),
                F.count_if(~F.col("in_left")).alias("n_expression_samples_without_metadata"),
            ),
            gene_overlap(main_genes, cohort.expr).withColumnRenamed("study", "dataset"),
        ],
    )


def portal_datasets(spark: SparkSession, paths: Mapping[str, Mapping[str, str]], out: str) -> DataFrame:
    """The portal studies and their merged groups; returns the summary of the studies.

    ``paths`` gives ``expression``, ``samples`` and ``patients`` of each study. A study
    that fails is reported in the summary, and a group that lacks a study is left out.
    """

    def prepare(study: str):
        files = paths[study]
        cells = scan_matrix_long(
            spark, files["expression"], study, "\t", clean_gene=clean_text, comment="#",
            gene_candidates=PORTAL_GENE_COLUMNS,
        )
        tables = [scan_table(spark, files[kind], sep="\t", comment="#") for kind in ("samples", "patients")]
        cohort, summary = prepare_portal_study(PORTAL_SPECS[study], cells, *tables)
        write_cohort(cohort, f"{out}/{study}")
        return summary.drop("dataset")

    summary = summary_rows(spark, {study: (lambda s=study: prepare(s)) for study in paths})
    done = {row.dataset for row in summary.select("*").collect() if not row.asDict().get("error")}
    merged = []
    for name, studies in PORTAL_GROUPS.items():
        if set(studies) <= done:
            cohort, rows = merge_labelled_studies({s: read_cohort(spark, f"{out}/{s}") for s in studies})
            write_cohort(cohort, f"{out}/{name}")
            stored = read_cohort(spark, f"{out}/{name}")
            write_ml_ready(stored, gene_index(stored.expr), f"{out}/{name}_ml_ready")
            merged.append(rows.withColumn("merged_dataset", F.lit(name)))
    if merged:
        write_table(stack(merged), f"{out}/portal_merged_summary")
    return summary


def cell_datasets(spark: SparkSession, paths: Mapping[str, str], samples: DataFrame, out: str) -> DataFrame:
    """Both single-cell sources as pseudobulk, and their fusion; returns the summary of the fusion.

    Paths: ``counts`` and ``cell_metadata`` (comma), ``tpm`` (tab). ``samples`` is the
    standard metadata of the TPM study with a column ``row``.
    """
    first, second = CELL_STUDIES
    metadata = scan_table(spark, paths["cell_metadata"], with_row=True).withColumnRenamed("_row", "row")
    counts = sum_cell_file(spark, paths["counts"], metadata, CELL_STUDY)
    write_cohort(counts, f"{out}/{first}_counts")
    counts = read_cohort(spark, f"{out}/{first}_counts")
    write_cohort(to_log_cpm(counts), f"{out}/{first}_log_cpm")
    write_table(cohort_summary(counts, first), f"{out}/{first}_summary")
    write_cohort(mean_cell_file(spark, paths["tpm"], samples, second), f"{out}/{second}_mean_tpm")
    write_table(cohort_summary(read_cohort(spark, f"{out}/{second}_mean_tpm"), second), f"{out}/{second}_summary")
    fused, summary = fuse_pseudobulk(
        {
            first: read_cohort(spark, f"{out}/{first}_log_cpm"),
            second: read_cohort(spark, f"{out}/{second}_mean_tpm"),
        },
        allow_mixed=True,
    )
    write_cohort(fused, f"{out}/single_cell")
    stored = read_cohort(spark, f"{out}/single_cell")
    by_source = stored.samples.withColumnRenamed("dataset_source", "study")
    write_ml_ready(Cohort(by_source, stored.expr), gene_index(stored.expr), f"{out}/single_cell_ml_ready")
    write_table(summary, f"{out}/single_cell_summary")
    return spark.read.parquet(f"{out}/single_cell_summary")
