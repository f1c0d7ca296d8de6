"""Bulk cohorts: conversion, clinical join, alignment and union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Literal, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import drop_visit_suffix, parse_visit_column, sample_join_key
from ..operators.genes import (
    SAMPLE_KEYS,
    apply_gene_map,
    common_genes,
    ensembl_aliases,
    entrez_aliases,
    first_symbol_map,
    gene_overlap,
    last_symbol_map,
    mean_duplicates,
    on_genes,
    preferred_symbol_aliases,
    require_genes,
    symbol_aliases,
)
from ..operators.matching import join_on_sample_key, reconcile, sample_pairs
from ..operators.summaries import distinct_texts, label_counts, mean_of_numeric_samples, merge_rows
from . import Cohort


class MergedCohorts(NamedTuple):
    samples: DataFrame
    expr: DataFrame
    genes: DataFrame

    def ml_ready(self) -> DataFrame:
        """Sample rows with the identifying columns and the label only."""
        return self.samples.select("sample_id", "patient_id", "study", "response", "survival_event")


def samples_of(expr: DataFrame) -> DataFrame:
    return expr.select(*SAMPLE_KEYS).distinct()


def matrix_to_samples(cells: DataFrame) -> Cohort:
    """A scanned gene x sample sheet as a cohort; the patient is the sample without its visit."""
    expr = mean_duplicates(cells)
    patient = drop_visit_suffix(F.col("sample_id"))
    return Cohort(samples_of(cells).withColumn("patient_id", patient), expr)


def visit_cohort(
    cells: DataFrame, study: str, category: str = "targeted_therapy"
) -> Cohort:
    """A pre/post matrix as a cohort; visit and therapy come from the column names.

    As the mean is taken over numeric columns only, a sample with a single
    text that is no number is left out.
    """
    visit = parse_visit_column(F.col("sample_id"), study)
    expr = mean_of_numeric_samples(cells.filter(visit.isNotNull()))
    samples = (
        samples_of(expr)
        .withColumn("visit", visit)
        .select(*SAMPLE_KEYS, "visit.*", F.lit(category).alias("treatment_category"))
    )
    return Cohort(samples, expr)


def gene_map(alias: DataFrame, unmatched: Literal["drop", "keep"]) -> DataFrame:
    """(id, symbol) from an alias table (protein_id, alias, source, row).

    ``drop`` maps numeric ids and lets the latest symbol win; ``keep`` maps
    Ensembl ids and lets the first symbol win.
    """
    if unmatched == "drop":
        return last_symbol_map(entrez_aliases(alias), symbol_aliases(alias))
    return first_symbol_map(ensembl_aliases(alias), preferred_symbol_aliases(alias))


def convert_gene_ids(
    expr: DataFrame, alias: DataFrame, unmatched: Literal["drop", "keep"]
) -> DataFrame:
    """Symbols instead of gene ids, one value per sample and symbol."""
    return mean_duplicates(apply_gene_map(expr, gene_map(alias, unmatched), unmatched))


def merge_cohorts(
    expr: DataFrame, clinical: DataFrame, score: DataFrame | None, studies: Sequence[str]
) -> MergedCohorts:
    """Union of cohorts on their common genes, with clinical data and label.

    Clinical columns and the score are joined to the samples, not to the
    measurements: the long table is only filtered. A sample needs a clinical
    row of its study with a label; the score is optional and matched by
    patient alone. Genes are stored, so that the filter on the long table
    knows their size; ``expr`` is read three times and is best a stored table
    itself.
    """
    genes = require_genes(common_genes(expr, studies), ", ".join(studies))
    members = samples_of(expr.filter(F.col("study").isin(*studies)))
    samples = members.withColumn("patient_id", drop_visit_suffix(F.col("sample_id"))).join(
        clinical.dropna(subset=["survival_event"]), ["patient_id", "study"]
    )
    if score is not None:
        samples = samples.join(score, "patient_id", "left")
    samples = samples.withColumn("survival_event", F.col("survival_event").cast("int"))
    kept = on_genes(expr, genes).join(
        samples.select(*SAMPLE_KEYS).distinct(), list(SAMPLE_KEYS), "left_semi"
    )
    return MergedCohorts(samples, kept, genes)


def align_to_genes(expr: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Measurements on a target gene list, and the overlap per study; fails if no gene is on the list."""
    aligned = on_genes(expr, genes)
    if aligned.isEmpty():
        raise ValueError("no common gene found between the measurements and the gene list")
    return aligned, gene_overlap(genes, expr)


def attach_metadata(expr: DataFrame, metadata: DataFrame) -> Cohort:
    """Metadata and measurements of the samples both sides have, under the metadata id.

    Measured ids that are spellings of one sample stay apart, as ``sample_pairs`` names them, each with the metadata.
    """
    pairs = sample_pairs(metadata, expr)
    named = pairs.select(F.col("meta_id").alias("_meta_id"), F.col("sample_id").alias("_sample_id"))
    samples = (
        metadata.join(named, metadata["sample_id"] == F.col("_meta_id"))
        .withColumn("sample_id", F.col("_sample_id")).select(*metadata.columns)
    )
    return Cohort(samples, join_on_sample_key(pairs, expr))


def reconcile_samples(metadata: DataFrame, expr: DataFrame) -> DataFrame:
    """(sample_key, in_left, in_right): ids of the metadata (left) and of the measurements (right)."""
    key = sample_join_key(F.col("sample_id")).alias("sample_key")
    return reconcile(metadata.select(key), expr.select("sample_id").distinct().select(key), "sample_key")


def merge_labelled_studies(
    cohorts: dict[str, Cohort], drop_missing: bool = True
) -> tuple[Cohort, DataFrame]:
    """Union of studies on their common genes, and one summary row per study.

    Genes are those that every dataset has, in whatever sample. Datasets are
    told apart by their names here; the study column, which may name something
    else, is filled in where it is missing. Samples without label are dropped
    on request.
    """

    def named(table: DataFrame, name: str) -> DataFrame:
        return table.withColumn("study", F.coalesce("study", F.lit(name)) if "study" in table.columns else F.lit(name))

    parts, owned = [], []
    for name, cohort in cohorts.items():
        samples = named(cohort.samples, name).withColumn("_dataset", F.lit(name))
        if drop_missing:
            samples = samples.dropna(subset=["response_binary"])
        all_expr = named(cohort.expr, name)
        owned.append(all_expr.select(F.lit(name).alias("study"), "gene"))
        parts.append(Cohort(samples, all_expr.join(samples.select(*SAMPLE_KEYS), list(SAMPLE_KEYS), "left_semi")))
    samples = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.samples for p in parts]
    )
    expr = reduce(DataFrame.unionByName, [p.expr for p in parts])
    genes = require_genes(common_genes(reduce(DataFrame.unionByName, owned), list(cohorts)), ", ".join(cohorts))
    n_genes = genes.count()
    dataset = F.col("_dataset").alias("source_dataset")
    summary = samples.groupBy(dataset).agg(F.count(F.lit(1)).alias("n_samples"), *label_counts(F.col("response_binary")))
    if "expression_format" in samples.columns:
        # made distinct before anything is gathered
        formats = samples.select(dataset, "expression_format").distinct().groupBy("source_dataset")
        texts = formats.agg(distinct_texts(F.col("expression_format")).alias("expression_formats"))
        summary = merge_rows("source_dataset", [summary, texts])
    else:
        summary = summary.withColumn("expression_formats", F.lit(None).cast("string"))
    summary = summary.withColumn("n_common_genes", F.lit(n_genes).cast("bigint"))
    return Cohort(samples.drop("_dataset"), on_genes(expr, genes)), summary
