"""Sample metadata: attribute lines to one standard table for all cohorts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import add_label
from ..functions.text import (
    bracket_patient,
    bracket_sample,
    compose_note,
    patient_from_description,
    split_sample_class,
    split_visit_prefix,
)
from ..operators.projection import column_or_null, conform
from ..operators.summaries import group_sizes
from ..sources.attributes import named_attributes, pivot_attributes, scan_attribute_lines


@dataclass(frozen=True)
class MetadataSpec:
    """How the extracted columns of one study map to the standard ones.

    ``derive`` gets the table and returns standard columns; ``role`` and
    ``notes`` are constants; ``fixed_label`` replaces the label policy for a
    cohort selected by outcome.
    """

    study: str
    role: str
    derive: object = field(repr=False)
    notes: str | None = None
    fixed_label: int | None = None


def extract_metadata(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """One row per sample of one or many attribute-line files, one column per attribute of any of them; one scan."""
    return pivot_attributes(named_attributes(scan_attribute_lines(spark, path)), names)


def standardise_metadata(table: DataFrame, spec: MetadataSpec) -> DataFrame:
    """The standard columns of a study; what the study lacks is NULL."""
    columns: dict[str, Column] = {
        "platform": column_or_null(table, "platform_id"),
        "sample_id": column_or_null(table, "title"),
        "geo_accession": column_or_null(table, "geo_accession"),
        "notes": F.lit(spec.notes).cast("string"),
        **spec.derive(table),
    }
    columns.setdefault("response", F.lit(None).cast("string"))
    standard = table.select(
        F.lit(spec.study).alias("study"),
        F.lit(spec.role).alias("dataset_role"),
        *[value.alias(name) for name, value in columns.items()],
    )
    if spec.fixed_label is None:
        standard = add_label(standard, "response", "responder")
    else:
        standard = standard.withColumn("response_binary", F.lit(spec.fixed_label))
    return conform(standard)


def union_metadata(tables: Sequence[DataFrame]) -> DataFrame:
    return conform(reduce(DataFrame.unionByName, tables))


def metadata_summary(metadata: DataFrame) -> DataFrame:
    return group_sizes(metadata, ["study", "dataset_role", "response", "response_binary"])


def _immunotherapy(table: DataFrame) -> dict[str, Column]:
    return {
        "patient_id": patient_from_description(column_or_null(table, "description")),
        "treatment": column_or_null(table, "characteristics_antibody"),
        "timepoint": column_or_null(table, "characteristics_treatment_state"),
        "response": column_or_null(
            table, "characteristics_response_immune_checkpoint_blockade_therapy"
        ),
        "notes": column_or_null(table, "characteristics_timepoint_days"),
    }


def _targeted(table: DataFrame) -> dict[str, Column]:
    title = column_or_null(table, "title")
    sample_class = split_sample_class(column_or_null(table, "characteristics_sample_class"))
    return {
        "sample_id": bracket_sample(title),
        "patient_id": bracket_patient(title),
        "treatment": column_or_null(table, "characteristics_drug"),
        "timepoint": sample_class["timepoint"],
        "response": sample_class["response"],
        "notes": column_or_null(
            table, "characteristics_pt_id_tm_id_according_to_table_s4,_pubmed_id_35643181"
        ),
    }


def _resistant(table: DataFrame) -> dict[str, Column]:
    return {
        "patient_id": column_or_null(table, "title"),
        "treatment": column_or_null(table, "characteristics_treatment"),
        "timepoint": F.lit("resistant"),
        "response": F.lit("resistant"),
        "notes": compose_note(
            [
                ("gender", column_or_null(table, "characteristics_gender")),
                ("stage", column_or_null(table, "characteristics_stage")),
                ("prior_ctla4i", column_or_null(table, "characteristics_prior.ctla4i")),
                ("previous_brafi", column_or_null(table, "characteristics_previous._brafi")),
            ]
        ),
    }


def _single_cell(table: DataFrame) -> dict[str, Column]:
    visit = split_visit_prefix(
        column_or_null(table, "characteristics_patient_id_pre=baseline;_post=on_treatment")
    )
    return {
        "patient_id": visit["patient_id"],
        "treatment": column_or_null(table, "characteristics_therapy"),
        "timepoint": visit["timepoint"],
        "response": column_or_null(table, "characteristics_response"),
    }


# The four cohorts with their roles.
COHORT_SPECS = {
    "GSE168204": MetadataSpec("GSE168204", "extra_immunotherapy_response", _immunotherapy),
    "GSE196434": MetadataSpec("GSE196434", "targeted_therapy_response", _targeted),
    "GSE244982": MetadataSpec("GSE244982", "immunotherapy_resistance", _resistant, fixed_label=0),
    "GSE120575": MetadataSpec(
        "GSE120575", "single_cell_immunotherapy_response", _single_cell, notes="single_cell"
    ),
}
