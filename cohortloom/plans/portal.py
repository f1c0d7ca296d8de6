"""Portal studies: sample and patient tables plus a gene x sample matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import add_label
from ..functions.text import first_informative, strip
from ..operators.genes import mean_duplicates
from ..operators.matching import join_patients, reconcile
from ..operators.projection import carry_optional, prefer_order
from ..operators.summaries import label_counts, merge_rows
from ..session import settle
from . import Cohort

PORTAL_COLUMNS = (
    "study",
    "sample_id",
    "patient_id",
    "response",
    "response_binary",
    "treatment",
    "expression_format",
    "dataset_role",
)


@dataclass(frozen=True)
class PortalSpec:
    study: str
    expression_format: str
    response_columns: tuple[str, ...]
    treatment_columns: tuple[str, ...]
    sample_column: str = "SAMPLE_ID"
    patient_column: str = "PATIENT_ID"
    role: str = "cbioportal_bulk_immunotherapy"


# Formats and columns of the four portal studies, and how they are grouped.
PORTAL_SPECS = {
    "CBIO_GIDE_2019": PortalSpec(
        "CBIO_GIDE_2019", "z-score", ("RESPONSE", "CLINICAL_BENEFIT"), ("SAMPLE_TREATMENT",)
    ),
    "CBIO_UCLA_2016": PortalSpec(
        "CBIO_UCLA_2016", "RPKM z-score", ("TREATMENT_RESPONSE", "DURABLE_CLINICAL_BENEFIT"), ("TREATMENT",)
    ),
    "CBIO_DFCI_2019": PortalSpec(
        "CBIO_DFCI_2019", "TPM z-score", ("PFS_STATUS", "OS_STATUS"), ("IO_THERAPY",)
    ),
    "CBIO_LIU_2019": PortalSpec(
        "CBIO_LIU_2019", "TPM z-score", ("RESPONSE", "CLINICAL_BENEFIT"), ("SAMPLE_TREATMENT",)
    ),
}
PORTAL_GROUPS = {
    "CBIOPORTAL_BULK_RECIST_ML_READY": ("CBIO_GIDE_2019", "CBIO_LIU_2019"),
    "CBIOPORTAL_DFCI_PFS_READY": ("CBIO_DFCI_2019",),
    "CBIOPORTAL_UCLA_2016_ENTREZ_READY": ("CBIO_UCLA_2016",),
}


def portal_metadata(spec: PortalSpec, samples: DataFrame, patients: DataFrame) -> DataFrame:
    """Standard columns of a portal study, then its optional clinical columns."""
    clinical = join_patients(samples, patients, spec.patient_column)
    if spec.sample_column not in clinical.columns:
        raise ValueError(f"{spec.study}: sample table has no column {spec.sample_column}")

    def informative(names: tuple[str, ...]):
        return first_informative([F.col(f"`{n}`") for n in names if n in clinical.columns])

    return clinical.select(
        F.lit(spec.study).alias("study"),
        strip(F.col(f"`{spec.sample_column}`")).alias("sample_id"),
        strip(F.col(f"`{spec.patient_column}`")).alias("patient_id"),
        informative(spec.response_columns).alias("response"),
        informative(spec.treatment_columns).alias("treatment"),
        F.lit(spec.expression_format).alias("expression_format"),
        F.lit(spec.role).alias("dataset_role"),
        *carry_optional(clinical, PORTAL_COLUMNS),
    ).transform(add_label, "response", "portal").transform(prefer_order, PORTAL_COLUMNS)


def prepare_portal_study(
    spec: PortalSpec, cells: DataFrame, samples: DataFrame, patients: DataFrame
) -> tuple[Cohort, DataFrame]:
    """A portal study as a cohort, and its summary row.

    ``cells`` is the melted matrix (study, sample_id, gene, value). It is
    averaged and stored once; everything after that reads the stored table.
    """
    metadata = portal_metadata(spec, samples, patients)
    expr = settle(mean_duplicates(cells.withColumn("sample_id", strip(F.col("sample_id")))), "expr")
    ids = expr.select("sample_id").distinct()
    clean = metadata.join(ids, "sample_id", "left_semi")
    measured = expr.join(metadata.select("sample_id").distinct(), "sample_id", "left_semi")
    dataset = F.lit(spec.study).alias("dataset")
    n_rows = F.count(F.lit(1))
    summary = merge_rows(
        "dataset",
        [
            clean.agg(
                dataset,
                F.lit(spec.expression_format).alias("expression_format"),
                n_rows.alias("n_clean_samples"),
                *label_counts(F.col("response_binary"), "n_response_binary"),
            ),
            reconcile(metadata, ids, "sample_id").agg(
                dataset,
                F.count_if(~F.col("in_right")).alias("n_missing_samples_from_expression"),
                F.count_if(~F.col("in_left")).alias("n_expression_samples_without_metadata"),
                F.count_if("in_right").alias("n_expression_samples"),
            ),
            expr.select("gene").distinct().agg(dataset, n_rows.alias("n_expression_genes")),
            metadata.agg(dataset, n_rows.alias("n_clinical_samples")),
        ],
    )
    return Cohort(clean, measured), summary
