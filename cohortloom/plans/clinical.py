"""Clinical tables: one row per patient and study, with the outcome label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import CLINICAL_COLUMNS
from ..functions.labels import add_label, label
from ..functions.numeric import to_number
from ..functions.text import clean_text, drop_visit_suffix
from ..operators.ordering import first_per_key
from ..operators.projection import column_or_null, conform
from ..sources.attributes import extract_labelled_attributes


def clinical_from_table(table: DataFrame, study: str | Column) -> DataFrame:
    """Clinical rows of a cleaned table with ``patient_id`` and optional response or event.

    The label comes from ``survival_event`` when the table has that column,
    otherwise from the response under policy ``main``. ``study`` is a name, or
    a column of a table that holds several studies.
    """
    if "patient_id" not in table.columns:
        raise ValueError(f"clinical table of {study} has no column patient_id")
    if "survival_event" in table.columns:
        event = to_number(F.col("survival_event").cast("string")).cast("int")
    else:
        event = label(F.col("response"), "main")
    return (
        table.withColumns(
            {
                "patient_id": clean_text(F.col("patient_id").cast("string"), keep_empty=True),
                "response": clean_text(column_or_null(table, "response"), keep_empty=True),
                "study": F.lit(study) if isinstance(study, str) else study,
            }
        )
        .withColumn("survival_event", event)
        .select(
            "patient_id", "response", "survival_event",
            F.col("survival_event").alias("response_binary"), "study", "row",
        )
    )


def clinical_from_attributes(lines: DataFrame, study: str) -> DataFrame:
    """Clinical rows of the attribute lines of one cohort."""
    return (
        extract_labelled_attributes(lines)
        .transform(add_label, "response", "main")
        .withColumns(
            {
                "patient_id": drop_visit_suffix(F.col("patient_id")),
                "survival_event": F.col("response_binary"),
                "study": F.lit(study),
            }
        )
        .withColumnRenamed("sample_idx", "row")
    )


def build_clinical(cohorts: dict[str, DataFrame]) -> DataFrame:
    """Union of clinical rows; the first row of a patient counts. No study is in two entries.

    Rows without a patient id are left out: they can match nothing.
    """
    parts = [
        conform(
            first_per_key(rows.dropna(subset=["patient_id"]), ["patient_id", "study"], F.col("row")),
            CLINICAL_COLUMNS,
        )
        for rows in cohorts.values()
    ]
    return reduce(DataFrame.unionByName, parts)
