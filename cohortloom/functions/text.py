"""Text cleaning and id parsing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import BLANKS, UNINFORMATIVE, VISIT_SUFFIXES


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def clean_text(text: Column, keep_empty: bool = False) -> Column:
    """Drop double quotes and outer blanks; an empty rest becomes NULL unless kept."""
    cleaned = strip(F.replace(text, F.lit('"')))
    return cleaned if keep_empty else F.nullif(cleaned, F.lit(""))


def clean_gene_symbol(text: Column) -> Column:
    """Strip a gene symbol; empty and ``nan`` become NULL."""
    symbol = strip(text)
    return F.when(~F.lower(symbol).isin("", "nan"), symbol)


def clean_gene_id(text: Column) -> Column:
    """Clean a gene id and drop the version of an Ensembl id."""
    gene = clean_gene_symbol(F.replace(text, F.lit('"')))
    return drop_ensembl_version(gene)


def drop_ensembl_version(gene: Column) -> Column:
    return F.when(gene.startswith("ENSG"), F.split_part(gene, F.lit("."), F.lit(1))).otherwise(gene)


def drop_visit_suffix(patient: Column) -> Column:
    """``Pt1.baseline`` and ``Pt1.OnTx`` both become ``Pt1``."""
    for suffix in VISIT_SUFFIXES:
        patient = F.replace(patient, F.lit(suffix))
    return strip(patient)


def parse_visit_column(name: Column, study: str) -> Column:
    """``Patient 3 Post-RAF/MEKi`` -> struct(patient_id, treatment_phase, therapy_type), else NULL."""
    pattern = r"(?U)^Patient\s+(\d+)\s+(Pre|Post)-(.+)"
    label = strip(name)
    therapy = F.when(
        F.upper(F.regexp_extract(label, pattern, 3)).contains("MEK"), "RAF_MEKi"
    ).otherwise("RAFi")
    return F.when(
        label.rlike(pattern),
        F.struct(
            F.concat(F.lit(f"{study}_Patient_"), F.regexp_extract(label, pattern, 1)).alias("patient_id"),
            F.regexp_extract(label, pattern, 2).alias("treatment_phase"),
            therapy.alias("therapy_type"),
        ),
    )


def bracket_sample(title: Column) -> Column:
    """``EX99 [pt5]`` -> ``EX99``."""
    return strip(F.split_part(clean_text(title), F.lit("["), F.lit(1)))


def bracket_patient(title: Column) -> Column:
    """``EX99 [pt5]`` -> ``pt5``; NULL without brackets."""
    pattern = r"\[(.*?)\]"
    title = clean_text(title)
    return F.when(title.rlike(pattern), strip(F.regexp_extract(title, pattern, 1)))


def split_sample_class(text: Column) -> Column:
    """``PRE SR`` -> struct(timepoint, response); a single word has no response."""
    text = clean_text(text)
    words = F.split(text, r"(?U)\s+")
    return F.struct(
        F.get(words, F.lit(0)).alias("timepoint"),
        F.get(words, F.lit(1)).alias("response"),
    )


def split_visit_prefix(text: Column) -> Column:
    """``Pre_P1`` -> struct(timepoint ``PRE``, patient_id ``P1``); no ``_`` -> only a patient."""
    text = clean_text(text)
    parts = F.split(text, "_", 2)
    prefixed = text.contains("_")
    return F.struct(
        F.when(prefixed, F.upper(F.get(parts, F.lit(0)))).alias("timepoint"),
        F.when(prefixed, F.get(parts, F.lit(1))).otherwise(text).alias("patient_id"),
    )


def patient_from_description(text: Column, prefix: str = "MGH") -> Column:
    """``MGH Patient 200`` -> ``MGH200``."""
    rest = strip(F.replace(clean_text(text), F.lit(f"{prefix} Patient")))
    rest = F.replace(rest, F.lit(" "))
    return F.when(rest.startswith(prefix), rest).otherwise(F.concat(F.lit(prefix), rest))


def sample_join_key(sample: Column) -> Column:
    """Key under which differently written sample ids meet: no ``.bam``/``_bam``, ``-`` as ``_``."""
    key = F.replace(F.replace(strip(sample), F.lit(".bam")), F.lit("_bam"))
    return F.translate(key, "-", "_")


def normalise_sample_id(sample: Column) -> Column:
    return F.translate(strip(sample), " ", "_")


def patient_from_cell_id(cell: Column) -> Column:
    """``A10_P3_M11`` -> ``P3``: first ``P<digits>`` token, else a second token starting with ``P``."""
    cell = strip(cell)
    numbered = F.nullif(F.regexp_extract(cell, r"(?U)(?:^|_)(P\d+)(?=_|$)", 1), F.lit(""))
    second = F.split_part(cell, F.lit("_"), F.lit(2))
    return F.when(
        cell.contains("_"), F.coalesce(numbered, F.when(second.startswith("P"), second))
    )


def attribute_slug(first_value: Column) -> Column:
    """Column name of a characteristics line, from the label of its first value."""
    label = F.lower(strip(F.split_part(first_value, F.lit(":"), F.lit(1))))
    return F.when(
        first_value.contains(":"),
        F.concat(F.lit("characteristics_"), F.translate(label, " /-()", "___")),
    ).otherwise("characteristics_unknown")


def attribute_key(key: Column) -> Column:
    """``!Sample_title`` -> ``title``."""
    return F.lower(F.replace(key, F.lit("!Sample_")))


def after_first_colon(text: Column) -> Column:
    """Text after the first colon; the text itself when there is none."""
    return F.when(text.contains(":"), strip(F.get(F.split(text, ":", 2), F.lit(1)))).otherwise(text)


def after_last_colon(text: Column) -> Column:
    return strip(F.element_at(F.split(text, ":"), -1))


def first_informative(columns: Sequence[Column]) -> Column:
    """First of several columns that says something (not blank, nan, na, n/a, unknown)."""
    cleaned = [clean_text(c) for c in columns]
    return F.coalesce(*[F.when(~F.lower(c).isin(*UNINFORMATIVE), c) for c in cleaned], F.lit(None).cast("string"))


def compose_note(parts: Sequence[tuple[str, Column]]) -> Column:
    """``k=v; k=v``; a missing value is shown as ``nan``."""
    return F.concat_ws(
        "; ",
        *[F.concat(F.lit(f"{key}="), F.coalesce(value, F.lit("nan"))) for key, value in parts],
    )


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when the text contains one of a fixed list of words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit
