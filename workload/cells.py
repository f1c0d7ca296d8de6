"""Queries on single-cell measurements."""

from pyspark.sql import functions as F

from cohortloom.plans import Cohort
from cohortloom.plans.cells import (
    cohort_summary,
    fuse_pseudobulk,
    label_cells,
    log_cpm,
    mean_cells,
    pseudobulk_mean,
    pseudobulk_sum,
    roll_up_cells,
    sum_cells,
    to_log_cpm,
)
from cohortloom.operators.matching import cell_to_sample

from .mapping import CELL_VALUES, EVENT_KEY, cell_values, event_key, exact_sum
from .registry import Tables, query

PSEUDOBULK = f"""
    SELECT study, sample_id, gene, coalesce({exact_sum('value')}, 0.0) AS value
    FROM ({CELL_VALUES}) GROUP BY study, sample_id, gene
"""


@query("pseudobulk_sum", PSEUDOBULK)
def summed_cells(t: Tables):
    return pseudobulk_sum(cell_values(t))


@query(
    "log_cpm",
    f"""
    SELECT study, sample_id, gene, round(log2(value / library * 1000000 + 1), 6) AS value
    FROM ({PSEUDOBULK}) JOIN (
        SELECT sample_id, {exact_sum('value')} AS library FROM ({PSEUDOBULK}) GROUP BY sample_id) USING (sample_id)
    """,
)
def log_cpm_of_cells(t: Tables):
    counts = log_cpm(pseudobulk_sum(cell_values(t)))
    return counts.withColumn("value", F.round("value", 6))


@query(
    "pseudobulk_mean",
    f"""
    SELECT study, sample_id, gene, coalesce({exact_sum('value')}, 0.0) / count(*) AS value
    FROM ({CELL_VALUES}) GROUP BY study, sample_id, gene
    """,
)
def averaged_cells(t: Tables):
    return pseudobulk_mean(cell_values(t))


def cell_metadata(t: Tables):
    """Two metadata rows per cell, some of them without a usable sample."""
    key = event_key()
    sample = F.expr(
        """CASE WHEN event_id % 13 = 0 THEN 'Doublet' WHEN event_id % 13 = 1 THEN concat(user_id, '/1')
           ELSE concat('S', user_id, ' ') END"""
    )
    return t.events.select(
        F.col("event_type").alias("batch"),
        F.expr("event_id div 2").alias("barcode"),
        sample.alias("sample"),
        F.when(key % 3 == 1, "PD").when(key % 3 == 2, "Complete Response").alias("RECIST"),
        F.col("event_id").alias("row"),
    )


def cell_header(t: Tables):
    return t.events.select(F.col("event_id").cast("string").alias("cell_id"))


LABELLED_CELLS = f"""
    SELECT CAST(event_id // 2 AS VARCHAR) AS cell_id, 'S' || user_id AS sample_id,
           CASE {EVENT_KEY} % 3 WHEN 1 THEN 'PD' WHEN 2 THEN 'Complete Response' END AS response,
           CASE {EVENT_KEY} % 3 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS response_binary, event_id AS row
    FROM events WHERE event_id % 13 > 1
"""


@query("label_cells", LABELLED_CELLS)
def labelled_cells(t: Tables):
    return label_cells(cell_metadata(t), cell_header(t))


@query(
    "cell_rollup",
    f"""
    SELECT sample_id, count(*) AS n_cells, arg_min(response, row) FILTER (WHERE response IS NOT NULL) AS response,
           arg_min(response_binary, row) FILTER (WHERE response_binary IS NOT NULL) AS response_binary
    FROM ({LABELLED_CELLS}) GROUP BY sample_id
    """,
)
def cells_rolled_up(t: Tables):
    return roll_up_cells(labelled_cells(t), F.col("row"))


@query(
    "cell_to_sample",
    f"SELECT cell_id, arg_max(sample_id, row) AS sample_id FROM ({LABELLED_CELLS}) GROUP BY cell_id",
)
def last_sample_of_cell(t: Tables):
    return cell_to_sample(labelled_cells(t), F.col("row"))


SUM_COHORT = f"""
    labelled AS ({LABELLED_CELLS}),
    placed AS (SELECT cell_id, arg_max(sample_id, row) AS sample_id FROM labelled GROUP BY cell_id),
    counts AS (
        SELECT p.sample_id, c.gene, coalesce({exact_sum('c.value')}, 0.0) AS value
        FROM ({CELL_VALUES}) c JOIN placed p ON c.cell_id = p.cell_id GROUP BY p.sample_id, c.gene),
    rolled AS (
        SELECT sample_id, count(*) AS n_cells,
               arg_min(response_binary, row) FILTER (WHERE response_binary IS NOT NULL) AS response_binary
        FROM labelled GROUP BY sample_id HAVING sample_id IN (SELECT sample_id FROM counts))
"""


def sum_of_cells(t: Tables):
    return sum_cells(cell_values(t).drop("sample_id"), cell_metadata(t), "EVENTS")


@query(
    "cell_cohort_counts",
    f"""
    WITH {SUM_COHORT}
    SELECT c.sample_id, c.gene, c.value, r.n_cells, r.response_binary
    FROM counts c JOIN rolled r ON c.sample_id = r.sample_id
    """,
)
def cell_cohort_counts(t: Tables):
    cohort = sum_of_cells(t)
    return cohort.expr.drop("study").join(
        cohort.samples.select("sample_id", "n_cells", "response_binary"), "sample_id"
    )


@query(
    "cell_cohort_summary",
    f"""
    WITH {SUM_COHORT}
    SELECT 'EVENTS' AS dataset, count(*) AS n_samples, CAST(sum(n_cells) AS BIGINT) AS n_cells_used,
           (SELECT count(DISTINCT gene) FROM counts) AS n_genes,
           count(*) FILTER (WHERE response_binary = 0) AS n_response_0,
           count(*) FILTER (WHERE response_binary = 1) AS n_response_1,
           count(*) FILTER (WHERE response_binary IS NULL) AS n_response_missing
    FROM rolled
    """,
)
def cell_cohort_summary(t: Tables):
    return cohort_summary(sum_of_cells(t), "EVENTS")


def patient_samples(t: Tables):
    """Two samples per user; the first one by row counts."""
    users = t.events.groupBy("user_id").agg(F.min("event_id").alias("row"))
    entry = F.explode(F.array(F.lit("Pre"), F.lit("Post")))
    return users.select("user_id", "row", entry.alias("visit")).select(
        F.concat_ws(" ", "visit", F.concat(F.lit("P"), F.col("user_id").cast("string"))).alias("sample_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("patient_id"),
        F.expr("IF(user_id % 2 = 0, 'Responder', NULL)").alias("response"),
        F.expr("IF(user_id % 2 = 0, 1, NULL)").alias("response_binary"),
        F.lit("single_cell").alias("dataset_role"),
        F.col("visit").alias("notes"),
        F.when(F.col("visit") == "Pre", F.col("row") * 2).otherwise(F.col("row") * 2 + 1).alias("row"),
    )


def patient_cells(t: Tables):
    """Cells that carry their patient in the id; every fifth one does not."""
    cell = F.expr(
        "IF(event_id % 5 = 0, concat('A', event_id), concat('A', event_id, '_P', user_id, '_M', event_id % 3))"
    )
    return t.events.select(
        F.lit("TPM").alias("study"),
        cell.alias("cell_id"),
        F.col("event_type").alias("gene"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


MEAN_COHORT = f"""
    SELECT 'TPM' AS study, 'Pre_P' || user_id AS sample_id, event_type AS gene,
           coalesce({exact_sum('CASE WHEN event_id % 7 <> 0 THEN value END')}, 0.0) / count(*) AS value
    FROM events WHERE event_id % 5 <> 0 GROUP BY user_id, event_type
"""


@query("tpm_cohort", MEAN_COHORT)
def tpm_cohort(t: Tables):
    return mean_cells(patient_cells(t), patient_samples(t)).expr


@query(
    "tpm_cohort_samples",
    """
    SELECT 'Pre_P' || user_id AS sample_id, 'P' || user_id AS patient_id,
           CASE WHEN user_id % 2 = 0 THEN 'Responder' END AS response,
           CASE WHEN user_id % 2 = 0 THEN 1 END AS response_binary, 'single_cell' AS dataset_role, 'Pre' AS notes
    FROM events WHERE event_id % 5 <> 0 GROUP BY user_id
    """,
)
def tpm_cohort_samples(t: Tables):
    return mean_cells(patient_cells(t), patient_samples(t)).samples


def _fused(t: Tables):
    summed = sum_of_cells(t)
    first = to_log_cpm(Cohort(summed.samples, summed.expr.filter("gene <> 'view'")))
    averaged = mean_cells(patient_cells(t), patient_samples(t))
    second = Cohort(averaged.samples, averaged.expr.filter("gene <> 'signup'"))
    return fuse_pseudobulk({"COUNTS": first, "TPM": second}, allow_mixed=True)


@query(
    "fuse_pseudobulk",
    f"""
    WITH {SUM_COHORT},
    log AS (
        SELECT sample_id, gene, log2(value / nullif(library, 0) * 1000000 + 1) AS value
        FROM counts JOIN (
            SELECT sample_id, {exact_sum('value')} AS library FROM counts WHERE gene <> 'view' GROUP BY sample_id) USING (sample_id)
        WHERE gene <> 'view')
    SELECT 'COUNTS' AS study, sample_id, gene, round(value, 6) AS value FROM log WHERE gene <> 'signup'
    UNION ALL
    SELECT 'TPM', sample_id, gene, value FROM ({MEAN_COHORT}) WHERE gene NOT IN ('signup', 'view')
    """,
)
def fused_values(t: Tables):
    cohort, _ = _fused(t)
    # the logarithms of two engines may differ in their last bit; sums and means do not
    return cohort.expr.withColumn("value", F.when(F.col("study") == "COUNTS", F.round("value", 6)).otherwise(F.col("value")))


@query(
    "fuse_summary",
    f"""
    WITH {SUM_COHORT},
    parts AS (SELECT 'COUNTS' AS dataset_source, count(*) AS n_samples FROM rolled
              UNION ALL SELECT 'TPM', count(DISTINCT sample_id) FROM ({MEAN_COHORT}))
    SELECT dataset_source, n_samples, CAST(3 AS BIGINT) AS n_genes FROM parts
    UNION ALL SELECT 'TOTAL_FUSION', CAST(sum(n_samples) AS BIGINT), 3 FROM parts
    """,
)
def fused_summary(t: Tables):
    _, summary = _fused(t)
    return summary
