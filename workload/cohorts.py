"""Queries on cohorts: merging, matching, alignment, portal studies."""

from pyspark.sql import functions as F

from cohortloom.functions.text import sample_join_key
from cohortloom.operators.matching import (
    choose_key,
    join_by_position,
    key_overlap,
    rejected_ids,
    unmatched_summary,
)
from cohortloom.operators.ordering import with_position
from cohortloom.operators.summaries import label_counts
from cohortloom.plans import Cohort
from cohortloom.plans.clinical import build_clinical, clinical_from_table
from cohortloom.plans.cohorts import (
    attach_metadata,
    convert_gene_ids,
    matrix_to_samples,
    merge_cohorts,
    merge_labelled_studies,
    reconcile_samples,
    visit_cohort,
)
from cohortloom.plans.portal import PORTAL_SPECS, portal_metadata, prepare_portal_study
from cohortloom.session import settle

from .mapping import (
    LAST_SYMBOL_MAP,
    PATIENTS,
    RESPONSE,
    STUDIES,
    VISIT_EXPRESSION,
    alias_table,
    patients,
    visit_expression,
)
from .registry import Tables, query

MERGED = f"""
    expr AS (
        SELECT study, sample_id, symbol AS gene, avg(value) AS value
        FROM ({VISIT_EXPRESSION}) e JOIN ({LAST_SYMBOL_MAP}) m ON e.gene = m.id
        GROUP BY study, sample_id, symbol),
    common AS (SELECT gene FROM expr GROUP BY gene HAVING count(DISTINCT study) = 5),
    clinical AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS patient_id, r_name AS study, {RESPONSE} AS response,
               CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS survival_event
        FROM {PATIENTS}),
    score AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN 'x' ELSE '' END || o_orderkey AS patient_id, o_totalprice AS cytolytic_score
              FROM orders),
    samples AS (
        SELECT s.sample_id, c.patient_id, s.study, c.response, c.survival_event, k.cytolytic_score
        FROM (SELECT DISTINCT study, sample_id FROM expr) s
        JOIN clinical c ON c.study = s.study
         AND c.patient_id = replace(replace(s.sample_id, '.baseline', ''), '.OnTx', '')
        LEFT JOIN score k ON k.patient_id = c.patient_id
        WHERE c.survival_event IS NOT NULL)
"""


def merged(t: Tables):
    # The converted table is read three times (genes, samples, values): it is computed once.
    expr = settle(convert_gene_ids(visit_expression(t), alias_table(t), "drop"), "expr")
    rows = patients(t).select(
        F.col("o_orderkey").cast("string").alias("patient_id"),
        F.expr(RESPONSE).alias("response"),
        "r_name",
        F.col("o_orderkey").alias("row"),
    )
    clinical = build_clinical({"all": clinical_from_table(rows, F.col("r_name"))}).select(
        "patient_id", "study", "response", "survival_event"
    )
    # two of three scores are of patients that nothing else knows
    score = t.orders.select(
        F.concat(F.expr("IF(o_orderkey % 3 > 0, 'x', '')"), F.col("o_orderkey").cast("string")).alias("patient_id"),
        F.col("o_totalprice").alias("cytolytic_score"),
    )
    return merge_cohorts(expr, clinical, score, STUDIES)


@query(
    "merge_cohorts",
    f"""
    WITH {MERGED}
    SELECT s.study, s.n_samples, s.n_patients, s.n_response_0, s.n_response_1, s.n_response_missing,
           s.n_scored, e.n_genes, e.n_values, e.total
    FROM (SELECT study, count(*) AS n_samples, count(DISTINCT patient_id) AS n_patients,
                 count(*) FILTER (WHERE survival_event = 0) AS n_response_0,
                 count(*) FILTER (WHERE survival_event = 1) AS n_response_1,
                 count(*) FILTER (WHERE survival_event IS NULL) AS n_response_missing,
                 count(cytolytic_score) AS n_scored FROM samples GROUP BY study) s
    JOIN (SELECT study, count(DISTINCT gene) AS n_genes, count(*) AS n_values,
                 CAST(sum(CAST(round(value * 60) AS BIGINT)) AS BIGINT) AS total
          FROM expr SEMI JOIN common USING (gene) SEMI JOIN samples USING (study, sample_id)
          GROUP BY study) e ON s.study = e.study
    """,
)
def merge_all(t: Tables):
    result = merged(t)
    per_study = result.samples.groupBy("study").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_distinct("patient_id").alias("n_patients"),
        *label_counts(F.col("survival_event")),
        F.count("cytolytic_score").alias("n_scored"),
    )
    values = (
        result.expr.groupBy("study", "gene")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 60).cast("bigint")).alias("total"))
        .groupBy("study")
        .agg(F.count(F.lit(1)).alias("n_genes"), F.sum("n").alias("n_values"), F.sum("total").alias("total"))
    )
    return per_study.join(values, "study")


@query(
    "ml_ready_samples",
    f"""
    WITH {MERGED}
    SELECT sample_id, patient_id, study, response, survival_event FROM samples
    """,
)
def ml_ready_samples(t: Tables):
    return merged(t).ml_ready()


@query(
    "matrix_to_samples",
    f"""
    SELECT study, sample_id, replace(replace(sample_id, '.baseline', ''), '.OnTx', '') AS patient_id,
           count(*) AS n_genes, CAST(sum(CAST(round(value * 60) AS BIGINT)) AS BIGINT) AS total
    FROM (SELECT study, sample_id, gene, avg(value) AS value
          FROM ({VISIT_EXPRESSION}) GROUP BY study, sample_id, gene)
    GROUP BY study, sample_id
    """,
)
def sheet_to_samples(t: Tables):
    # repeated genes are averaged by the operator; sixtieths make the sum one of whole numbers
    cohort = matrix_to_samples(visit_expression(t))
    totals = cohort.expr.groupBy("study", "sample_id").agg(
        F.count(F.lit(1)).alias("n_genes"), F.sum(F.round(F.col("value") * 60).cast("bigint")).alias("total")
    )
    return cohort.samples.join(totals, ["study", "sample_id"])


@query(
    "visit_cohort",
    f"""
    WITH cells AS (
        SELECT 'Patient ' || (l_orderkey % 997) || CASE WHEN l_linenumber % 2 = 0 THEN ' Pre-' ELSE ' Post-' END
               || CASE WHEN l_orderkey % 997 % 3 = 0 THEN 'RAFi' ELSE 'RAF/MEKi' END AS sample_id,
               p_name AS gene, l_quantity AS value, l_orderkey % 997 = 5 AS broken,
               'COHORT_Patient_' || (l_orderkey % 997) AS patient_id,
               CASE WHEN l_linenumber % 2 = 0 THEN 'Pre' ELSE 'Post' END AS treatment_phase,
               CASE WHEN l_orderkey % 997 % 3 = 0 THEN 'RAFi' ELSE 'RAF_MEKi' END AS therapy_type
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'A')
    SELECT sample_id, patient_id, treatment_phase, therapy_type,
           'targeted_therapy' AS treatment_category, count(*) AS n_genes,
           CAST(CAST(sum(value) AS DECIMAL(28,2)) AS DOUBLE) AS total
    FROM (SELECT sample_id, patient_id, treatment_phase, therapy_type, gene,
                 CAST(max(value) AS DECIMAL(18,2)) AS value
          FROM cells WHERE NOT broken GROUP BY ALL)
    GROUP BY ALL
    """,
)
def pre_post_cohort(t: Tables):
    number = F.col("l_orderkey") % 997
    name = F.concat(
        F.lit("Patient "), number.cast("string"),
        F.when(F.col("l_linenumber") % 2 == 0, " Pre-").otherwise(" Post-"),
        F.when(number % 3 == 0, "RAFi").otherwise("RAF/MEKi"),
    )
    cells = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit("COHORT").alias("study"),
            F.when(F.col("l_returnflag") == "A", "Symbol").otherwise(name).alias("sample_id"),
            F.col("p_name").alias("gene"),
            (number == 5).alias("broken"),
            F.col("l_quantity").alias("value"),
        )
        .groupBy("study", "sample_id", "gene", "broken").agg(F.max("value").alias("value"))
        .withColumn("raw", F.when(F.col("broken"), "x").otherwise(F.col("value").cast("string")))
        .withColumn("value", F.when(~F.col("broken"), F.col("value")))
    )
    cohort = visit_cohort(cells, "COHORT")
    totals = cohort.expr.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_genes"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    )
    return cohort.samples.drop("study").join(totals, "sample_id")


METADATA_ID = """
    'MGH-' || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END || (o_orderkey // 3)
    || CASE o_orderkey % 3 WHEN 0 THEN '_bam' WHEN 1 THEN '.bam' ELSE '' END
"""


def order_metadata(t: Tables):
    """Samples written in three ways; every eleventh order has an id of its own, which nothing measured has."""
    own = F.when(F.col("o_orderkey") % 11 == 0, "x").otherwise("")
    suffix = F.when(F.col("o_orderkey") % 3 == 0, "_bam").when(F.col("o_orderkey") % 3 == 1, ".bam").otherwise("")
    return t.orders.select(
        F.concat(F.lit("MGH-"), own, F.expr("o_orderkey div 3").cast("string"), suffix).alias("sample_id"),
        F.col("o_orderpriority").alias("treatment"),
    )


def measured_orders(t: Tables):
    """Measurements under yet another spelling of the sample id, some under two of them."""
    number = F.expr("l_orderkey div 3")
    two = (number % 5 == 0) & (F.col("l_linenumber") % 2 == 0)
    return t.lineitem.select(
        F.when(two, F.concat(F.lit("MGH-"), number.cast("string"), F.lit(".bam")))
        .otherwise(F.concat(F.lit(" MGH_"), number.cast("string"))).alias("sample_id"),
        F.col("l_partkey").cast("string").alias("gene"),
        F.col("l_quantity").alias("value"),
    )


ORDER_METADATA = f"""
    SELECT {METADATA_ID} AS sample_id, o_orderpriority AS treatment,
           'MGH_' || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END || (o_orderkey // 3) AS sample_key
    FROM orders
"""
MEASURED_ORDERS = """
    SELECT 'MGH_' || (l_orderkey // 3) AS sample_key, CAST(l_partkey AS VARCHAR) AS gene, l_quantity AS value,
           CASE WHEN l_orderkey // 3 % 5 = 0 AND l_linenumber % 2 = 0 THEN 'MGH-' || (l_orderkey // 3) || '.bam'
                ELSE ' MGH_' || (l_orderkey // 3) END AS own_id
    FROM lineitem
"""


@query(
    "attach_metadata",
    f"""
    SELECT m.sample_id || CASE WHEN count(*) OVER (PARTITION BY m.sample_id) > 1 THEN ' [' || own_id || ']' ELSE '' END AS sample_id,
           m.treatment, e.n_values, e.total
    FROM ({ORDER_METADATA}) m
    JOIN (SELECT sample_key, own_id, count(*) AS n_values, sum(value) AS total FROM ({MEASURED_ORDERS})
          GROUP BY sample_key, own_id) e ON m.sample_key = e.sample_key
    """,
)
def metadata_attached(t: Tables):
    cohort = attach_metadata(measured_orders(t), order_metadata(t))
    totals = cohort.expr.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("value").alias("total")
    )
    return cohort.samples.join(totals, "sample_id")


UNMATCHED = """
    SELECT '{side}' AS side, count(*) AS n_unmatched,
           coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM
                     (SELECT k FROM {side} ORDER BY k LIMIT 20)), '') AS examples FROM {side}
"""


@query(
    "reconcile_ids",
    f"""
    WITH a AS (SELECT DISTINCT sample_key AS k FROM ({ORDER_METADATA})),
    b AS (SELECT DISTINCT sample_key AS k FROM ({MEASURED_ORDERS})),
    missing_in_right AS (SELECT k FROM a EXCEPT SELECT k FROM b),
    missing_in_left AS (SELECT k FROM b EXCEPT SELECT k FROM a)
    {UNMATCHED.format(side="missing_in_right")} UNION ALL {UNMATCHED.format(side="missing_in_left")}
    """,
)
def reconciled_ids(t: Tables):
    presence = reconcile_samples(order_metadata(t), measured_orders(t))
    return unmatched_summary(presence, "sample_key").withColumn(
        "examples", F.array_join("examples", ",")
    )


@query(
    "rejected_ids",
    """
    SELECT 'documents' AS side, count(*) FILTER (WHERE quality IS NULL) AS n_rejected
    FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'labels', count(*) FILTER (WHERE quality IS NULL) FROM labels
    """,
)
def rejected(t: Tables):
    documents = t.documents.join(t.labels, "doc_id", "left")
    return rejected_ids({"documents": documents, "labels": t.labels}, "quality")


def portal_samples(t: Tables):
    """Orders as the sample table of a portal study."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("SAMPLE_ID"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("PATIENT_ID"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Progressive Disease' WHEN 'P' THEN 'unknown' ELSE ' ' END")
        .alias("RESPONSE"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'N/A' WHEN o_orderkey % 4 = 1 THEN 'CB' "
               "WHEN o_orderkey % 4 = 2 THEN 'SD' ELSE 'no benefit' END").alias("CLINICAL_BENEFIT"),
        F.col("o_orderpriority").alias("SAMPLE_TREATMENT"),
        F.expr("IF(o_orderkey % 2 = 0, 'F', 'M')").alias("SEX"),
    )


def portal_patients(t: Tables):
    """Customers as the patient table; every seventh one has an id that no sample has."""
    return t.customer.select(
        F.concat(F.expr("IF(c_custkey % 7 = 0, ' x', ' ')"), F.col("c_custkey").cast("string")).alias("PATIENT_ID"),
        F.col("c_mktsegment").alias("SEX"),
        F.expr("IF(c_custkey % 2 = 0, '0:LIVING', '1:DECEASED')").alias("OS_STATUS"),
    )


PORTAL_METADATA = """
    SELECT 'CBIO_GIDE_2019' AS study, CAST(o_orderkey AS VARCHAR) AS sample_id,
           CAST(o_custkey AS VARCHAR) AS patient_id, response, CASE response
               WHEN 'Progressive Disease' THEN 0 WHEN 'no benefit' THEN 0 WHEN 'CB' THEN 1 END AS response_binary,
           o_orderpriority AS treatment, 'z-score' AS expression_format,
           'cbioportal_bulk_immunotherapy' AS dataset_role, raw_response, clinical_benefit, sample_treatment,
           sex, CASE WHEN c_custkey IS NULL THEN NULL WHEN c_custkey % 2 = 0 THEN '0:LIVING'
                     ELSE '1:DECEASED' END AS os_status
    FROM (SELECT *, o_orderpriority AS sample_treatment,
             CASE o_orderstatus WHEN 'F' THEN 'Progressive Disease' WHEN 'P' THEN 'unknown' ELSE ' ' END AS raw_response,
             CASE o_orderkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN 'CB' WHEN 2 THEN 'SD' ELSE 'no benefit' END
                 AS clinical_benefit,
             CASE WHEN o_orderstatus = 'F' THEN 'Progressive Disease' WHEN o_orderkey % 4 = 0 THEN NULL
                  WHEN o_orderkey % 4 = 1 THEN 'CB' WHEN o_orderkey % 4 = 2 THEN 'SD' ELSE 'no benefit' END AS response,
             CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex
          FROM orders) o
    LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE '' END || c_custkey AS patient FROM customer) c
      ON CAST(o.o_custkey AS VARCHAR) = c.patient
"""


@query("sample_patient_merge", PORTAL_METADATA)
def sample_patient_merge(t: Tables):
    return portal_metadata(PORTAL_SPECS["CBIO_GIDE_2019"], portal_samples(t), portal_patients(t))


@query(
    "portal_study",
    f"""
    WITH meta AS ({PORTAL_METADATA}),
    expr AS (SELECT DISTINCT sample_id, gene FROM
             (SELECT CAST(l_orderkey + 40 AS VARCHAR) AS sample_id, p_name AS gene
              FROM lineitem JOIN part ON l_partkey = p_partkey)),
    ids AS (SELECT DISTINCT sample_id FROM expr),
    clean AS (SELECT * FROM meta SEMI JOIN ids USING (sample_id))
    SELECT 'CBIO_GIDE_2019' AS dataset, 'z-score' AS expression_format,
           (SELECT count(DISTINCT gene) FROM expr) AS n_expression_genes,
           (SELECT count(*) FROM ids) AS n_expression_samples,
           (SELECT count(*) FROM meta) AS n_clinical_samples, count(*) AS n_clean_samples,
           count(*) FILTER (WHERE response_binary = 0) AS n_response_binary_0,
           count(*) FILTER (WHERE response_binary = 1) AS n_response_binary_1,
           count(*) FILTER (WHERE response_binary IS NULL) AS n_response_binary_missing,
           (SELECT count(*) FROM meta ANTI JOIN ids USING (sample_id)) AS n_missing_samples_from_expression,
           (SELECT count(*) FROM ids ANTI JOIN meta USING (sample_id)) AS n_expression_samples_without_metadata
    FROM clean
    """,
)
def portal_summary(t: Tables):
    cells = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.lit("CBIO_GIDE_2019").alias("study"),
        F.concat((F.col("l_orderkey") + 40).cast("string"), F.lit(" ")).alias("sample_id"),
        F.col("p_name").alias("gene"),
        F.col("l_quantity").alias("value"),
    )
    spec = PORTAL_SPECS["CBIO_GIDE_2019"]
    _, summary = prepare_portal_study(spec, cells, portal_samples(t), portal_patients(t))
    return summary


def labelled_studies(t: Tables):
    """Two studies of labelled orders; one lacks its study name and uses other formats."""
    expr = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.max("l_quantity").alias("value"))
    label = F.expr("CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END")
    cohorts = {}
    for name, parity in (("EVEN", 0), ("ODD", 1)):
        study = F.lit(None if parity else name).cast("string")
        samples = t.orders.filter(F.col("o_orderkey") % 2 == parity).select(
            study.alias("study"),
            F.col("o_orderkey").cast("string").alias("sample_id"),
            label.alias("response_binary"),
            F.expr("IF(o_orderkey % 4 < 2, 'TPM', 'z-score')").alias("expression_format"),
        )
        measured = expr.filter(F.col("l_orderkey") % 2 == parity).select(
            study.alias("study"),
            F.col("l_orderkey").cast("string").alias("sample_id"),
            F.col("l_partkey").cast("string").alias("gene"),
            "value",
        )
        cohorts[name] = Cohort(samples, measured)
    return cohorts


LABELLED = """
    samples AS (
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS study, o_orderkey AS k,
               CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS response_binary,
               CASE WHEN o_orderkey % 4 < 2 THEN 'TPM' ELSE 'z-score' END AS expression_format
        FROM orders WHERE o_orderstatus <> 'O'),
    measured AS (
        SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS study, l_orderkey AS k, l_partkey,
               max(l_quantity) AS value
        FROM lineitem GROUP BY 1, 2, 3),
    expr AS (SELECT * FROM measured WHERE k IN (SELECT k FROM samples)),
    common AS (SELECT l_partkey FROM measured GROUP BY l_partkey HAVING count(DISTINCT study) = 2)
"""


@query(
    "merge_labelled",
    f"""
    WITH {LABELLED}
    SELECT study AS source_dataset, count(*) AS n_samples, (SELECT count(*) FROM common) AS n_common_genes,
           count(*) FILTER (WHERE response_binary = 0) AS n_response_0,
           count(*) FILTER (WHERE response_binary = 1) AS n_response_1,
           count(*) FILTER (WHERE response_binary IS NULL) AS n_response_missing,
           string_agg(DISTINCT expression_format, '; ' ORDER BY expression_format) AS expression_formats
    FROM samples GROUP BY study
    """,
)
def labelled_summary(t: Tables):
    _, summary = merge_labelled_studies(labelled_studies(t))
    return summary


@query(
    "merge_labelled_values",
    f"""
    WITH {LABELLED}
    SELECT study, CAST(l_partkey AS VARCHAR) AS gene, count(*) AS n_values, sum(value) AS total
    FROM expr WHERE l_partkey IN (SELECT l_partkey FROM common) GROUP BY study, l_partkey
    """,
)
def labelled_values(t: Tables):
    cohort, _ = merge_labelled_studies(labelled_studies(t))
    return cohort.expr.groupBy("study", "gene").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("value").alias("total")
    )


@query(
    "best_key_column",
    """
    SELECT 'o_orderkey' AS "column", count(DISTINCT o_orderkey) AS overlap
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
    """,
)
def key_choice(t: Tables):
    # a filter of the ids leaves few of all columns to be counted
    found = choose_key(t.orders, t.orders.columns, t.lineitem, "l_orderkey")
    return t.spark.createDataFrame([found] if found else [], "column string, overlap bigint")


@query(
    "key_overlap",
    """
    WITH ids AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS v FROM lineitem)
    SELECT 'o_custkey' AS "column", 0 AS position,
           (SELECT count(DISTINCT o_custkey) FROM orders WHERE CAST(o_custkey AS VARCHAR) IN (SELECT v FROM ids)) AS overlap
    UNION ALL SELECT 'o_orderstatus', 1, 0
    UNION ALL SELECT 'o_orderkey', 2,
           (SELECT count(DISTINCT o_orderkey) FROM orders WHERE CAST(o_orderkey AS VARCHAR) IN (SELECT v FROM ids))
    """,
)
def _key_overlaps(t: Tables):
    return key_overlap(t.orders, ["o_custkey", "o_orderstatus", "o_orderkey"], t.lineitem, "l_orderkey")


@query(
    "positional_join",
    """
    SELECT a.idx, a.c_custkey, b.c_name, b.c_acctbal
    FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer) a
    JOIN (SELECT c_name, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_name) - 1 AS idx FROM customer) b
      ON a.idx = b.idx
    """,
)
def positional_join(t: Tables):
    header = with_position(t.customer.select("c_custkey"), ["c_custkey"])
    return join_by_position(header, t.customer.select("c_name", "c_acctbal"), ["c_acctbal", "c_name"])


@query(
    "sample_keys",
    f"SELECT DISTINCT sample_id, sample_key FROM ({ORDER_METADATA})",
)
def sample_keys(t: Tables):
    key = sample_join_key(F.col("sample_id")).alias("sample_key")
    return order_metadata(t).select("sample_id", key).distinct()
