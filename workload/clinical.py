"""Queries on labels, ids, clinical tables and sample metadata."""

from pyspark.sql import functions as F

from cohortloom.functions.labels import label
from cohortloom.functions.text import (
    bracket_patient,
    bracket_sample,
    clean_gene_id,
    clean_gene_symbol,
    clean_text,
    drop_visit_suffix,
    first_informative,
    normalise_sample_id,
    parse_visit_column,
    patient_from_cell_id,
    patient_from_description,
    split_sample_class,
    split_visit_prefix,
)
from cohortloom.operators.matching import patient_to_sample
from cohortloom.operators.ordering import number_within
from cohortloom.operators.projection import conform, prefer_order
from cohortloom.operators.summaries import value_counts
from cohortloom.plans.clinical import build_clinical, clinical_from_table
from cohortloom.plans.metadata import (
    COHORT_SPECS,
    metadata_summary,
    standardise_metadata,
    union_metadata,
)

from .mapping import patients
from .registry import Tables, query

# Raw outcome texts, one per order, chosen by the order key.
TOKENS = {
    "main": ["PD", " pd ", "Progressive disease", "SD", "stable disease", "PR", "Partial Response",
             "cr", "COMPLETE RESPONSE", "NE", "", "MR"],
    "responder": ["R", "r ", "Responder", "LR", "long-responder", "NR", "non response", "SR",
                  "SHORT_RESPONSE", "resistant", "SD", "CR", "unknown"],
    "portal": ["NO PROGRESSION", "1:PROGRESSION", "0:CENSORED", "0:DiseaseFree", "disease free",
               "1:Recurred/Progressed", "1:DECEASED", "0:LIVING", "dead", "CR", "yes", "DCB",
               "clinical benefit", "NDB", "no", "false", "PD", "SD", "stable disease", "NE"],
    "recist": ["CR", "partial_response", "R", "PD", "NON-RESPONDER", "sd", "STABLE DISEASE",
               "near complete resp.", "partial (mixed)", "slow progress", "unstable", "NE"],
}
LABEL_SQL = {
    "main": """
        CASE WHEN v IN ('PD', 'PROGRESSIVE DISEASE') THEN 0
             WHEN v IN ('SD', 'STABLE DISEASE', 'PR', 'PARTIAL RESPONSE', 'CR', 'COMPLETE RESPONSE') THEN 1 END
    """,
    "responder": """
        CASE WHEN v IN ('R', 'RESPONDER', 'RESPONSE', 'LR', 'LONG RESPONDER', 'LONG_RESPONSE',
                        'LONG-RESPONDER') THEN 1
             WHEN v IN ('NR', 'NON-RESPONDER', 'NON_RESPONDER', 'NONRESPONDER', 'NON RESPONSE',
                        'NON-RESPONSE', 'SR', 'SHORT RESPONDER', 'SHORT_RESPONSE', 'SHORT-RESPONDER',
                        'RESISTANT') THEN 0 END
    """,
    "portal": """
        CASE WHEN v LIKE '%PROGRESSION%' THEN 0 WHEN v LIKE '%CENSORED%' THEN 1
             WHEN v LIKE '%DISEASEFREE%' OR v LIKE '%DISEASE FREE%' THEN 1
             WHEN v LIKE '%RECURRED%' OR v LIKE '%PROGRESSED%' OR v LIKE '%DECEASED%' OR v LIKE '%DEAD%' THEN 0
             WHEN v IN ('R', 'RESPONDER', 'RESPONSE', 'CR', 'PR', 'COMPLETE RESPONSE', 'PARTIAL RESPONSE',
                        'YES', 'TRUE', 'BENEFIT', 'CLINICAL BENEFIT', 'DURABLE CLINICAL BENEFIT', 'DCB', 'CB') THEN 1
             WHEN v IN ('NR', 'NON-RESPONDER', 'NON_RESPONDER', 'NONRESPONDER', 'NO RESPONSE',
                        'PROGRESSIVE DISEASE', 'PD', 'NO BENEFIT', 'NO CLINICAL BENEFIT',
                        'NON-DURABLE CLINICAL BENEFIT', 'NDB', 'NCB', 'FALSE', 'NO') THEN 0 END
    """,
    "recist": """
        CASE WHEN v IN ('CR', 'COMPLETE RESPONSE', 'COMPLETE_RESPONSE', 'PR', 'PARTIAL RESPONSE',
                        'PARTIAL_RESPONSE', 'RESPONDER', 'RESPONSE', 'R') THEN 1
             WHEN v IN ('PD', 'PROGRESSIVE DISEASE', 'PROGRESSIVE_DISEASE', 'PROGRESSION', 'NON-RESPONDER',
                        'NON_RESPONDER', 'NONRESPONDER', 'NR') THEN 0
             WHEN v IN ('SD', 'STABLE DISEASE', 'STABLE_DISEASE') THEN NULL
             WHEN v LIKE '%COMPLETE%' OR v LIKE '%PARTIAL%' THEN 1
             WHEN v LIKE '%PROGRESS%' THEN 0 END
    """,
}


def outcome(t: Tables, policy: str):
    tokens = F.array(*[F.lit(token) for token in TOKENS[policy]])
    place = (F.col("o_orderkey") % len(TOKENS[policy])).cast("int")
    return t.orders.select("o_orderkey", "o_orderpriority", F.get(tokens, place).alias("response"))


def outcome_sql(policy: str) -> str:
    tokens = ", ".join("'" + token + "'" for token in TOKENS[policy])
    return f"""
        SELECT o_orderkey, o_orderpriority, [{tokens}][o_orderkey % {len(TOKENS[policy])} + 1] AS response
        FROM orders
    """


def _label_query(policy: str):
    @query(
        f"label_{policy}",
        f"""
        SELECT o_orderpriority, response, label, count(*) AS n FROM (
            SELECT *, {LABEL_SQL[policy]} AS label
            FROM (SELECT *, upper(trim(response)) AS v FROM ({outcome_sql(policy)})))
        GROUP BY ALL
        """,
    )
    def labelled(t: Tables):
        rows = outcome(t, policy).withColumn("label", label(F.col("response"), policy))
        return rows.groupBy("o_orderpriority", "response", "label").agg(F.count(F.lit(1)).alias("n"))


for _policy in TOKENS:
    _label_query(_policy)


@query(
    "clean_ids",
    r"""
    WITH raw AS (
        SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN chr(9) || ' "' || c_name || '" '
            WHEN 1 THEN ' "" ' WHEN 2 THEN 'NaN ' WHEN 3 THEN c_name || '.baseline'
            ELSE c_mktsegment || '.OnTx ' END AS raw FROM customer)
    SELECT c_custkey, trim(replace(raw, '"', ''), ' ' || chr(9)) AS kept,
           nullif(trim(replace(raw, '"', ''), ' ' || chr(9)), '') AS cleaned,
           CASE WHEN lower(trim(raw, ' ' || chr(9))) NOT IN ('', 'nan') THEN trim(raw, ' ' || chr(9)) END AS symbol,
           trim(replace(replace(raw, '.baseline', ''), '.OnTx', ''), ' ' || chr(9)) AS patient,
           CASE WHEN c_custkey % 3 = 0 THEN 'ENSG' || c_custkey
                WHEN c_custkey % 3 = 1 THEN 'AC' || c_custkey || '.2' END AS gene
    FROM raw
    """,
)
def clean_ids(t: Tables):
    raw = F.expr(
        """CASE c_custkey % 5 WHEN 0 THEN concat('\t "', c_name, '" ') WHEN 1 THEN ' "" ' WHEN 2 THEN 'NaN '
           WHEN 3 THEN concat(c_name, '.baseline') ELSE concat(c_mktsegment, '.OnTx ') END"""
    )
    gene = F.expr(
        """CASE c_custkey % 3 WHEN 0 THEN concat('"ENSG', c_custkey, '.15"') WHEN 1 THEN concat(' AC', c_custkey, '.2')
           ELSE 'nan' END"""
    )
    return t.customer.select(
        "c_custkey",
        clean_text(raw, keep_empty=True).alias("kept"),
        clean_text(raw).alias("cleaned"),
        clean_gene_symbol(raw).alias("symbol"),
        drop_visit_suffix(raw).alias("patient"),
        clean_gene_id(gene).alias("gene"),
    )


@query(
    "parse_titles",
    """
    SELECT c_custkey,
           CASE WHEN c_custkey % 4 <> 3 THEN 'S_Patient_' || c_custkey END AS patient_id,
           CASE c_custkey % 4 WHEN 0 THEN 'Pre' WHEN 1 THEN 'Post' WHEN 2 THEN 'Post' END AS treatment_phase,
           CASE c_custkey % 4 WHEN 0 THEN 'RAFi' WHEN 1 THEN 'RAF_MEKi' WHEN 2 THEN 'RAF_MEKi' END AS therapy_type,
           c_name AS bracket_sample,
           CASE WHEN c_custkey % 2 = 0 THEN 'pt' || c_nationkey END AS bracket_patient
    FROM customer
    """,
)
def parse_titles(t: Tables):
    name = F.expr(
        """CASE c_custkey % 4 WHEN 0 THEN concat(' Patient ', c_custkey, ' Pre-RAFi') WHEN 1 THEN
           concat('Patient  ', c_custkey, ' Post-RAF/MEKi ') WHEN 2 THEN concat('Patient ', c_custkey, ' Post-mek')
           ELSE concat('Patient ', c_custkey, ' During-RAFi') END"""
    )
    title = F.expr("concat(c_name, IF(c_custkey % 2 = 0, concat(' [ pt', c_nationkey, '] [x]'), ' '))")
    visit = parse_visit_column(name, "S")
    return t.customer.select(
        "c_custkey",
        visit["patient_id"].alias("patient_id"),
        visit["treatment_phase"].alias("treatment_phase"),
        visit["therapy_type"].alias("therapy_type"),
        bracket_sample(title).alias("bracket_sample"),
        bracket_patient(title).alias("bracket_patient"),
    )


@query(
    "parse_classes",
    """
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'PRE' WHEN 1 THEN c_mktsegment END AS class_timepoint,
           CASE WHEN c_custkey % 3 = 0 THEN 'SR' END AS class_response,
           CASE WHEN c_custkey % 2 = 0 THEN 'POST' END AS visit_timepoint,
           CASE WHEN c_custkey % 2 = 0 THEN 'P' || c_custkey || '_b' ELSE c_mktsegment END AS visit_patient,
           'MGH' || c_nationkey || 'x' AS described_patient
    FROM customer
    """,
)
def parse_classes(t: Tables):
    sample_class = split_sample_class(
        F.expr("CASE c_custkey % 3 WHEN 0 THEN ' PRE  SR x' WHEN 1 THEN c_mktsegment ELSE '\"\"' END")
    )
    visit = split_visit_prefix(
        F.expr("IF(c_custkey % 2 = 0, concat('Post_P', c_custkey, '_b'), c_mktsegment)")
    )
    description = F.expr(
        """CASE c_custkey % 3 WHEN 0 THEN concat('MGH Patient ', c_nationkey, ' x') WHEN 1 THEN
           concat('MGH', c_nationkey, 'x ') ELSE concat('"', c_nationkey, '" x') END"""
    )
    return t.customer.select(
        "c_custkey",
        sample_class["timepoint"].alias("class_timepoint"),
        sample_class["response"].alias("class_response"),
        visit["timepoint"].alias("visit_timepoint"),
        visit["patient_id"].alias("visit_patient"),
        patient_from_description(description).alias("described_patient"),
    )


@query(
    "parse_cells",
    """
    SELECT p_partkey, replace(p_name, ' ', '_') AS sample_id,
           CASE p_partkey % 4 WHEN 0 THEN 'P' || p_size WHEN 1 THEN 'Px' WHEN 2 THEN 'P' || p_size END AS patient_id
    FROM part
    """,
)
def parse_cells(t: Tables):
    cell = F.expr(
        """CASE p_partkey % 4 WHEN 0 THEN concat('A10_P', p_size, '_M11 ') WHEN 1 THEN 'A10_Px_1'
           WHEN 2 THEN concat('P1x_Q_P', p_size, '_P0') ELSE concat('P', p_size) END"""
    )
    return t.part.select(
        "p_partkey",
        normalise_sample_id(F.concat(F.lit(" "), "p_name", F.lit("\t"))).alias("sample_id"),
        patient_from_cell_id(cell).alias("patient_id"),
    )


@query(
    "first_informative",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
                            WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS response
    FROM orders
    """,
)
def informative(t: Tables):
    first = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('\"', o_orderstatus, '\"') WHEN 1 THEN ' NA' ELSE 'Unknown' END")
    second = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'n/a' END")
    return t.orders.select("o_orderkey", first_informative([first, second]).alias("response"))


@query(
    "clinical_union",
    """
    WITH a AS (
        SELECT CAST(o_custkey AS VARCHAR) AS patient_id, arg_min(o_orderstatus, o_orderkey) AS s
        FROM orders GROUP BY o_custkey),
    b AS (
        SELECT CAST(o_custkey % 1000 AS VARCHAR) AS patient_id, min(o_orderkey) AS k FROM orders GROUP BY 1)
    SELECT patient_id, 'A' AS study, CASE s WHEN 'F' THEN 'PD' WHEN 'P' THEN 'SD' ELSE 'other' END AS response,
           CASE s WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS survival_event,
           CASE s WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS response_binary, CAST(NULL AS VARCHAR) AS age FROM a
    UNION ALL
    SELECT patient_id, 'B', NULL, CASE WHEN k % 3 < 2 THEN CAST(k % 3 AS INTEGER) END,
           CASE WHEN k % 3 < 2 THEN CAST(k % 3 AS INTEGER) END, NULL FROM b
    """,
)
def clinical_union(t: Tables):
    a = t.orders.select(
        F.concat(F.lit(' "'), F.col("o_custkey").cast("string"), F.lit('"')).alias("patient_id"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'PD' WHEN 'P' THEN 'SD' ELSE 'other' END").alias("response"),
        F.col("o_orderkey").alias("row"),
    )
    b = t.orders.select(
        (F.col("o_custkey") % 1000).cast("string").alias("patient_id"),
        F.expr("CASE o_orderkey % 3 WHEN 0 THEN '0' WHEN 1 THEN ' 1.0' ELSE '1d' END").alias("survival_event"),
        F.col("o_orderkey").alias("row"),
    )
    return build_clinical(
        {"A": clinical_from_table(a, "A"), "B": clinical_from_table(b, "B")}
    ).select("patient_id", "study", "response", "survival_event", "response_binary", "age")


def series_tables(t: Tables):
    """One extracted attribute table per cohort, from a quarter of the orders each."""
    base = patients(t)
    common = [
        F.concat(F.lit("GSM"), F.col("o_orderkey").cast("string")).alias("geo_accession"),
        F.col("r_name").alias("platform_id"),
    ]

    def part(remainder: int, *columns):
        return base.filter(F.col("o_orderkey") % 4 == remainder).select(*common, *columns)

    return {
        "GSE168204": part(
            0,
            F.col("c_name").alias("title"),
            F.concat(F.lit("MGH Patient "), F.col("o_custkey").cast("string")).alias("description"),
            F.expr("CASE o_orderstatus WHEN 'F' THEN 'NR' WHEN 'P' THEN 'R' END")
            .alias("characteristics_response_immune_checkpoint_blockade_therapy"),
            F.col("o_orderpriority").alias("characteristics_antibody"),
        ),
        "GSE196434": part(
            1,
            F.concat("c_name", F.lit(" [pt"), F.col("o_custkey").cast("string"), F.lit("]")).alias("title"),
            F.expr("CASE o_orderstatus WHEN 'F' THEN 'PRE SR' WHEN 'P' THEN 'POST LR' ELSE 'PRE' END")
            .alias("characteristics_sample_class"),
        ),
        "GSE244982": part(
            2,
            F.col("c_name").alias("title"),
            F.col("c_mktsegment").alias("characteristics_gender"),
            F.expr("IF(o_orderstatus = 'F', 'IV', NULL)").alias("characteristics_stage"),
        ),
        "GSE120575": part(
            3,
            F.col("c_name").alias("title"),
            F.concat(F.lit("Pre_P"), F.col("o_custkey").cast("string"))
            .alias("characteristics_patient_id_pre=baseline;_post=on_treatment"),
            F.expr("IF(o_orderstatus = 'F', 'Non-responder', 'Responder')").alias("characteristics_response"),
        ),
    }


STANDARD_METADATA = """
    SELECT CASE o_orderkey % 4 WHEN 0 THEN 'GSE168204' WHEN 1 THEN 'GSE196434' WHEN 2 THEN 'GSE244982'
               ELSE 'GSE120575' END AS study,
           r_name AS platform, c_name AS sample_id, 'GSM' || o_orderkey AS geo_accession,
           CASE o_orderkey % 4 WHEN 0 THEN 'MGH' || o_custkey WHEN 1 THEN 'pt' || o_custkey WHEN 2 THEN c_name
               ELSE 'P' || o_custkey END AS patient_id,
           CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS treatment,
           CASE o_orderkey % 4 WHEN 1 THEN CASE WHEN o_orderstatus = 'P' THEN 'POST' ELSE 'PRE' END
               WHEN 2 THEN 'resistant' WHEN 3 THEN 'PRE' END AS timepoint,
           CASE o_orderkey % 4 WHEN 0 THEN CASE o_orderstatus WHEN 'F' THEN 'NR' WHEN 'P' THEN 'R' END
               WHEN 1 THEN CASE o_orderstatus WHEN 'F' THEN 'SR' WHEN 'P' THEN 'LR' END
               WHEN 2 THEN 'resistant'
               ELSE CASE WHEN o_orderstatus = 'F' THEN 'Non-responder' ELSE 'Responder' END END AS response,
           CASE WHEN o_orderkey % 4 = 2 OR o_orderstatus = 'F' THEN 0
                WHEN o_orderstatus = 'P' OR o_orderkey % 4 = 3 THEN 1 END AS response_binary,
           CASE o_orderkey % 4 WHEN 0 THEN 'extra_immunotherapy_response' WHEN 1 THEN 'targeted_therapy_response'
               WHEN 2 THEN 'immunotherapy_resistance' ELSE 'single_cell_immunotherapy_response' END AS dataset_role,
           CASE o_orderkey % 4 WHEN 2 THEN 'gender=' || c_mktsegment || '; stage='
                    || CASE WHEN o_orderstatus = 'F' THEN 'IV' ELSE 'nan' END
                    || '; prior_ctla4i=nan; previous_brafi=nan'
               WHEN 3 THEN 'single_cell' END AS notes
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
"""


@query("standard_metadata", STANDARD_METADATA)
def standard_metadata(t: Tables):
    tables = series_tables(t)
    return union_metadata([standardise_metadata(tables[s], COHORT_SPECS[s]) for s in tables])


@query(
    "group_sizes",
    f"""
    SELECT study, dataset_role, response, response_binary, count(*) AS n_samples FROM ({STANDARD_METADATA})
    WHERE response IS NOT NULL AND response_binary IS NOT NULL GROUP BY ALL
    """,
)
def sizes_of_groups(t: Tables):
    return metadata_summary(standard_metadata(t))


@query(
    "optional_columns",
    """
    SELECT c_name AS sample_id, CAST(c_nationkey AS VARCHAR) AS platform, 'customer' AS dataset_role,
           CAST(NULL AS VARCHAR) AS notes
    FROM customer
    """,
)
def optional_columns(t: Tables):
    table = t.customer.select(
        "c_acctbal", F.col("c_name").alias("sample_id"), F.col("c_nationkey").alias("platform"),
        F.lit("customer").alias("dataset_role"),
    )
    standard = conform(prefer_order(table, ["platform", "missing"]))
    return standard.select("sample_id", "platform", "dataset_role", "notes")


@query(
    "first_sample_per_patient",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderkey AS VARCHAR) AS sample_id
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    """,
)
def first_sample_per_patient(t: Tables):
    return patient_to_sample(_patient_samples(t), F.struct("day", "key"))


@query(
    "samples_in_order",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderkey AS VARCHAR) AS sample_id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
    FROM orders
    """,
)
def samples_in_order(t: Tables):
    numbered = number_within(
        _patient_samples(t), ["patient_id"], F.struct("day", "key"), F.year("day")
    )
    return numbered.select("patient_id", "sample_id", "n")


def _patient_samples(t: Tables):
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderkey").cast("string").alias("sample_id"),
        F.col("o_orderdate").alias("day"),
        F.col("o_orderkey").alias("key"),
    )


@query(
    "value_counts",
    """
    SELECT 'present' AS kind, CAST(quality AS VARCHAR) AS value, count(*) AS n
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality
    UNION ALL
    SELECT 'all', CAST(quality AS VARCHAR), count(*) FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality
    UNION ALL
    SELECT 'source', source, count(*) FROM documents GROUP BY source
    """,
)
def frequencies(t: Tables):
    rows = t.documents.join(t.labels, "doc_id", "left").select("source", F.col("quality").cast("string"))

    def counted(kind, column, with_nulls=False):
        return value_counts(rows, column, with_nulls).select(F.lit(kind).alias("kind"), "value", "n")

    return (
        counted("present", "quality")
        .unionByName(counted("all", "quality", with_nulls=True))
        .unionByName(counted("source", "source"))
    )
