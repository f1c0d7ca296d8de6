"""Queries on profiles and summaries."""

from pyspark.sql import functions as F

from cohortloom.functions.fixed_values import PORTAL_KEYWORDS
from cohortloom.functions.numeric import to_number
from cohortloom.operators.projection import drop_missing
from cohortloom.operators.summaries import (
    distinct_values,
    mean_of_numeric_samples,
    numeric_samples,
    preview,
    table_shape,
)
from cohortloom.plans.clinical import clinical_from_table
from cohortloom.plans.profiling import profile_relevant, profile_table
from cohortloom.sinks.tables import summary_rows

from .registry import Tables, query


def labelled_documents(t: Tables):
    return t.documents.join(t.labels, "doc_id", "left")


@query(
    "missing_cells",
    """
    SELECT count(*) AS n_rows, CAST(7 AS BIGINT) AS n_cols,
           CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END + CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT)
               AS n_missing
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def missing_cells(t: Tables):
    return table_shape(labelled_documents(t))


@query(
    "drop_missing",
    """
    SELECT source, count(*) AS n_labelled, CAST(sum(quality) AS BIGINT) AS n_good
    FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY source
    """,
)
def dropped_missing(t: Tables):
    kept, _ = drop_missing(labelled_documents(t), ["quality"])
    return kept.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_labelled"), F.sum(F.col("quality").cast("bigint")).alias("n_good")
    )


@query(
    "distinct_values",
    """
    WITH v AS (
        SELECT DISTINCT * FROM (
            SELECT 'lang' AS "column", lang AS value FROM documents
            UNION ALL SELECT 'doc_id', CAST(doc_id AS VARCHAR) FROM documents
            UNION ALL SELECT 'source', source FROM documents
            UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM documents
            UNION ALL SELECT 'text', text FROM documents)
        WHERE value IS NOT NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS r FROM v)
    SELECT "column", count(*) AS n_values,
           md5(string_agg(value, '|' ORDER BY value) FILTER (WHERE r <= 12)) AS examples
    FROM ranked GROUP BY "column"
    """,
)
def values_of_columns(t: Tables):
    values = distinct_values(t.documents, t.documents.columns)
    return values.withColumn("examples", F.md5(F.array_join("examples", "|")))


@query(
    "relevant_columns",
    """
    WITH v AS (
        SELECT DISTINCT * FROM (
            SELECT 'o_orderpriority' AS "column", o_orderpriority AS value FROM orders
            UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders)
        WHERE value IS NOT NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS r FROM v)
    SELECT "column", count(*) AS n_values, string_agg(value, '|' ORDER BY value) FILTER (WHERE r <= 12) AS examples
    FROM ranked GROUP BY "column"
    """,
)
def values_of_relevant_columns(t: Tables):
    values = profile_relevant(t.orders, PORTAL_KEYWORDS)
    return values.withColumn("examples", F.array_join("examples", "|"))


def raw_cells(t: Tables):
    """Order lines as a raw matrix; one sample holds texts, some cells are missing."""
    text = F.expr(
        """CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_linenumber = 3 AND l_orderkey % 101 = 1 THEN 'x'
           ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"""
    )
    return t.lineitem.select(
        F.col("l_returnflag").alias("study"),
        F.col("l_linenumber").cast("string").alias("sample_id"),
        F.col("l_partkey").cast("string").alias("gene"),
        text.alias("raw"),
        to_number(text).alias("value"),
    )


RAW_CELLS = """
    SELECT l_returnflag AS study, CAST(l_linenumber AS VARCHAR) AS sample_id, CAST(l_partkey AS VARCHAR) AS gene,
           l_linenumber = 3 AND l_orderkey % 101 = 1 AND l_orderkey % 19 <> 0 AS broken,
           CASE WHEN l_orderkey % 19 <> 0 AND NOT (l_linenumber = 3 AND l_orderkey % 101 = 1) THEN l_quantity END AS value
    FROM lineitem
"""


@query(
    "numeric_samples",
    f"SELECT study, sample_id, NOT bool_or(broken) AS is_numeric FROM ({RAW_CELLS}) GROUP BY study, sample_id",
)
def samples_that_are_numeric(t: Tables):
    return numeric_samples(raw_cells(t))


@query(
    "numeric_only",
    f"""
    SELECT study, sample_id, gene, sum(value) / count(value) AS value FROM ({RAW_CELLS}) c
    WHERE (study, sample_id) NOT IN (SELECT (study, sample_id) FROM ({RAW_CELLS}) WHERE broken)
    GROUP BY study, sample_id, gene
    """,
)
def numeric_only(t: Tables):
    return mean_of_numeric_samples(raw_cells(t))


@query(
    "top_n_preview",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_n_preview(t: Tables):
    ranked = t.orders.withColumn("order", -F.col("o_totalprice"))
    return preview(ranked, 20, "order", "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
NUMBER_TYPES = "('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT')"


@query(
    "dataset_summary",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS n_rows,"
        f" (SELECT count(*) FROM (DESCRIBE {n})) AS n_cols, CAST(0 AS BIGINT) AS n_missing,"
        f" (SELECT count(*) FROM (DESCRIBE {n}) WHERE column_type IN {NUMBER_TYPES} OR column_type LIKE 'DECIMAL%')"
        f" AS n_numeric_cols, false AS failed FROM {n}"
        for n in TABLES
    )
    + " UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, true",
)
def dataset_summary(t: Tables):
    def profile(name: str):
        return lambda: profile_table(getattr(t, name), name)

    datasets = {name: profile(name) for name in TABLES}
    datasets["broken"] = lambda: clinical_from_table(t.part, "broken")
    rows = summary_rows(t.spark, datasets)
    return rows.withColumn("failed", F.col("error").isNotNull()).drop("error")
