"""The given tables seen as cohorts, alias tables and clinical tables.

Every view has a Spark form and an SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables

STUDIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def measured_lines(t: Tables) -> DataFrame:
    """Order lines with the region of their supplier."""
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


MEASURED_LINES = """
    lineitem JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
"""


def expression(t: Tables) -> DataFrame:
    """Study = supplier region, sample = order, gene = part, value = quantity."""
    return measured_lines(t).select(
        F.col("r_name").alias("study"),
        F.col("l_orderkey").cast("string").alias("sample_id"),
        F.col("l_partkey").cast("string").alias("gene"),
        F.col("l_quantity").alias("value"),
    )


EXPRESSION = f"""
    SELECT r_name AS study, CAST(l_orderkey AS VARCHAR) AS sample_id,
           CAST(l_partkey AS VARCHAR) AS gene, l_quantity AS value
    FROM {MEASURED_LINES}
"""


def visit_expression(t: Tables) -> DataFrame:
    """The same with two visits per order, told apart by a suffix of the sample id."""
    visit = F.when(F.col("l_linenumber") % 2 == 0, ".OnTx").otherwise(".baseline")
    return measured_lines(t).select(
        F.col("r_name").alias("study"),
        F.concat(F.col("l_orderkey").cast("string"), visit).alias("sample_id"),
        F.col("l_partkey").cast("string").alias("gene"),
        F.col("l_quantity").alias("value"),
    )


VISIT_EXPRESSION = f"""
    SELECT r_name AS study,
           l_orderkey || CASE WHEN l_linenumber % 2 = 0 THEN '.OnTx' ELSE '.baseline' END AS sample_id,
           CAST(l_partkey AS VARCHAR) AS gene, l_quantity AS value
    FROM {MEASURED_LINES}
"""


def named_expression(t: Tables) -> DataFrame:
    """Gene = part name, so that genes repeat within a sample; some values are missing."""
    return (
        measured_lines(t)
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("r_name").alias("study"),
            F.col("l_orderkey").cast("string").alias("sample_id"),
            F.col("p_name").alias("gene"),
            F.when(F.col("l_linenumber") != 5, F.col("l_quantity")).alias("value"),
        )
    )


NAMED_EXPRESSION = f"""
    SELECT r_name AS study, CAST(l_orderkey AS VARCHAR) AS sample_id, p_name AS gene,
           CASE WHEN l_linenumber <> 5 THEN l_quantity END AS value
    FROM {MEASURED_LINES} JOIN part ON l_partkey = p_partkey
"""


def patients(t: Tables) -> DataFrame:
    """Orders with the region of their customer."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


PATIENTS = """
    orders JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey
"""

# Order status as an outcome text: F failed, P partly, O open.
RESPONSE = "CASE o_orderstatus WHEN 'F' THEN 'PD' WHEN 'P' THEN 'PR' ELSE 'unclear' END"


def alias_table(t: Tables) -> DataFrame:
    """(protein_id, alias, source, row): parts as genes, brands and names as proteins.

    Every part of a size up to 25 is a numeric and an Ensembl id of its brand;
    every third one belongs to a second protein, its name. Each part also
    contributes symbols to both proteins.
    """
    key = F.col("p_partkey").cast("string")
    symbol = F.concat_ws("_", "p_type", (F.col("p_size") % 4).cast("string"))
    ensembl = F.concat(F.lit("ENSG"), F.lpad(key, 11, "0"), F.lit("."), F.col("p_size").cast("string"))
    small, third = F.col("p_size") <= 25, F.col("p_partkey") % 3 == 0
    entries = [
        (small, F.col("p_brand"), key, "Ensembl_HGNC_entrez_id"),
        (small & third, F.col("p_name"), key, "Ensembl_HGNC_entrez_id"),
        (small, F.col("p_brand"), ensembl, "Ensembl_gene"),
        (small & third, F.col("p_name"), ensembl, "Ensembl_gene"),
        (F.lit(True), F.col("p_brand"), symbol, "Ensembl_HGNC"),
        (F.lit(True), F.col("p_name"), symbol, "Ensembl_HGNC"),
        (F.lit(True), F.col("p_brand"), F.col("p_name"), "BLAST_UniProt"),
    ]
    rows = F.array(
        *[
            F.when(
                used,
                F.struct(
                    protein.alias("protein_id"),
                    name.alias("alias"),
                    F.lit(source).alias("source"),
                    (F.col("p_partkey") * 10 + i).alias("row"),
                ),
            )
            for i, (used, protein, name, source) in enumerate(entries)
        ]
    )
    return t.part.select(F.inline(rows)).dropna(subset=["source"])


ALIAS_TABLE = """
    SELECT p_brand AS protein_id, CAST(p_partkey AS VARCHAR) AS alias,
           'Ensembl_HGNC_entrez_id' AS source, p_partkey * 10 AS row FROM part WHERE p_size <= 25
    UNION ALL
    SELECT p_name, CAST(p_partkey AS VARCHAR), 'Ensembl_HGNC_entrez_id', p_partkey * 10 + 1
    FROM part WHERE p_size <= 25 AND p_partkey % 3 = 0
    UNION ALL
    SELECT p_brand, 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') || '.' || p_size,
           'Ensembl_gene', p_partkey * 10 + 2 FROM part WHERE p_size <= 25
    UNION ALL
    SELECT p_name, 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') || '.' || p_size,
           'Ensembl_gene', p_partkey * 10 + 3 FROM part WHERE p_size <= 25 AND p_partkey % 3 = 0
    UNION ALL
    SELECT p_brand, p_type || '_' || (p_size % 4), 'Ensembl_HGNC', p_partkey * 10 + 4 FROM part
    UNION ALL
    SELECT p_name, p_type || '_' || (p_size % 4), 'Ensembl_HGNC', p_partkey * 10 + 5 FROM part
    UNION ALL
    SELECT p_brand, p_name, 'BLAST_UniProt', p_partkey * 10 + 6 FROM part
"""

# The join of ids and symbols in file order; the pair first seen at the latest place wins.
LAST_SYMBOL_MAP = f"""
    SELECT id, arg_max(symbol, first_seen) AS symbol FROM (
        SELECT i.alias AS id, s.alias AS symbol, min(i.row * 1000000000000 + s.row) AS first_seen
        FROM ({ALIAS_TABLE}) i JOIN ({ALIAS_TABLE}) s ON i.protein_id = s.protein_id
        WHERE i.source = 'Ensembl_HGNC_entrez_id' AND s.source = 'Ensembl_HGNC'
        GROUP BY 1, 2) GROUP BY id
"""

FIRST_SYMBOL_MAP = f"""
    SELECT id, arg_min(symbol, place) AS symbol FROM (
        SELECT split_part(i.alias, '.', 1) AS id, s.alias AS symbol,
               i.row * 1000000000000 + s.row AS place
        FROM ({ALIAS_TABLE}) i JOIN ({ALIAS_TABLE}) s ON i.protein_id = s.protein_id
        WHERE i.alias LIKE 'ENSG%' AND s.source = 'Ensembl_HGNC') GROUP BY id
"""


def cell_values(t: Tables) -> DataFrame:
    """Events as cell measurements; every seventh value is a text that is no number."""
    return t.events.select(
        F.lit("EVENTS").alias("study"),
        F.col("event_id").cast("string").alias("cell_id"),
        F.col("user_id").cast("string").alias("sample_id"),
        F.col("event_type").alias("gene"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


def exact_sum(value: str) -> str:
    """SQL for the exact sum of doubles below 2**62 of whole 2**-64ths, as the double that the library makes of it."""
    low = "((n + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648"
    parts = f"[sum(CAST(trunc({value} * 18446744073709551616.0) AS HUGEINT))]"
    parts = f"list_transform({parts}, lambda n: {{'low': {low}, 'n': (n - ({low})) // 4294967296}})"
    mid = low.replace("n +", "s.n +")
    parts = f"list_transform({parts}, lambda s: {{'low': s.low, 'mid': {mid}, 'n': (s.n - ({mid})) // 4294967296}})"
    double = "CAST(u.{} AS DOUBLE)".format
    total = f"{double('n')} + ({double('mid')} + {double('low')} / 4294967296.0) / 4294967296.0"
    return f"list_transform({parts}, lambda u: {total})[1]"


CELL_VALUES = """
    SELECT 'EVENTS' AS study, CAST(event_id AS VARCHAR) AS cell_id,
           CAST(user_id AS VARCHAR) AS sample_id, event_type AS gene,
           CASE WHEN event_id % 7 <> 0 THEN value END AS value
    FROM events
"""


def event_key(column: str = "props"):
    """The number in the properties of an event."""
    return F.get_json_object(F.col(column), "$.k").cast("int")


EVENT_KEY = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
