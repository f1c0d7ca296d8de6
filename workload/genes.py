"""Queries on gene ids, gene sets and duplicate genes."""

from pyspark.sql import functions as F

from cohortloom.functions.text import clean_gene_id
from cohortloom.operators.genes import (
    alias_pairs,
    common_genes,
    entrez_aliases,
    gene_index,
    gene_overlap,
    genes_of,
    mean_duplicates,
    on_genes,
    preferred_symbol_aliases,
    symbol_aliases,
)
from cohortloom.operators.genesets import add_genes, common_bitmap, common_genes_of, overlap_of_sets
from cohortloom.plans.cohorts import convert_gene_ids, gene_map
from cohortloom.session import settle
from cohortloom.sinks.features import sample_index, to_features, to_tiles, to_wide

from .mapping import (
    ALIAS_TABLE,
    EXPRESSION,
    FIRST_SYMBOL_MAP,
    LAST_SYMBOL_MAP,
    MEASURED_LINES,
    NAMED_EXPRESSION,
    STUDIES,
    alias_table,
    expression,
    measured_lines,
    named_expression,
)
from .registry import Tables, query


@query(
    "duplicate_gene_mean",
    f"""
    SELECT study, sample_id, gene, avg(value) AS value FROM ({NAMED_EXPRESSION})
    GROUP BY study, sample_id, gene
    """,
)
def duplicate_gene_mean(t: Tables):
    return mean_duplicates(named_expression(t))


@query(
    "alias_pairs",
    f"""
    SELECT DISTINCT i.alias AS id, s.alias AS symbol
    FROM ({ALIAS_TABLE}) i JOIN ({ALIAS_TABLE}) s ON i.protein_id = s.protein_id
    WHERE i.source = 'Ensembl_HGNC_entrez_id' AND s.source = 'Ensembl_HGNC'
    """,
)
def pairs_of_aliases(t: Tables):
    alias = alias_table(t)
    return alias_pairs(entrez_aliases(alias), symbol_aliases(alias))


@query("alias_map_last", LAST_SYMBOL_MAP)
def alias_map_last(t: Tables):
    return gene_map(alias_table(t), "drop")


@query("alias_map_first", FIRST_SYMBOL_MAP)
def alias_map_first(t: Tables):
    return gene_map(alias_table(t), "keep")


@query(
    "preferred_symbols",
    f"""
    SELECT 'hgnc' AS choice, protein_id, alias AS symbol, row FROM ({ALIAS_TABLE})
    WHERE alias NOT LIKE 'ENSG%' AND NOT regexp_full_match(alias, '[0-9]+') AND source ILIKE '%HGNC%'
    UNION ALL
    SELECT 'any', protein_id, alias, row FROM ({ALIAS_TABLE})
    WHERE alias NOT LIKE 'ENSG%' AND NOT regexp_full_match(alias, '[0-9]+')
      AND source NOT ILIKE '%HGNC%'
    """,
)
def preferred_symbols(t: Tables):
    alias = alias_table(t)
    without = alias.filter(~F.lower("source").contains("hgnc"))
    return (
        preferred_symbol_aliases(alias).withColumn("choice", F.lit("hgnc"))
        .unionByName(preferred_symbol_aliases(without).withColumn("choice", F.lit("any")))
    )


@query(
    "map_drop_unmatched",
    f"""
    SELECT study, sample_id, symbol AS gene, avg(value) AS value
    FROM ({EXPRESSION}) e JOIN ({LAST_SYMBOL_MAP}) m ON e.gene = m.id
    GROUP BY study, sample_id, symbol
    """,
)
def map_drop_unmatched(t: Tables):
    return convert_gene_ids(expression(t), alias_table(t), "drop")


ENSEMBL_EXPRESSION = f"""
    SELECT r_name AS study, CAST(l_orderkey AS VARCHAR) AS sample_id,
           'ENSG' || lpad(CAST(l_partkey AS VARCHAR), 11, '0') AS gene, l_quantity AS value
    FROM {MEASURED_LINES}
"""


@query(
    "map_keep_unmatched",
    f"""
    SELECT study, sample_id, coalesce(symbol, gene) AS gene, avg(value) AS value
    FROM ({ENSEMBL_EXPRESSION}) e LEFT JOIN ({FIRST_SYMBOL_MAP}) m ON e.gene = m.id
    GROUP BY 1, 2, 3
    """,
)
def map_keep_unmatched(t: Tables):
    raw = F.concat(
        F.lit(' "ENSG'), F.lpad(F.col("l_partkey").cast("string"), 11, "0"), F.lit("."),
        F.col("l_linenumber").cast("string"), F.lit('"'),
    )
    expr = measured_lines(t).select(
        F.col("r_name").alias("study"),
        F.col("l_orderkey").cast("string").alias("sample_id"),
        clean_gene_id(raw).alias("gene"),
        F.col("l_quantity").alias("value"),
    )
    return convert_gene_ids(expr, alias_table(t), "keep")


COMMON_GENES = f"""
    SELECT gene FROM ({EXPRESSION}) GROUP BY gene HAVING count(DISTINCT study) = 5
"""


@query(
    "common_genes",
    f"SELECT row_number() OVER (ORDER BY gene) - 1 AS idx, gene FROM ({COMMON_GENES})",
)
def common_gene_order(t: Tables):
    return gene_index(common_genes(expression(t), STUDIES))


@query(
    "common_genes_bitmap",
    f"""
    SELECT s.studies, row_number() OVER (PARTITION BY s.studies ORDER BY e.gene) - 1 AS place, e.gene
    FROM (SELECT DISTINCT study, gene FROM ({EXPRESSION})) e
    JOIN (VALUES ('ALL', 'AFRICA,AMERICA,ASIA,EUROPE,MIDDLE EAST'), ('TWO', 'AFRICA,ASIA')) s(studies, names)
      ON list_contains(string_split(s.names, ','), e.study)
    GROUP BY s.studies, s.names, e.gene HAVING count(DISTINCT e.study) = len(string_split(s.names, ','))
    """,
)
def common_genes_by_bitmap(t: Tables):
    expr = expression(t)
    # the cohort of one region comes later, and is added without the others
    sets = add_genes(expr.filter("study = 'ASIA'"), add_genes(expr.filter("study <> 'ASIA'")))
    parts = [
        gene_index(common_genes_of(sets, studies)).select(F.lit(name).alias("studies"), F.col("idx").alias("place"), "gene")
        for name, studies in (("ALL", STUDIES), ("TWO", ("AFRICA", "ASIA")))
    ]
    return parts[0].unionByName(parts[1])


MAIN_GENES = f"""
    SELECT gene FROM ({EXPRESSION}) WHERE study IN ('AFRICA', 'ASIA')
    GROUP BY gene HAVING count(DISTINCT study) = 2
"""


@query(
    "align_to_genes",
    f"""
    SELECT e.study, g.idx, e.gene, count(*) AS n_values, sum(e.value) AS total
    FROM ({EXPRESSION}) e
    JOIN (SELECT row_number() OVER (ORDER BY gene) - 1 AS idx, gene FROM ({MAIN_GENES})) g ON e.gene = g.gene
    WHERE e.study NOT IN ('AFRICA', 'ASIA')
    GROUP BY 1, 2, 3
    """,
)
def aligned_genes(t: Tables):
    expr = expression(t)
    index = gene_index(common_genes(expr, ("AFRICA", "ASIA")))
    extra = expr.filter(~F.col("study").isin("AFRICA", "ASIA"))
    return (
        on_genes(extra, index)
        .groupBy("study", "gene")
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("value").alias("total"))
        .join(index, "gene")
    )


@query(
    "gene_overlap",
    f"""
    SELECT study, count(*) AS n_extra_genes, count(m.gene) AS n_common_genes,
           (SELECT count(*) FROM ({MAIN_GENES})) AS n_main_genes
    FROM (SELECT DISTINCT study, gene FROM ({EXPRESSION}) WHERE study NOT IN ('AFRICA', 'ASIA')) x
    LEFT JOIN ({MAIN_GENES}) m ON x.gene = m.gene
    GROUP BY study
    """,
)
def overlap_of_genes(t: Tables):
    expr = expression(t)
    extra = expr.filter(~F.col("study").isin("AFRICA", "ASIA"))
    return gene_overlap(common_genes(expr, ("AFRICA", "ASIA")), extra)


@query(
    "gene_overlap_bitmap",
    f"""
    SELECT study, count(*) AS n_extra_genes, count(m.gene) AS n_common_genes,
           (SELECT count(*) FROM ({MAIN_GENES})) AS n_main_genes
    FROM (SELECT DISTINCT study, gene FROM ({EXPRESSION})) x
    LEFT JOIN ({MAIN_GENES}) m ON x.gene = m.gene
    GROUP BY study
    """,
)
def overlap_by_bitmap(t: Tables):
    sets = add_genes(expression(t))
    return overlap_of_sets(common_bitmap(sets, ("AFRICA", "ASIA")), sets)


@query(
    "gene_difference",
    f"""
    SELECT gene FROM ({EXPRESSION}) WHERE study = 'EUROPE'
    EXCEPT SELECT gene FROM ({EXPRESSION}) WHERE study = 'ASIA'
    """,
)
def gene_difference(t: Tables):
    genes = genes_of(expression(t))
    return (
        genes.filter("study = 'EUROPE'").select("gene")
        .join(genes.filter("study = 'ASIA'").select("gene"), "gene", "left_anti")
    )


@query(
    "features_export",
    f"""
    WITH m AS (
        SELECT sample_id, gene, avg(value) AS value FROM ({NAMED_EXPRESSION}) GROUP BY sample_id, gene),
    g AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS idx FROM (SELECT DISTINCT gene FROM m)),
    s AS (SELECT DISTINCT sample_id FROM m)
    SELECT s.sample_id, count(*) AS n_features, count(m.value) AS n_present,
           coalesce(string_agg(g.idx || '=' || CAST(round(m.value * 60) AS BIGINT), ','
                    ORDER BY g.idx) FILTER (WHERE m.value IS NOT NULL), '') AS present
    FROM s CROSS JOIN g LEFT JOIN m ON m.sample_id = s.sample_id AND m.gene = g.gene
    GROUP BY s.sample_id
    """,
)
def features_export(t: Tables):
    # read twice, for the index and for the values
    expr = settle(mean_duplicates(named_expression(t), ["sample_id", "gene"]), "means")
    features = to_features(expr, gene_index(expr), ["sample_id"])
    shown = F.filter(
        F.transform(
            "features",
            lambda v, i: F.concat_ws(
                "=", i.cast("string"), F.round(v * 60).cast("bigint").cast("string")
            ),
        ),
        lambda text: text.contains("="),
    )
    return features.select(
        "sample_id",
        F.size("features").cast("bigint").alias("n_features"),
        F.size(F.filter("features", lambda v: v.isNotNull())).cast("bigint").alias("n_present"),
        F.array_join(shown, ",").alias("present"),
    )


TILE = (64, 128)


@query(
    "feature_tiles",
    f"""
    WITH m AS (SELECT study, sample_id, gene, avg(value) AS value FROM ({NAMED_EXPRESSION}) GROUP BY ALL),
    g AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS idx FROM (SELECT DISTINCT gene FROM m)),
    s AS (SELECT study, sample_id, row_number() OVER (ORDER BY study, sample_id) - 1 AS row FROM (SELECT DISTINCT study, sample_id FROM m)),
    t AS (
        SELECT row // {TILE[0]} AS sample_block, idx // {TILE[1]} AS gene_block, list(row % {TILE[0]} ORDER BY row, idx) AS rows,
               string_agg(idx % {TILE[1]} || '=' || CAST(value * 60 AS BIGINT), ',' ORDER BY row, idx) AS cells
        FROM m JOIN g USING (gene) JOIN s USING (study, sample_id) WHERE value IS NOT NULL GROUP BY 1, 2)
    SELECT sample_block, gene_block, cells, array_to_string(
        list_transform(range({TILE[0]} + 1), lambda k: len(list_filter(rows, lambda r: r < k))), ',') AS indptr
    FROM t
    """,
)
def feature_tiles(t: Tables):
    expr = settle(mean_duplicates(named_expression(t)), "means")
    tiles = to_tiles(expr, sample_index(expr), gene_index(expr), tile=TILE)
    cell = F.zip_with("indices", "values", lambda c, v: F.concat_ws("=", c.cast("string"), F.round(v * 60).cast("bigint").cast("string")))
    return tiles.select("sample_block", "gene_block", F.array_join(cell, ",").alias("cells"), F.array_join(F.col("indptr").cast("array<string>"), ",").alias("indptr"))


@query(
    "wide_export",
    f"""
    SELECT study, sample_id,
           avg(value) FILTER (WHERE r = 'A') AS "A", avg(value) FILTER (WHERE r = 'N') AS "N",
           avg(value) FILTER (WHERE r = 'R') AS "R"
    FROM (SELECT r_name AS study, CAST(l_orderkey AS VARCHAR) AS sample_id, l_returnflag AS r,
                 l_quantity AS value FROM {MEASURED_LINES})
    GROUP BY study, sample_id
    """,
)
def wide_export(t: Tables):
    expr = measured_lines(t).select(
        F.col("r_name").alias("study"),
        F.col("l_orderkey").cast("string").alias("sample_id"),
        F.col("l_returnflag").alias("gene"),
        F.col("l_quantity").alias("value"),
    )
    return to_wide(mean_duplicates(expr), ["A", "N", "R"])
