"""Queries on scans and sinks: tables written as text by Spark and read back, attribute lines, catalogues."""

from pyspark.sql import functions as F

from cohortloom.functions.fixed_values import ATTRIBUTE_KEYWORDS
from cohortloom.functions.numeric import to_number
from cohortloom.operators.projection import drop_technical, melt, strip_column_names
from cohortloom.plans.cells import mean_cell_file
from cohortloom.plans.cohorts import visit_cohort
from cohortloom.plans.profiling import profile_matrix_file, relevant_names
from cohortloom.session import new_path
from cohortloom.sinks.tables import read_cohort, write_cohort, write_table
from cohortloom.sources.attributes import (
    extract_labelled_attributes,
    named_attributes,
    attribute_maps,
    scan_attribute_lines,
)
from cohortloom.sources.catalog import classify_cell_tables, classify_files, pick_member
from cohortloom.sources.matrix import scan_matrix_long, scan_wide_dataset
from cohortloom.sources.tables import detect_separator, scan_table

from .mapping import ALIAS_TABLE, alias_table, exact_sum
from .registry import Tables, query


def written(t: Tables, df, label: str, sep: str = ",", **options) -> str:
    path = new_path(t.spark, label)
    if options:
        df.write.options(**options).csv(path, header=True, sep=sep, emptyValue="")
    else:
        write_table(df, path, "csv", sep=sep)
    return path


@query(
    "scan_table",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority,
           o_orderstatus AS status, o_totalprice AS price
    FROM orders
    """,
)
def scanned_table(t: Tables):
    source = t.orders.select(
        F.col("o_orderkey").alias(" o_orderkey "),
        F.expr("CASE o_orderkey % 3 WHEN 0 THEN IF(o_orderkey % 2 = 0, 'N/A', '') ELSE o_orderpriority END").alias("priority"),
        F.col("o_orderstatus").alias("status "),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    scanned = strip_column_names(scan_table(t.spark, written(t, source, "orders")))
    return scanned.withColumn("price", F.col("price").cast("double"))


@query("scan_gzip_alias", f"SELECT protein_id, alias, source FROM ({ALIAS_TABLE})")
def scanned_alias(t: Tables):
    source = alias_table(t).select(F.col("protein_id").alias("#string_protein_id"), "alias", "source")
    path = written(t, source, "alias", sep="\t", compression="gzip")
    return scan_table(t.spark, path, sep="\t").withColumnRenamed("#string_protein_id", "protein_id")


@query(
    "scan_commented",
    """
    SELECT p_name AS "Hugo_Symbol", CAST(p_partkey AS VARCHAR) AS id,
           CASE WHEN p_partkey % 3 > 0 THEN p_type END AS type, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS brand
    FROM part WHERE p_partkey % 5 > 0
    """,
)
def scanned_commented(t: Tables):
    # A brand holds the comment sign itself: it is taken out here.
    source = t.part.select(
        F.expr("IF(p_partkey % 5 = 0, concat('#', p_name), p_name)").alias("Hugo_Symbol"),
        F.col("p_partkey").alias("Entrez_Gene_Id"),
        F.col("p_partkey").alias("id"),
        F.expr("IF(p_partkey % 3 = 0, '#rest', p_type)").alias("type"),
        F.translate("p_brand", "#", "-").alias("brand"),
    )
    scanned = scan_table(t.spark, written(t, source, "portal", sep="\t", comment="~"), sep="\t", comment="#")
    return drop_technical(scanned).withColumn("brand", F.translate("brand", "-", "#"))


@query(
    "detect_separator",
    """
    SELECT ';' AS separator, count(*) AS n_rows, CAST(sum(c_acctbal_cents) AS BIGINT) AS cents
    FROM (SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS c_acctbal_cents FROM customer)
    """,
)
def detected_separator(t: Tables):
    source = t.customer.select("c_name", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"))
    path = written(t, source, "customer", sep=";")
    sep = detect_separator(t.spark, path)
    return scan_table(t.spark, path, sep=sep).agg(
        F.lit(sep).alias("separator"),
        F.count("c_name").alias("n_rows"),
        F.sum(F.col("cents").cast("bigint")).alias("cents"),
    )


PHASES = {"F": "Pre", "O": "Post"}
THERAPIES = {"A": "RAFi", "N": "RAF/MEKi", "R": "RAF"}
SAMPLES = [
    f"Patient {n} {phase}-{therapy}"
    for n in range(1, 8) for phase in PHASES.values() for therapy in THERAPIES.values()
]
SAMPLE_SQL = """
    'Patient ' || l_linenumber || CASE l_linestatus WHEN 'F' THEN ' Pre-' ELSE ' Post-' END
    || CASE l_returnflag WHEN 'A' THEN 'RAFi' WHEN 'N' THEN 'RAF/MEKi' ELSE 'RAF' END
"""


def quantity_matrix(t: Tables) -> str:
    """Parts x samples as a tab-separated text: annotation columns, empty cells, repeated genes."""
    def chosen(column: str, names: dict):
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        return F.create_map(*pairs)[F.col(column)]

    sample = F.concat(
        F.lit("Patient "), F.col("l_linenumber").cast("string"), F.lit(" "),
        chosen("l_linestatus", PHASES), F.lit("-"), chosen("l_returnflag", THERAPIES),
    )
    wide = (
        t.lineitem.withColumn("sample", sample)
        .groupBy("l_partkey").pivot("sample", SAMPLES).agg(F.sum("l_quantity").cast("int"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return written(
        t,
        wide.select(
            F.col("p_partkey").alias("Entrez_Gene_Id"), F.col("p_name").alias("Gene Symbol"),
            F.col("p_type").alias("Description"), *[f"`{name}`" for name in SAMPLES],
        ),
        "matrix", sep="\t",
    )


QUANTITY_MATRIX = f"""
    SELECT l_partkey, p_name AS gene, {SAMPLE_SQL} AS sample_id, sum(l_quantity) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
"""


@query(
    "scan_matrix",
    f"""
    SELECT s.sample_id, g.gene, sum(g.n) AS n_cells, count(m.value) AS n_present, coalesce(sum(m.value), 0) AS total
    FROM (SELECT DISTINCT sample_id FROM ({QUANTITY_MATRIX})) s
    CROSS JOIN (SELECT p_name AS gene, p_partkey, 1 AS n FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)) g
    LEFT JOIN ({QUANTITY_MATRIX}) m ON m.sample_id = s.sample_id AND m.l_partkey = g.p_partkey
    GROUP BY s.sample_id, g.gene
    """.replace("sum(g.n)", "CAST(sum(g.n) AS BIGINT)"),
)
def scanned_matrix(t: Tables):
    cells = scan_matrix_long(t.spark, quantity_matrix(t), "S", sep="\t", gene_column="Gene Symbol")
    return cells.groupBy("sample_id", "gene").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count("value").alias("n_present"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"),
    )


@query(
    "scan_visit_cohort",
    f"""
    SELECT sample_id, gene, avg(value) AS value,
           'S_' || replace(split_part(sample_id, ' P', 1), ' ', '_') AS patient_id,
           CASE WHEN sample_id LIKE '% Pre-%' THEN 'Pre' ELSE 'Post' END AS treatment_phase,
           CASE WHEN sample_id LIKE '%MEK%' THEN 'RAF_MEKi' ELSE 'RAFi' END AS therapy_type
    FROM ({QUANTITY_MATRIX}) GROUP BY ALL
    """,
)
def scanned_visit_cohort(t: Tables):
    cells = scan_matrix_long(
        t.spark, quantity_matrix(t), "S", sep="\t", sample_pattern=r"^Patient\s+\d+\s+(Pre|Post)-"
    )
    cohort = visit_cohort(cells, "S")
    details = cohort.samples.select("sample_id", "patient_id", "treatment_phase", "therapy_type")
    return cohort.expr.dropna(subset=["value"]).drop("study").join(details, "sample_id")


@query(
    "overlap_profile",
    f"""
    WITH cells AS ({QUANTITY_MATRIX}),
    main AS (SELECT p_name AS gene FROM part WHERE p_size > 30 UNION SELECT 'absent'),
    rows AS (SELECT count(DISTINCT l_partkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey),
    -- the header: id, gene, remark, then a column per line number, status and flag
    header AS (
        SELECT 0 AS place, true AS numeric
        UNION ALL SELECT 1, (SELECT bool_and(TRY_CAST(p_type AS DOUBLE) IS NOT NULL) FROM part)
        UNION ALL SELECT 1 + row_number() OVER (), true
        FROM range(1, 8), (VALUES ('Pre'), ('Post')) v(phase), (VALUES ('RAFi'), ('RAF/MEKi'), ('RAF')) w(therapy))
    SELECT 'S' AS study, chr(9) AS separator, n AS n_rows, (SELECT count(DISTINCT gene) FROM cells) AS n_unique_genes,
           (SELECT count(*) FROM cells WHERE gene IS NULL) AS n_missing_genes, (SELECT count(*) FROM header) AS n_samples,
           n * (SELECT count(*) FROM header WHERE place > 1) - (SELECT count(*) FROM cells) AS n_missing_cells,
           (SELECT count(*) FROM header WHERE numeric AND place < 20) AS n_numeric_samples,
           (SELECT count(DISTINCT gene) FROM cells) AS n_extra_genes,
           (SELECT count(DISTINCT gene) FROM cells WHERE gene IN (SELECT gene FROM main)) AS n_common_genes,
           (SELECT count(*) FROM main) AS n_main_genes
    FROM rows
    """,
)
def overlap_profile(t: Tables):
    # Among the first 20 columns of the header, the text column Description is no number.
    main = t.part.filter("p_size > 30").select(F.col("p_name").alias("gene")).distinct()
    main = main.unionByName(t.part.agg(F.lit("absent").alias("gene")))
    return profile_matrix_file(t.spark, quantity_matrix(t), "S", main).drop("file")


HOURS = [f"A{h}_P{h % 5}_M1" for h in range(24)]


@query(
    "scan_cell_text",
    f"""
    WITH sums AS (
        SELECT user_id, hour(ts) AS h, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY ALL),
    cells AS (
        SELECT u.user_id, h.h, s.v FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN range(24) h(h)
        LEFT JOIN sums s ON s.user_id = u.user_id AND s.h = h.h)
    SELECT 'S_' || (h % 5) AS sample_id, 'U' || user_id AS gene,
           coalesce({exact_sum('CASE WHEN user_id % 4 <> 1 THEN CAST(v AS DOUBLE) END')}, 0.0) / count(*) AS value
    FROM cells WHERE h % 5 <> 4 GROUP BY ALL
    """,
)
def scanned_cell_text(t: Tables):
    hour = F.hour("ts")
    cell = F.concat(F.lit("A"), hour.cast("string"), F.lit("_P"), (hour % 5).cast("string"), F.lit("_M1"))
    sums = (
        t.events.withColumn("cell", cell).groupBy("user_id").pivot("cell", HOURS)
        .agg(F.sum(F.col("value").cast("decimal(18,2)")))
    )
    # Every fourth gene holds texts; one row per gene carries visit tokens and is skipped.
    shown = [
        F.when(F.col("user_id") % 4 == 1, "x").otherwise(F.col(name).cast("string")).alias(name) for name in HOURS
    ]
    genes = sums.select(F.concat(F.lit(" U"), F.col("user_id").cast("string")).alias("gene"), *shown)
    tokens = sums.select(
        F.concat(F.lit("Pre_P"), F.col("user_id").cast("string")).alias("gene"), *[F.lit("Pre").alias(n) for n in HOURS]
    )
    path = written(t, genes.unionByName(tokens), "cells", sep="\t")
    samples = t.events.select((F.col("user_id") % 4).alias("p")).distinct().select(
        F.concat(F.lit("S "), F.col("p").cast("string")).alias("sample_id"),
        F.concat(F.lit("P"), F.col("p").cast("string")).alias("patient_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("response", "dataset_role", "notes")],
        F.lit(None).cast("int").alias("response_binary"),
        F.col("p").alias("row"),
    )
    expr = mean_cell_file(t.spark, path, samples, "TPM").expr
    return expr.select("sample_id", "gene", "value")


@query(
    "melt_wide",
    """
    SELECT c_custkey, 'c_nationkey' AS gene, CAST(c_nationkey AS DOUBLE) AS value FROM customer
    UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer
    """,
)
def melted(t: Tables):
    wide = t.customer.select("c_custkey", F.col("c_nationkey").cast("double"), "c_acctbal")
    return melt(wide, ["c_custkey"])


@query(
    "scan_attribute_text",
    """
    SELECT CASE role WHEN 'system' THEN '!Sample_title' ELSE '!Sample_characteristics_ch1' END AS key,
           len(string_split(line, ' ')) AS n_fields, md5(replace(line, ' ', '|')) AS digest, count(*) AS n
    FROM (SELECT role, conv_id || 'k' || turn || ' ' || replace(replace(text, chr(10), ' '), chr(9), ' ') || ' end' AS line
          FROM conversations WHERE turn % 3 <> 2)
    GROUP BY ALL
    """,
)
def scanned_attribute_text(t: Tables):
    words = F.expr("concat(conv_id, 'k', turn, ' ', translate(text, '\\n\\t', '  '), ' end')")
    key = F.expr(
        """CASE WHEN turn % 3 = 2 THEN '!Series_summary' WHEN role = 'system' THEN '!Sample_title'
           ELSE '!Sample_characteristics_ch1' END"""
    )
    path = new_path(t.spark, "series")
    t.conversations.select(F.concat_ws("\t", key, F.translate(words, " ", "\t"))).write.text(path, compression="gzip")
    return (
        scan_attribute_lines(t.spark, path)
        .groupBy("key", F.size("fields").cast("bigint").alias("n_fields"), F.md5(F.array_join("fields", "|")).alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "scan_wide",
    """
    SELECT c_mktsegment AS study, c_name AS sample_id, 'c_nationkey' AS gene, CAST(c_nationkey AS DOUBLE) AS value
    FROM customer
    UNION ALL
    SELECT c_mktsegment, c_name, 'c_acctbal', CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END FROM customer
    """,
)
def scanned_wide(t: Tables):
    wide = t.customer.select(
        F.col("c_name").alias("sample_id"), "c_nationkey", F.col("c_mktsegment").alias("study"),
        F.expr("IF(c_custkey % 3 = 0, 'NA', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING))").alias("c_acctbal"),
    )
    cohort = scan_wide_dataset(t.spark, written(t, wide, "wide"), ["study", "sample_id"])
    path = new_path(t.spark, "cohort")
    write_cohort(cohort, path)
    return read_cohort(t.spark, path).expr


def conversation_lines(t: Tables):
    """Conversations as attribute lines: file = conversation, line = turn, values = all words of the text."""
    label = F.expr(
        "CASE role WHEN 'user' THEN 'User (Pt/ID-a): ' WHEN 'assistant' THEN 'Time to reply : ' ELSE '' END"
    )
    return t.conversations.select(
        F.col("conv_id").cast("string").alias("file"),
        F.col("turn").alias("line_no"),
        F.expr("turn div 4").alias("block"),
        F.expr("CASE WHEN role = 'system' THEN '!Sample_title' WHEN turn = 1 THEN '!Sample_description' "
               "ELSE '!Sample_characteristics_ch1' END").alias("key"),
        F.transform(
            F.split("text", " "),
            lambda word: F.concat(label, F.lit('"'), word, F.lit('"')),
        ).alias("fields"),
    )


# Words of every turn, cleaned, with the label put before them.
CONVERSATION_VALUES = r"""
    SELECT conv_id, turn, idx, role, CASE WHEN role = 'system' THEN 'title' WHEN turn = 1 THEN 'description' END AS key,
           CASE role WHEN 'user' THEN 'User (Pt/ID-a): ' WHEN 'assistant' THEN 'Time to reply : ' ELSE '' END AS label,
           replace(w, '"', '') AS w
    FROM (SELECT *, unnest(words) AS w, CAST(unnest(range(len(words))) AS INTEGER) AS idx
          FROM (SELECT *, string_split(text, ' ') AS words FROM conversations))
"""
TRIMMED = r"trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"

NAMED_VALUES = f"""
    WITH v AS ({CONVERSATION_VALUES}),
    lines AS (
        SELECT conv_id, turn, CASE role WHEN 'user' THEN 'characteristics_user_pt_id_a'
                                WHEN 'assistant' THEN 'characteristics_time_to_reply'
                                ELSE 'characteristics_unknown' END AS slug
        FROM v WHERE key IS NULL GROUP BY ALL),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, slug ORDER BY turn) AS n FROM lines)
    SELECT CAST(v.conv_id AS VARCHAR) AS file, v.idx AS sample_idx,
           slug || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS name,
           CASE WHEN label = '' THEN nullif({TRIMMED.format('w')}, '') ELSE {TRIMMED.format('w')} END AS value
    FROM v JOIN numbered USING (conv_id, turn)
    UNION ALL
    SELECT CAST(v.conv_id AS VARCHAR), idx, key, nullif({TRIMMED.format('label || w')}, '')
    FROM v WHERE key IS NOT NULL AND turn = (SELECT max(turn) FROM v x WHERE x.conv_id = v.conv_id AND x.key = v.key)
"""


@query("attribute_lines", NAMED_VALUES)
def attribute_lines(t: Tables):
    return named_attributes(conversation_lines(t))


@query(
    "attribute_records",
    f"""
    WITH named AS ({NAMED_VALUES})
    SELECT file, sample_idx, count(*) AS n_attributes,
           string_agg(name || '=' || coalesce(value, ''), '|' ORDER BY name) AS attributes
    FROM named GROUP BY file, sample_idx
    """,
)
def attribute_records(t: Tables):
    entries = F.array_sort(F.map_entries("attributes"))
    shown = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return attribute_maps(named_attributes(conversation_lines(t))).select(
        "file",
        "sample_idx",
        F.size("attributes").cast("bigint").alias("n_attributes"),
        F.array_join(shown, "|").alias("attributes"),
    )


@query(
    "labelled_attributes",
    f"""
    WITH w AS (
        SELECT *, unnest(words) AS w, CAST(unnest(range(len(words))) AS INTEGER) AS idx
        FROM (SELECT conv_id || '-' || turn AS file, turn, string_split(text, ' ') AS words FROM conversations))
    SELECT file, idx AS sample_idx, {TRIMMED.format("replace(w, '" + '"' + "', '')")} AS patient_id,
           CASE WHEN length(w) % 2 = 0 THEN 'PD' ELSE 'CR' END AS response, CAST(length(w) AS VARCHAR) AS age,
           CASE WHEN turn % 2 = 0 THEN CASE WHEN length(w) > 3 THEN 'F' ELSE 'M' END END AS gender,
           'later' AS treatment
    FROM w
    """,
)
def labelled_attributes(t: Tables):
    words = F.split("text", " ")

    def line(number: int, key: str, fields):
        return F.struct(F.lit(number).alias("line_no"), F.lit(key).alias("key"), fields.alias("fields"))

    def labelled(text: str, value):
        return F.transform(words, lambda w: F.concat(F.lit(text), value(w)))

    characteristics = "!Sample_characteristics_ch1"
    gender = labelled("Gender: ", lambda w: F.when(F.length(w) > 3, "F").otherwise("M"))
    shorter = F.slice(gender, 1, F.size(gender) - 1)
    lines = F.array(
        line(1, "!Sample_title", words),
        line(2, characteristics, labelled("anti-PD-1 response: ", lambda w: F.when(F.length(w) % 2 == 0, "PD").otherwise("CR"))),
        line(3, characteristics, labelled("age (yrs): about: ", lambda w: F.length(w).cast("string"))),
        line(4, characteristics, F.when(F.col("turn") % 2 == 0, gender).otherwise(shorter)),
        line(5, characteristics, labelled("Treatment: ", lambda w: F.lit("earlier"))),
        line(6, characteristics, labelled("treatment: ", lambda w: F.lit("later"))),
    )
    file = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    rows = t.conversations.select(file.alias("file"), F.inline(lines))
    rows = rows.withColumn("line", F.concat_ws("\t", F.array("key"), "fields"))
    return extract_labelled_attributes(rows).select(
        "file", "sample_idx", "patient_id", "response", "age", "gender", "treatment"
    )


NAMES = [
    "/data_mrna_seq_tpm_zscores.txt", "/data_RPKM.txt", "/data_clinical_sample.txt", "/Expression_counts.csv",
    "/data_mrna.txt", "/data_cna_fpkm.txt", "/Melanoma_RNA_counts.csv", "/adt_counts.tsv", "/RNA_metadata.csv",
    "/barcodes.tsv", "/other.csv", "/readme",
]


def file_catalog(t: Tables):
    """Page addresses as paths, each ending in one of some file names."""
    name = F.get(F.array(*[F.lit(n) for n in NAMES]), (F.col("page_id") % len(NAMES)).cast("int"))
    folder = F.translate(F.regexp_extract("url", "^https?://([^/?#]+)", 1), ".", "_")
    return t.pages.select(F.concat(folder, name).alias("path"), F.col("page_id").alias("ord"))


FILE_CATALOG = f"""
    SELECT replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '.', '_')
           || [{", ".join("'" + n + "'" for n in NAMES)}][page_id % {len(NAMES)} + 1] AS path, page_id AS ord
    FROM pages
"""


@query(
    "classify_files",
    f"""
    SELECT path, CASE WHEN p LIKE '%tpm%' THEN 'TPM' WHEN p LIKE '%rpkm%' THEN 'RPKM' WHEN p LIKE '%fpkm%' THEN 'FPKM'
                WHEN p LIKE '%zscore%' THEN 'z-score' WHEN p LIKE '%count%' THEN 'counts'
                WHEN p LIKE '%mrna%' OR p LIKE '%expression%' THEN 'mRNA expression, format exact à confirmer' ELSE 'unknown' END AS format,
           p LIKE '%.txt' AND regexp_matches(p, 'data_mrna|expression|rpkm|tpm|fpkm|zscore')
             AND NOT regexp_matches(p, 'genetic_alteration|case_lists|meta_|clinical|mutation|cna|timeline|signature')
             AS is_expression,
           p LIKE '%.txt' AND p LIKE '%clinical%' AS is_clinical, ord
    FROM (SELECT *, lower(path) AS p FROM ({FILE_CATALOG}))
    """,
)
def classified_files(t: Tables):
    return classify_files(file_catalog(t))


@query(
    "classify_cell_tables",
    f"""
    SELECT path, ord, CASE WHEN p LIKE '%rna_counts%' THEN 'single_cell_rna_counts' WHEN p LIKE '%adt_counts%'
                  THEN 'single_cell_adt_counts' WHEN p LIKE '%metadata%' THEN 'metadata'
                  WHEN p LIKE '%barcode%' THEN 'sample_barcode_assignment' ELSE 'unknown_tabular' END AS kind,
           CASE WHEN p LIKE '%rna_counts%' THEN 'counts' WHEN p LIKE '%adt_counts%' THEN 'ADT counts' END AS format,
           CASE WHEN regexp_matches(p, 'rna_counts|adt_counts') THEN 5
                WHEN regexp_matches(p, 'metadata|barcode') THEN NULL ELSE 20 END AS preview_rows
    FROM (SELECT *, lower(path) AS p FROM ({FILE_CATALOG})) WHERE p LIKE '%.csv' OR p LIKE '%.tsv'
    """,
)
def classified_cell_tables(t: Tables):
    return classify_cell_tables(file_catalog(t))


@query(
    "pick_member",
    f"""
    SELECT arg_min(path, ord) AS path, count(*) AS n_matches FROM ({FILE_CATALOG})
    WHERE lower(path) LIKE '%melanoma\\_rna\\_counts.csv%' ESCAPE '\\'
    """,
)
def picked_member(t: Tables):
    return pick_member(file_catalog(t), "Melanoma_RNA_counts.csv")


@query(
    "keyword_columns",
    f"""
    SELECT DISTINCT name FROM (SELECT unnest(string_split(text, ' ')) AS name FROM conversations)
    WHERE regexp_matches(lower(name), '{"|".join(ATTRIBUTE_KEYWORDS)}')
    """,
)
def keyword_columns(t: Tables):
    names = t.conversations.select(F.explode(F.split("text", " ")).alias("name")).distinct()
    return relevant_names(names, "name", ATTRIBUTE_KEYWORDS)


@query(
    "numeric_coercion",
    """
    SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN CAST(event_id AS DOUBLE)
        WHEN 2 THEN event_id * 1000.0 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL
        WHEN 6 THEN -0.5 ELSE NULL END AS number
    FROM events
    """,
)
def numeric_coercion(t: Tables):
    text = F.expr(
        """CASE event_id % 8 WHEN 0 THEN concat(' ', event_id, ' ') WHEN 1 THEN concat('+', event_id, '.')
           WHEN 2 THEN concat(event_id, 'E3') WHEN 3 THEN concat(event_id, 'd') WHEN 4 THEN 'nan'
           WHEN 5 THEN 'Infinity' WHEN 6 THEN '-.5' ELSE '0x1p3' END"""
    )
    return t.events.select("event_id", to_number(text).alias("number"))
