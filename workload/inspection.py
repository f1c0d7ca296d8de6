"""Query on the inspection of many files: tables written as text files of several kinds, looked at in one go."""

from pyspark.sql import functions as F

from cohortloom.plans.inspection import inspect_files
from cohortloom.plans.profiling import profile_of_sketches, sketch_files
from cohortloom.session import new_path, settle

from .mapping import MEASURED_LINES, measured_lines
from .registry import Tables, query

LINES = range(1, 8)


def matrix_files(t: Tables, folder: str) -> list[str]:
    """A tab-separated matrix per region: parts x line numbers, and a text column that is taken for a sample."""
    wide = (
        measured_lines(t).groupBy("r_name", "l_partkey").pivot("l_linenumber", list(LINES)).agg(F.sum("l_quantity").cast("int"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    shown = wide.select(
        F.concat(F.lit("data_mrna_tpm_"), "r_name", F.lit(".txt")).alias("file"),
        F.col("p_type").alias("remark"),
        F.expr("IF(l_partkey % 50 = 0, 'NA', concat(' ', p_name))").alias("Hugo_Symbol"),
        *[F.col(str(n)).alias(f"s{n}") for n in LINES],
    )
    shown.write.partitionBy("file").csv(folder, header=True, sep="\t", emptyValue="")
    return [f"{folder}/file=data_mrna_tpm_{r.r_name}.txt" for r in t.region.select("r_name").collect()]


def clinical_files(t: Tables, folder: str) -> list[str]:
    """A table of customers per market segment, separated by semicolons."""
    name = F.concat(F.lit("data_clinical_"), "c_mktsegment", F.lit(".txt"))
    shown = t.customer.select(
        name.alias("file"), F.col("c_custkey").alias("SAMPLE_ID"), F.col("c_name").alias("label"),
        F.expr("IF(c_custkey % 3 = 0, 'N/A', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING))").alias("Age"),
        F.expr("IF(c_custkey % 4 = 0, '', 'CR')").alias("RESPONSE"),
    )
    shown.write.partitionBy("file").csv(folder, header=True, sep=";", emptyValue="")
    return [f"{folder}/{r.file}" for r in shown.select(F.concat(F.lit("file="), "file").alias("file")).distinct().collect()]


def unreadable_file(t: Tables, path: str) -> str:
    """A file that says it is compressed and is not."""
    context = t.spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(f"{path}/part-0.csv.gz")
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    out.writeBytes("Hugo_Symbol\ts1\nG\t1\n")
    out.close()
    return path


@query(
    "inspect_files",
    f"""
    WITH cells AS (
        SELECT r_name, l_partkey, l_linenumber, p_name, l_partkey % 50 = 0 AS unnamed
        FROM {MEASURED_LINES} JOIN part ON l_partkey = p_partkey),
    main AS (SELECT p_name AS gene FROM part WHERE p_size > 30 UNION SELECT 'absent'),
    listed AS (
        SELECT 'other' AS kind, 'OTHER' AS dataset, 'readme.md' AS file, 'unknown' AS format, NULL AS problem
        UNION ALL SELECT 'expression', 'BROKEN', 'data_mrna_tpm_broken.txt', 'TPM', 'cannot be read'
        UNION ALL SELECT 'expression', 'BROKEN', 'data_mrna_zscore_gone.txt', 'z-score', 'no such file')
    SELECT 'BULK' AS dataset, 'data_mrna_tpm_' || r_name || '.txt' AS file, 'expression' AS file_type, 'TPM' AS format,
           chr(9) AS separator, count(DISTINCT l_partkey) AS n_rows,
           count(DISTINCT p_name) FILTER (WHERE NOT unnamed) AS n_unique_genes,
           count(DISTINCT l_partkey) FILTER (WHERE unnamed) AS n_missing_genes,
           (SELECT count(*) FROM range(1, 8)) + 1 AS n_samples,
           count(DISTINCT l_partkey) * (SELECT count(*) FROM range(1, 8)) - count(DISTINCT (l_partkey, l_linenumber)) AS n_missing_cells,
           (SELECT count(*) FROM range(1, 8)) + (SELECT CAST(bool_and(TRY_CAST(p_type AS DOUBLE) IS NOT NULL) AS BIGINT) FROM part) AS n_numeric_samples,
           count(DISTINCT p_name) FILTER (WHERE NOT unnamed) AS n_extra_genes,
           count(DISTINCT p_name) FILTER (WHERE NOT unnamed AND p_name IN (SELECT gene FROM main)) AS n_common_genes,
           (SELECT count(*) FROM main) AS n_main_genes,
           NULL AS n_cols, NULL AS n_missing, NULL AS n_numeric_cols, NULL AS relevant_columns, NULL AS problem
    FROM cells GROUP BY r_name
    UNION ALL
    SELECT 'CLINIC', 'data_clinical_' || c_mktsegment || '.txt', 'clinical', 'unknown', ';', count(*), NULL, NULL, NULL, NULL, NULL,
           NULL, NULL, NULL, 4, count(*) FILTER (WHERE c_custkey % 3 = 0) + count(*) FILTER (WHERE c_custkey % 4 = 0),
           1 + CAST(count(*) FILTER (WHERE c_custkey % 3 <> 0) > 0 AS BIGINT), 'SAMPLE_ID; Age; RESPONSE', NULL
    FROM customer GROUP BY c_mktsegment
    UNION ALL
    SELECT dataset, file, kind, format, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, problem
    FROM listed
    """,
)
def inspected_files(t: Tables):
    base = new_path(t.spark, "inspect")
    files = {
        "BULK": matrix_files(t, f"{base}/bulk"),
        "CLINIC": clinical_files(t, f"{base}/clinic"),
        "BROKEN": [unreadable_file(t, f"{base}/broken/data_mrna_tpm_broken.txt"), f"{base}/broken/data_mrna_zscore_gone.txt"],
        "OTHER": [f"{base}/readme.md"],
    }
    main = t.part.filter("p_size > 30").select(F.col("p_name").alias("gene")).distinct()
    found = inspect_files(t.spark, files, main.unionByName(t.part.agg(F.lit("absent").alias("gene"))))
    name = F.regexp_replace("file", "^.*/(file=)?", "")
    return found.withColumns({"file": name, "problem": F.split_part("error", F.lit(":"), F.lit(1))}).drop("error")


SKETCHED = {
    "orders": {
        "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus",
        "priority": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END",
    },
    "customer": {"c_custkey": "c_custkey", "c_mktsegment": "c_mktsegment", "c_nationkey": "c_nationkey", "nothing": "CASE WHEN c_custkey < 0 THEN 'x' END"},
}


@query(
    "sketch_profile",
    """
    SELECT "column", n_rows, n_missing, n_values, true AS near, examples,
           CASE WHEN n_values <= 500 THEN coalesce(most, 0) END AS most
    FROM ({}) s JOIN (
        SELECT "column" AS c, max(n) AS most FROM (SELECT "column", value, count(*) FILTER (WHERE value IS NOT NULL) AS n FROM ({}) GROUP BY ALL) GROUP BY 1
    ) t ON s."column" = t.c
    """.format(
        *[
            " UNION ALL ".join(part.format(name, value, table) for table, columns in SKETCHED.items() for name, value in columns.items())
            for part in (
                "SELECT '{0}' AS \"column\", count(*) AS n_rows, count(*) - count({1}) AS n_missing, count(DISTINCT {1}) AS n_values,"
                " coalesce(array_to_string(list_sort(list(DISTINCT CAST({1} AS VARCHAR)) FILTER (WHERE {1} IS NOT NULL))[1:12], ','), '') AS examples FROM {2}",
                "SELECT '{0}' AS \"column\", CAST({1} AS VARCHAR) AS value FROM {2}",
            )
        ]
    ),
)
def sketched_profile(t: Tables):
    base, paths, exact = new_path(t.spark, "sketch"), [], []
    for (table, columns), sep in zip(SKETCHED.items(), (",", ";")):
        shown = getattr(t, table).selectExpr(*[f"{value} AS {name}" for name, value in columns.items()])
        paths.append(f"{base}/{table}")
        shown.write.csv(paths[-1], header=True, sep=sep, emptyValue="", nullValue="NA")
        exact += [shown.agg(F.lit(name).alias("column"), F.count_distinct(name).alias("exact")) for name in columns]
    profile = profile_of_sketches(settle(sketch_files(t.spark, paths), "sketches"))
    counted = exact[0]
    for more in exact[1:]:
        counted = counted.unionByName(more)
    return profile.join(counted, "column").select(
        "column", "n_rows", "n_missing", F.col("exact").alias("n_values"),
        (F.abs(F.col("n_values") - F.col("exact")) <= F.col("exact") * 0.04).alias("near"),
        F.array_join("examples", ",").alias("examples"),
        F.when(F.col("exact") <= 500, F.coalesce(F.get("most_frequent", F.lit(0))["n"], F.lit(0))).alias("most"),
    )
