"""Published datasets: tables in files of bounded size under a manifest that is written last.

``data/<version>`` holds the files of a version, ``manifest/<version>`` what is in them. Spark marks a written folder
as complete at the very end, and readers go by the latest complete manifest. So a run that dies half-way leaves
files that nobody reads, and the version before stays what it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a file, and parts into which the genes of a study are dealt.
MAX_ROWS = 5_000_000
BUCKETS = 256
_BUCKET = "_gene_bucket"
_MARK = "_SUCCESS"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions, oldest first; the folder of manifests is listed, no data."""
    place, system = _file_system(spark, f"{path}/manifest")
    if not system.exists(place):
        return []
    names = sorted(status.getPath().getName() for status in system.listStatus(place))
    return [n for n in names if system.exists(_file_system(spark, f"{path}/manifest/{n}/{_MARK}")[0])]


def gene_bucket(gene: Column) -> Column:
    return F.pmod(F.xxhash64(gene), F.lit(BUCKETS)).cast("int")


def _clustered(df: DataFrame) -> DataFrame:
    """Rows of one study and gene bucket close together; a large group is dealt to several tasks by their size."""
    if not {"study", "gene"} <= set(df.columns):
        return df
    keyed = df.withColumn(_BUCKET, gene_bucket(F.col("gene")))
    order = ["study", _BUCKET, "gene", *(["sample_id"] if "sample_id" in df.columns else [])]
    return keyed.hint("rebalance", "study", _BUCKET).sortWithinPartitions(*order)


def _described(spark: SparkSession, path: str, version: str, table: str) -> DataFrame:
    """(table, file, n_rows, first, last) of the written files; of the rows only study and bucket are read."""
    folder = f"{path}/data/{version}/{table}"
    stored = spark.read.parquet(folder)
    clustered = _BUCKET in stored.columns
    nothing = F.struct(F.lit(None).cast("string").alias("study"), F.lit(None).cast("int").alias("bucket"))
    key = F.struct(F.col("study").cast("string").alias("study"), F.col(_BUCKET).alias("bucket")) if clustered else nothing
    file = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    return (
        stored.groupBy(F.lit(table).alias("table"), file.alias("file"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    )


def publish(tables: Mapping[str, DataFrame], path: str, max_rows: int = MAX_ROWS, keep: int = 2) -> str:
    """Write the tables as the next version of a dataset and return its name; older ones but ``keep - 1`` go.

    Tables with ``study`` and ``gene`` are clustered by them. Whoever reads the version before goes on reading it.
    """
    spark = next(iter(tables.values())).sparkSession
    known = _versions(spark, path)
    number = int(known[-1].split("-")[0][1:]) + 1 if known else 0
    version = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        _clustered(df).write.option("maxRecordsPerFile", max_rows).parquet(f"{path}/data/{version}/{name}")
    described = reduce(DataFrame.unionByName, [_described(spark, path, version, name) for name in tables])
    described.coalesce(1).write.parquet(f"{path}/manifest/{version}")  # one row per file
    for old in known[: max(0, len(known) - keep + 1)]:
        for part in ("manifest", "data"):  # the manifest first, so that nobody begins to read what goes
            place, system = _file_system(spark, f"{path}/{part}/{old}")
            system.delete(place, True)
    return version


def read_published(
    spark: SparkSession,
    path: str,
    table: str,
    studies: Sequence[str] | None = None,
    genes: Sequence[str] | None = None,
) -> DataFrame:
    """A table of the latest complete version, all of it or some studies or genes; files that cannot hold them are not read.

    The manifest, a row per file, reaches the driver, as the reader takes the names of files.
    """
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no published dataset in {path}")
    listed = spark.read.parquet(f"{path}/manifest/{versions[-1]}").filter(F.col("table") == table)
    folder = f"{path}/data/{versions[-1]}/{table}"
    schema = spark.read.parquet(folder).schema
    clustered = _BUCKET in schema.names
    if (studies is not None or genes is not None) and not clustered:
        raise ValueError(f"table {table} has no study and gene")
    if studies is not None:
        # a null study is the smallest
        near = [F.coalesce(F.col("first.study") <= s, F.lit(True)) & F.coalesce(F.col("last.study") >= s, F.lit(False)) for s in studies]
        listed = listed.filter(reduce(Column.__or__, near, F.lit(False)))
    if genes is not None:
        wanted = spark.createDataFrame([(g,) for g in genes], "gene string").select(gene_bucket(F.col("gene"))).distinct()
        buckets = [row[0] for row in wanted.collect()]
        whole = F.coalesce(F.col("first.study") != F.col("last.study"), F.lit(True))
        near = [F.lit(b).between(F.col("first.bucket"), F.col("last.bucket")) for b in buckets]
        listed = listed.filter(whole | reduce(Column.__or__, near, F.lit(False)))
    files = sorted(row["file"] for row in listed.select("file").collect())
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{f}" for f in files]) if files else spark.createDataFrame([], schema)
    if studies is not None:
        rows = rows.filter(F.col("study").isin(*studies))
    if genes is not None:
        rows = rows.filter(F.col("gene").isin(*genes))
    return rows.drop(_BUCKET)
