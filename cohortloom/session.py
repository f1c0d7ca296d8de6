"""Session defaults and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session that names none gets one of its own; a cluster must
    name a folder that all executors see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    on_cluster = not context.master.startswith("local")
    if not folder:
        if on_cluster:
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="cohortloom-")
        folder = _local_folders[context.applicationId]
    elif on_cluster and re.match("/tmp/|/var/tmp/|file:/+(tmp|var/tmp)/", folder + "/"):
        # it may be mounted on all of them, which cannot be told from here
        warnings.warn(f"spark.checkpoint.dir is {folder}: every executor must see that folder", stacklevel=3)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/cohortloom/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a table once to the shared folder and read it back.

    This cuts the lineage in a way that survives a lost executor, and it gives
    Spark the exact size of the table: a join with it is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled beyond it.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
