"""Table and summary sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cohort import Cohort
from ..operators.summaries import stack
from ..session import settle
from .published import publish, read_published


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), sep: str = ","
) -> None:
    """Overwrite a table; CSV gets a header line per file."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.csv(path, header=True, sep=sep, emptyValue="")
    else:
        writer.format(fmt).save(path)


def write_cohort(cohort: Cohort, path: str) -> None:
    """Publish a cohort: measurements clustered by study and gene, samples beside them, both under one manifest."""
    publish({"expr": cohort.expr, "samples": cohort.samples}, path)


def read_cohort(
    spark: SparkSession, path: str, studies: Sequence[str] | None = None, genes: Sequence[str] | None = None
) -> Cohort:
    """A published cohort, with the measurements of some studies or genes alone if asked for."""
    expr = read_published(spark, path, "expr", studies, genes)
    return Cohort(read_published(spark, path, "samples"), expr.select("study", "sample_id", "gene", "value"))


def summary_rows(
    spark: SparkSession, datasets: dict[str, Callable[[], DataFrame]], name: str = "dataset"
) -> DataFrame:
    """One summary row per dataset.

    Each row is computed and stored on its own: a dataset that fails gets a
    row with the ``error`` alone, and the others still come out.
    """
    rows = []
    for dataset, prepare in datasets.items():
        try:
            row = settle(prepare().withColumn(name, F.lit(dataset)), "summary")
        except Exception as error:  # noqa: BLE001 - any failure is reported as data
            row = spark.createDataFrame([(dataset, str(error))], f"{name} string, error string")
        rows.append(row)
    return stack(rows)
