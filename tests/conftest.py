import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, memory="6g", shuffle_partitions=4)


@pytest.fixture
def evaluate(spark):
    """Value of an expression for each input text."""

    def run(build, *texts):
        from pyspark.sql import functions as F

        rows = [(i, text) for i, text in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, x string")
        result = df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()
        return [tuple(r.y) if isinstance(r.y, tuple) else r.y for r in result]

    return run


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
