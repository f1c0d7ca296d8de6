"""Every registered query against its SQL, and what its plan must not contain."""

import decimal
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from cohortloom import session
from workload import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="given tables are absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def shown(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value)
    return str(value)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries()) and all(query.sql for query in QUERIES.values())


UNWANTED = ("EvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def inspect_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


@pytest.fixture
def inspected(monkeypatch):
    """Every table that a query stores on the way has its plan inspected too; gives their labels."""
    labels = []
    store = session.settle

    def settle(df, label="settled"):
        inspect_plan(df)
        labels.append(label)
        return store(df, label)

    for module in list(sys.modules.values()):
        if getattr(module, "settle", None) is store:
            monkeypatch.setattr(module, "settle", settle)
    return labels


#: Tables that these queries may store on the way.
STORED = {"merge_cohorts": 5, "cell_cohort_counts": 3, "fuse_pseudobulk": 6}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, inspected, name):
    df = entry_point.queries()[name](spark, str(FOLDER))
    inspect_plan(df)
    assert len(inspected) <= STORED.get(name, 99), inspected
    columns = sorted(df.columns)
    got = sorted(tuple(shown(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(shown(row[i]) for i in places) for row in cursor.fetchall())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 5 and "n_response_0" in df.columns
