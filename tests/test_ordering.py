import random

from conftest import rows
from pyspark.sql import functions as F

from cohortloom.operators import matching
from cohortloom.operators.matching import best_key_column, join_by_position, key_overlap, reconcile, unmatched_summary
from cohortloom.operators.ordering import first_per_key, last_per_key, number_within, with_position

import pytest


def test_first_and_last_row(spark):
    df = spark.createDataFrame([("p1", "X", 2), ("p1", "Y", 1), ("p2", None, 1)], "k string, v string, row int")
    assert rows(first_per_key(df, ["k"], F.col("row"))) == [("p1", "Y", 1), ("p2", None, 1)]
    assert rows(last_per_key(df, ["k"], F.col("row")), "k", "v") == [("p1", "X"), ("p2", None)]


def test_numbers_of_a_hot_key(spark):
    """One key holds nearly all rows and is numbered over several blocks."""
    order = list(range(3000))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame([("hot" if i % 50 else "cold", i) for i in order], "k string, i int").repartition(5)
    numbered = number_within(df, ["k"], F.col("i"), F.expr("i div 100"))
    got = sorted((r.k, r.i, r.n) for r in numbered.collect())
    for key in ("hot", "cold"):
        assert [n for k, _, n in got if k == key] == list(range(1, 1 + sum(k == key for k, _, _ in got)))


def test_positions_over_partitions(spark):
    values = [f"g{i:05d}" for i in range(2000)]
    shuffled = values[:]
    random.Random(2).shuffle(shuffled)
    df = spark.createDataFrame([(v,) for v in shuffled], "gene string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_position(df, ["gene"])
        assert [r.gene for r in placed.orderBy("idx").collect()] == values
        assert sorted(r.idx for r in placed.collect()) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_join_by_position_needs_equal_length(spark):
    left = spark.createDataFrame([(0, "c1"), (1, "c2")], "idx int, cell_id string")
    right = spark.createDataFrame([("b", 2), ("a", 1)], "v string, row int")
    assert rows(join_by_position(left, right, ["row"]), "cell_id", "v") == [("c1", "a"), ("c2", "b")]
    with pytest.raises(ValueError, match="2 and 1 rows"):
        join_by_position(left, right.limit(1), ["row"])


def test_best_key_takes_first_on_tie_and_none_without_overlap(spark):
    table = spark.createDataFrame([("x", "c1", "c1"), ("y", "c2", "c2")], "a string, b string, c string")
    ids = spark.createDataFrame([("c1",), ("c2",)], "cell_id string")
    assert rows(best_key_column(key_overlap(table, ["a", "b", "c"], ids, "cell_id"))) == [("b", 2)]
    assert best_key_column(key_overlap(table, ["a"], ids, "cell_id")).first() is None


def test_reconcile_ignores_nulls(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    right = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "id string")
    presence = reconcile(left, right, "id")
    assert rows(presence) == [("a", True, False), ("b", True, True), ("c", False, True)]
    assert rows(unmatched_summary(presence, "id")) == [
        ("missing_in_left", 1, ["c"]), ("missing_in_right", 1, ["a"]),
    ]


def test_choose_key_counts_few_columns(spark, monkeypatch):
    ids = spark.range(3000).selectExpr("concat('c', id) AS cell_id")
    listed = [f"concat('{chr(97 + i)}', id) AS x{i}" for i in range(6) if i != 2]
    table = spark.range(4000).selectExpr(
        *listed, "IF(id < 2000, concat('c', id), NULL) AS first", "concat('c', id % 1500) AS second",
        "concat('c', id) AS `whole.key`", "concat('c', id) AS again", "'c1' AS constant",
    )
    counted = []
    exact = matching._exact_overlap
    monkeypatch.setattr(matching, "_exact_overlap", lambda t, name, known: counted.append(name) or exact(t, name, known))
    assert matching.choose_key(table, table.columns, ids, "cell_id") == ("whole.key", 3000)
    assert "whole.key" in counted and len(counted) <= 3 and not any(c.startswith("x") for c in counted)
    # as the full count has it
    assert rows(best_key_column(key_overlap(table, table.columns, ids, "cell_id"))) == [("whole.key", 3000)]
    for name, bound in rows(matching.overlap_bounds(table, ["first", "x0"], ids, "cell_id"), "column", "bound"):
        assert bound >= {"first": 2000, "x0": 0}[name]
    assert matching.choose_key(table, ["x0", "x1"], ids, "cell_id") is None
    none = ids.limit(0)
    assert matching.choose_key(table, table.columns, none, "cell_id") is None and matching.choose_key(table.limit(0), ["again"], ids, "cell_id") is None
