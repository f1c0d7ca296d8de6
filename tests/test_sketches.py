"""Profiles by mergeable sketches."""

import random
from collections import Counter

import pytest

from cohortloom.operators import sketches as S
from cohortloom.plans.profiling import profile_of_sketches, sketch_files
from workload import QUERIES, Tables


def drawn(seed):
    draw = random.Random(seed)
    spread = {"few": 3, "some": 700, "many": 40_000}
    return [
        (f"f{draw.randrange(5)}", column, None if draw.random() < 0.1 else f"v{int(draw.random() ** 2 * n)}")
        for column, n in spread.items() for _ in range(30_000)
    ] + [("f9", "none", None)] * 3


@pytest.fixture(scope="module")
def values(spark):
    listed = drawn(4)
    return listed, spark.createDataFrame(listed, "file string, column string, value string")


def checked(profile, listed):
    found = {r.column: r for r in profile.collect()}
    assert set(found) == {c for _, c, _ in listed}
    for column, r in found.items():
        own = [v for _, c, v in listed if c == column]
        counts = Counter(v for v in own if v is not None)
        assert (r.n_rows, r.n_missing) == (len(own), own.count(None))
        assert r.examples == sorted(counts)[:12]
        assert abs(r.n_values - len(counts)) <= 0.03 * len(counts)
        if counts and len(counts) <= 700:
            assert sorted((e.n for e in r.most_frequent), reverse=True) == sorted(counts.values(), reverse=True)[:5]
            assert all(counts[e.value] == e.n for e in r.most_frequent)
        if not counts:
            assert r.n_values == 0 and r.most_frequent is None


def test_merged_is_as_if_made_of_all(spark, values, tmp_path):
    listed, table = values
    checked(S.described(S.sketch_values(table, ["column"]), ["column"]), listed)
    S.sketch_values(table, ["file", "column"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    checked(profile_of_sketches(stored), listed)
    only = [x for x in listed if x[0] in ("f1", "f2")]
    checked(profile_of_sketches(stored.filter("file IN ('f1', 'f2')")), only)
    whole = S.described(S.sketch_values(table, ["column"]), ["column"]).select("column", "n_values")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, profile_of_sketches(stored).select("column", "n_values").collect()))
    assert S.merge_sketches(stored.limit(0), ["column"]).collect() == []


def test_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,kind,age\n1,x,3\n2,y,NA\n3,x\n")
    (tmp_path / "b.tsv").write_text("kind\tid\textra\nz\t3\t\nx\t4\tq\t9\n")
    names = [str(tmp_path / n) for n in ("a.csv", "b.tsv", "gone.csv")]
    sketched = sketch_files(spark, names)
    found = {r.column: r for r in profile_of_sketches(sketched).collect()}
    assert set(found) == {"id", "kind", "age", "extra"}
    assert (found["id"].n_rows, found["id"].n_values, found["id"].examples) == (5, 4, ["1", "2", "3", "4"])
    assert (found["age"].n_rows, found["age"].n_missing, found["age"].n_values) == (3, 2, 1)
    assert (found["extra"].n_missing, found["extra"].examples) == (1, ["q"])
    assert found["kind"].most_frequent[0] == ("x", 3)
    per_file = {(r.path.rsplit("/", 1)[-1], r.column): r.n_values for r in profile_of_sketches(sketched, ["path", "column"]).collect()}
    assert per_file["a.csv", "kind"] == 2 and per_file["b.tsv", "kind"] == 2
    assert {r.column for r in sketch_files(spark, names[:1], ["age"]).collect()} == {"age"}
    with pytest.raises(ValueError, match="no such file"):
        sketch_files(spark, names[2:])


def test_profile_of_columns_without_a_frequent_value(spark, tmp_path):
    # 6 000 values, all once: no value is frequent enough to be named
    spark.range(6000).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(5000).selectExpr("id AS c_custkey", "'B' AS c_mktsegment", "CAST(id % 3 AS INT) AS c_nationkey").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    found = {r["column"]: r for r in QUERIES["sketch_profile"].run(Tables(spark, str(tmp_path))).collect()}
    assert {name: r.most for name, r in found.items()} == {
        "o_orderkey": None, "o_custkey": 858, "o_orderstatus": 6000, "priority": 4000,
        "c_custkey": None, "c_mktsegment": 5000, "c_nationkey": 1667, "nothing": 0,
    }
    assert all(r.near for r in found.values()) and found["o_orderkey"].n_values == 6000
