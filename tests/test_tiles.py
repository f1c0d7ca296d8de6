"""The feature matrix in tiles."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.operators.genes import gene_index
from cohortloom.sinks.features import from_tiles, sample_index, to_tiles
from workload import QUERIES, Tables

SCHEMA = "study string, sample_id string, gene string, value double"


@pytest.mark.parametrize("tile", [(1, 1), (3, 4), (256, 1024)])
def test_round_trip(spark, tile):
    draw = random.Random(3)
    cells = {(f"S{draw.randrange(2)}", f"s{draw.randrange(9)}", f"g{draw.randrange(11)}"): draw.choice([None, draw.random()]) for _ in range(120)}
    expr = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [("S0", None, "g1", 1.0), ("S0", "s1", None, 1.0)], SCHEMA)
    samples, genes = sample_index(expr), gene_index(expr)
    tiles = to_tiles(expr, samples, genes, tile=tile).cache()
    want = sorted(((*k, v) for k, v in cells.items() if v is not None), key=repr)
    assert rows(from_tiles(tiles, samples, genes, tile=tile), "study", "sample_id", "gene", "value") == want
    height, width = tile
    for t in tiles.collect():
        assert len(t.indptr) == height + 1 and t.indptr[0] == 0 and t.indptr[-1] == len(t.indices) == len(t["values"])
        assert 0 < len(t.indices) <= height * width and max(t.indices) < width
        for a, b in zip(t.indptr, t.indptr[1:]):
            assert t.indices[a:b] == sorted(set(t.indices[a:b]))
    assert tiles.count() == tiles.select("sample_block", "gene_block").distinct().count()


def test_no_row_grows_with_the_index(spark):
    wide = spark.range(20_000).selectExpr("'S' AS study", "'one' AS sample_id", "concat('g', id) AS gene", "CAST(id AS DOUBLE) AS value")
    long = spark.range(5_000).selectExpr("'S' AS study", "concat('s', id) AS sample_id", "'g1' AS gene", "1.0D AS value")
    expr = wide.unionByName(long)
    tiles = to_tiles(expr, sample_index(expr), gene_index(expr))
    assert tiles.agg(F.max(F.size("values"))).first()[0] <= 1024 + 256
    assert tiles.agg(F.sum(F.size("values"))).first()[0] == 25_000
    exchanges = tiles._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(sample_block")
    assert exchanges == 1, "tiles are dealt out once"


def test_repeats_fail_and_nothing_gives_nothing(spark):
    expr = spark.createDataFrame([("S", "s", "G", 1.0), ("S", "s", "G", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="several values"):
        to_tiles(expr, sample_index(expr), gene_index(expr)).collect()
    none = expr.limit(0)
    assert to_tiles(none, sample_index(none), gene_index(none)).collect() == []


def test_places_of_dense_features_are_rows(spark, tmp_path):
    tables = {
        "region": [("AFRICA", 0), ("ASIA", 1), ("EUROPE", 2)], "nation": [(n, n) for n in range(3)], "supplier": [(n, n) for n in range(3)],
        # genes 1 to 8 are common; of the samples in Europe the last has no value, and one gene is not common
        "lineitem": [(1, p, s, 1.0) for p in range(1, 9) for s in (0, 1)]
        + [(7, 3, 2, 2.0), (7, 3, 2, 4.0), (7, 8, 2, 0.5), (7, 99, 2, 9.0), (8, 1, 2, 1.0), (9, 5, 2, None), (9, 8, 2, None)],
    }
    schemas = {
        "region": "r_name string, r_regionkey int", "nation": "n_nationkey int, n_regionkey int",
        "supplier": "s_suppkey bigint, s_nationkey int", "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double",
    }
    for name, listed in tables.items():
        spark.createDataFrame(listed, schemas[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = QUERIES["aligned_features"].run(Tables(spark, str(tmp_path)))
    assert sorted(map(tuple, found.collect())) == [
        ("EUROPE", "7", 8, 2, "2=180,7=30"), ("EUROPE", "8", 8, 1, "0=60"), ("EUROPE", "9", 8, 0, "")
    ]
    # no function is called for each of the places of a sample
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "posexplode(features" in plan and "transform(features" not in plan


def test_dense_features_are_dealt_to_all_tasks(spark, tmp_path):
    # few entries, many places: Spark would size the tasks by the entries
    region, nation = [("AFRICA", 0), ("ASIA", 1), ("EUROPE", 2)], [(n, n) for n in range(3)]
    lines = [(1, p, s, 1.0) for p in range(1, 4) for s in (0, 1)] + [(10 + k, 1 + k % 3, 2, float(k)) for k in range(200)]
    spark.createDataFrame(region, "r_name string, r_regionkey int").write.parquet(str(tmp_path / "region.parquet"))
    spark.createDataFrame(nation, "n_nationkey int, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame(nation, "s_suppkey bigint, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["aligned_features"].run(Tables(spark, str(tmp_path)))
    tasks = found.withColumn("task", F.spark_partition_id()).select("sample_id", "n_features", "present", "task").collect()
    assert {(r.sample_id, r.n_features, r.present) for r in tasks} == {(str(10 + k), 3, f"{k % 3}={60 * k}") for k in range(200)}
    assert len(tasks) == 200 and len({r.task for r in tasks}) >= min(20, 2 * spark.sparkContext.defaultParallelism)
    # one shuffle by sample for both groupings
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(study#\d+, sample_id#\d+, \d+\)", plan)) == 1
