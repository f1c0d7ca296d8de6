"""Gene sets as bitmaps, against sets of Python."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.operators import genesets as S
from cohortloom.operators.genes import common_genes, gene_overlap


def drawn(seed, genes=400):
    draw = random.Random(seed)
    return {s: {f"G{draw.randrange(genes)}" for _ in range(draw.choice([0, 5, 300]))} | {"G1", "zz"} for s in "abcd"}


def table(spark, sets):
    listed = [(s, g) for s, genes in sets.items() for g in genes]
    return spark.createDataFrame([*listed, *listed[:3], ("a", None)], "study string, gene string")


@pytest.mark.parametrize("seed", range(3))
def test_against_sets(spark, seed):
    sets = drawn(seed)
    known = S.add_genes(table(spark, sets))
    for names in (["a"], ["a", "b"], ["d", "c", "b", "a", "a"], ["a", "none"]):
        want = set.intersection(*(sets.get(n, set()) for n in names))
        assert rows(S.common_genes_of(known, names)) == sorted((g,) for g in want)
        assert rows(common_genes(table(spark, sets), list(dict.fromkeys(names)))) == sorted((g,) for g in want)
    main = spark.createDataFrame([(g,) for g in sets["a"] & sets["b"]], "gene string")
    got = S.overlap_of_sets(S.common_bitmap(known, ["a", "b"]), known)
    assert rows(got) == rows(gene_overlap(main, table(spark, sets).dropna()).select(*got.columns))


def test_many_genes_over_several_buckets(spark):
    wide = spark.range(100_000).selectExpr("'a' AS study", "concat('G', id) AS gene").unionByName(
        spark.range(0, 100_000, 3).selectExpr("'b' AS study", "concat('G', id) AS gene")
    )
    known = S.add_genes(wide)
    assert known.bitmaps.filter("study = 'a'").count() == 4
    assert S.common_genes_of(known, ["a", "b"]).exceptAll(wide.filter("study = 'b'").select("gene")).isEmpty()
    assert S.common_genes_of(known, ["a", "b"]).count() == 33_334


def test_a_cohort_is_added_without_the_others(spark, tmp_path):
    first = S.add_genes(table(spark, {"a": {"B", "D"}, "b": {"D"}}))
    S.write_gene_sets(first, str(tmp_path / "sets"))
    stored = S.read_gene_sets(spark, str(tmp_path / "sets"))
    numbers = dict((g, i) for i, g in rows(stored.index))
    second = S.add_genes(spark.createDataFrame([("c", "A"), ("c", "D"), ("a", "A")], "study string, gene string"), stored)
    assert {g: i for i, g in rows(second.index)} == numbers | {"A": 2}
    assert rows(S.common_genes_of(second, ["a", "b", "c"])) == [("D",)]
    assert rows(S.common_genes_of(second, ["a", "c"])) == [("A",), ("D",)]
    plan = S.common_bitmap(second, ["a", "c"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("study" in line and "bucket" in line and "genes" in line and "value" not in line for line in scans)


def test_empty(spark):
    none = S.add_genes(spark.createDataFrame([], "study string, gene string"))
    assert rows(S.common_genes_of(none, ["a"])) == [] and rows(none.index) == []
    assert rows(S.overlap_of_sets(S.common_bitmap(none, ["a"]), none)) == []
    more = S.add_genes(spark.createDataFrame([("a", "G")], "study string, gene string"), none)
    assert rows(more.index) == [(0, "G")]
    assert rows(S.overlap_of_sets(S.common_bitmap(more, ["b"]), more)) == [("a", 1, 0, 0)]
    assert more.bitmaps.agg(F.sum(F.bitmap_count("genes"))).first()[0] == 1
