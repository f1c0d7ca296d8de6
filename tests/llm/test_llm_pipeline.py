import random

import pytest
from conftest import rows

import __spark_entry__ as entry_point
import corpus_pipeline as C
from cohortloom.llm import components
from cohortloom.llm.components import roots_within
from cohortloom.session import settle

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = entry_point.queries()
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "sentence_pieces"]
    assert names["pipeline"] is C.run
    for i in range(1, 11):
        assert len([n for n in names if n.startswith(f"op{i}_")]) == 1


@pytest.mark.parametrize("seed", range(3))
def test_components_against_search(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)] + [(200, 200 + i) for i in range(1, 40)]
    edges += edges[:5] + [(7, 7), (None, 3)]
    table = spark.createDataFrame(edges, "a long, b long")
    least = {}
    for a, b in edges:
        if a is not None and a != b:
            least.setdefault(a, a)
            least.setdefault(b, b)
    while True:
        moved = False
        for a, b in edges:
            if a is not None and a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                moved = True
        if not moved:
            break
    assert rows(components.roots(table)) == sorted(least.items(), key=repr)
    assert components.roots(table.limit(0)).collect() == []


@pytest.mark.parametrize("members", [2, 40])
def test_every_pair_of_a_bucket_counts(spark, members):
    """Nodes of one bucket that are linked with their neighbours alone, or not at all, in any order."""
    nodes = random.Random(members).sample(range(1000), members)
    chain = {frozenset(p) for p in zip(nodes, nodes[1 : members // 2 + 1])}
    linked = spark.createDataFrame([tuple(sorted(p)) for p in chain], "a long, b long")
    buckets = spark.createDataFrame([(7, n) for n in nodes], "bucket long, node long")
    got = {r.node: r.root for r in roots_within(buckets, lambda pairs: pairs.join(linked, ["a", "b"], "left_semi")).collect()}
    inside = nodes[: members // 2 + 1]
    assert got == {n: min(inside) for n in inside}


def test_each_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in C.STAGES:
        before = docs
        docs = settle(stage(spark, docs, FOLDER), name)
        seen[name] = (before, docs)
        if name != "sentence_pieces":
            assert docs.columns == columns
        assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    before, after = seen["line_dedup"]
    assert after.count() == before.count() and after.selectExpr("sum(n_chars - length(text))").first()[0] == 0
    before, after = seen["simhash"]
    from cohortloom.llm import simhash

    assert after.count() == simhash.near_duplicates(before).select("component_id").distinct().count()
    before, after = seen["decontaminate"]
    from cohortloom.llm import decontaminate

    found = {r.doc_id for r in decontaminate.contained(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == found
    assert docs.filter("NOT round_trip").count() == 0
    ran = C.run(spark, FOLDER)
    assert ran.columns == docs.columns and rows(ran, "doc_id", "n_pieces") == rows(docs, "doc_id", "n_pieces")


def test_odd_documents(spark):
    clash = ["ids", "score", "others", "row_number", "fingerprint", "toxicity", "strongest", "text_mark", "keys", "hash", "item", "mark", "root"]
    texts = [(1, None), (1, None), (2, ""), (None, "some words here"), (3, "x " * 50_000), (4, "one line of words\nand another"), (4, "one line of words\nand another")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "CAST(length(text) AS LONG) AS n_chars", *[f"1 AS `{c}`" for c in clash]
    )
    for empty in (False, True):
        table = docs.limit(0) if empty else docs
        for name, stage in C.STAGES:
            table = settle(stage(spark, table, FOLDER), name)
            if name != "sentence_pieces":
                assert table.columns == docs.columns
        found = {r.doc_id for r in table.collect()}
        assert found == (set() if empty else {None, 1, 3, 4})
