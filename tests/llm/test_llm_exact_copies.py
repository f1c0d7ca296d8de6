import hashlib
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.llm import exact_copies as E
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def naive(docs):
    """(id, keep_id, size, kept, sha) of (id, text); distinct ids, or null."""
    groups = {}
    for i, text in docs:
        groups.setdefault(plain(text), []).append(i)
    out = []
    for i, text in docs:
        ids = groups[plain(text)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n=120):
    draw = random.Random(seed)
    words = ["one", "two\n", " three", "vier zwölf", "nnnn", "bdf h", "日本語", " x", "a\x1cb"]
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 1, 3, 40, 900]))) for _ in range(n // 3)]
    texts += ["", " ", "\t\n", None, "x" * 30_000, "bdf " * 9_000]
    picked = [draw.choice(texts) for _ in range(n)]
    return [(i if i % 17 else None, t.replace(" ", draw.choice([" ", "  ", "\n"])) if t else t) for i, t in enumerate(picked, 1)][: n - 1]


def distinct_ids(docs):
    """Null ids apart, as brute force cannot tell them from each other."""
    return [(i, t) for i, t in docs if i is not None]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS chunks", "2 AS RECIPE", "'x' AS row", "3 AS first")


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_against_equal_texts(spark):
    docs = distinct_ids(made(1))
    assert rows(E.exact_copies(frame(spark, docs)), *COLUMNS) == naive(docs)


@pytest.mark.parametrize("kinds", [1, 3, 50])
def test_chunks_of_one_hash_stay_apart(spark, kinds):
    """With few hash values nearly all identifiers need their rank."""
    docs = distinct_ids(made(2))
    table = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(docs)], "row long, id long, text string")
    got = E.copies(table, lambda c: F.pmod(F.xxhash64(c), F.lit(kinds)), least=20, most=60)
    want = naive(docs)
    assert rows(got, "id", F.col("first.id"), "group_size", F.expr("first.row = row"), "text_sha256") == want


def test_cut(spark):
    texts = ["", "a", "bdf " * 4000, "x" * 10_000, " ".join(f"word{i}" for i in range(5000)), "é日 𝄞bdf " * 900]
    cut = spark.createDataFrame([(t,) for t in texts], "t string").select("t", E.chunks(F.col("t")).alias("c")).collect()
    for r in cut:
        assert "".join(r.c) == r.t and all(len(c) <= E.MOST for c in r.c) and all(len(c) >= E.LEAST for c in r.c[:-1])
    ahead = "z" * 700 + " " + texts[4]
    other = spark.createDataFrame([(ahead,)], "t string").select(E.chunks(F.col("t")).alias("c")).first().c
    shared = {r.t: set(r.c) for r in cut}[texts[4]] & set(other)
    assert len(shared) > len(other) // 2, "cuts follow the text, not its places"


def test_odd_rows(spark):
    docs = [(3, "a b"), (3, "a  b"), (None, "a\tb"), (2, None), (1, ""), (None, "q"), (None, "q"), (7, " "), (8, "\n")]
    got = rows(E.exact_copies(frame(spark, docs)), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(
        [(3, 3, 3, True), (3, 3, 3, False), (None, 3, 3, False), (2, 1, 2, False), (1, 1, 2, True), (None, None, 2, True), (None, None, 2, False), (7, 7, 2, True), (8, 7, 2, False)],
        key=repr,
    )
    kept = E.drop_exact_copies(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns
    assert rows(kept, "doc_id") == sorted([(3,), (1,), (None,), (7,)], key=repr)
    empty = frame(spark, docs).limit(0)
    assert E.exact_copies(empty).collect() == [] and E.drop_exact_copies(empty).collect() == []


def test_large_group(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 < 2, 'the same text', concat('text ', id)) AS text")
    got = E.exact_copies(docs)
    assert got.count() == 3000
    assert rows(got.groupBy("group_size", "kept").count()) == rows(spark.createDataFrame([(2000, True, 1), (2000, False, 1999), (1, True, 1000)]))
    assert got.where("keep_id <> doc_id AND keep_id <> 0").isEmpty()


def test_native_plan(spark):
    plan = E.exact_copies(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert rows(QUERIES["op11_exact_copies"](spark, FOLDER), *COLUMNS) == naive(docs)
