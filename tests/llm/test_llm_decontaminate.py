import re

import duckdb
from conftest import rows

from cohortloom.llm import decontaminate as D
from cohortloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS mark", "3 AS hash"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words"),
    )


def test_share_and_edges(spark):
    item = " ".join(f"w{i}" for i in range(29))  # 25 shingles
    one = item.replace("w28", "other")
    five = item.replace("w6", "x")  # five shingles gone: 20 of 25
    six = item.replace("w6", "x").replace("w7", "y")  # 19 of 25
    docs = [
        (1, "before it, " + item.upper() + ". After it"), (2, one), (3, five), (4, six), (5, None), (6, ""), (7, "tiny item"),
        (8, "a tiny item in a longer text"), (None, item), (1, "nothing here at all in this"), (9, "lorem " * 100_000 + item), (2, one),
    ]
    items = [(10, item), (11, "Tiny, item!"), (12, None), (13, ""), (10, item), (None, "one two three four five six")]
    documents, benchmark = tables(spark, docs, items)
    got = rows(D.contained(documents, benchmark), "doc_id", "item_id", "n_shingles", "n_found")
    want = [(1, 10, 25, 25), (2, 10, 25, 24), (3, 10, 25, 20), (7, 11, 1, 1), (9, 10, 25, 25), (None, 10, 25, 25)]
    assert got == sorted(want, key=repr)
    left = D.without_contaminated(documents, benchmark)
    assert left.columns == documents.columns
    assert rows(left, "doc_id") == sorted([(1,), (4,), (5,), (6,), (8,)], key=repr)
    for a, b in ((documents.limit(0), benchmark), (documents, benchmark.limit(0))):
        assert D.contained(a, b).collect() == [] and D.without_contaminated(a, b).count() == a.count()


def test_query(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    names = ["doc_id", "item_id", "n_shingles", "n_found", "containment"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op2_decontaminate']})").fetchall()
    got = rows(QUERIES["op2_decontaminate"](spark, FOLDER), *names)
    assert got == sorted(want, key=repr)
    docs = {r.doc_id: shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = {r.item_id: shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    plain = {(d, i) for d, a in docs.items() for i, b in items.items() if 5 * len(a & b) >= 4 * len(b) > 0}
    assert {r[:2] for r in got} == plain and plain
