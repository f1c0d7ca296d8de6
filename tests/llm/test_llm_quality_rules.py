import re
import struct
from collections import Counter
from math import log

import xxhash

from cohortloom.llm import quality_rules as Q
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    own, n = words(text), len(words(text))
    windows = [tuple(own[i : i + 5]) for i in range(n - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def grams(text, buckets):
    hashes = [xxhash.xxh64_intdigest(w, 42) for w in words(text)]
    # Spark hashes the second long with the hash of the first as seed
    seeds = [xxhash.xxh64_intdigest(struct.pack("<Q", h), 42) for h in hashes]
    pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), a) for a, b in zip(seeds, hashes[1:])]
    signed = [x - (1 << 64) if x >> 63 else x for x in hashes + pairs]
    return [x % buckets for x in signed]


def naive(docs, trusted, buckets=Q.BUCKETS, threshold=Q.THRESHOLD):
    listed = [grams(t, buckets) for _, t in docs]
    raw, target = Counter(), Counter()
    for (doc, _), own in zip(docs, listed):
        raw.update(own)
        if doc in trusted:
            target.update(own)
    n, t = raw.total() + buckets, target.total() + buckets
    weight = [round(log((target[b] + 1) / t) - log((raw[b] + 1) / n), 6) for b in range(buckets)]
    out = []
    for (doc, text), own in zip(docs, listed):
        llr = sum(weight[b] for b in own) / len(own) if own else None
        counts = base(text)
        out.append((doc, *counts, llr, not counts[-1] and llr >= threshold))
    return out


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert [r[:7] for r in got] == [r[:7] for r in want]
    for a, b in zip(got, want):
        assert (a[7] is None) == (b[7] is None) and (a[7] is None or abs(a[7] - b[7]) < 1e-9)
        if a[7] is None or abs(a[7] - Q.THRESHOLD) > 1e-6:
            assert a[8] == b[8]


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]


def test_edges(spark):
    good = "the quick brown fox jumps over a lazy dog while ten more words follow it here"
    rows = [
        (1, good), (2, good + " again"), (3, "#%% &&& " * 8), (4, None), (5, ""), (6, " \n\t "), (7, "a b c d e " * 2 + "f g h i j k l m n"),
        (8, "one line\none line\n one line\n\n\none line"), (None, good), (1, good), (9, "é|<> " + good), (10, "x " * 100_000), (11, "a b c d e a b c d e"),
        (12, "a\x0bb\x0cc\x1cd e f g h i j k l"), (13, "q w e r t q w e r t q w e r t"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS trusted", "2 AS _hashes", "3 AS llr", "4 AS n_words", "5 AS hashes")
    trusted = spark.createDataFrame([(1,), (1,), (2,), (None,), (99,)], "doc_id long").selectExpr("*", "'x' AS text")
    got = [(r.doc_id, *[r[c] for c in COLUMNS]) for r in Q.judge(docs, trusted).collect()]
    same(got, naive(rows, {1, 2}))
    assert Q.judge(docs.limit(0), trusted).collect() == []
    nothing = Q.judge(docs, trusted.limit(0))
    same([(r.doc_id, *[r[c] for c in COLUMNS]) for r in nothing.collect()], naive(rows, set()))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    got = QUERIES["op6_quality_rules"](spark, FOLDER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = [(r.doc_id, *[r[c] for c in COLUMNS]) for r in got.collect()]
    same(got, naive(docs, {r.doc_id for r in labels if r.quality == 1}))
    bad = {r.doc_id for r in labels if r.quality == 0}
    kept = {r[0]: r[8] for r in got}
    wanted = [kept[i] for i, *_ in naive(docs, set()) if i in {r.doc_id for r in labels if r.quality == 1} and not base(dict(docs)[i])[-1]]
    assert sum(wanted) >= 0.97 * len(wanted) and sum(kept[i] for i in bad) <= 0.6 * len(bad)
