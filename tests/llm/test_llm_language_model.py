import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortloom.llm import language_model as M
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def naive(docs):
    """(id, held out, tokens, known, N, base score, score) of every (id, text)."""
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(AZ)) + [" "]) for d, t in docs]
    part = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 for d, _ in texts]

    def count(taken):
        single, pair, context = Counter(), Counter(), Counter()
        for (_, tokens), p in zip(texts, part):
            if taken(p):
                single.update(tokens)
                pair.update(zip(["  ", *tokens], tokens))
                context["  "] += 1
        context.update(single)
        return single, pair, context

    u, b, c = count(lambda p: p != 0)
    u1, b1, c1 = count(lambda p: p > 1)
    n, v, rest = sum(u.values()), len(u), max(sum(u1.values()), 1)
    p0 = 1 / (v + 1)
    bucket = lambda x: min(x.bit_length(), 47)
    share = lambda x, of: x / of if of else 0.0
    held = Counter()
    for (_, tokens), p in zip(texts, part):
        if p == 1:
            for w, x in zip(["  ", *tokens], tokens):
                held[bucket(c1[w]), share(b1[w, x], c1[w]), u1[x] / rest] += 1
    mix = [[0.0, 0.7, 0.3]] + [[0.4, 0.4, 0.2] for _ in range(47)]
    for _ in range(25):
        found, new = {}, [list(x) for x in mix]
        for (k, p2, p1), times in held.items():
            parts = [mix[k][0] * p2, mix[k][1] * p1, mix[k][2] * p0]
            found[k] = [e + times * x / sum(parts) for e, x in zip(found.get(k, [0, 0, 0]), parts)]
        for k in range(48):
            prior = [0.0 if k == 0 else 0.1, 0.1, 0.1]
            if k in found:
                new[k] = [(e + q) / (sum(found[k]) + sum(prior)) for e, q in zip(found[k], prior)]
            elif k > 1:
                new[k] = new[k - 1]
        moved = max(abs(x - y) for q, r in zip(new, mix) for x, y in zip(q, r))
        mix = new
        if moved < 1e-4:
            break
    out = []
    for (d, tokens), p in zip(texts, part):
        base = sum(math.log10((u[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens)
        score = 0.0
        for w, x in zip(["  ", *tokens], tokens):
            m = mix[bucket(c[w])]
            score += math.log10(m[0] * share(b[w, x], c[w]) + m[1] * u[x] / max(n, 1) + m[2] * p0)
        out.append((d, p == 0, len(tokens), sum(u[x] > 0 for x in tokens), n, base, score))
    return out


def same(got, want):
    got, want = sorted(got, key=lambda r: (repr(r[0]), r[5])), sorted(want, key=lambda r: (repr(r[0]), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6)


@pytest.mark.parametrize("keys", [[], [0], [7, 7], [1, 2**63, 2**64 - 1], sorted(np.random.default_rng(1).integers(0, 2**63, 999).tolist())])
def test_blobs(keys):
    keys = np.array(keys, np.uint64)
    assert (M.unpack_keys(M.pack_keys(keys)) == keys).all()
    counts = np.concatenate([np.arange(300), [10**12]])
    assert (M.unpack_counts(M.pack_counts(counts)) == counts).all()


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(M, "PACK_BYTES", 200)  # many packs
    rows = [(i, f"the cat sat on the mat number {i % 3}\nand THE dog") for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \t\n"), (None, "the unknown ÄÖ ä"), (53, "a\x0bb\x1cc"), (7, rows[7][1]), (54, "x y " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS part", "3 AS pack", "4 AS score", "'s' AS slice")
    same([tuple(r) for r in M.score(docs).collect()], naive(rows))
    assert M.score(docs.limit(0)).collect() == []
    held = [(d, t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 10 == 0]
    same([tuple(r) for r in M.score(spark.createDataFrame(held, "doc_id long, text string")).collect()], naive(held))


def test_query(spark, monkeypatch):
    monkeypatch.setattr(M, "PACK_BYTES", 60_000)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op4_language_model"](spark, FOLDER).collect()]
    same(got, naive(docs))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # likelier than under the unigram model
