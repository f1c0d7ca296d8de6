import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.llm import hard_negatives as H
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(i, label):
    return (label + 1) % 10 if label is not None and i is not None and i % 7 == 0 else label


def naive(vectors, every=100):
    """Brute force with whole numbers of any size over (id, vector, label)."""
    taken = []
    for i, vec, label in vectors:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        taken.append((i, [max(-H.BOUND, min(H.BOUND, math.floor(256 * x))) for x in vec], relabelled(i, label)))

    def first(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:5]

    def long(score):
        return score if -(2**63) <= score < 2**63 else None

    out = []
    for at, (i, a, label) in enumerate(taken):
        if i is None or i % every:
            continue
        scores = [(sum(x * y for x, y in zip(a, c)), j, other) for k, (j, c, other) in enumerate(taken) if k != at]
        for ps, p, _ in first(s for s in scores if s[2] == label):
            fit = [s for s in scores if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps]
            out += [(i, p, n, s[1], long(ps), long(s[0])) for n, s in enumerate(first(fit), 1)]
    return sorted(out, key=repr)


def mined(spark, vectors, every=100, **more):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS ROW", "2 AS id", "3 AS cell", "4 AS p_no")
    i, label = F.col("vec_id"), F.col("label")
    moved = F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    return rows(H.hard_negatives(table, i % every == 0, moved, **more), *COLUMNS)


@pytest.mark.parametrize("bits,top", [(32, 300), (64, 1 << 20), (128, 1 << 40)])
def test_packed_products(bits, top):
    draw = np.random.default_rng(bits)
    c, a = draw.integers(-top, top, (1500, 17), endpoint=True), draw.integers(-top, top, (4, 17), endpoint=True)
    packs = H.Packs(c, int(np.abs(a).max()))
    assert packs.bits == bits and len(packs.parts) == 2
    for x in a.tolist():
        assert packs.scores(x).tolist() == [sum(p * q for p, q in zip(x, y)) for y in c.tolist()]
    assert H.Packs(np.zeros((3, 2), np.int64), 0).scores([0, 0]).tolist() == [0, 0, 0]


@pytest.mark.parametrize("cell", [(1024, 4096), (3, 40)])
def test_against_brute_force(spark, cell):
    draw = random.Random(4)
    centers = [[draw.gauss(0, 1) for _ in range(9)] for _ in range(4)]
    vectors = [(i, [x + draw.gauss(0, 0.2) for x in draw.choice(centers)], draw.randrange(3)) for i in range(400)]
    vectors += [(1000 + i, vectors[5][1], draw.randrange(3)) for i in range(60)]  # ties
    assert len(naive(vectors, 20)) > 200
    assert mined(spark, vectors, 20, cell=cell) == naive(vectors, 20)


def test_odd_rows(spark):
    vectors = [(100 * i, [float(i), 1.0], 1) for i in range(4)]
    vectors += [(i, [2.0 - i / 8, 1.0], 2 - i % 2) for i in range(1, 12)]
    vectors += [(300, [3.0, 1.0], 1), (300, [3.0, 1.0], 1), (None, [3.0, 1.0], 2), (None, [3.0, 1.0], 1), (21, None, 1), (22, [1.0, None], 1)]
    vectors += [(23, [float("nan"), 1.0], 2), (24, [float("inf"), 1.0], 2), (25, [], 2), (26, [3.0], 2), (27, [3.0, 1.0, 5.0], 2), (28, [3.0, 1.0], None)]
    assert naive(vectors) and mined(spark, vectors) == naive(vectors)


def test_large_components(spark):
    vectors = [(i, [1e6 * (1 + i / 500), -(2.0**31)], i % 2) for i in range(300)]
    vectors += [(1000 + i, [1e300, 1e9 * i], i % 2) for i in range(4)]
    got = mined(spark, vectors)
    assert got == naive(vectors) and any(r[4] is None for r in got)


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(100, [1.0], 1)]) == []


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    got = rows(QUERIES["op13_hard_negatives"](spark, FOLDER), *COLUMNS)
    assert got == naive([(r.vec_id, r.embedding, r.label) for r in table])
