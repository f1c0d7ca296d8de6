"""Sums of doubles that no order of the rows changes."""

import math
import random
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.functions import numeric as N
from cohortloom.operators.genes import mean_duplicates
from cohortloom.plans.cells import log_cpm, pseudobulk_mean, pseudobulk_sum


def drawn(seed, n):
    draw = random.Random(seed)
    kinds = [
        lambda: draw.uniform(-1, 1) * 10 ** draw.randint(-20, 20),
        lambda: draw.choice([0.1, -0.1, 1e16, -1e16, 1.0, 3.3]),
        lambda: float(draw.randint(-(10**6), 10**6)),
        lambda: draw.choice([0.0, -0.0, 5e-324, 2.0**-96, 2.0**-97, -(2.0**80), 2.0**80]),
    ]
    return [kinds[draw.randrange(len(kinds))]() for _ in range(n)]


def cut(value):
    """A value without what lies below 2**-96."""
    scaled = Fraction(value) * 2**96
    return Fraction(math.trunc(scaled), 2**96)


@pytest.mark.parametrize("seed", range(4))
def test_limbs_hold_the_value(spark, seed):
    values = drawn(seed, 200)
    table = spark.createDataFrame([(v,) for v in values], "v double")
    for row, v in zip(table.select(*[c.alias(f"l{i}") for i, c in enumerate(N.limbs(F.col("v")))]).collect(), values):
        assert sum(Fraction(limb) * Fraction(2) ** e for limb, e in zip(row, N.EXPONENTS)) == cut(v)


@pytest.mark.parametrize("seed", range(6))
def test_sum_is_that_of_fractions(spark, seed):
    values = drawn(seed, 3000) if seed else [0.1] * 10 + [-1.0]
    table = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    exact = sum(map(cut, values))
    found = set()
    for parts in (1, 7, 211):
        shuffled = table.repartition(parts, F.xxhash64("v", F.lit(parts)))
        found.add(shuffled.agg(N.sum_of(shuffled, "v")).first()[0])
    (got,) = found
    assert abs(Fraction(got) - exact) <= Fraction(math.ulp(float(exact)))


def test_same_bits_in_any_order(spark):
    draw = random.Random(9)
    listed = [("S", f"s{draw.randrange(3)}", f"g{draw.randrange(5)}", draw.choice([None, draw.uniform(0, 1) * 10 ** draw.randint(-8, 8)])) for _ in range(4000)]
    table = spark.createDataFrame(listed, "study string, sample_id string, gene string, value double").withColumn("cell_id", F.lit("c"))
    for operator in (mean_duplicates, pseudobulk_sum, pseudobulk_mean, lambda t: log_cpm(pseudobulk_sum(t))):
        seen = {repr(rows(operator(table.repartition(parts, F.rand(parts))))) for parts in (1, 7, 211)}
        assert len(seen) == 1


def test_kinds_and_empty_groups(spark):
    table = spark.createDataFrame([("a", 1.5, 3, 2), ("a", None, 4, 1), ("b", None, None, None)], "k string, d double, i int, f int")
    table = table.withColumns({"f": F.col("f").cast("float"), "c": (F.col("i") / 8).cast("decimal(18,3)")})
    got = table.groupBy("k").agg(*[N.sum_of(table, c).alias(c) for c in "difc"], N.total_of(table, "d").alias("t"), N.mean_of(table, "i").alias("m"), N.mean_with_zeros(table, "d").alias("z"))
    assert rows(got, "k", "d", "i", "f", "c", "t", "m", "z") == [("a", 1.5, 7.0, 3.0, 0.875, 1.5, 3.5, 0.75), ("b", None, None, None, None, 0.0, None, 0.0)]
    large = spark.createDataFrame([(1e300,)], "v double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        large.agg(N.sum_of(large, "v")).collect()
