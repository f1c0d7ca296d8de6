"""Profiles that can be merged: per group a sketch of its distinct values, of its most frequent ones, and its first values.

A sketch has a bounded size whatever it was made of. The sketches of the files of a folder, stored once, give the
profile of any set of them without reading a file again. Counts by sketch are estimates; exact ones are the default
of the library (``distinct_values``, ``value_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Binary logarithm of the registers of a distinct count: a relative error of about 1.04 / sqrt(2**14), 0.8 %.
LOG_REGISTERS = 14
#: Values whose frequency is tracked; up to about three quarters as many distinct ones are counted exactly.
TRACKED = 1024
#: First values, in sorted order.
FIRST = 12


def sketch_values(values: DataFrame, keys: Sequence[str], first: int = FIRST) -> DataFrame:
    """(keys..., n_rows, n_missing, distinct, frequent, first_values) of (keys..., value).

    ``distinct`` and ``frequent`` are sketches of the present values, NULL where there is none. ``first_values`` are
    exact.
    """
    text = values.select(*keys, F.col("value").cast("string").alias("value"))
    counts = text.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_missing"))
    present = text.dropna(subset=["value"])
    made = present.groupBy(*keys).agg(
        F.expr(f"hll_sketch_agg(value, {LOG_REGISTERS})").alias("distinct"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED})").alias("frequent"),
    )
    return _with_first(counts.join(made, list(keys), "left"), present, keys, first)


def merge_sketches(sketches: DataFrame, keys: Sequence[str], first: int = FIRST) -> DataFrame:
    """One sketch per key of those of finer keys, as if it had been made of all their values."""
    counts = sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"))
    made = sketches.filter("n_rows > n_missing").groupBy(*keys).agg(
        F.hll_union_agg("distinct").alias("distinct"), F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent")
    )
    values = sketches.select(*keys, F.explode("first_values").alias("value"))
    return _with_first(counts.join(made, list(keys), "left"), values, keys, first)


def _with_first(counts: DataFrame, values: DataFrame, keys: Sequence[str], first: int) -> DataFrame:
    """``counts`` with the first distinct values of each key; a task passes on only as many of a key as are asked for."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("value"))
    ranked = values.distinct().withColumn("_rank", rank).filter(F.col("_rank") <= first)
    listed = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list("value")).alias("first_values"))
    joined = counts.join(listed, list(keys), "left")
    return joined.withColumn("first_values", F.coalesce("first_values", F.array().cast("array<string>")))


def described(sketches: DataFrame, keys: Sequence[str], top: int = 5) -> DataFrame:
    """(keys..., n_rows, n_missing, n_values, examples, most_frequent): what sketches say, ``n_values`` by estimate."""
    some = F.col("n_rows") > F.col("n_missing")
    frequent = F.expr(f"approx_top_k_estimate(frequent, {top})")
    return sketches.select(
        *keys, "n_rows", "n_missing",
        F.when(some, F.hll_sketch_estimate("distinct")).otherwise(F.lit(0).cast("bigint")).alias("n_values"),
        F.col("first_values").alias("examples"),
        F.when(some, F.transform(frequent, lambda e: F.struct(e["item"].alias("value"), e["count"].alias("n")))).alias("most_frequent"),
    )
