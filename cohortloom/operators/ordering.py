"""Operators that depend on row order: first and last per key, running numbers, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Keep the first row of every key. Pre-aggregates before the shuffle, so a hot key is no hot task."""
    return _one_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Keep the last row of every key."""
    return _one_per_key(df, keys, F.max_by, order)


def _one_per_key(df: DataFrame, keys: Sequence[str], pick, order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*df.columns)


def number_within(
    df: DataFrame, keys: Sequence[str], order: Column, block: Column, name: str = "n"
) -> DataFrame:
    """Running number 1, 2, ... of the rows of each key, in ``order``.

    ``block`` is any expression that never decreases along ``order``. Rows are
    numbered inside (key, block) and shifted by the size of the earlier blocks,
    so that a key holding a large share of all rows is spread over its blocks.
    """
    tagged = df.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        tagged.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        tagged.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_block", "_inside", "_offset")
    )


def with_position(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Dense position 0, 1, ... of every row in the order of unique key columns.

    The rows are range-partitioned and sorted, stored once with their place in
    their partition, and shifted by the sizes of the earlier partitions. No
    task sees more than its own range.
    """
    part = F.spark_partition_id()
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", part)
        .withColumn("_place", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)),
        "placed",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per shuffle partition: the broadcast is bounded by the partition count.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_part", "_place", "_offset")
    )
