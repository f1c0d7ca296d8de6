"""Joins between measurements, samples, patients and cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sample_join_key
from ..session import settle
from .ordering import first_per_key, last_per_key, with_position


def sample_pairs(meta: DataFrame, expr: DataFrame) -> DataFrame:
    """(own_id, meta_id, sample_id) of the samples that both sides have, matched on the normalised id; stored.

    A sample goes by its metadata id. Where several measured ids are spellings of one key, each is a sample of its own:
    the measured id is put behind the metadata id.
    """
    key = sample_join_key(F.col("sample_id")).alias("sample_key")
    known = meta.select(F.col("sample_id").alias("meta_id"), key).dropna().distinct()
    own = expr.select(F.col("sample_id").alias("own_id"), key).dropna().distinct()
    spellings = own.groupBy("sample_key").agg(F.count(F.lit(1)).alias("spellings"))
    told_apart = F.concat("meta_id", F.lit(" ["), "own_id", F.lit("]"))
    matched = own.join(known, "sample_key").join(spellings, "sample_key")
    return settle(
        matched.select("own_id", "meta_id", F.when(F.col("spellings") > 1, told_apart).otherwise(F.col("meta_id")).alias("sample_id")),
        "sample-pairs",
    )


def join_on_sample_key(pairs: DataFrame, expr: DataFrame) -> DataFrame:
    """Measurements under the sample ids of ``sample_pairs``; a measured sample that several metadata ids name comes under each."""
    measured = expr.withColumnRenamed("sample_id", "own_id")
    return measured.join(pairs.select("own_id", "sample_id"), "own_id").select(*expr.columns)


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, in_left, in_right) of every distinct id of two sides. One shuffle on the id."""
    sides = left.select(key, F.lit(True).alias("in_left"), F.lit(False).alias("in_right")).unionByName(
        right.select(key, F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))
    )
    return (
        sides.dropna(subset=[key])
        .groupBy(key)
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )


def rejected_ids(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """(side, n_rejected): rows of each side whose id is NULL. They match nothing, not even each other."""
    counts = [
        rows.agg(F.lit(name).alias("side"), F.count_if(F.col(key).isNull()).alias("n_rejected"))
        for name, rows in sides.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def unmatched_summary(presence: DataFrame, key: str, first: int = 20) -> DataFrame:
    """Per side: number of ids the other side lacks, and the first ones in sorted order."""

    def side(name: str, only_here: Column) -> DataFrame:
        ids = presence.filter(only_here)
        examples = ids.orderBy(key).limit(first).agg(F.array_sort(F.collect_list(key)))
        return ids.agg(F.count(F.lit(1)).alias("n_unmatched")).select(
            F.lit(name).alias("side"), "n_unmatched", examples.scalar().alias("examples")
        )

    return side("missing_in_right", ~F.col("in_right")).unionByName(
        side("missing_in_left", ~F.col("in_left"))
    )


def join_patients(samples: DataFrame, patients: DataFrame, key: str = "PATIENT_ID") -> DataFrame:
    """Samples with the columns of their patient; a clashing column gets the suffix ``_patient``."""
    if key not in samples.columns:
        raise ValueError(f"sample table has no column {key}")
    if key not in patients.columns:
        return samples
    renamed = patients.select(
        *[
            F.col(f"`{c}`").alias(f"{c}_patient" if c != key and c in samples.columns else c)
            for c in patients.columns
        ]
    )
    return samples.join(renamed, key, "left")


def cell_to_sample(cell_meta: DataFrame, order: Column) -> DataFrame:
    """(cell_id, sample_id): the last row of a cell counts."""
    return last_per_key(cell_meta.select("cell_id", "sample_id", order.alias("_order")), ["cell_id"], F.col("_order")).drop("_order")


def patient_to_sample(samples: DataFrame, order: Column) -> DataFrame:
    """(patient_id, sample_id): the first sample of a patient counts."""
    return first_per_key(
        samples.dropna(subset=["patient_id"]).select("patient_id", "sample_id", order.alias("_order")),
        ["patient_id"],
        F.col("_order"),
    ).drop("_order")


def key_overlap(table: DataFrame, candidates: Sequence[str], ids: DataFrame, id_column: str) -> DataFrame:
    """(column, position, overlap): distinct values of each candidate column found among the ids."""
    known = ids.select(F.col(id_column).cast("string").alias("value")).dropna().distinct()
    values = (
        table.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in candidates])
        .unpivot([], [f"`{c}`" for c in candidates], "column", "value")
        .dropna()
        .distinct()
    )
    found = (
        values.join(known, "value", "left_semi").groupBy("column").agg(F.count(F.lit(1)).alias("overlap"))
    )
    listed = table.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(candidates)], "column string, position int"
    )
    return listed.join(found, "column", "left").fillna(0, ["overlap"])


def best_key_column(overlaps: DataFrame) -> DataFrame:
    """The column that matches most ids, the earliest on a tie; no row when none matches any."""
    rank = F.struct(F.col("overlap"), -F.col("position"))
    return (
        overlaps.agg(F.max_by("column", rank).alias("column"), F.max("overlap").alias("overlap"))
        .filter(F.col("overlap") > 0)
    )


def _exact_overlap(table: DataFrame, name: str, known: DataFrame) -> int:
    values = table.select(F.col(f"`{name}`").cast("string").alias("value")).dropna().distinct()
    return values.join(known, "value", "left_semi").count()


#: Bits that an id sets in its word of a filter, and ids per word for which a filter is made.
FILTER_BITS = 4
IDS_PER_WORD = 4


def _slot(value: Column, words: int) -> tuple[Column, Column]:
    """Word of a filter that a value belongs to, and the bits that it sets there."""
    at, mask = F.xxhash64(value), F.lit(0).cast("bigint")
    for i in range(FILTER_BITS):
        place = F.shiftright(F.xxhash64(value, F.lit(1)), 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return F.pmod(at, F.lit(words)), mask


def id_filter(ids: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(word, bits) of a Bloom filter of the ids, stored, and its number of words.

    Ids need not be distinct: a task reduces its own to the words before anything moves. The size follows an estimate
    of the number of ids, so a join with the filter is broadcast or not as Spark judges its stored size.
    """
    value = F.col(column).cast("string")
    n = ids.agg(F.approx_count_distinct(value)).first()[0]
    words = max(1 << 10, 1 << max(0, (n // IDS_PER_WORD).bit_length()))
    word, mask = _slot(value, words)
    made = ids.filter(value.isNotNull()).select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    return settle(made, "id-filter"), words


def overlap_bounds(table: DataFrame, candidates: Sequence[str], ids: DataFrame, id_column: str) -> DataFrame:
    """(column, position, bound, about): no more than ``bound`` distinct values of a candidate can be among the ids.

    Counted are the rows whose value passes a filter of the ids, in one pass without moving a value; a value that is
    no id passes now and then. ``about`` estimates how many of these values are distinct.
    """
    bits, words = id_filter(ids, id_column)
    listed = table.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(candidates)])
    values = listed.unpivot([], [f"c{i}" for i in range(len(candidates))], "place", "value").dropna()
    word, mask = _slot(F.col("value"), words)
    passing = (
        values.select("place", word.alias("word"), mask.alias("mask"), F.xxhash64("value").alias("hash")).join(bits, "word")
        .filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        .groupBy("place").agg(F.count(F.lit(1)).alias("bound"), F.approx_count_distinct("hash").alias("about"))
    )
    none = F.lit(0).cast("bigint")
    names = table.sparkSession.createDataFrame([(f"c{i}", name, i) for i, name in enumerate(candidates)], "place string, column string, position int")
    shown = [F.coalesce(c, none).alias(c) for c in ("bound", "about")]
    return names.join(passing, "place", "left").select("column", "position", *shown)


def choose_key(table: DataFrame, candidates: Sequence[str], ids: DataFrame, id_column: str) -> tuple[str, int] | None:
    """The column whose distinct values match most ids, the earliest on a tie, and how many; None when none matches any.

    Columns are counted exactly in the order of their estimates, and only as long as their bound, or the number of ids
    where that is smaller, leaves it open whether they win.
    """
    bounds = [tuple(row) for row in overlap_bounds(table, candidates, ids, id_column).collect()]
    known = ids.select(F.col(id_column).cast("string").alias("value")).dropna().distinct()
    n_ids = known.count()
    best: tuple[int, int, str] | None = None
    for name, position, bound, _ in sorted(bounds, key=lambda b: (-b[3], b[1])):
        if bound == 0 or best and (min(bound, n_ids), -position) <= best[:2]:
            continue
        found = (_exact_overlap(table, name, known), -position, name)
        best = max(best, found) if best else found
    return (best[2], best[0]) if best and best[0] else None


def join_by_position(left: DataFrame, right: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of ``right`` in ``order``, matched to ``left`` (which has ``idx``) by position.

    Allowed only when both sides are equally long (two counts on the driver).
    """
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"cannot match by position: {n_left} and {n_right} rows")
    return left.join(with_position(right, order), "idx")
