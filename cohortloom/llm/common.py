"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every operator: ASCII only.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK = r"[\x20\x09-\x0D]+"

Run = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wish: str) -> str:
    """Column name that no column of the table has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; null text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare != "", F.split(bare, BLANK)).otherwise(F.array().cast("array<string>"))


def ahead(items: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(items, by + 1, F.greatest(F.size(items) - by, F.lit(0)))


def paired(items: Column, by: int, join) -> Column:
    """``join(items[i], items[i + by])`` for every i that has both; ``items`` should be a plain column.

    Written with slices instead of an index into the array, as a lambda that
    refers to an outer array may make Spark build that array once per element.
    """
    return F.zip_with(F.slice(items, 1, F.greatest(F.size(items) - by, F.lit(0))), ahead(items, by), join)


def with_windows(df: DataFrame, source: str, name: str, size: int, join) -> DataFrame:
    """Adds an array with one value for every ``size`` consecutive elements of the array ``source``.

    A window of ``width`` elements and the one that begins ``step`` later make one of
    ``width + step``. Each doubling is a projection of its own, so that no array is computed twice.
    """
    width, made = 1, [source]
    while width < size:
        step = min(width, size - width)
        width += step
        made.append(name if width == size else f"{name}_{width}")
        df = df.select("*", paired(F.col(made[-2]), step, join).alias(made[-1]))
    return df.drop(*made[1:-1])


def hash_pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def exploded(df: DataFrame, items: Column, name: str, *keep) -> DataFrame:
    """A row for every element of an array that is not null, with the columns to keep.

    The outer form is used as the inner one makes Spark push a filter on the
    array's size below the projections that build the array, which then build
    it again, one inside the other.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def remainder(ids: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % divisor


def sent(docs: DataFrame, keep: list[str], text_col: str) -> tuple[DataFrame, int]:
    """What a function over batches needs: the columns to keep and the text, and the text's place; a text that is kept goes there once."""
    if text_col in keep:
        return docs.select(*[col(c) for c in keep]), keep.index(text_col)
    return docs.select(*[col(c) for c in keep], col(text_col).alias(free_name(docs, "raw_text"))), len(keep)


def hot_keys(groups: DataFrame, key: str, size: str, share: int = 256, most: int = 1000) -> DataFrame:
    """``key, salts`` of the largest groups: into how many parts of ``share`` rows each should be dealt.

    At most ``most`` rows, so it may be broadcast. Only load depends on it: the largest group that is left out holds
    at most one part in ``most`` of all rows. ``key`` may be shared by several groups.
    """
    large = groups.where(F.col(size) >= 2 * share).groupBy(key).agg(F.max(size).alias(size))
    return large.orderBy(F.desc(size)).limit(most).select(key, F.ceil(F.col(size) / share).cast("int").alias("salts"))


def tidy(run):
    """A function over Arrow batches that, once it is through, gives the memory that Arrow keeps ready back to the system.

    Workers wait for the next task with what they have; a waiting worker should be small.
    """

    def through(batches):
        import gc

        import pyarrow as pa

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()

    return through
