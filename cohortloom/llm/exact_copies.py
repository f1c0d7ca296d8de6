"""Exact dedup by content-defined chunk recipes.

A text, with every run of white space made one blank, is cut into chunks where
its own characters say so. A chunk's identifier is its 64-bit hash together
with its number among the different chunks of that hash, so that equal
identifiers mean equal chunks. Texts are equal if their recipes, the ordered
lists of identifiers, are. Chunks move once, merged before they do; whole texts
never move, only recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .common import BLANK, Run, col, free_name, hot_keys, table

#: Characters of a chunk; the last chunk of a text may be shorter.
LEAST, MOST = 512, 4096
#: Printable ASCII characters of even code. A chunk ends after three of them and a blank.
EVEN = "".join(rf"\x{code:02X}" for code in range(34, 127, 2))


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text cut into chunks of ``least`` to ``most`` characters; the empty text has none."""
    cut = rf"(?s).{{{least},{most}}}?(?<=[{EVEN}]{{3}}\x20)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def recipes(docs: DataFrame, chunk_hash=F.xxhash64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``docs`` (``row`` unique, ``text``) with ``text_sha256``, ``recipe`` and ``ranks`` instead of the text, stored.

    ``recipe`` has the hashes of a text's chunks in order. ``ranks`` has place and number of those chunks that are not
    the first, by their text, of the different chunks of their hash; it is empty for almost every text.
    """
    cut = docs.withColumn("text", normalised(F.col("text"))).select(
        *[c for c in docs.columns if c != "text"], F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text"), least, most).alias("chunks")
    )
    cut = settle(cut.withColumn("recipe", F.transform("chunks", lambda c: chunk_hash(c))), "chunks")
    kinds = cut.select(F.explode("chunks").alias("chunk")).select(chunk_hash(F.col("chunk")).alias("hash"), "chunk").distinct()
    shared = settle(kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "shared-hashes")
    rest = cut.drop("chunks")
    none = F.array().cast("array<struct<place:int,rank:int>>")
    if shared.isEmpty():
        return rest.withColumn("ranks", none)
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("chunk")) - 1
    numbered = kinds.join(shared, "hash", "left_semi").select("hash", "chunk", rank.alias("rank")).where("rank > 0")
    placed = cut.select("row", F.posexplode("chunks").alias("place", "chunk")).withColumn("hash", chunk_hash(F.col("chunk")))
    found = placed.join(numbered, ["hash", "chunk"]).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "rank"))).alias("ranks"))
    return rest.join(found, "row", "left").withColumn("ranks", F.coalesce("ranks", none))


def copies(docs: DataFrame, chunk_hash=F.xxhash64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``row, id, first, group_size, text_sha256`` for every row of ``docs`` (``row`` unique, ``id``, ``text``).

    ``first`` is a struct whose ``id`` and ``row`` are those of the row with the smallest id among equal texts; null ids come last.
    """
    told = recipes(docs.select("row", "id", "text"), chunk_hash, least, most).withColumn("mark", F.xxhash64("recipe", "ranks"))
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))
    same = ["mark", "recipe", "ranks"]
    groups = settle(
        told.groupBy(*same).agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first")).where("group_size > 1"), "copies"
    )
    # a large group's rows are dealt to several tasks, each with a copy of the group's one row
    hot = F.broadcast(hot_keys(groups, "mark", "group_size"))
    dealt = told.join(hot, "mark", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0)))
    salted = groups.join(hot, "mark", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    joined = dealt.drop("salts").join(salted.withColumn("salt", F.col("salt").cast("long")).drop("salts"), [*same, "salt"], "left")
    return joined.select(
        "row", "id", F.coalesce("first", order).alias("first"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256"
    )


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they are the same after every run of ASCII white space
    became one blank; null counts as empty, and empty texts are equal. Of equal
    texts the row with the smallest id is kept; null ids come last, and of
    repeated rows with that id exactly one is kept. ``keep_id`` is null only if
    all ids of the group are. An empty table gives none. Other columns are
    ignored, whatever their names. Texts of any length are cut whole.
    """
    named = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), col(text_col).alias("text"))
    return copies(named).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_copies`` keeps, with all their columns; the table is stored once."""
    row = free_name(docs, "row_number")
    stored = settle(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = copies(stored.select(col(row).alias("row"), col(id_col).alias("id"), col(text_col).alias("text")))
    kept = found.where("first.row = row").select(F.col("row").alias(row))
    return stored.join(kept, row, "left_semi").select(*[col(c) for c in docs.columns])


def op11(spark, folder):
    return exact_copies(table(spark, folder, "documents"))


QUERIES: dict[str, Run] = {"op11_exact_copies": op11}
SQL: dict[str, str] = {
    "op11_exact_copies": r"""
WITH plain AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY text)
""".strip()
}
