"""Benchmark decontamination: which documents contain a benchmark item.

Items are partitioned by the number of their distinct shingles. An item is
contained if at least 0.8 of its shingles occur in the document, so at most
``n - ceil(0.8 n)`` are missing, and any set of one more must be met. The
MinHash sketch of an item is the set of its shingles with the least hashes,
as many as the upper size of its partition asks for; a document is a candidate
if one of its shingles is in the sketch. No contained item is missed. Every
candidate is verified on the shingles themselves. Only built-in functions are
used.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import Run, col, exploded, free_name, hash_pair, table, with_windows

SHINGLE = 5
#: Share of an item's shingles, as a fraction of whole numbers.
SHARE = (4, 5)
NOT_WORD = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    """Words of letters and digits in lower case; punctuation and white space part them."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _with_hashes(df: DataFrame) -> DataFrame:
    """Adds ``hashes``, the distinct hashes of the five-word shingles of ``words``.

    Of fewer words the whole sequence is the only shingle; of none there is none (null).
    """
    hashed = df.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("_w"))
    return with_windows(hashed, "_w", "_s", SHINGLE, hash_pair).select(
        *df.columns,
        F.when(F.size("words") >= SHINGLE, F.array_distinct("_s"))
        .when(F.size("words") > 0, F.array(F.xxhash64(F.concat_ws(" ", "words"))))
        .alias("hashes"),
    )


def _with_shingles(df: DataFrame) -> DataFrame:
    """Adds ``shingles``, the distinct shingles of ``words`` themselves: arrays of words."""
    listed = df.select("*", F.transform("words", lambda w: F.array(w)).alias("_w"))
    return with_windows(listed, "_w", "_s", SHINGLE, _overlapped).select(
        *df.columns,
        F.when(F.size("words") >= SHINGLE, F.array_distinct("_s")).when(F.size("words") > 0, F.array("words")).alias("shingles"),
    )


def _overlapped(a: Column, b: Column) -> Column:
    """Two windows of words as one: equally long ones that follow each other, or overlap in all but one word."""
    return F.when(F.size(a) <= 2, F.concat(a, b)).otherwise(F.concat(a, F.slice(b, -1, 1)))


def sketches(items: DataFrame) -> DataFrame:
    """Rows ``hash, item`` of the sketch of every item, from a table ``item, words``.

    Partition p holds the items of 2**p up to 2**(p+1) - 1 distinct shingles,
    its sketch has ``u - ceil(share * u) + 1`` of the least hashes for u, the
    upper size.
    """
    up, down = SHARE
    hashed = _with_hashes(items).select("item", F.sort_array("hashes").alias("hashes"))
    upper = F.expr("shiftleft(1, length(bin(size(hashes)))) - 1")
    needed = upper - F.ceil(upper * up / down) + 1
    return exploded(hashed, F.slice("hashes", 1, needed.cast("int")), "hash", "item")


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct ``id, mark, item`` of documents that hold a shingle of an item's sketch; ``mark`` is a hash of the text."""
    read = docs.select("id", F.xxhash64("text").alias("mark"), _words(F.col("text")).alias("words"))
    hashes = exploded(_with_hashes(read), F.col("hashes"), "hash", "id", "mark")
    return hashes.join(sketches(items), "hash").select("id", "mark", "item").distinct()


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """Rows ``id, mark, item, n_shingles, n_found`` of contained items, once per different (id, mark)."""
    up, down = SHARE
    read = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    items = settle(
        benchmark.select(col(item_col).alias("item"), _words(col(item_text_col)).alias("words")).distinct(), "items"
    )
    # settled, so that Spark knows their size and broadcasts them only if that is small
    pairs = settle(candidates(read, items), "candidates")
    chosen = pairs.select(F.col("id").alias("c_id"), F.col("mark").alias("c_mark")).distinct()
    marked = read.withColumn("mark", F.xxhash64("text"))
    again = marked.join(
        chosen, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")), "left_semi"
    ).select("id", "mark", _words(F.col("text")).alias("words"))
    held = exploded(_with_shingles(again), F.col("shingles"), "shingle", "id", "mark").distinct()
    # an item id may stand on several texts; each is an item of its own
    asked = exploded(
        _with_shingles(items),
        F.col("shingles"),
        "shingle",
        "item",
        F.xxhash64("words").alias("item_mark"),
        F.size("shingles").alias("n_shingles"),
    )
    wanted = pairs.withColumnsRenamed({"id": "p_id", "mark": "p_mark", "item": "p_item"}).join(
        asked, F.col("p_item").eqNullSafe(F.col("item"))
    )
    met = held.join(
        wanted,
        (held["shingle"] == wanted["shingle"]) & held["id"].eqNullSafe(wanted["p_id"]) & (held["mark"] == wanted["p_mark"]),
    )
    return (
        met.groupBy("id", "mark", "item", "item_mark", "n_shingles")
        .agg(F.count(F.lit(1)).alias("n_found"))
        .where(F.col("n_found") * down >= F.col("n_shingles") * up)
        .groupBy("id", "mark", "item")
        .agg(F.max(F.struct(F.col("n_found") / F.col("n_shingles"), "n_shingles", "n_found")).alias("best"))
        .select("id", "mark", "item", "best.n_shingles", "best.n_found")
    )


def contained(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Rows ``doc id, item id, n_shingles, n_found, containment``: the document holds 0.8 or more of the item's shingles.

    Words are letters and digits in lower case. An item of fewer than five
    words is contained in documents that have exactly those words. Null and
    empty texts hold nothing and are contained in nothing. A pair stands once:
    of several texts under one id that with the largest share counts.
    """
    found = _found(docs, benchmark, id_col, text_col, item_col, item_text_col)
    best = found.groupBy("id", "item").agg(
        F.max(F.struct(F.col("n_found") / F.col("n_shingles"), "n_shingles", "n_found")).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("best.n_shingles").cast("long").alias("n_shingles"),
        F.col("best.n_found").alias("n_found"),
        (F.col("best.n_found") / F.col("best.n_shingles")).alias("containment"),
    )


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; rows are judged by their own text."""
    found = settle(
        _found(docs, benchmark, id_col, text_col, item_col, item_text_col).select("id", "mark").distinct(), "contaminated"
    )
    mark = free_name(docs, "text_mark")
    return (
        docs.withColumn(mark, F.xxhash64(col(text_col)))
        .join(found, col(id_col).eqNullSafe(found["id"]) & (col(mark) == found["mark"]), "left_anti")
        .select(*[col(c) for c in docs.columns])
    )


def op2(spark, folder):
    return contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
    THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    ELSE [array_to_string(w, ' ')] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_found,
  count(*) / any_value(n) AS containment
FROM shingles d JOIN shingles i ON d.s = i.s JOIN sizes ON sizes.id = i.id
WHERE d.kind = 'd' AND i.kind = 'i'
GROUP BY d.id, i.id HAVING count(*) * 5 >= any_value(n) * 4
"""

QUERIES: dict[str, Run] = {"op2_decontaminate": op2}
SQL: dict[str, str] = {"op2_decontaminate": _SQL}
