"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its
leading tokens, where a token with a digit is a variable field. In a leaf that
holds different lines, the template has the most frequent token of every
place; lines that agree with it in 0.8 of their tokens are instances of it, and
the places in which they differ are variable fields too. A leaf may hold further
templates: lines that are no instance are linked with every line of the leaf that agrees
with them in 0.8 of its tokens, and linked lines are one template. All other lines are
templates of their own, with their digits left open; lines in which most tokens have
digits are compared as they are. A line of five to nine tokens may differ in one place, also a
leading one: its templates leave one place open, and it goes by the one that stands in most documents.
A template that recurs
across documents stays in the document with the smallest id and is dropped
from all others.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import settle
from .common import Run, col, free_name, table
from .components import roots_within

#: Leading tokens that lead to a leaf.
DEPTH = 4
#: Lines of fewer tokens recur by chance: they drop only from SHORT_DOCS documents on, also as instances of a template.
LONG = 10
LONG_DOCS = 2
SHORT_DOCS = 10
#: Share of a line's tokens that agree with the template, as a fraction of whole numbers.
AGREE = (4, 5)
#: Bits of the filter that is put before the join of line texts.
FILTER_BITS = 1 << 22
OPEN = b"<*>"
_DIGIT = re.compile(rb"[0-9]")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def parse(line: bytes) -> tuple[int, int, int, list[bytes]] | None:
    """Tokens of a line with variable fields left open, their number, the leaf, the key of the line.

    None for a line without a token, and for one that is made of variable fields for the larger part.
    """
    tokens = line.split()
    if not tokens:
        return None
    if _DIGIT.search(line):
        tokens = [OPEN if _DIGIT.search(t) else t for t in tokens]
        if 2 * tokens.count(OPEN) > len(tokens):
            return None
    n = len(tokens)
    leaf = xxhash.xxh64_intdigest(b"%d " % n + b" ".join(tokens[:DEPTH]))
    return n, _signed(leaf), _signed(xxhash.xxh64_intdigest(b" ".join(tokens))), tokens


def named(line: bytes) -> tuple[int, int, int, list[bytes]] | None:
    """As ``parse``, but a line made of variable fields for the larger part goes by its exact tokens, in a leaf of its own."""
    found = parse(line)
    if found:
        return found
    tokens = line.split()
    if not tokens:
        return None
    key = _signed(xxhash.xxh64_intdigest(b"=" + b" ".join(tokens), seed=1))
    return len(tokens), key, key, tokens


def variants(tokens: list[bytes]) -> list[int]:
    """Keys of the templates of a short line: one place open, if that leaves half of the tokens or more."""
    n, is_open = len(tokens), tokens.count(OPEN)
    if n >= LONG or n * (AGREE[1] - AGREE[0]) < AGREE[1]:
        return []
    return [
        _signed(xxhash.xxh64_intdigest(b" ".join([*tokens[:i], OPEN, *tokens[i + 1 :]])))
        for i in range(n)
        if 2 * (is_open + (tokens[i] != OPEN)) <= n
    ]


def marks_of(keys: DataFrame) -> np.ndarray:
    """A bit for every residue of a key that occurs: a filter of fixed size, which lets all listed keys pass.

    Keys are hashes; ``keys`` has them in ``key``. At most ``FILTER_BITS / 64`` rows reach the driver.
    """
    places = keys.select(F.pmod("key", F.lit(FILTER_BITS)).cast("int").alias("place"))
    words = places.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, place % 64))").alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():
        out[row["word"]] = row["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def parsed_lines(docs: DataFrame, marks: np.ndarray | None = None) -> DataFrame:
    """Rows ``id, mark, n, leaf, key, variants, places`` of the different lines of every document (``id, text``).

    ``mark`` is a hash of the text, ``places`` the numbers of the lines, from 0. With ``marks``, only lines whose key
    passes that filter, and ``id, n, leaf, key, tokens`` of them.
    """
    texts = marks is not None
    packed = np.packbits(marks) if texts else None
    fields = [StructField("n", IntegerType()), StructField("leaf", LongType()), StructField("key", LongType())]
    if texts:
        schema = StructType([docs.schema["id"], *fields, StructField("tokens", StringType())])
    else:
        more = [StructField("variants", ArrayType(LongType())), StructField("places", ArrayType(IntegerType()))]
        schema = StructType([docs.schema["id"], StructField("mark", LongType()), *fields, *more])
    rows_at_once = 1 << 14

    def run(batches):
        import pyarrow as pa

        def batch_of(place, batch, rows):
            taken = pa.array(place, pa.int32())
            arrays = [batch.column(0).take(taken)] if texts else [batch.column(0).take(taken), batch.column(2).take(taken)]
            arrays += [pa.array([r[i] for r in rows], kind) for i, kind in ((0, pa.int32()), (1, pa.int64()), (2, pa.int64()))]
            if texts:
                arrays.append(pa.array([b" ".join(r[3]).decode("utf-8", "replace") for r in rows], pa.string()))
            else:  # a line in a leaf of its own, as `named` has it, has none
                arrays.append(pa.array([variants(r[3]) or None if r[1] != r[2] else None for r in rows], pa.list_(pa.int64())))
                arrays.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

        passing = np.unpackbits(packed).tobytes() if texts else b""
        for batch in batches:
            place, rows = [], []
            for at, raw in enumerate(batch.column(1)):
                seen: dict[int, list[int]] = {}
                for number, line in enumerate((raw.as_py() or b"").split(b"\n")):
                    found = named(line)
                    if not found:
                        continue
                    known = seen.get(found[2])
                    if known is not None:
                        known.append(number)
                    elif not texts or passing[found[2] % FILTER_BITS]:
                        seen[found[2]] = numbers = [number]
                        place.append(at)
                        rows.append((*found, numbers))
                if len(rows) >= rows_at_once:
                    yield batch_of(place, batch, rows)
                    place, rows = [], []
            yield batch_of(place, batch, rows)

    read = docs.select("id", F.col("text").cast("binary").alias("text"), *([] if texts else [F.xxhash64("text").alias("mark")]))
    return read.mapInArrow(run, schema)


def instances(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows ``leaf, key, tree`` of the lines that are instances of a template of their leaf, which ``tree`` names.

    ``keys`` has the different lines, ``leaf, key, n``. Only leaves with
    several long lines are looked at. Counts per (leaf, place, token) are
    aggregates, so a leaf may hold any share of all lines.
    """
    long = keys.where(F.col("n") >= LONG).select("leaf", "key").distinct()
    shared = long.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("leaf")
    # settled, so that Spark knows its size
    members = settle(long.join(shared, "leaf"), "leaves")
    # the filter keeps the texts of most other lines out of the shuffle; the join is exact
    lines = parsed_lines(docs, marks_of(members)).join(members.select("key"), "key", "left_semi")
    texts = settle(
        lines.groupBy("leaf", "key").agg(F.first("tokens").alias("tokens")).withColumn("tokens", F.split("tokens", " ")), "texts"
    )
    placed = texts.select("leaf", "key", F.posexplode("tokens").alias("place", "token"))
    most = (
        placed.groupBy("leaf", "place", "token")
        .agg(F.count(F.lit(1)).alias("lines"))
        .groupBy("leaf", "place")
        .agg(F.min(F.struct((-F.col("lines")).alias("rank"), F.col("token"))).alias("least"))
        .select("leaf", "place", F.col("least.token").alias("usual"))
    )
    up, down = AGREE
    matched = settle(
        placed.join(most, ["leaf", "place"])
        .groupBy("leaf", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("token") == F.col("usual")).alias("same"))
        .where(F.col("same") * down >= F.col("n") * up)
        .select("leaf", "key"),
        "matched",
    )
    root = settle(_linked(texts, matched).withColumnRenamed("node", "key"), "linked")
    own = matched.withColumn("first", F.lit(True))
    found = texts.select("leaf", "key").join(own, ["leaf", "key"], "left").join(root, "key", "left")
    return found.where("first OR root IS NOT NULL").select("leaf", "key", F.coalesce("root", "leaf").alias("tree"))


def _linked(texts: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows ``node, root``: components of the lines of leaves in which not all lines are ``matched``.

    Lines of n tokens that agree in 0.8 of them differ in ``n div 5`` places at most, none of which is a leading
    one. Of one segment more than that, one is the same in both; so no such pair is missed.
    """
    up, down = AGREE
    left = texts.join(matched, ["leaf", "key"], "left_anti").select("leaf").distinct()
    rest = settle(texts.join(left, "leaf", "left_semi"), "unmatched")
    differ = f"(size(tokens) * {down - up} div {down})"
    at = f"(size(tokens) - {DEPTH}) * %s div ({differ} + 1)"
    segments = F.expr(
        f"transform(sequence(0, {differ}), i -> xxhash64(leaf, i, "
        f"slice(tokens, int({DEPTH + 1} + {at % 'i'}), int({at % '(i + 1)'} - {at % 'i'}))))"
    )
    keyed = rest.select(F.explode(segments).alias("bucket"), F.col("key").alias("node"))
    several = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("bucket")
    buckets = settle(keyed.join(several, "bucket").select("bucket", "node"), "segments")
    given = rest.select("leaf", "key").join(matched, ["leaf", "key"], "left_semi")
    known = settle(given.join(given.groupBy("leaf").agg(F.min("key").alias("b")), "leaf").select(F.col("key").alias("a"), "b"), "known")

    def close(pairs: DataFrame) -> DataFrame:
        both = pairs.join(rest.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a").join(
            rest.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b"
        )
        same = F.size(F.filter(F.zip_with("x", "y", lambda p, q: p == q), lambda e: e))
        return both.where((F.size("x") == F.size("y")) & (same * down >= F.size("x") * up)).select("a", "b")

    return roots_within(buckets, close, known, "line-links")


def short_templates(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows ``key, short`` of the short lines whose template stands in SHORT_DOCS documents or more.

    ``lines`` has ``id, key``, ``keys`` has ``key, docs, variants``. A template has several different lines.
    """
    listed = keys.where("variants IS NOT NULL").select("key", "docs", F.explode("variants").alias("short"))
    several = listed.groupBy("short").agg(F.count(F.lit(1)).alias("lines"), F.sum("docs").alias("docs"))
    wide = several.where((F.col("lines") > 1) & (F.col("docs") >= SHORT_DOCS)).select("short")
    members = settle(listed.join(wide, "short").select("key", "short"), "short-lines")
    # a document may hold several lines of a template
    held = lines.join(members, "key").select("short", "id").distinct().groupBy("short").agg(F.count(F.lit(1)).alias("docs"))
    best = members.join(held.where(F.col("docs") >= SHORT_DOCS), "short")
    return best.groupBy("key").agg(F.max(F.struct("docs", "short")).alias("best")).select("key", F.col("best.short").alias("short"))


def recurring(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of every document, ``id, mark, key, places``, and the recurring ones, ``key, keeper``.

    ``keeper`` is the smallest id of the documents that hold the template; null ids come last.
    """
    lines = settle(parsed_lines(docs), "lines")
    own = F.struct(F.col("id").isNull().alias("last"), F.col("id"))
    keys = settle(
        lines.groupBy("leaf", "key", "n").agg(F.count(F.lit(1)).alias("docs"), F.min(own).alias("first"), F.first("variants").alias("variants")),
        "line-keys",
    )
    matched = settle(instances(docs, keys), "instances")
    short = settle(short_templates(lines.select("id", "key"), keys), "short-templates")
    template = F.when(F.col("tree").isNotNull(), F.struct(F.col("tree").alias("name"), F.lit(True).alias("many"))).when(
        F.col("short").isNotNull(), F.struct(F.col("short").alias("name"), F.lit(True).alias("many"))
    ).otherwise(
        F.struct(F.col("key").alias("name"), F.lit(False).alias("many"))
    )
    # the templates of short lines have been judged, by all lines that they hold
    enough = F.when(F.col("short").isNotNull(), 1).when(F.col("n") >= LONG, LONG_DOCS).otherwise(SHORT_DOCS)
    tied = keys.join(matched, ["leaf", "key"], "left").join(short, "key", "left")
    known = tied.select("key", "n", "docs", "first", template.alias("template"), enough.alias("enough"))
    wide = (
        known.groupBy("template", "n")
        .agg(F.sum("docs").alias("docs"), F.min("first").alias("first"), F.min("enough").alias("enough"))
        .where("docs >= enough")
    )
    found = known.select("key", "template", "n").join(wide, ["template", "n"]).select("key", F.col("first.id").alias("keeper"))
    return lines.select("id", "mark", "key", "places"), found


def _dropped(docs: DataFrame) -> DataFrame:
    """Rows ``id, mark, places``: numbers of the lines that go from a document; rows of an id may differ in their text."""
    lines, found = recurring(docs)
    return (
        lines.join(found, "key")
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "mark")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    )


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", counts: bool = False) -> DataFrame:
    """The documents with their columns, without the lines whose template an earlier document has.

    No document goes: one whose lines are all dropped has an empty text. Null
    texts stay null, texts without a dropped line stay as they are. Rows with
    the same id count as one document; null ids as one that comes last. A
    column named ``length_col`` gets the new number of characters where a text
    changed. ``counts`` adds ``n_lines`` (all) and ``dropped`` (places of the
    dropped lines, from 0).
    """
    dropped = settle(_dropped(docs.select(col(id_col).alias("id"), col(text_col).alias("text"))), "dropped-lines")
    of, mark, gone, lines, kept = (free_name(docs, n) for n in ("dropped_of", "text_mark", "dropped_places", "text_lines", "kept_text"))
    away = dropped.select(F.col("id").alias(of), F.col("mark").alias(mark), F.col("places").alias(gone))
    same = col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(col(text_col)) == F.col(mark))
    split = F.split(F.coalesce(col(text_col), F.lit("")), "\n")
    joined = docs.join(away, same, "left").drop(of, mark).withColumn(lines, split)
    # by the numbers that stay, so that a text of many dropped lines takes no longer
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), col(text_col)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    joined = joined.withColumn(kept, text)
    columns = []
    for c in docs.columns:
        value = col(c)
        if c == text_col:
            value = F.col(kept)
        elif c == length_col and docs.schema[c].dataType.typeName() in ("byte", "short", "integer", "long"):
            value = F.when(F.col(gone).isNull() | F.col(kept).isNull(), value).otherwise(F.length(kept)).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    if counts:
        columns += [
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.col(gone), F.array().cast("array<int>")).alias("dropped"),
        ]
    return joined.select(*columns)


def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = drop_recurring(docs, counts=True)
    return cleaned.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped", "text")


QUERIES: dict[str, Run] = {"op8_line_dedup": op8}
SQL: dict[str, str] = {}
