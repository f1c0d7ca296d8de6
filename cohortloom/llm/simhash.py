"""SimHash near-duplicate detection with covering locality-sensitive hashing.

Fingerprints of 64 bits are compared in 15 tables. Bit i belongs to class
``i % 15 + 1``, read as a vector of four bits; table v keeps the bits whose
class has an odd product with v. Any three bits leave some v with an even
product for each of them, so two fingerprints that differ in three bits or
fewer agree in the kept bits of some table: no pair within the radius is
missed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import settle
from .common import Run, col, free_name, table
from .components import roots

RADIUS = 3
SEED = 42
SHINGLE = 3
#: Members of a bucket that are compared directly; larger buckets go through the neighbour keys.
BUCKET = 1024
_BLOCK = 1 << 16


def covering_masks() -> list[int]:
    """The 15 bit masks for radius 3, as unsigned numbers."""
    classes = [i % 15 + 1 for i in range(64)]
    return [sum(1 << i for i, c in enumerate(classes) if (c & v).bit_count() % 2) for v in range(1, 16)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def simhash(raw: bytes | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a UTF-8 text: a bit is set if over half of the shingles' XXH64 have it.

    A-Z are lower-cased, words are runs without ASCII white space, shingles
    count as often as they occur. Fewer words than ``size``: the whole
    sequence is the only shingle. No word: zero.
    """
    words = (raw or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """The columns of ``docs`` but the text, and the fingerprint as a signed long; null text counts as empty."""
    rest = [c for c in docs.columns if c != text_col]
    schema = StructType([docs.schema[c] for c in rest] + [StructField(name, LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            marks = [signed(simhash(raw)) for raw in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(marks, pa.int64())], names=[*rest, name]
            )

    picked = docs.select(*[col(c) for c in rest], col(text_col).cast("binary").alias(free_name(docs, "raw_text")))
    return picked.mapInArrow(run, schema)


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning edges (smallest member, member) of the groups of fingerprints linked within the radius."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    root = np.arange(len(fps))
    while True:
        now = np.where(near, root[None, :], len(fps)).min(axis=1)
        now = now[now]
        if (now == root).all():
            break
        root = now
    return [(i, r) for i, r in enumerate(root.tolist()) if i != r]


def links(fingerprints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs of distinct fingerprints within radius 3.

    ``fingerprints`` holds distinct signed longs in ``fp``. Buckets of up to
    ``bucket`` members give spanning edges, not pairs. The members of larger
    buckets are spread over the keys that lie within one bit (near) or two bits
    of them: two fingerprints within three bits share a key that is near to one
    of them. A key has at most 65 near and 2081 members in all, so no key is
    hot however many fingerprints lie close together.
    """
    if radius != RADIUS:
        raise ValueError("the masks are built for radius 3")
    masks = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(signed(m)).cast("long").alias("m")) for v, m in enumerate(covering_masks())])
    keyed = fingerprints.select("fp", F.explode(masks).alias("t")).select(
        F.col("t.v").alias("v"), F.col("fp").bitwiseAND(F.col("t.m")).alias("key"), "fp"
    )
    sizes = keyed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = settle(keyed.join(sizes, ["v", "key"]), "buckets")

    small = shared.where(F.col("members") <= bucket).groupBy("v", "key").agg(F.collect_list("fp").alias("fps"))

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = [], []
            for members in batch.column(0).to_pylist():
                # unsigned and sorted by the signed value, so that the first is the smallest
                fps = np.sort(np.array(members, np.int64))
                for i, r in _forest(fps.view(np.uint64), RADIUS):
                    a.append(int(fps[i]))
                    b.append(int(fps[r]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    within = small.select("fps").mapInArrow(compare, "a long, b long")

    flips = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))]
    moves = F.expr(f"array({', '.join(f"{signed(x)}L" for x in flips if x != 1 << 63)}, bigint(-9223372036854775808))")
    crowd = shared.where(F.col("members") > bucket).select("fp").distinct()
    around = crowd.select("fp", F.explode(moves).alias("move")).select(
        F.col("fp").bitwiseXOR(F.col("move")).alias("key"), "fp", (F.bit_count("move") <= 1).alias("near")
    )
    met = around.groupBy("key").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_list("fp").alias("fps")
    )
    dense = met.where("b IS NOT NULL AND size(fps) > 1").select(F.explode("fps").alias("a"), "b").where("a <> b")
    return within.unionByName(dense).distinct()


def _rooted(own: DataFrame) -> DataFrame:
    """``own`` (one row per distinct fingerprint ``fp``, stored) with ``root``, the smallest fingerprint reachable over links."""
    root = roots(links(own.select("fp")), "links").withColumnRenamed("node", "fp")
    return own.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicate_groups(fingerprints: DataFrame, id_col: str) -> DataFrame:
    """Columns ``fingerprint, root, component_id`` for every distinct fingerprint.

    ``root`` is the smallest fingerprint and ``component_id`` the smallest id reachable over links.

    ``fingerprints`` has the ids and ``fingerprint``. Null ids never become a
    component id unless all ids of a component are null.
    """
    own = settle(
        fingerprints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(col(id_col)).alias("least")), "fingerprints"
    )
    tied = _rooted(own)
    least = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return tied.join(least, "root").select(F.col("fp").alias("fingerprint"), "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id.

    Null and empty texts have fingerprint zero and link like any other.
    Repeated rows are each returned; an empty table gives none. Other columns
    are ignored, whatever their names. Whole texts are read; distinct
    fingerprints alone are compared, so copies cost nothing beyond their own
    fingerprint.
    """
    marks = settle(with_fingerprint(docs.select(col(id_col), col(text_col)), text_col), "marks")
    groups = near_duplicate_groups(marks, id_col)
    return marks.join(groups, "fingerprint").select(
        col(id_col), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of ``docs`` without near copies: the row with the smallest id of each group stays.

    Groups are those of ``near_duplicates``: fingerprints of three-word shingles, linked at three or fewer
    differing bits; null and empty texts are one group with all that lies near fingerprint zero. Null ids
    come last; of repeated rows one stays. An empty table stays empty. All columns are kept.
    """
    row, mark = free_name(docs, "row_number"), "fingerprint"
    stored = settle(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    named = stored.select(col(row).alias("row"), col(id_col).alias("id"), col(text_col).alias("text"))
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))
    # one row per fingerprint before anything is joined, so that copies are no hot key
    own = with_fingerprint(named, "text", mark).groupBy(F.col(mark).alias("fp")).agg(F.min(order).alias("first"))
    chosen = _rooted(settle(own, "fingerprints")).groupBy("root").agg(F.min("first").alias("first"))
    return stored.join(chosen.select(F.col("first.row").alias(row)), row, "left_semi").select(*[col(c) for c in docs.columns])


def op1(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


QUERIES: dict[str, Run] = {"op1_simhash": op1}
SQL: dict[str, str] = {}
