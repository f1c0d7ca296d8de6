"""Hard-negative mining with Kronecker-packed products.

The components of one dimension of several candidates, made non-negative by a
bias, stand in separated fields of one wide integer. For an anchor, every such
integer is multiplied once by the anchor's component; the sum over the
dimensions holds the scores of all these candidates in its fields, from which
they are read exactly once the part of the biases is taken away.

Anchors and candidates are dealt to cells of a grid. A cell has a bounded
number of each, whatever the size of the table; every anchor meets every
candidate in one cell.
"""

from __future__ import annotations

from operator import mul

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StructField, StructType

from ..session import settle
from .common import Run, col, table

#: Anchors and candidates of a cell, and the most components of either.
ANCHORS, CANDIDATES, COMPONENTS = 1024, 4096, 1 << 22
#: Candidates in one wide integer.
FIELDS = 1024
#: Components are whole numbers within this bound; what is beyond counts as the bound.
BOUND = 1 << 40
#: A negative has at least LEAST and at most MOST hundredths of the positive's score.
LEAST, MOST = 80, 100


def field_bits(dims: int, anchor_top: int, candidate_top: int) -> int:
    """Width of a field that holds the sum of ``dims`` products without a carry: 32, or a multiple of 64."""
    need = (dims * anchor_top * candidate_top).bit_length()
    return 32 if need <= 32 else -(-need // 64) * 64


def packed(values: np.ndarray, bits: int) -> list[int]:
    """One integer per column of a table of non-negative numbers; row j stands in field j."""
    if bits <= 64:
        columns = np.ascontiguousarray(values.T.astype("<u4" if bits == 32 else "<u8"))
        return [int.from_bytes(c.tobytes(), "little") for c in columns]
    return [int.from_bytes(b"".join(v.to_bytes(bits // 8, "little") for v in c), "little") for c in values.T.tolist()]


def unpacked(total: int, n: int, bits: int):
    """The first n fields of an integer."""
    raw = total.to_bytes(n * bits // 8, "little")
    if bits <= 64:
        return np.frombuffer(raw, "<u4" if bits == 32 else "<u8")
    size = bits // 8
    return np.array([int.from_bytes(raw[i : i + size], "little") for i in range(0, len(raw), size)], object)


class Packs:
    """Candidates (rows of whole numbers) packed for products with anchors whose components lie within ``anchor_top``."""

    def __init__(self, candidates: np.ndarray, anchor_top: int):
        self.dims = candidates.shape[1]
        self.plus = int(np.abs(candidates).max(initial=0))
        self.anchor_plus = anchor_top
        self.bits = field_bits(self.dims, 2 * anchor_top, 2 * self.plus)
        #: scores of fewer bits than a long leave room for the comparisons in hundredths
        kind = np.int64 if self.bits == 32 else object
        self.parts = []
        for at in range(0, len(candidates), FIELDS):
            rows = candidates[at : at + FIELDS]
            sums = rows.astype(kind).sum(axis=1)
            self.parts.append((packed(rows + self.plus, self.bits), len(rows), sums * anchor_top))
        self.kind = kind

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of one anchor with all candidates."""
        if not self.parts:
            return np.zeros(0, self.kind)
        up = self.anchor_plus
        raised = [x + up for x in anchor]
        fixed = self.plus * sum(anchor) + self.dims * self.plus * up
        out = []
        for integers, n, shift in self.parts:
            total = sum(map(mul, raised, integers))
            out.append(unpacked(total, n, self.bits).astype(self.kind) - shift - fixed)
        return np.concatenate(out)


def whole(lists, dims: int, scale: int) -> np.ndarray:
    """Rows of ``floor(scale * x)`` of an Arrow array of lists, short ones filled up with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    out = np.zeros((len(lists), dims), np.int64)
    with np.errstate(over="ignore"):
        numbers = np.clip(np.floor(scale * flat), -BOUND, BOUND).astype(np.int64)
    lengths = np.diff(offsets)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(flat)) - np.repeat(offsets[:-1], lengths)] = numbers
    return out


def best(scores: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """The n places of ``among`` (rising) with the highest scores, of equal ones the first."""
    if len(among) > n and scores.dtype != object:
        found = scores[among]
        among = among[found >= np.partition(found, len(found) - n)[len(found) - n]]
    return among[np.argsort(-scores[among], kind="stable")[:n]]


def numbered(vectors: DataFrame, id_col: str, label: Column, vector_col: str, anchor: Column) -> DataFrame:
    """``row, id, label, vec, anchor`` of the rows that take part, stored: no null label, vector or component, all finite."""
    vec = col(vector_col).cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = vectors.select(
        col(id_col).alias("id"), label.alias("label"), vec.alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.coalesce(odd, F.lit(True)).alias("odd")
    )
    kept = named.where("NOT odd AND label IS NOT NULL").drop("odd")
    return settle(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")


def in_cells(side: DataFrame, buckets: int, others: int, first: bool) -> DataFrame:
    """Rows of one side with their bucket, once for every bucket of the other side; ``cell`` numbers the pairs."""
    own = F.pmod(F.xxhash64("row", F.lit(int(first))), F.lit(buckets))
    other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    parted = side.withColumn("own", own).withColumn("other", other)
    cell = F.col("own") * others + F.col("other") if first else F.col("other") * buckets + F.col("own")
    return parted.withColumn("cell", cell.cast("long")).drop("own", "other")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    scale: int = 256,
    cell: tuple[int, int] = (ANCHORS, CANDIDATES),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part. A score is the inner product of components
    ``floor(scale * x)``; components beyond 2**40 count as 2**40, vectors
    of unequal length as if filled up with zeros. For every anchor (a row for
    which ``anchor`` holds) its first ``positives`` other rows of the same
    label, and for each of these the first ``negatives`` rows of another label
    whose score lies between 80 and 100 hundredths of the positive's. Higher
    scores come first, ties by smaller id, null ids last. Rows, not ids, are
    told apart: a repeated row is another row, and repeated anchors each have
    their result. A score beyond a long is null. Empty tables, anchors without
    positives and positives without negatives give no row. Other columns are
    ignored, whatever their names. Rows are counted once on the driver.
    """
    known = numbered(vectors, id_col, col(label_col) if label is None else label, vector_col, anchor)
    n, n_anchors, dims = known.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("vec"))).first()
    dims = max(dims or 0, 1)
    per_anchors, per_candidates = (max(1, min(size, COMPONENTS // dims)) for size in cell)
    a, g = -(-n_anchors // per_anchors) or 1, -(-n // per_candidates) or 1
    id_type, score = known.schema["id"].dataType, DecimalType(38, 0)

    candidates = in_cells(known.select("row", "id", "label", "vec"), g, a, False)
    anchors = known.where("anchor").select("row", "id", "label", "vec")

    def prepared(left, right):
        """Both sides of a cell as numbers; candidates in the order of their ids."""
        import pyarrow as pa
        import pyarrow.compute as pc

        # sort_indices puts nulls last
        right = right.take(pc.sort_indices(right, sort_keys=[("id", "ascending"), ("row", "ascending")]))
        both = pa.chunked_array([*left.column("label").chunks, *right.column("label").chunks]).combine_chunks()
        codes = both.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        sides = [whole(s.column("vec").combine_chunks(), dims, scale) for s in (left, right)]
        return left, right, codes[: len(left)], codes[len(left) :], *sides

    def find_positives(left, right):
        import pyarrow as pa

        left, right, l_code, r_code, l_whole, r_whole = prepared(left, right)
        rows, l_rows = right.column("row").to_numpy(), left.column("row").to_numpy()
        top, out = int(np.abs(l_whole).max(initial=0)), []
        for code in np.unique(l_code):
            same = np.flatnonzero(r_code == code)
            packs = Packs(r_whole[same], top)
            for i in np.flatnonzero(l_code == code):
                scores = packs.scores(l_whole[i].tolist())
                for k in best(scores, np.flatnonzero(rows[same] != l_rows[i]), positives):
                    out.append((i, same[k], int(scores[k])))
        taken = lambda s, name, at: s.column(name).take(pa.array([int(r[at]) for r in out], pa.int64())).combine_chunks()
        arrays = [taken(left, "row", 0), taken(right, "row", 1), taken(right, "id", 1), pa.array([r[2] for r in out], pa.decimal128(38))]
        return pa.Table.from_arrays(arrays, names=["anchor", "p_row", "p_id", "p_score"])

    fields = [StructField("anchor", LongType()), StructField("p_row", LongType()), StructField("p_id", id_type), StructField("p_score", score)]
    met = in_cells(anchors, a, g, True).groupBy("cell").cogroup(candidates.groupBy("cell"))
    near = first_of(met.applyInArrow(find_positives, StructType(fields)), ["anchor"], ["p_score", "p_id", "p_row"], positives, "p_no")
    listed = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("p_no", "p_id", "p_score"))).alias("positives"))
    ready = settle(
        anchors.join(listed.withColumnRenamed("anchor", "row"), "row").withColumn("p_scores", F.col("positives.p_score")), "positives"
    )

    def find_negatives(left, right):
        import pyarrow as pa

        left, right, l_code, r_code, l_whole, r_whole = prepared(left, right)
        packs = Packs(r_whole, int(np.abs(l_whole).max(initial=0)))
        out = []
        for i, wanted in enumerate(left.column("p_scores").to_pylist()):
            scores = packs.scores(l_whole[i].tolist())
            others = np.flatnonzero(r_code != l_code[i])
            hundredfold = 100 * scores[others]
            for no, limit in enumerate(map(int, wanted), 1):
                if limit < 0:  # no score is between 80 and 100 hundredths of it
                    continue
                # of whole numbers, 100 * s >= LEAST * limit means s >= ceil
                among = others[(hundredfold >= LEAST * limit) & (hundredfold <= MOST * limit)]
                out += [(i, no, k, int(scores[k])) for k in best(scores, among, negatives)]
        taken = lambda s, name, at: s.column(name).take(pa.array([int(r[at]) for r in out], pa.int64())).combine_chunks()
        arrays = [taken(left, "row", 0), pa.array([r[1] for r in out], pa.int32()), taken(right, "row", 2), taken(right, "id", 2)]
        return pa.Table.from_arrays([*arrays, pa.array([r[3] for r in out], pa.decimal128(38))], names=["row", "p_no", "n_row", "n_id", "n_score"])

    fields = [StructField("row", LongType()), StructField("p_no", IntegerType()), StructField("n_row", LongType()), StructField("n_id", id_type), StructField("n_score", score)]
    left = in_cells(ready.select("row", "id", "label", "vec", "p_scores"), a, g, True)
    mined = left.groupBy("cell").cogroup(candidates.groupBy("cell")).applyInArrow(find_negatives, StructType(fields))
    ranked = first_of(mined, ["row", "p_no"], ["n_score", "n_id", "n_row"], negatives, "rank")
    shown = ready.select("row", F.col("id").alias("anchor_id"), F.explode("positives").alias("p")).select("row", "anchor_id", "p.*")
    return ranked.join(shown, ["row", "p_no"]).select(
        "anchor_id",
        F.col("p_id").alias("positive_id"),
        "rank",
        F.col("n_id").alias("negative_id"),
        F.col("p_score").try_cast("long").alias("positive_score"),
        F.col("n_score").try_cast("long").alias("negative_score"),
    )


def first_of(found: DataFrame, keys: list[str], order: list[str], n: int, name: str) -> DataFrame:
    """The first n rows of every key, numbered from 1: highest score first, then smaller id and row.

    Spark drops later rows of a key in every task before they are shuffled.
    """
    score, *ties = order
    window = Window.partitionBy(*keys).orderBy(F.desc(score), *[F.asc_nulls_last(t) for t in ties])
    return found.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def op13(spark, folder):
    vectors = table(spark, folder, "embeddings")
    number, label = F.col("vec_id"), F.col("label")
    moved = F.when(number % 7 == 0, ((label.cast("long") + 1) % 10).cast("int")).otherwise(label)
    return hard_negatives(vectors, number % 100 == 0, moved)


QUERIES: dict[str, Run] = {"op13_hard_negatives": op13}
SQL: dict[str, str] = {
    "op13_hard_negatives": """
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_dot_product(a.vec, c.vec) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT row, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS n
    FROM scores WHERE same QUALIFY n <= 5)
SELECT s.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.row, p.n ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.row = p.row
WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
""".strip()
}
