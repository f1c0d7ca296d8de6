"""Language-model scoring: deleted interpolation of a word bigram model.

The probability of a token after another is a mixture of its share after that
token, its share in the corpus and a uniform share. The weights depend on how
often the context was seen; they are learned by expectation-maximisation on a
part of the training documents, with the counts of the rest.

Counts are exchanged in packs. A task turns some megabytes of text into a pack:
the distinct words and word pairs with their counts, sorted by hash and cut into
slices of the hash range. All packs' entries of a slice meet in one task, are
added up, and the sums go back to their packs. A frequent pair thus costs one
entry per pack, the number of slices grows with the corpus, and no task or
driver sees all counts. A slice row holds one entry at least, so there are
never more rows than entries.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from ..session import settle
from .common import Run, col, remainder, table
from .tokens import encode, pieces, segment_sum

#: Bytes of text in a pack (a task holds one at a time), and in a slice.
PACK_BYTES = 4 << 20
SLICE_BYTES = 12 << 20
#: Remainder of the training documents on which the weights are learned.
WEIGHT_PART = 1
BUCKETS = 48
EM_STEPS = 25
EM_STOP = 1e-4
PRIOR = 0.1
_SEED = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


# ---- blobs --------------------------------------------------------------------------------------------


def pack_counts(counts: np.ndarray) -> bytes:
    """Non-negative counts, most of them small: a byte each, larger ones behind them."""
    small = zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1)
    return len(small).to_bytes(8, "little") + small + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(blob[:8], "little")
    counts = np.frombuffer(zlib.decompress(blob[8:end]), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob[end:], "<i8")
    return counts


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as their differences, of each as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    first, steps = int(steps[0]) if len(steps) else 0, steps[1:]
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width])
    return bytes([width]) + len(keys).to_bytes(8, "little") + first.to_bytes(8, "little") + body.tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    width, n, first = blob[0], int.from_bytes(blob[1:9], "little"), int.from_bytes(blob[9:17], "little")
    if not n:
        return np.zeros(0, np.uint64)
    wide = np.zeros((n - 1, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob[17:], np.uint8).reshape(n - 1, width)
    return np.cumsum(np.concatenate(([np.uint64(first)], wide.reshape(-1).view("<u8"))), dtype=np.uint64)


# ---- packs ------------------------------------------------------------------------------------------------


class Pack:
    """Texts as numbers: tokens of text i are ``tokens[offsets[i]:offsets[i + 1]]``, the last one is the end.

    ``hashes`` has those of the words, of the end and of the start. ``parts``
    tells of every text 0 held out, 1 learned from, 2 learned from and used for
    the weights.
    """

    def __init__(self, offsets: np.ndarray, tokens: np.ndarray, hashes: np.ndarray, parts: np.ndarray):
        self.offsets, self.tokens, self.hashes, self.parts = offsets, tokens, hashes, parts
        start = len(hashes) - 1
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[offsets[:-1]] = start
        before *= len(hashes)
        before += tokens
        self.pairs, self.pair_of = np.unique(before, return_inverse=True)
        self.pair_of = self.pair_of.astype(np.int32)
        self.first, self.second = self.pairs // len(hashes), self.pairs % len(hashes)

    @classmethod
    def of_texts(cls, texts, remainders: np.ndarray) -> Pack:
        offsets, codes, vocabulary = encode(texts)
        n = len(offsets) - 1
        own = np.repeat(np.arange(n), np.diff(offsets))
        tokens = np.full(len(codes) + n, len(vocabulary), np.int64)
        tokens[np.arange(len(codes)) + own] = codes
        digest = xxhash.xxh64_intdigest
        # no word holds a blank: these two stand for the end and the start
        hashes = np.array([digest(w, _SEED) for w in [*vocabulary, " ", "  "]], np.uint64)
        parts = np.where(remainders == 0, 0, np.where(remainders == WEIGHT_PART, 2, 1))
        return cls(offsets + np.arange(n + 1), tokens, hashes, parts)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of all entries (tokens: even; start and pairs: odd), and the entry of each: tokens, start, pairs."""
        single = self.hashes & ~_ONE
        single[-1] |= _ONE
        a, b = self.hashes[self.first], self.hashes[self.second]
        x = (a * _MIX + b) * np.uint64(0xD6E8FEB86659FD93)
        double = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | _ONE
        keys = np.concatenate([single, double])
        order = np.argsort(keys, kind="stable")
        return keys[order], order

    def counts(self, part: int) -> np.ndarray:
        """How often every entry occurs in the texts of at least this part."""
        chosen = self.parts >= part
        weight = np.repeat(chosen, np.diff(self.offsets)).astype(float)
        single = np.bincount(self.tokens, weight, len(self.hashes))
        single[-1] = chosen.sum()
        return np.concatenate([single, np.bincount(self.pair_of, weight, len(self.pairs))]).astype(np.int64)


def _packs(batches) -> Iterator[tuple]:
    """(pack id, ids, pack) of the texts of a task; batches have id, remainder, text."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for start, end in pieces(batch.column(2), PACK_BYTES):
            part = batch.slice(start, end - start)
            yield number, part.column(0), Pack.of_texts(part.column(2), part.column(1).to_numpy(zero_copy_only=False))
            number += 1


def _requests(docs: DataFrame, slices: int) -> DataFrame:
    """Rows ``slice, pack, keys, train, weight``: entries of a pack that fall into a slice, with their counts."""
    shift = np.uint64(64 - (slices.bit_length() - 1))

    def run(batches):
        import pyarrow as pa

        for number, _, pack in _packs(batches):
            keys, order = pack.keys()
            train, weight = pack.counts(1)[order], pack.counts(2)[order]
            of = (keys >> shift).astype(np.int64) if slices > 1 else np.zeros(len(keys), np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(keys)]
            spans = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(of[a]) for a, _ in spans], pa.int64()),
                    pa.array([number] * len(spans), pa.int64()),
                    *[pa.array([f(x[a:b]) for a, b in spans], pa.binary()) for f, x in ((pack_keys, keys), (pack_counts, train), (pack_counts, weight))],
                ],
                names=["slice", "pack", "keys", "train", "weight"],
            )

    return docs.mapInArrow(run, "slice long, pack long, keys binary, train binary, weight binary")


_REPLY = "slice long, pack long, train binary, weight binary, vocabulary long, n_train long, n_weight long"


def _added(rows):
    """Sums over all packs, for the entries of every pack; one more row has what the slice adds to the totals."""
    import pyarrow as pa

    names = ["slice", "pack", "train", "weight", "vocabulary", "n_train", "n_weight"]
    keys = [unpack_keys(x.as_py()) for x in rows["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for name in ("train", "weight"):
        parts = np.concatenate([unpack_counts(x.as_py()) for x in rows[name]])
        sums.append(np.bincount(place, parts, len(distinct)).astype(np.int64))
    token = distinct & _ONE == 0
    spans = list(zip([0, *ends[:-1].tolist()], ends.tolist()))
    back = [[pack_counts(s[place[a:b]]) for a, b in spans] for s in sums]
    totals = [int((token & (sums[0] > 0)).sum()), int(sums[0][token].sum()), int(sums[1][token].sum())]
    n = len(spans)
    columns = [
        pa.array([*rows["slice"].to_pylist(), rows["slice"][0].as_py()], pa.int64()),
        pa.array([*rows["pack"].to_pylist(), -1], pa.int64()),
        *[pa.array([*b, None], pa.binary()) for b in back],
        *[pa.array([None] * n + [t], pa.int64()) for t in totals],
    ]
    return pa.table(columns, names=names)


# ---- packs with their sums ------------------------------------------------------------------------------------


def _stored_schema(docs: DataFrame) -> StructType:
    blobs = [StructField(n, BinaryType()) for n in ("parts", "lengths", "tokens", "hashes", "train", "weight")]
    return StructType([StructField("pack", LongType()), StructField("ids", ArrayType(docs.schema["id"].dataType)), *blobs])


def _stored_packs(docs: DataFrame) -> DataFrame:
    """The packs themselves, without sums."""
    schema = _stored_schema(docs)

    def run(batches):
        import pyarrow as pa

        for number, ids, pack in _packs(batches):
            blobs = [
                pack.parts.astype(np.uint8).tobytes(),
                np.diff(pack.offsets).astype("<i8").tobytes(),
                zlib.compress(pack.tokens.astype("<i4").tobytes(), 1),
                pack.hashes.astype("<u8").tobytes(),
            ]
            offsets = pa.array([0, len(ids)], pa.int32())
            columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(offsets, ids), *[pa.array([b], pa.binary()) for b in blobs]]
            none = pa.array([None], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, none, none], names=schema.names)

    return docs.mapInArrow(run, schema)


def _restored(row) -> Pack:
    """The pack of a stored row, given as a function from a column's name to its value."""
    lengths = np.frombuffer(row("lengths"), "<i8")
    tokens = np.frombuffer(zlib.decompress(row("tokens")), "<i4").astype(np.int64)
    return Pack(
        np.concatenate(([0], np.cumsum(lengths))),
        tokens,
        np.frombuffer(row("hashes"), "<u8").astype(np.uint64),
        np.frombuffer(row("parts"), np.uint8).astype(np.int64),
    )


def _answered(packs, replies):
    """A pack with the sums of its entries, in the pack's order: tokens, start, pairs."""
    import pyarrow as pa

    if packs.num_rows == 0:
        return packs
    if packs.num_rows != 1:
        raise ValueError("two packs have one number")
    pack = _restored(lambda name: packs[name][0].as_py())
    _, order = pack.keys()
    by_slice = replies.sort_by("slice")
    columns = []
    for name in ("train", "weight"):
        parts = [unpack_counts(x.as_py()) for x in by_slice[name]]
        got = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if len(got) != len(order):
            raise ValueError("the sums are not those of this pack: its texts were dealt otherwise when they were counted")
        sums = np.empty_like(got)
        sums[order] = got
        columns.append(pa.array([pack_counts(sums)], pa.binary()))
    kept = [packs[n].combine_chunks() for n in packs.column_names[:-2]]
    return pa.table([*kept, *columns], names=packs.column_names)


def _seen(pack: Pack, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every distinct pair: sums of its context, of itself, and of its second token."""
    n = len(pack.hashes)
    return sums[pack.first], sums[n:], sums[pack.second]


def bucket_of(contexts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the whole part of log2 of how often it was seen."""
    return np.minimum(np.where(contexts > 0, np.frexp(np.maximum(contexts, 1))[1], 0), BUCKETS - 1)


def _weight_counts(stored: DataFrame) -> DataFrame:
    """Rows ``bucket, context, pair, token, n``: counts of the rest, and how often the weight part has them, per pack."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                row = lambda name, at=at: batch.column(name)[at].as_py()
                pack = _restored(row)
                if not (pack.parts == 2).any():
                    continue
                own = pack.counts(2)[len(pack.hashes) :]
                rest = unpack_counts(row("train")) - unpack_counts(row("weight"))
                context, pair, token = (x[own > 0] for x in _seen(pack, rest))
                found = np.stack([bucket_of(context), context, pair, token])
                distinct, place = np.unique(found, axis=1, return_inverse=True)
                times = np.bincount(place.reshape(-1), own[own > 0], distinct.shape[1]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x, pa.int64()) for x in distinct], pa.array(times)], names=["bucket", "context", "pair", "token", "n"]
                )

    return stored.mapInArrow(run, "bucket long, context long, pair long, token long, n long")


def learn_weights(counts: DataFrame, tokens: int, vocabulary: int, steps: int = EM_STEPS) -> np.ndarray:
    """Mixture weights (pair, token, uniform) per bucket, by expectation-maximisation on ``bucket, context, pair, token, n``.

    ``tokens`` is the size of the rest. A step is one aggregation of the table
    to a row per bucket. Buckets that hold nothing take the weights of the next
    lower one; a small prior keeps every weight above zero.
    """
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    p2 = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    p1 = F.col("token") / F.lit(float(max(tokens, 1)))
    known = counts.select("bucket", p2.alias("p2"), p1.alias("p1"), "n")
    p0 = 1.0 / (vocabulary + 1)
    for _ in range(steps):
        table_ = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in weights])
        at = F.get(table_, F.col("bucket").cast("int"))
        mixed = known.select(
            "bucket", "n", (at[0] * F.col("p2")).alias("a"), (at[1] * F.col("p1")).alias("b"), (at[2] * F.lit(p0)).alias("c")
        ).withColumn("s", F.col("a") + F.col("b") + F.col("c"))
        share = [F.sum(F.col("n") * F.col(x) / F.col("s")).alias(x) for x in "abc"]
        new = weights.copy()
        filled = {r["bucket"]: np.array([r["a"], r["b"], r["c"]]) for r in mixed.groupBy("bucket").agg(*share).collect()}
        for bucket in range(BUCKETS):
            if bucket in filled:
                prior = np.array([0.0, PRIOR, PRIOR]) if bucket == 0 else np.full(3, PRIOR)
                new[bucket] = (filled[bucket] + prior) / (filled[bucket].sum() + prior.sum())
            elif bucket > 1:
                new[bucket] = new[bucket - 1]
        moved = np.abs(new - weights).max()
        weights = new
        if moved < EM_STOP:
            break
    return weights


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = 10, held_out: int = 0
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents with ``crc32(id as text) % divisor == held_out`` are scored but
    give no count. A text is its words in lower case (A-Z) and one end; null and
    empty texts are an end alone. base_score is the unigram score with 0.1
    added to every count, score the log10 probability under the interpolated
    model. Repeated rows count and are scored each. Other columns are ignored.
    """
    part = (remainder(col(id_col), divisor) + (divisor - held_out)) % divisor  # held-out documents have 0
    read = docs.select(col(id_col).alias("id"), part.cast("int").alias("part"), col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(col(text_col)))).first()[0] or 0
    slices = 1 << max(3, (size // SLICE_BYTES).bit_length())
    replies = settle(_requests(read, slices).groupBy("slice").applyInArrow(_added, _REPLY), "sums")
    totals = replies.where("pack = -1").agg(F.sum("vocabulary"), F.sum("n_train"), F.sum("n_weight")).first()
    vocabulary, n_train, n_weight = (int(x or 0) for x in totals)

    packs = _stored_packs(read)
    answers = replies.where("pack >= 0").select("slice", "pack", "train", "weight")
    joined = packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_answered, packs.schema)
    stored = settle(joined, "packs")
    weights = learn_weights(settle(_weight_counts(stored), "weight-counts"), n_train - n_weight, vocabulary)

    schema = StructType(
        [docs.schema[id_col]]
        + [StructField("part", LongType()), StructField("n_tokens", LongType()), StructField("n_known", LongType())]
        + [StructField("base_score", DoubleType()), StructField("score", DoubleType())]
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                row = lambda name, at=at: batch.column(name)[at].as_py()
                pack, sums = _restored(row), unpack_counts(row("train"))
                context, pair, token = _seen(pack, sums)
                mix = weights[bucket_of(context)]
                p = mix[:, 0] * (pair / np.maximum(context, 1)) + mix[:, 1] * (token / max(n_train, 1)) + mix[:, 2] / (vocabulary + 1)
                own = sums[: len(pack.hashes)]
                base = np.log10((own + 0.1) / (n_train + 0.1 * (vocabulary + 1)))
                ids = batch.column("ids").slice(at, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(pack.parts, pa.int64()),
                        pa.array(np.diff(pack.offsets), pa.int64()),
                        pa.array(segment_sum((own > 0).astype(np.int64)[pack.tokens], pack.offsets)),
                        pa.array(segment_sum(base[pack.tokens], pack.offsets)),
                        pa.array(segment_sum(np.log10(p)[pack.pair_of], pack.offsets)),
                    ],
                    names=schema.names,
                )

    return stored.mapInArrow(run, schema).select(
        col(id_col),
        (F.col("part") == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4(spark, folder):
    return score(table(spark, folder, "documents"))


QUERIES: dict[str, Run] = {"op4_language_model": op4}
SQL: dict[str, str] = {}
