"""Quality classifier: Naive Bayes support vectors on hashed n-grams.

The features of a text are indicators: which word unigrams and bigrams it has,
and which unigrams and bigrams of word shapes (``The`` is ``Aa``, ``OF!!`` is
``A!``, a word that repeats the one before is marked). Each indicator is scaled
by its class log-count ratio; a linear model with hinge loss is fitted on the
scaled, length-normalised vectors by dual coordinate descent.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Run, col, free_name, remainder, table
from .labelled import logistic, sigmoid, training_rows
from .tokens import encode, pieces, segment_sum

FEATURES = 1 << 18
#: Documents the classifier is fitted on at most; it is fitted in the driver.
MAX_ROWS = 6_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
_MEMO = 100_000
_SHAPES = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "Aa" if m[0][0].isupper() else "a"),)
_RUNS = re.compile(r"(.)\1+", re.S)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """Letters as their case, digits as 0, equal signs in a row as one."""
    for pattern, how in _SHAPES:
        word = pattern.sub(how, word)
    return _RUNS.sub(r"\1", re.sub(r"\d+", "0", word))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes, order included."""
    x = (a * _MIX + b) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def indicators(texts, memo: dict, size: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, features): the sorted, distinct features of every text of an Arrow string array."""
    offsets, codes, vocabulary = encode(texts, lower=False)
    if len(memo) > _MEMO:
        memo.clear()
    known = []
    for word in vocabulary:
        got = memo.get(word)
        if got is None:
            form = shape(word)
            got = memo[word] = (xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(form, 2), xxhash.xxh64_intdigest("=" + form, 2))
        known.append(got)
    table = np.array(known, np.uint64).reshape(-1, 3)
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    word = table[codes, 0]
    inside = text[1:] == text[:-1]
    same = np.concatenate(([False], inside & (codes[1:] == codes[:-1]))) if len(codes) else np.zeros(0, bool)
    form = np.where(same, table[codes, 2], table[codes, 1])
    pairs = [_mixed(x[:-1], x[1:])[inside] for x in (word, form)]
    hashes = np.concatenate([word, form, *pairs]) % np.uint64(size)
    owner = np.concatenate([text, text, text[1:][inside], text[1:][inside]])
    both = np.unique(owner.astype(np.uint64) * np.uint64(size) + hashes)
    owner, features = both // np.uint64(size), (both % np.uint64(size)).astype(np.int64)
    return np.searchsorted(owner, np.arange(n + 1).astype(np.uint64)), features


# ---- model -----------------------------------------------------------------------------------------


def log_count_ratio(offsets: np.ndarray, features: np.ndarray, y: np.ndarray, size: int, smoothing: float = SMOOTHING) -> np.ndarray:
    """log of the smoothed share of an indicator among those of class 1, over that among those of class 0."""
    of = np.repeat(y, np.diff(offsets))
    up = np.bincount(features[of == 1], minlength=size) + smoothing
    down = np.bincount(features[of == 0], minlength=size) + smoothing
    return np.log(up / up.sum()) - np.log(down / down.sum())


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS, seed: int = 0
) -> np.ndarray:
    """Weights (the last is the bias) that minimise |w|²/2 + cost · Σ max(0, 1 - y w·x); y is -1 or 1, rows are (places, values).

    One dual variable per row is set to its best value in turn, in an order
    drawn from the seed, until no projected gradient exceeds 0.001.
    """
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            at, values = rows[i]
            gradient = y[i] * (w[at] @ values + w[-1]) - 1
            projected = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= cost else gradient
            if abs(projected) > 1e-12:
                worst = max(worst, abs(projected))
                old = alpha[i]
                alpha[i] = min(max(old - gradient / norm[i], 0.0), cost)
                step = (alpha[i] - old) * y[i]
                w[at] += step * values
                w[-1] += step
        if worst < 1e-3:
            break
    return w


def _scaled(offsets: np.ndarray, features: np.ndarray, ratio: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of scaled indicators, each of length 1."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        at = features[a:b]
        values = ratio[at]
        length = np.sqrt(values @ values)
        out.append((at, values / length if length > 0 else values))
    return out


class QualityModel(NamedTuple):
    """Log-count ratios, weights of the scaled indicators, bias, and the logistic curve over the margin."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    offset: float
    slope: float

    def margins(self, offsets: np.ndarray, features: np.ndarray) -> np.ndarray:
        ratio = self.ratio[features]
        length = np.sqrt(segment_sum(ratio * ratio, offsets))
        return segment_sum(ratio * self.weights[features], offsets) / np.where(length > 0, length, 1.0) + self.bias

    def score(self, docs: DataFrame, keep: list[str], name: str, text_col: str = "text") -> DataFrame:
        """The columns to keep and the score, from 0 to 1 (good). Null and empty texts have no indicator: the bias decides."""
        ratio, weights = self.ratio.astype(np.float32), self.weights.astype(np.float32)
        model = self._replace(ratio=ratio, weights=weights)
        schema = StructType([*[docs.schema[c] for c in keep], StructField(name, DoubleType())])

        def run(batches):
            import pyarrow as pa

            memo: dict = {}
            for batch in batches:
                found = [np.zeros(0)]
                for start, end in pieces(batch.column(len(keep))):
                    margins = model.margins(*indicators(batch.column(len(keep)).slice(start, end - start), memo, len(ratio)))
                    found.append(sigmoid(model.offset + model.slope * margins.astype(float)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.concatenate(found))], names=[*keep, name])

        return docs.select(*[col(c) for c in keep], col(text_col).alias(free_name(docs, "raw_text"))).mapInArrow(run, schema)


def fit_rows(offsets: np.ndarray, features: np.ndarray, y: np.ndarray, size: int = FEATURES) -> QualityModel:
    """Fit on rows in memory. The logistic curve is fitted on margins of models that have not seen the row (two halves)."""

    def linear(chosen: np.ndarray):
        lengths = np.diff(offsets)[chosen]
        own = np.concatenate(([0], np.cumsum(lengths)))
        parts = [features[offsets[i] : offsets[i + 1]] for i in chosen]
        listed = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        ratio = log_count_ratio(own, listed, y[chosen], size)
        w = dual_coordinate_descent(_scaled(own, listed, ratio), np.where(y[chosen] > 0, 1.0, -1.0), size)
        return QualityModel(ratio, w[:-1], float(w[-1]), 0.0, 1.0)

    everything = np.arange(len(y))
    margins = np.zeros(len(y))
    for half in (0, 1):
        unseen = everything % 2 == half
        margins[unseen] = linear(everything[~unseen]).margins(offsets, features)[unseen]
    offset, slope = logistic(margins, y)
    return linear(everything)._replace(offset=offset, slope=slope)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = 4,
    held_out: int = 2,
    max_rows: int = MAX_ROWS,
    size: int = FEATURES,
) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents; ids with ``crc32(id as text) % divisor == held_out`` are never among them.

    Their indicators are made on the executors; what reaches the driver is
    bounded by the number of rows and of features. Without labelled rows every
    score is one half.
    """
    rows = training_rows(docs, labels, label, divisor, held_out, max_rows, id_col, text_col)

    def run(batches):
        import pyarrow as pa

        memo: dict = {}
        for batch in batches:
            for start, end in pieces(batch.column(1)):
                offsets, features = indicators(batch.column(1).slice(start, end - start), memo, size)
                packed = [features[a:b].astype(np.int32).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(packed, pa.binary())], names=["label", "features"]
                )

    got = sorted(((r["label"], bytes(r["features"])) for r in rows.mapInArrow(run, "label int, features binary").collect()))
    # dealt out by content, so that the order of tasks and the labels do not matter for the halves
    got.sort(key=lambda r: xxhash.xxh64_intdigest(r[1]))
    lists = [np.frombuffer(f, np.int32) for _, f in got]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    features = np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int64)
    return fit_rows(offsets, features, np.array([label for label, _ in got], float), size)


def op10(spark, folder):
    docs = table(spark, folder, "documents")
    scored = fit(docs, table(spark, folder, "labels")).score(docs, ["doc_id"], "score")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Run] = {"op10_quality_classifier": op10}
SQL: dict[str, str] = {}
