"""Words of a batch of texts as numbers, with Arrow and numpy."""

from __future__ import annotations

import numpy as np


def encoded(texts, lower: bool = True):
    """(offsets, codes, vocabulary): words ``codes[offsets[i]:offsets[i + 1]]`` of text i, the vocabulary as an Arrow array.

    ``texts`` is an Arrow string array; a null text has no word. Words are runs
    without ASCII white space; ``lower`` puts A-Z in lower case first.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    # a copy, as Arrow casts and fills slices of string arrays wrongly
    texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not real.all():  # white space at an end gives an empty word
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def encode(texts, lower: bool = True):
    """As ``encoded``, the vocabulary as a list."""
    offsets, codes, vocabulary = encoded(texts, lower)
    return offsets, codes, vocabulary.to_pylist()


def characters(words):
    """(offsets, points): code points ``points[offsets[i]:offsets[i + 1]]`` of word i of an Arrow array without nulls."""
    import pyarrow as pa
    import pyarrow.compute as pc

    offsets = np.concatenate(([0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.scalar("", words.type))[0].as_py()
    return offsets, np.frombuffer(whole.encode("utf-32-le"), np.uint32)


def from_characters(offsets: np.ndarray, points: np.ndarray):
    """The words that ``characters`` took apart, as an Arrow array of large strings."""
    import pyarrow as pa

    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    ends = np.concatenate(([0], np.cumsum(sizes)))[offsets]
    data = points.tobytes().decode("utf-32-le").encode()
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends), pa.py_buffer(data))


def pieces(batch_texts, limit: int = 1 << 22):
    """Ranges (start, end) of consecutive texts of about ``limit`` bytes, one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch_texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def segment_max(values: np.ndarray, offsets: np.ndarray, empty: float) -> np.ndarray:
    """Largest value of every segment."""
    out = np.full(len(offsets) - 1, empty)
    some = offsets[:-1] < offsets[1:]
    if some.any():
        out[some] = np.maximum.reduceat(values, offsets[:-1][some])
    return out


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of every segment."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    some = offsets[:-1] < offsets[1:]
    if some.any():
        out[some] = np.add.reduceat(values, offsets[:-1][some])
    return out
