"""Toxicity: a noisy channel restores disguised words, then the restored text is scored.

A word that may be disguised (letters written as digits or signs, letters
repeated, letters parted by blanks or signs) becomes a lattice of characters.
Viterbi's algorithm finds the path that is likeliest under a character trigram
model of the corpus and the costs of the disguises. The score of a document
comes from its strongest restored word or word beginning, as counted in
labelled documents.
"""

from __future__ import annotations

import re
from math import log
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import BLANKS, Run, col, free_name, remainder, sent, table, tidy
from .labelled import logistic, training_rows
from .tokens import characters, encoded, from_characters, pieces, segment_max

#: Symbols of the character model: word end, any other character, a-z, and the small letters of Latin-1.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
_K = len(ALPHABET) + 2
_CODE = {c: i + 2 for i, c in enumerate(ALPHABET)}
#: Letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Log costs of the channel.
SIGN_FOR_LETTER = log(0.25)
SIGN_KEPT = log(0.05)
LETTER_DOUBLED = log(0.8)
LETTER_DROPPED = log(0.2)
SEPARATOR = log(0.3)
#: In a run of single characters: a blank that parts the letters of a word, and one between words.
BLANK_INSIDE = log(0.8)
BLANK_KEPT = log(0.2)
#: Signs that may also be mere punctuation.
_MARKS = "!|(¡+"
MARK_DROPPED = log(0.02)
_SEPARATORS = ".-_*~'’·"
_EDGES = ".,;:?!\"'()[]{}<>*%&#~`-_|=/\\“”„«»¿¡…"
_LEFT = "".join(c for c in _EDGES if c not in LEET)
_TWICE = re.compile(r"(.)\1")
_LETTER = re.compile(r"[^\W\d_]")
_DISGUISE = re.compile("[" + re.escape("".join(LEET) + _SEPARATORS) + "]")
#: Word beginnings that count beside whole words.
PREFIXES = (4, 5)
#: Toxic documents that must hold a word before it counts, as a number and as a share of those learned from.
MIN_DOCS = 3
MIN_SHARE = 0.01
MAX_ROWS = 20_000
MAX_FEATURES = 65_536
_MEMO = 50_000
#: Bytes of text whose words are looked at together, and those whose characters are.
_BYTES_AT_ONCE = 1 << 20
_BYTES_COUNTED = 1 << 18
#: Runs of equal characters in a word, up to which it is restored together with others.
_LONG = 64


# ---- character model -------------------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    """Model symbols of the characters below 0x100; the last entry is any other character's too."""
    out = np.ones(0x101, np.int32)
    for c, i in _CODE.items():
        out[ord(c)] = i
    return out


_SYMBOLS = _symbol_table()
_CASELESS = _SYMBOLS.copy()
_CASELESS[ord("A") : ord("Z") + 1] = _SYMBOLS[ord("a") : ord("z") + 1]
_CASELESS[[ord(c) for c in BLANKS]] = 0


def _triples(text: str) -> np.ndarray:
    """Symbol triples of the words of a text, A-Z in lower case, each word between two word ends."""
    points = np.frombuffer(("\n" + text + "\n").encode("utf-32-le"), np.uint32)
    symbols = _CASELESS[np.minimum(points, 0x100)]
    symbols = symbols[np.concatenate(([True], (symbols[1:] != 0) | (symbols[:-1] != 0)))]  # one blank of a run
    last, this = symbols[:-1], symbols[1:]
    before = np.concatenate(([0], symbols[:-2])) * (last != 0)  # before a word there are two word ends
    return (before * _K + last) * _K + this


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of symbol triples over all words of all documents, each word between two word ends.

    A task sends at most one row for every triple of the fixed alphabet, and so
    many rows at most reach the driver, however large the corpus.
    """

    def run(batches):
        import pyarrow as pa

        total = np.zeros(_K**3, np.int64)
        for batch in batches:
            for start, end in pieces(batch.column(0), _BYTES_COUNTED):
                texts = batch.column(0).slice(start, end - start).to_pylist()
                total += np.bincount(_triples("\n".join(t for t in texts if t)), minlength=_K**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["triple", "n"])

    rows = docs.select(col(text_col).alias("text")).mapInArrow(tidy(run), "triple long, n long")
    counts = np.zeros(_K**3)
    for r in rows.groupBy("triple").agg(F.sum("n").alias("n")).collect():
        counts[r["triple"]] = r["n"]
    return counts


def character_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Log probabilities of a symbol after two others, each order smoothed by the one below."""
    three = counts.reshape(_K, _K, _K)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + _K)
    p2 = (two + weight * p1) / (two.sum(axis=1, keepdims=True) + weight)
    p3 = (three + weight * p2) / (three.sum(axis=2, keepdims=True) + weight)
    return np.log(p3).reshape(-1)


# ---- lattice and Viterbi -----------------------------------------------------------------------


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Alternatives (text, log cost) for every run of equal characters of a word."""
    out = []
    at = 0
    while at < len(word):
        end = at + 1
        while end < len(word) and word[end] == word[at]:
            end += 1
        c, times = word[at], end - at
        if c in LEET:
            letters = [(x * n, SIGN_FOR_LETTER + (LETTER_DROPPED if n < times else 0.0)) for x in LEET[c] for n in {1, min(times, 2)}]
            mark = [("", MARK_DROPPED)] if c in _MARKS else []
            out.append([(c * times, SIGN_KEPT * times), *letters, *mark])
        elif c in _SEPARATORS:
            out.append([("", SEPARATOR), (c * times, SEPARATOR)])
        elif times > 1:
            out.append([(c * 2, LETTER_DOUBLED if times == 2 else LETTER_DROPPED), (c, LETTER_DROPPED)])
        else:
            out.append([(c, 0.0)])
        at = end
    return out


def viterbi(units: list[list[tuple[str, float]]], model: list[float]) -> str:
    """The likeliest text through the lattice; of equal paths the first alternative wins. NUL is a word end."""
    code = _CODE
    states = {(0, 0): (0.0, "")}
    for unit in units:
        reached: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (p, text) in states.items():
            for option, cost in unit:
                x, y, q = a, b, p + cost
                for c in option:
                    z = 0 if c == "\0" else code.get(c, 1)
                    q += model[(x * _K + y) * _K + z]
                    x, y = (0, 0) if z == 0 else (y, z)
                best = reached.get((x, y))
                if best is None or q > best[0]:
                    reached[(x, y)] = (q, text + option)
        states = reached
    ends = [(p + (0.0 if b == 0 else model[(a * _K + b) * _K]), -i, text) for i, ((a, b), (p, text)) in enumerate(states.items())]
    return max(ends)[2] if ends else ""


def restore(word: str, model: list[float]) -> str:
    """A lower-case word without signs at its edges, disguises undone where the model finds that likelier."""
    core = word.rstrip(_EDGES).lstrip(_LEFT)
    if not _LETTER.search(core):
        return core
    if _TWICE.search(core) or _DISGUISE.search(core):
        return viterbi(lattice(core), model)
    return core


def restore_spaced(letters: list[str], model: list[float]) -> list[str]:
    """Words of a run of single characters, in which every blank may be a word's end or a disguise."""
    units: list[list[tuple[str, float]]] = []
    for i, c in enumerate(letters):
        if i:
            units.append([("", BLANK_INSIDE), ("\0", BLANK_KEPT)])
        units.extend(lattice(c))
    return [w for w in viterbi(units, model).split("\0") if w]


def features(word: str) -> list[str]:
    """A restored word as a whole, and its beginnings."""
    return ["=" + word, *[word[:n] for n in PREFIXES if len(word) >= n]]


def feature_arrays(words) -> list:
    """The features of an Arrow array of restored words: an array of each kind, null where a word is too short for it."""
    import pyarrow as pa
    import pyarrow.compute as pc

    none = pa.scalar(None, words.type)
    sizes = pc.utf8_length(words)
    beginnings = [pc.if_else(pc.greater_equal(sizes, n), pc.utf8_slice_codeunits(words, 0, n), none) for n in PREFIXES]
    return [pc.binary_join_element_wise(pa.scalar("=", words.type), words, pa.scalar("", words.type)), *beginnings]


def _doubled(symbols: np.ndarray, times: np.ndarray, starts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Which runs of equal letters the likeliest path doubles, of words that hold no sign; the others it writes once.

    Word i has the runs ``starts[i]:starts[i + 1]``, with their symbols and
    lengths. As ``viterbi`` does, but run by run for all words: behind a run
    only two contexts can be, the letter twice or the letter after the run before.
    Sums are taken in the same order and equal paths decided alike.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    base, sizes = starts[:-1][order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
    cost = np.where(times == 1, 0.0, LETTER_DROPPED)
    cost_doubled = np.where(times == 2, LETTER_DOUBLED, LETTER_DROPPED)
    # paths that end in a doubled letter and those that do not, and their last two symbols if they do not
    twice, once = np.full(len(base), -np.inf), np.zeros(len(base))
    before, last = np.zeros(len(base), np.int64), np.zeros(len(base), np.int64)
    # whether a path came from one that did not end in a doubled letter, by how it ends; and whether one that merged doubles
    twice_from_once, once_from_once = np.ones(len(times), bool), np.ones(len(times), bool)
    merged_doubles = np.zeros(len(times), bool)
    for j, m in enumerate(active.tolist()):
        at = base[:m] + j
        a, b, c = before[:m], last[:m], symbols[at]
        step_twice, step_once = model[(b * _K + b) * _K + c], model[(a * _K + b) * _K + c]
        p, q = twice[:m] + cost[at] + step_twice, once[:m] + cost[at] + step_once
        run = np.flatnonzero(times[at] > 1)
        if len(run):
            again = model[(b[run] * _K + c[run]) * _K + c[run]]
            p2 = twice[run] + cost_doubled[at[run]] + step_twice[run] + again
            q2 = once[run] + cost_doubled[at[run]] + step_once[run] + again
        other = q > p
        best = np.where(other, q, p)
        once_from_once[at] = other
        twice[:m] = -np.inf
        if len(run):
            other = q2 > p2
            twice[run] = np.where(other, q2, p2)
            twice_from_once[at[run]] = other
            # a letter without a symbol of its own after another such: both contexts are one
            same = np.flatnonzero(b[run] == c[run])
            if len(same):
                rows = run[same]
                paths = np.stack([p2[same], p[rows], q2[same], q[rows]])
                first = paths.argmax(axis=0)
                best[rows], twice[rows] = paths.max(axis=0), -np.inf
                once_from_once[at[rows]], merged_doubles[at[rows]] = first >= 2, first % 2 == 0
        once[:m] = best
        before[:m], last[:m] = b.copy(), c
    ends_twice = twice + model[(last * _K + last) * _K] >= once + model[(before * _K + last) * _K]
    out = np.zeros(len(times), bool)
    for j in range(len(active) - 1, -1, -1):
        m = active[j]
        at, now = base[:m] + j, ends_twice[:m]
        out[at] = now | merged_doubles[at]
        ends_twice[:m] = ~np.where(now, twice_from_once[at], once_from_once[at])
    return out


class _Words:
    """Restores words, those without signs all together; the others one by one, remembered within a task up to a bound."""

    def __init__(self, model: np.ndarray):
        self.model, self.listed, self.memo = model, model.tolist(), {}
        self.kinds = np.zeros(0x110000, np.uint8)  # 1: looked up, 2: letter, 4: has alternatives or ends a word

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        new = points[self.kinds[points] == 0]
        for point in np.unique(new).tolist():
            c = chr(point)
            self.kinds[point] = 1 + 2 * bool(_LETTER.match(c)) + 4 * bool(_DISGUISE.match(c) or c == "\0")
        return self.kinds[points]

    def __call__(self, vocabulary):
        """Arrow array of what ``restore`` gives for every word of an Arrow array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        cores = pc.utf8_ltrim(pc.utf8_rtrim(vocabulary, characters=_EDGES), characters=_LEFT)
        offsets, points = characters(cores)
        kinds = self._kinds(points)

        def holds(marks):
            sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
            return np.diff(sums[offsets])

        begins = np.ones(len(points), bool)
        begins[1:] = points[1:] != points[:-1]
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        runs = holds(begins)
        lettered, sizes = holds(kinds & 2) > 0, np.diff(offsets)
        repeated = runs < sizes
        alone = lettered & ((holds(kinds & 4) > 0) | (repeated & (runs > _LONG)))
        together = lettered & repeated & ~alone

        # every run of the words that are restored together
        at = np.flatnonzero(begins & np.repeat(together, sizes))
        run_starts = np.concatenate(([0], np.cumsum(runs[together])))
        times = np.diff(np.flatnonzero(np.concatenate((begins, [True]))))[np.repeat(together, runs)]
        symbols = _SYMBOLS[np.minimum(points[at], 0x100)].astype(np.int64)
        doubled = _doubled(symbols, times, run_starts, self.model)
        left = 1 + (doubled & (times > 1))
        keep = np.ones(len(points), bool)
        many = np.flatnonzero(times > left)
        drop = times[many] - left[many]
        first = np.repeat(at[many] + left[many] - np.concatenate(([0], np.cumsum(drop)[:-1])), drop) if len(many) else at[:0]
        keep[first + np.arange(len(first))] = False
        kept = np.concatenate(([0], np.cumsum(keep)))[offsets]
        out = from_characters(kept, points[keep])

        single = np.flatnonzero(alone)
        if not len(single):
            return out
        found = []
        for core in cores.take(pa.array(single)).to_pylist():
            word = self.memo.get(core)
            if word is None:
                if len(self.memo) >= _MEMO:
                    self.memo.clear()
                word = self.memo[core] = restore(core, self.listed)
            found.append(word)
        place = np.arange(len(out))
        place[single] = len(out) + np.arange(len(single))
        return pa.concat_arrays([out, pa.array(found, pa.large_string())]).take(pa.array(place))

    def spaced(self, offsets: np.ndarray, codes: np.ndarray, vocabulary) -> list[tuple[int, list[str]]]:
        """(text, restored words) of every run of three or more single characters inside a text."""
        return [(text, restore_spaced(letters, self.listed)) for text, letters in _spaced(offsets, codes, vocabulary)]


def _spaced(offsets: np.ndarray, codes: np.ndarray, vocabulary):
    """(text, characters) of every run of three or more single characters inside a text; the vocabulary is an Arrow array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    short = np.flatnonzero(pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False) == 1)
    letters = {c: w for c, w in zip(short.tolist(), vocabulary.take(pa.array(short)).to_pylist()) if w in LEET or _LETTER.match(w)}
    single = np.zeros(len(vocabulary), bool)
    single[list(letters)] = True
    marked = np.concatenate(([False], single[codes], [False]))
    edges = np.flatnonzero(marked[1:] != marked[:-1])
    bounds = set(offsets.tolist())
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start < 3:
            continue
        # a run ends where a text ends
        cuts = [start, *(x for x in range(start + 1, end) if x in bounds), end] if bounds else [start, end]
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= 3:
                yield int(np.searchsorted(offsets, a, "right") - 1), [letters[c] for c in codes[a:b].tolist()]


# ---- scoring -------------------------------------------------------------------------------------


class _Strengths:
    """Strengths of features, looked up for many restored words at once."""

    def __init__(self, strong: dict[str, float]):
        import pyarrow as pa

        self.strong, self.names = strong, pa.array(list(strong), pa.large_string())
        self.values = np.array([*strong.values(), 0.0])

    def __call__(self, arrays: list) -> np.ndarray:
        """The largest strength of the features of every word; unknown ones have 0."""
        import pyarrow.compute as pc

        best = None
        for features_ in arrays:
            at = pc.fill_null(pc.index_in(features_, value_set=self.names), -1).to_numpy(zero_copy_only=False)
            value = np.where(features_.is_null().to_numpy(zero_copy_only=False), -np.inf, self.values[at])
            best = value if best is None else np.maximum(best, value)
        return best

    def of(self, word: str) -> float:
        return max(self.strong.get(f, 0.0) for f in features(word))


def _counted_features(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Rows ``feature, toxic, clean``: documents of either label that hold a feature; ``label, text`` come in."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        words = _Words(model)
        for batch in batches:
            for start, end in pieces(batch.column(1), _BYTES_AT_ONCE):
                offsets, codes, vocabulary = encoded(batch.column(1).slice(start, end - start))
                arrays = feature_arrays(words(vocabulary))
                extra = [(text, f) for text, found in words.spaced(offsets, codes, vocabulary) for w in found for f in features(w)]
                names = pa.concat_arrays([*arrays, pa.array([f for _, f in extra], pa.large_string())]).dictionary_encode()
                number = pc.fill_null(names.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                # every word of a text once, then every feature of a text once
                size, many = max(len(vocabulary), 1), max(len(names.dictionary), 1)
                text, word = np.divmod(np.unique(np.repeat(np.arange(end - start), np.diff(offsets)) * size + codes), size)
                held = [np.array([t for t, _ in extra], np.int64) * many + number[len(arrays) * len(vocabulary) :]]
                for i in range(len(arrays)):
                    f = number[i * len(vocabulary) + word]
                    held.append((text * many + f)[f >= 0])
                text, f = np.divmod(np.unique(np.concatenate(held)), many)
                label = batch.column(0).slice(start, end - start).to_numpy(zero_copy_only=False)
                toxic = label[text] != 0
                counts = [np.bincount(f[x], minlength=len(names.dictionary)) for x in (toxic, ~toxic)]
                yield pa.RecordBatch.from_arrays(
                    [names.dictionary.cast(pa.string()), *[pa.array(n, pa.int64()) for n in counts]], names=["feature", "toxic", "clean"]
                )

    partial = rows.select("label", "text").mapInArrow(tidy(run), "feature string, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _strength(toxic, clean, n_toxic, n_clean):
    """Log odds of a feature between toxic and clean documents."""
    return np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((clean + 0.5) / (n_clean + 1.0))


def _with_strongest(
    docs: DataFrame, text_col: str, keep: list[str], name: str, model: np.ndarray, counts: dict, totals, own: str | None = None
) -> DataFrame:
    """The columns to keep, and the largest strength of a feature of the text (0 if none is known).

    If ``own`` names a label column, the document itself is taken out of the
    counts: its words must be strong by the other documents.
    """
    n_toxic, n_clean = totals
    strong = {f: float(_strength(t, c, n_toxic, n_clean)) for f, (t, c) in counts.items()}
    without = {f: float(_strength(t - 1, c, n_toxic - 1, n_clean)) for f, (t, c) in counts.items()} if own else {}
    schema = StructType([*[docs.schema[c] for c in keep], StructField(name, DoubleType())])
    needed, place = sent(docs, keep, text_col)

    def run(batches):
        import pyarrow as pa

        words, known, others = _Words(model), _Strengths(strong), _Strengths(without)
        for batch in batches:
            found = [np.zeros(0)]
            for start, end in pieces(batch.column(place), _BYTES_AT_ONCE):
                offsets, codes, vocabulary = encoded(batch.column(place).slice(start, end - start))
                arrays = feature_arrays(words(vocabulary))
                spaced = words.spaced(offsets, codes, vocabulary)

                def strongest(strengths):
                    x = segment_max(strengths(arrays)[codes], offsets, 0.0)
                    for text, restored in spaced:
                        x[text] = max([x[text], *map(strengths.of, restored)])
                    return x

                x = strongest(known)
                if own:
                    label = np.array(batch.column(keep.index(own)).slice(start, end - start).to_pylist())
                    x = np.where(label == 1, strongest(others), x)
                found.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.concatenate(found))], names=[*keep, name])

    return needed.mapInArrow(tidy(run), schema)


class Toxicity(NamedTuple):
    """Fitted model: character model, documents of either label with a feature and in all, offset and slope of the score."""

    model: np.ndarray
    counts: dict[str, tuple[int, int]]
    totals: tuple[int, int]
    offset: float
    slope: float

    def score(self, docs: DataFrame, keep: list[str], name: str, text_col: str = "text") -> DataFrame:
        """The columns to keep and the score, from 0 to 1 (toxic). Null and empty texts score as texts without a known word."""
        x = free_name(docs, "strongest")
        found = _with_strongest(docs, text_col, keep, x, self.model, self.counts, self.totals)
        z = F.lit(self.offset) + F.lit(self.slope) * F.col(x)
        bound = F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))
        return found.select(*[col(c) for c in keep], (1 / (1 + F.exp(-bound))).alias(name))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = 5,
    held_out: int = 0,
    max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES,
) -> Toxicity:
    """Learn the character model from all texts, and the score from at most ``max_rows`` labelled documents.

    Ids with ``crc32(id as text) % divisor == held_out`` give no label. At
    most ``max_features`` features are kept, the strongest; ties go by name.
    """
    model = character_model(character_counts(docs, text_col))
    rows = training_rows(docs, labels, label, divisor, held_out, max_rows, id_col, text_col)
    totals = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    n_toxic, n_clean = totals[0], totals[1]
    strength = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    kept = (
        _counted_features(rows, model)
        .where((F.col("toxic") >= max(MIN_DOCS, MIN_SHARE * n_toxic)) & (strength > 0))
        .orderBy(strength.desc(), "feature")
        .limit(max_features)
        .collect()
    )
    counts = {r["feature"]: (r["toxic"], r["clean"]) for r in kept}
    found = _with_strongest(rows, "text", ["label"], "x", model, counts, (n_toxic, n_clean), "label").collect()
    x = np.array([r["x"] for r in found])
    y = np.array([r["label"] for r in found], float)
    return Toxicity(model, counts, (n_toxic, n_clean), *logistic(x, y))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    score = free_name(docs, "toxicity")
    scored = fit(docs, labels, id_col=id_col, text_col=text_col).score(docs, docs.columns, score, text_col)
    return scored.where(F.col(score) < threshold).select(*[col(c) for c in docs.columns])


def op9(spark, folder):
    docs = table(spark, folder, "documents")
    scored = fit(docs, table(spark, folder, "labels")).score(docs, ["doc_id"], "score")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Run] = {"op9_toxicity": op9}
SQL: dict[str, str] = {}
