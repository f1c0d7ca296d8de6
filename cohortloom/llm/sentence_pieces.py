"""SentencePiece encoding with the N best segmentations, and decoding.

A text becomes a lattice of the pieces of a model. Forward Viterbi scores give
the best score from the start to every place; a backward A-star search uses
them as its estimate, which is exact, so complete segmentations come out in the
order of their scores. No piece holds a blank behind another character, so the
lattice falls apart at blanks: every word is searched by itself, and the N best
segmentations of a text are put together from the N best of its words.
"""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property
from heapq import heappop, heappush
from itertools import chain
from math import inf
from operator import itemgetter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .common import Run, col, free_name, sent, table, tidy
from .tokens import pieces as text_ranges

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Segmentations per text.
N_BEST = 4
#: An unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
_MEMO = 30_000
#: Words of up to so many characters are remembered, and segmented many at a time.
_LONGEST_KEPT = 64
_WORDS_AT_ONCE = 1 << 12
_SIGNS_AT_ONCE = 1 << 16
#: Words whose further segmentations are remembered.
_SEARCHED = 4_000
_SHIFT = 21
#: Bytes of text whose words are looked at together.
_BYTES_AT_ONCE = 1 << 18


class Pieces(NamedTuple):
    """What a model holds: every piece with its score and kind (normal, byte, other)."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]


def load(path: str = MODEL) -> Pieces:
    """Read a model in the driver; its pieces travel with the tasks. It needs byte pieces for unknown characters."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    kinds = [
        "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"
        for i in ids
    ]
    return Pieces([model.id_to_piece(i) for i in ids], [float(model.get_score(i)) for i in ids], kinds)


#: Kinds of characters, and after which kind (row) which one (column) begins another part of a text.
_LETTER, _SIGN, _TIED, _SPACE, _CUT = range(5)
_BEGINS = np.zeros((5, 5), bool)
_BEGINS[_CUT], _BEGINS[:, _CUT], _BEGINS[_LETTER, _SIGN] = True, True, True
_BEGINS[:_SPACE, _SPACE] = True


def _kinds(pieces: list[str]):
    """Kind of a character. It tells where a text falls into the longest parts that pieces may tie together:

    before blanks, at control characters that no piece holds, and between a
    letter or digit and a sign that no piece has behind one.
    """
    held = set("".join(pieces))
    cut = {c for c in "\n\t\r\x0b\x0c" if c not in held}
    pairs = {pair for p in pieces for pair in zip(p, p[1:])}
    # rare letters that signs follow, such as a raised 2, count as signs themselves
    rare = {a for a, b in pairs if a.isalnum() and not b.isalnum() and not a.isascii()}
    tied = {b for a, b in pairs if a.isalnum() and a not in rare and (not b.isalnum() or b in rare)}

    def kind(c: str) -> int:
        if c == " ":
            return _SPACE
        if c in cut:
            return _CUT
        if c in tied:
            return _TIED
        return _LETTER if c.isalnum() and c not in rare else _SIGN

    return kind


@contextmanager
def _acyclic():
    """No search for cycles of objects meanwhile: what is made here has none, and the search goes through all remembered words."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


Path = tuple[float, tuple[int, ...]]


class Encoder:
    """Segmentations of words and texts under one model; remembers short words up to a bound."""

    def __init__(self, model: Pieces):
        normal = [(p, i, model.scores[i]) for i, p in enumerate(model.pieces) if model.kinds[i] == "normal"]
        crossing = [p for p, _, _ in normal if BLANK in p.lstrip(BLANK)]
        if crossing:
            raise ValueError(f"a piece holds a blank behind another character: {crossing[0]!r}")
        self.model = model
        # by character: the id and score of the piece that ends there, if one does, and what may follow, if anything may
        self.trie: dict = {}
        for piece, own, score in normal:
            node = self.trie
            for c in piece[:-1]:
                at = node.setdefault(c, [None, 0.0, None])
                if at[2] is None:
                    at[2] = {}
                node = at[2]
            node.setdefault(piece[-1], [None, 0.0, None])[:2] = own, score
        self._arrays()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(model.pieces) if model.kinds[i] == "byte"}
        if len(self.bytes) < 256:
            raise ValueError("the model has no piece for every byte")
        self.unknown = min((s for _, _, s in normal), default=0.0) - UNKNOWN_PENALTY
        self.kind = _kinds([p for p, _, _ in normal])
        # kinds of the characters met so far
        self.kinds = np.full(sys.maxunicode + 1, 255, np.uint8)
        # words met lately, and those met before: a word that is met again stays
        self.memo: dict[str, tuple[tuple[int, ...], float, float]] = {}
        self.older: dict[str, tuple[tuple[int, ...], float, float]] = {}
        self.searched: dict[tuple[str, int], list[Path]] = {}
        self.texts = ["" if k == "other" else p.replace(BLANK, " ") for p, k in zip(model.pieces, model.kinds)]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        # a byte below 128 is a character by itself; others have to be put together
        self.quick: list[str | None] = list(self.texts)
        for i, b in self.byte_of.items():
            self.quick[i] = chr(b) if b < 128 else None
        self.raw = None

    @cached_property
    def table(self) -> dict[str, tuple[int, float]]:
        """Id and score of every normal piece."""
        return {p: (i, self.model.scores[i]) for i, p in enumerate(self.model.pieces) if self.model.kinds[i] == "normal"}

    def _arrays(self) -> None:
        """The trie as sorted (node, character) keys with the node behind (-1: none) and the id (-1: none) and score of a piece."""
        keys, after, own, scores, nodes, at = [], [], [], [], [self.trie], 0
        while at < len(nodes):
            for c, (piece, score, below) in nodes[at].items():
                keys.append(at << _SHIFT | ord(c))
                after.append(len(nodes) if below else -1)
                own.append(-1 if piece is None else piece)
                scores.append(score)
                if below:
                    nodes.append(below)
            at += 1
        order = np.argsort(np.array(keys, np.int64)) if keys else np.zeros(0, np.int64)
        # one more key that nothing has, so that a search always ends on a key
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.after, self.own = (np.append(np.array(x, np.int32)[order], -1) for x in (after, own))
        self.scores = np.append(np.array(scores, float)[order], 0.0)

    def learn(self, words) -> list:
        """What ``word`` gives for every word (nothing for an empty one); those not yet known are segmented many at a time."""
        words = list(words)
        found = list(map(self.memo.get, words))
        new, older = [], self.older
        for k in [k for k, got in enumerate(found) if got is None]:
            w = words[k]
            if w in older:
                self._room()
                self.memo[w] = found[k] = older[w]
            elif len(w) > _LONGEST_KEPT:
                found[k] = self.word(w)
            elif w:
                new.append((len(w), k))
        new.sort()  # words of like length share their tables
        at = 0
        while at < len(new):
            longest = new[min(at + _WORDS_AT_ONCE, len(new)) - 1][0]
            places = [k for _, k in new[at : at + min(_WORDS_AT_ONCE, _SIGNS_AT_ONCE // longest)]]
            part = [words[k] for k in places]
            got = self._segmented(part)
            self._room()
            self.memo.update(zip(part, got))
            for k, x in zip(places, got):
                found[k] = x
            at += len(places)
        return found

    def _room(self) -> None:
        if len(self.memo) >= _MEMO:
            self.memo, self.older = {}, self.memo

    def _pieces_at(self, words: list[str], lengths: np.ndarray):
        """Lattice pieces of the words: ids and scores (-inf: none) by length less 1, start and word, and the lengths met at every start."""
        raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        signs = np.where(raw == ord(BLANK), 0, np.where(raw == 32, ord(BLANK), raw))
        n, longest = len(words), int(lengths[-1])
        word = np.repeat(np.arange(n), lengths)
        start = np.arange(len(raw)) - (np.cumsum(lengths) - lengths)[word]
        left, cell = lengths[word] - start, start * n + word
        alive, node, depth = np.arange(len(raw)), np.zeros(len(raw), np.int64), 0
        own, scores, met = [], [], []
        while len(alive):
            at = np.searchsorted(self.keys, node << _SHIFT | signs[alive + depth])
            there = self.keys[at] == (node << _SHIFT | signs[alive + depth])
            alive, at = alive[there], at[there]
            depth += 1
            ends = self.own[at] >= 0
            cells = cell[alive[ends]]
            ids, values = np.zeros(longest * n, np.int32), np.full(longest * n, -inf)
            ids[cells], values[cells] = self.own[at[ends]], self.scores[at[ends]]
            if depth == 1:  # a character that is no piece is unknown
                bare = np.ones(len(raw), bool)
                bare[alive[ends]] = False
                ids[cell[bare]], values[cell[bare]] = -1 - raw[bare], self.unknown
            own.append(ids.reshape(longest, n))
            scores.append(values.reshape(longest, n))
            met.append(np.ones(longest, bool) if depth == 1 else np.bincount(start[alive[ends]], minlength=longest) > 0)
            node = self.after[at]
            on = (node >= 0) & (left[alive] > depth)
            alive, node = alive[on], node[on].astype(np.int64)
        return own, scores, [(np.flatnonzero(m) + 1).tolist() for m in np.transpose(met)]

    def _segmented(self, words: list[str]) -> list[tuple[tuple[int, ...], float, float]]:
        """``word`` of many short words, sorted by length: forward and backward scores go over all words at once."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        own, scores, sizes = self._pieces_at(words, lengths)
        n, longest = len(words), int(lengths[-1])
        longer = np.searchsorted(lengths, np.arange(longest), "right").tolist()  # the first word longer than k
        best, back = np.full((longest + 1, n), -inf), np.zeros((longest + 1, n), np.int8)
        best[0] = 0.0
        for k in range(longest):
            for size in sizes[k]:
                of = slice(longer[k + size - 1], n)
                total = best[k, of] + scores[size - 1][k, of]
                up = total > best[k + size, of]
                np.copyto(best[k + size, of], total, where=up)
                np.copyto(back[k + size, of], size, where=up)

        taken = np.zeros((longest, n), np.int8)
        w, e, steps = np.arange(n), lengths, []
        every = np.array([x.ravel() for x in own])
        while len(w):
            size = back[e, w]
            e = e - size
            taken[e, w] = size
            steps.append((w, every[size - 1, e * n + w]))
            w, e = w[e > 0], e[e > 0]
        of, ids = (np.concatenate([x[i] for x in reversed(steps)]) for i in range(2))
        order = np.argsort(of, kind="stable")
        ids, of = ids[order], of[order]
        counts = np.bincount(of, minlength=n)
        odd = np.zeros(n, bool)
        odd[of[ids < 0]] = True

        rest, second = np.full((longest + 1, n), -inf), np.full(n, -inf)
        rest[lengths, np.arange(n)] = 0.0
        for k in reversed(range(longest)):
            for size in sizes[k]:
                of = slice(longer[k + size - 1], n)
                way = scores[size - 1][k, of] + rest[k + size, of]
                np.maximum(rest[k, of], way, out=rest[k, of])
                way += best[k, of]
                np.copyto(way, -inf, where=taken[k, of] == size)
                np.maximum(second[of], way, out=second[of])
        top = best[lengths, np.arange(n)]
        flat, ends = ids.tolist(), np.cumsum(counts).tolist()
        out, at = [], 0
        for stop, strange, total, loss in zip(ends, odd.tolist(), top.tolist(), (top - second).tolist()):
            pieces = flat[at:stop]
            out.append((self._ids(pieces) if strange else tuple(pieces), total, loss))
            at = stop
        return out

    def _lattice(self, word: str):
        """Pieces (start, end, id, score) by start, the forward Viterbi scores, and the last (start, id) of the best way to a place.

        An unknown character has id -1 - its code point. Blanks of the word
        stand as the model's blank sign; the sign itself is an unknown character.
        """
        trie, unknown, n = self.trie, self.unknown, len(word)
        signs = word.replace(BLANK, "\0").replace(" ", BLANK)
        edges: list[tuple[int, int, int, float]] = []
        best, back = [-inf] * (n + 1), [(0, 0)] * (n + 1)
        best[0] = 0.0
        add = edges.append
        for start in range(n):
            base, node, end, alone = best[start], trie, start, False
            while node and end < n:
                got = node.get(signs[end])
                if got is None:
                    break
                end += 1
                own, score, node = got
                if own is not None:
                    add((start, end, own, score))
                    total = base + score
                    if total > best[end]:
                        best[end] = total
                        back[end] = (start, own)
                    if end == start + 1:
                        alone = True
            if not alone:
                edges.append((start, start + 1, -1 - ord(word[start]), unknown))
                if base + unknown > best[start + 1]:
                    best[start + 1] = base + unknown
                    back[start + 1] = (start, -1 - ord(word[start]))
        return edges, best, back

    def _ids(self, pieces) -> tuple[int, ...]:
        """Ids of lattice pieces: an unknown character is that of its bytes."""
        ids: list[int] = []
        for own in pieces:
            ids.extend((own,) if own >= 0 else (self.bytes[b] for b in chr(-1 - own).encode("utf-8", "surrogatepass")))
        return tuple(ids)

    def search(self, word: str) -> Iterator[Path]:
        """Segmentations of a word as (score, ids), best first.

        Of equal scores the one that is nearer to its end goes on first, so that many ways of the same score, as a run of
        one character has, are not all kept open.
        """
        edges, best, _ = self._lattice(word)
        ends: list[list[tuple[int, int, float]]] = [[] for _ in best]
        for start, end, own, score in edges:
            ends[end].append((start, own, score))
        heap: list = [(-best[-1], len(word), 0, 0.0, None)]
        met = 0
        while heap:
            _, at, _, score, path = heappop(heap)
            if at == 0:
                pieces = []
                while path is not None:
                    own, path = path
                    pieces.append(own)
                yield score, self._ids(pieces)
                continue
            for start, own, s in ends[at]:
                met += 1
                heappush(heap, (-(best[start] + score + s), start, met, score + s, (own, path)))

    def word(self, word: str) -> tuple[tuple[int, ...], float, float]:
        """Ids and score of the best segmentation, and what the second best loses (infinite if there is none).

        The best one is read off the forward scores. Any other has a piece that
        the best lacks; forward and backward scores give the best way through
        each such piece, so the loss is known without a search.
        """
        got = self.memo.get(word)
        if got:
            return got
        got = self.older.get(word)
        if got is None:
            edges, best, back = self._lattice(word)
            at, pieces, after = len(word), [], {}
            while at:
                start, own = back[at]
                pieces.append(own)
                after[start] = at
                at = start
            rest = [-inf] * len(best)
            rest[-1] = 0.0
            second = -inf
            for start, end, _, score in reversed(edges):
                way = score + rest[end]
                if way > rest[start]:
                    rest[start] = way
                way += best[start]
                if way > second and after.get(start) != end:
                    second = way
            pieces.reverse()
            ids = tuple(pieces) if min(pieces) >= 0 else self._ids(pieces)
            got = (ids, best[-1], best[-1] - second)
        if len(word) <= _LONGEST_KEPT:
            self._room()
            self.memo[word] = got
        return got

    def words(self, text: str) -> list[str]:
        """The parts of a text that are searched alone; a blank is put before the text, as the model's training does."""
        different, codes, _ = self.words_all([text])
        return [different[c] for c in codes.tolist()]

    def words_all(self, texts: list[str]):
        """(different, codes, bounds): the ``words`` of text i are those of ``codes[bounds[i]:bounds[i + 1]]`` in ``different``."""
        import pyarrow as pa

        ends = np.cumsum([len(text) + 1 if text else 0 for text in texts])
        joined = "".join([" " + text for text in texts if text])
        if not joined:
            return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        signs = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[signs]
        new = np.unique(signs[kinds == 255]).tolist()
        if new:
            self.kinds[new] = [self.kind(chr(c)) for c in new]
            kinds = self.kinds[signs]
        begins = np.concatenate(([True], _BEGINS.ravel()[kinds[:-1] * np.uint8(5) + kinds[1:]]))
        begins[ends[ends < len(signs)]] = True
        starts = np.append(np.flatnonzero(begins), len(signs))
        bounds = np.searchsorted(starts, np.concatenate(([0], ends)))
        raw = joined.encode("utf-8", "surrogatepass")
        if len(raw) > len(signs):
            sizes = 1 + (signs > 0x7F).astype(np.int8) + (signs > 0x7FF) + (signs > 0xFFFF)
            starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))[starts]
        parts = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, parts).dictionary_encode()
        different = [w.decode("utf-8", "surrogatepass") for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        return different, coded.indices.to_numpy().astype(np.int64), bounds

    def encode(self, text: str, n: int = 1):
        """(ids, score, others) of a text, as ``encode_all`` has them."""
        ids, _, scores, others = self.encode_all([text], n)
        return ids.tolist(), scores[0], others[0]

    def encode_all(self, texts: list[str], n: int = 1):
        """(ids, offsets, scores, others) of texts: text i has ``ids[offsets[i]:offsets[i + 1]]``.

        ``others`` lists up to n - 1 further segmentations of every text. Each is (score, edits); an edit
        (at, count, ids) puts ids in the place of ``count`` ids from ``at`` on of the best segmentation.
        A word of these texts is looked up or segmented once, together with all others.
        """
        different, codes, bounds = self.words_all(texts)
        found = self.learn(different)
        counts = np.fromiter(map(len, map(itemgetter(0), found)), np.int64, len(found))
        pool = np.fromiter(chain.from_iterable(map(itemgetter(0), found)), np.int32, int(counts.sum()))
        values, losses = (np.fromiter(map(itemgetter(i), found), float, len(found))[codes] for i in (1, 2))
        lengths = counts[codes]
        starts = np.concatenate(([0], np.cumsum(lengths)))
        shift = (np.cumsum(counts) - counts)[codes] - starts[:-1]
        ids = pool[np.arange(starts[-1]) + np.repeat(shift, lengths)]
        scores, others = [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            scores.append(float(sum(values[a:b].tolist())))
            of = slice(a, b)
            others.append(self._others(different, codes[of], losses[of], starts[of], scores[-1], n) if n > 1 and a < b else [])
        return ids, starts[bounds], scores, others

    def _listed(self, word: str, n: int) -> list[Path]:
        """The n best segmentations of a word, the very best first; of short words they are remembered."""
        got = self.searched.get((word, n))
        if got is None:
            ids, total, _ = self.word(word)
            got = [(total, ids)]
            for path in self.search(word):
                if path[1] != ids:  # of equal scores the search may meet another one first
                    got.append(path)
                if len(got) == n:
                    break
            if len(word) <= _LONGEST_KEPT:
                if len(self.searched) >= _SEARCHED:
                    self.searched.clear()
                self.searched[word, n] = got
        return got

    def _others(self, different, codes, losses, starts, score, n):
        # a segmentation that changes a word outside the n - 1 cheapest to change has n - 1 better ones
        cheap = np.arange(len(losses))
        if len(losses) >= n:
            cheap = np.flatnonzero(losses <= np.partition(losses, n - 2)[n - 2])
        cheap = cheap[np.argsort(losses[cheap], kind="stable")[: n - 1]].tolist()
        lists = [(k, self._listed(different[codes[k]], n)) for k in cheap if losses[k] < inf]
        heap = [(0.0, (0,) * len(lists), 0)] if lists else []
        chosen = []
        while heap and len(chosen) < n:
            loss, places, last = heappop(heap)
            chosen.append((loss, places))
            for j in range(last, len(lists)):
                own = lists[j][1]
                if places[j] + 1 < len(own):
                    more = loss + own[places[j]][0] - own[places[j] + 1][0]
                    heappush(heap, (more, places[:j] + (places[j] + 1,) + places[j + 1 :], j))
        return [
            (
                score - loss,
                sorted((int(starts[k] - starts[0]), len(own[0][1]), list(own[p][1])) for (k, own), p in zip(lists, places) if p),
            )
            for loss, places in chosen[1:]
        ]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """``decode`` of the ids of every text of ``encode_all``, put together by Arrow."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.raw is None:
            self.raw = pa.array([bytes((self.byte_of[i],)) if i in self.byte_of else t.encode() for i, t in enumerate(self.texts)])
        parts = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.raw.take(pa.array(ids)))
        return [x.decode("utf-8", "replace").removeprefix(" ") for x in pc.binary_join(parts, b"").to_pylist()]

    def decode(self, ids) -> str:
        """The text of ids: bytes in a row are read as UTF-8 (wrong ones as U+FFFD), the blank put before the text goes."""
        quick = [self.quick[i] for i in ids]
        if None not in quick:
            return "".join(quick).removeprefix(" ")
        texts, byte_of = self.texts, self.byte_of
        parts, raw = [], bytearray()
        for i in ids:
            if i in byte_of:
                raw.append(byte_of[i])
                continue
            text = texts[i]
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(text)
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts).removeprefix(" ")


_EDIT = StructType([StructField("at", IntegerType()), StructField("count", IntegerType()), StructField("ids", ArrayType(IntegerType()))])
_OTHER = ArrayType(StructType([StructField("score", DoubleType()), StructField("edits", ArrayType(_EDIT))]))


def with_pieces(
    docs: DataFrame, model: Pieces, keep: list[str], text_col: str = "text", n: int = N_BEST
) -> DataFrame:
    """The columns to keep, and ``ids``, ``n_pieces``, ``score``, ``others`` and ``round_trip`` of every text.

    ``ids`` is the best segmentation, ``others`` up to n - 1 further ones as
    edits of it, in order. ``round_trip`` tells whether the ids decode to the
    very text. Null and empty texts have no piece and score 0. Whole texts are
    encoded; a task holds one of them at a time beside its batch. Where a kept
    column has a new column's name, underscores are added to the new one.
    """
    kept = docs.select(*[col(c) for c in keep])
    needed, place = sent(docs, keep, text_col)
    names = [free_name(kept, x) for x in ("ids", "n_pieces", "score", "others", "round_trip")]
    kinds = [ArrayType(IntegerType()), LongType(), DoubleType(), _OTHER, BooleanType()]
    schema = StructType([*[docs.schema[c] for c in keep], *[StructField(x, k) for x, k in zip(names, kinds)]])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        with _acyclic():
            encoder = Encoder(model)
        types = [to_arrow_type(k) for k in kinds]
        for batch in batches:
            for start, end in text_ranges(batch.column(place), _BYTES_AT_ONCE):
                part = batch.slice(start, end - start)
                texts = [text or "" for text in part.column(place).to_pylist()]
                with _acyclic():
                    ids, offsets, scores, found = encoder.encode_all(texts, n)
                others = [
                    [{"score": s, "edits": [dict(zip(("at", "count", "ids"), e)) for e in edits]} for s, edits in other]
                    for other in found
                ]
                trips = [back == text for back, text in zip(encoder.decode_all(ids, offsets), texts)]
                columns = [
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    *[pa.array(c, t) for c, t in zip((np.diff(offsets), scores, others, trips), types[1:])],
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=[*keep, *names])

    return needed.mapInArrow(tidy(run), schema)


def decoded(encoded: DataFrame, model: Pieces, ids_col: str = "ids", name: str = "text") -> DataFrame:
    """The table with the text of an array of ids; null ids give null. An id that the model lacks fails."""
    keep = encoded.columns
    schema = StructType([*encoded.schema.fields, StructField(name, StringType())])

    def run(batches):
        import pyarrow as pa

        encoder = Encoder(model)
        for batch in batches:
            texts = [None if x.as_py() is None else encoder.decode(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, name])

    return encoded.select("*", col(ids_col).alias(free_name(encoded, "raw_ids"))).mapInArrow(tidy(run), schema)


def op5(spark, folder):
    return with_pieces(table(spark, folder, "documents"), load(), ["doc_id"])


QUERIES: dict[str, Run] = {"op5_sentence_pieces": op5}
SQL: dict[str, str] = {}
