import itertools
import random
import re

import pytest

from cohortloom.llm import sentence_pieces as P
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return P.load()


@pytest.fixture(scope="module")
def encoder(model):
    return P.Encoder(model)


def every(encoder, word):
    """All segmentations of a word, best first."""
    signs, out = word.replace(P.BLANK, "\0").replace(" ", P.BLANK), []

    def walk(at, ids, score):
        if at == len(word):
            out.append((score, tuple(ids)))
            return
        alone = False
        for end in range(at + 1, len(word) + 1):
            got = encoder.table.get(signs[at:end])
            if got:
                alone = alone or end == at + 1
                walk(end, ids + [got[0]], score + got[1])
        if not alone:
            walk(at + 1, ids + [encoder.bytes[b] for b in word[at].encode()], score + encoder.unknown)

    walk(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])


def applied(ids, edits):
    ids = list(ids)
    for at, count, new in reversed([tuple(e.values()) if isinstance(e, dict) else tuple(e) for e in edits]):
        ids[at : at + count] = new
    return ids


def test_search_against_all_segmentations(encoder):
    draw = random.Random(5)
    words = [" the", " hello", " Étre", " 中x", " ☃a\U0001f600b", "abc", "  ab", "aaaaaa", "\n", "▁a"]
    words += ["".join(draw.choice("abenst ") for _ in range(7)) for _ in range(40)]
    for word in words:
        got, want = list(encoder.search(word)), every(encoder, word)
        assert [s for s, _ in got] == [s for s, _ in want] and sorted(got) == sorted(want)


def test_many_words_at_once(spark, model):
    draw = random.Random(8)
    words = [" the", "☃", " ☃a\U0001f600b", "a", "\n", "▁a", " ", "  ab", "aaaaaa", "\ud800x", "w" * 64, "é" * 40, "\0", "￿中文"]
    words += ["".join(draw.choice("abenst ü▁☃中") for _ in range(draw.randint(1, 30))) for _ in range(3000)]
    one, many = P.Encoder(model), P.Encoder(model)
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    words += [w for t in texts if t for w in one.words(t)]
    many.learn(set(words) | {"", "w" * 65})
    for w in set(words):
        if len(w) <= 64:
            assert many.memo[w] == one.word(w), w
    assert "w" * 65 not in many.memo and "" not in many.memo
    many.learn([])


def plain_words(model, text):
    """Parts of a text by a regular expression."""
    pieces = [p for p, k in zip(model.pieces, model.kinds) if k == "normal"]
    held = set("".join(pieces))
    cut = "".join(c for c in "\n\t\r\x0b\x0c" if c not in held)
    pairs = {pair for p in pieces for pair in zip(p, p[1:])}
    rare = {a for a, b in pairs if a.isalnum() and not b.isalnum() and not a.isascii()}
    tied = {b for a, b in pairs if a.isalnum() and a not in rare and (not b.isalnum() or b in rare)}
    odd, tying = ("".join(re.escape(c) for c in sorted(x)) for x in (rare, tied))
    sign, letter = f"(?:[^\\w {cut}]|[_{odd}])", f"[^\\W_{odd}]"
    more = f"(?:[{tying}]{sign}*{letter}*)*" if tied else ""
    return re.findall(f"[{cut}]|(?=[^{cut}]) *{sign}*{letter}*{more}", " " + text, re.DOTALL) if text else []


def test_parts_of_many_texts(model, encoder):
    draw = random.Random(11)
    texts = ["", "a", " ", "▁", "", "don't -- x²y_z  A\n\n b", "中文 é\r\tü😀!", ""]
    texts += ["".join(draw.choice("abE9 _'’-.#²½é▁中😀\n\t\x0b\xa0") for _ in range(draw.randint(0, 60))) for _ in range(500)]
    different, codes, bounds = encoder.words_all(texts)
    assert len(set(different)) == len(different) and len(bounds) == len(texts) + 1
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert [different[c] for c in codes[a:b]] == encoder.words(text) == plain_words(model, text)
    assert encoder.words_all([])[0] == encoder.words_all(["", ""])[0] == []


def test_words_are_segmented_once(model, monkeypatch):
    draw = random.Random(12)
    made = [" " + "".join(draw.choice("abenst") for _ in range(9)) for _ in range(600)]
    texts = ["x the" + "".join(draw.sample(made, 200)) + " the" for _ in range(30)] + [" " + "w" * 70, "", "☃ é"]
    want = [P.Encoder(model).encode(text, 4) for text in texts]
    monkeypatch.setattr(P, "_MEMO", 50)  # far fewer than the words of these texts
    met, lattice = [], P.Encoder._lattice
    monkeypatch.setattr(P.Encoder, "_lattice", lambda self, word: met.append(word) or lattice(self, word))
    encoder = P.Encoder(model)
    ids, offsets, scores, others = encoder.encode_all(texts, 4)
    assert [(ids[a:b].tolist(), s, o) for a, b, s, o in zip(offsets, offsets[1:], scores, others)] == want
    assert encoder.decode_all(ids, offsets) == texts
    assert met.count(" the") == 1 and len(met) < 150  # only those whose further segmentations are asked for


def test_long_run_of_one_character(encoder):
    import time

    began = time.perf_counter()
    ids, score, others = encoder.encode("a" * 200_000, 4)
    assert encoder.decode(ids) == "a" * 200_000 and len(others) == 3
    assert time.perf_counter() - began < 30  # some seconds; the square of the length would be hours
    few = [s for s, _ in itertools.islice(encoder.search("a" * 12), 6)]
    assert few == [s for s, _ in every(encoder, "a" * 12)[:6]]


@pytest.mark.parametrize("text", ["the cat sat\non it", "a  b", "no", "x\ty ▁ z"])
def test_best_of_a_text_against_all(encoder, text):
    parts = [every(encoder, w) for w in encoder.words(text)]
    scores = sorted((sum(s for s, _ in c) for c in itertools.product(*[p[:8] for p in parts])), reverse=True)[:6]
    ids, score, others = encoder.encode(text, 6)
    assert [score, *[s for s, _ in others]] == scores[: 1 + len(others)] and len(others) == min(5, len(scores) - 1)
    seen = {tuple(ids)}
    for _, edits in others:
        other = applied(ids, edits)
        assert encoder.decode(other) == text
        seen.add(tuple(other))
    assert len(seen) == 1 + len(others)


def test_the_library_reads_the_ids(model, encoder):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=P.MODEL)
    for text in ("Hello world, 12 näive ☃\U0001f600\n\tok", " two  blanks ", "x"):
        assert library.decode(encoder.encode(text)[0]) == text == encoder.decode(encoder.encode(text)[0])
    assert encoder.decode([encoder.bytes[0xFF], encoder.bytes[0x41]]) == "�A" and encoder.decode([]) == ""


def test_table_and_edges(spark, model):
    texts = [None, "", " ", "▁", "a\x00b", "\n\n", "word " * 40_000, "w" * 3_000, "中文字符" * 50, "a", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS SCORE", "2 AS raw_text")
    got = P.with_pieces(docs, model, docs.columns)
    assert got.columns == [*docs.columns, "ids_", "n_pieces", "score_", "others", "round_trip"]
    for r in got.collect():
        assert r.round_trip and r.n_pieces == len(r.ids_) and r.text == texts[r.doc_id] and (r.n_pieces > 0 or not r.text)
        assert len(r.others) <= P.N_BEST - 1 and all(a.score >= b.score for a, b in zip(r.others, r.others[1:]))
    plain = P.with_pieces(docs.select("doc_id", "text"), model, ["doc_id"])
    back = {r.doc_id: r.text for r in P.decoded(plain, model).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert P.with_pieces(docs.limit(0), model, ["doc_id"]).collect() == []


def test_memory_of_a_task(spark, model, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    docs, taken, rng = spark.createDataFrame([], "doc_id long, text string"), [], random.Random(7)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: taken.append((self.columns, run)))
    P.with_pieces(docs, model, docs.columns)
    (columns, run), = taken
    assert columns == ["doc_id", "text"]  # a text that is kept is sent once
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(800)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], names=columns)
    tracemalloc.start()
    try:
        assert sum(part.num_rows for part in run([batch])) == 400
        assert tracemalloc.get_traced_memory()[1] < 85e6  # 117 MB with larger memos, slices and tables
    finally:
        tracemalloc.stop()


def test_query(spark, encoder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op5_sentence_pieces"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert encoder.decode(r.ids) == texts[r.doc_id] and r.round_trip
        best = [max(every(encoder, w))[0] if len(w) < 14 else encoder.word(w)[1] for w in encoder.words(texts[r.doc_id])[:20]]
        assert [encoder.word(w)[1] for w in encoder.words(texts[r.doc_id])[:20]] == best
