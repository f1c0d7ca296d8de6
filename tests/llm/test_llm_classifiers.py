import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import quality_classifier as Q
from cohortloom.llm import tokens
from cohortloom.llm import toxicity as T
from cohortloom.llm.labelled import logistic, training_rows
from cohortloom.llm.queries import QUERIES
from cohortloom.llm.tokens import encode, encoded, pieces

FOLDER = "/root/testdata/sf0.01"


def part(doc, divisor):
    return zlib.crc32(str(doc).encode()) % divisor


# ---- words ------------------------------------------------------------------


def test_encode_slices():
    texts = ["skip", " A b\n", None, "", "x\x0by\x1cz é ", " ", "b A"]
    column = pa.array(texts).slice(1)
    for lower in (True, False):
        offsets, codes, vocabulary = encode(column, lower)
        got = [[vocabulary[c] for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
        assert got == [[w.lower() if lower else w for w in (t or "").encode().decode().split() if t] if t != "x\x0by\x1cz é " else ["x", "y\x1cz", "é"] for t in texts[1:]]
    assert list(pieces(pa.array(["aa", "b" * 9, None, "c"]), 4)) == [(0, 1), (1, 4)] or list(pieces(pa.array(["aa", "b" * 9, None, "c"]), 4))[-1][1] == 4
    assert list(pieces(pa.array([], pa.string()))) == []


def test_training_rows(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(None, "n")], "doc_id long, text string").selectExpr("*", "9 AS label", "8 AS l_id")
    labels = [(i, i % 2) for i in range(50)] + [(3, 0), (3, 1), (4, None), (None, 1), (5, 1)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = training_rows(docs, table, "toxic", 5, 0, 100, "doc_id", "text").collect()
    want = {(i % 2, f"t{i}") for i in range(50) if part(i, 5) != 0 and i not in (3,)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert training_rows(docs, table, "toxic", 5, 0, 7, "doc_id", "text").count() == 7


def test_logistic():
    x = np.concatenate([np.linspace(-3, 1, 200), np.linspace(-1, 3, 200)])
    y = np.repeat([0.0, 1.0], 200)
    offset, slope = logistic(x, y, ridge=1e-9)
    p = 1 / (1 + np.exp(-(offset + slope * x)))
    assert abs(np.sum(np.where(y > 0, 201 / 202, 1 / 202) - p)) < 1e-4 and slope > 0
    assert logistic(np.zeros(0), np.zeros(0)) == (0.0, 0.0)


# ---- toxicity -----------------------------------------------------------------


def naive_viterbi(units, model):
    """Best text over all paths, scored one by one."""
    best = None
    for path in itertools.product(*units):
        score, a, b = sum(cost for _, cost in path), 0, 0
        for c in "".join(t for t, _ in path):
            z = 0 if c == "\0" else T._CODE.get(c, 1)
            score += model[(a * T._K + b) * T._K + z]
            a, b = (0, 0) if z == 0 else (b, z)
        score += model[(a * T._K + b) * T._K] if b else 0.0
        if best is None or score > best[0] + 1e-9:
            best = (score, "".join(t for t, _ in path))
    return best


@pytest.fixture(scope="module")
def characters(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, T.character_counts(docs)


def test_character_counts(spark):
    texts = ["ab a", "b\n", None, "", "é1"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    want = np.zeros(T._K**3)
    for word in "ab a b é1".split():
        s = [0, 0] + [T._CODE.get(c, 1) for c in word] + [0]
        for a, b, c in zip(s, s[1:], s[2:]):
            want[(a * T._K + b) * T._K + c] += 1
    assert (T.character_counts(docs) == want).all()
    model = np.exp(T.character_model(want)).reshape(T._K, T._K, T._K)
    assert np.allclose(model.sum(axis=2), 1)


def test_viterbi_against_all_paths(characters):
    model = T.character_model(characters[1]).tolist()
    for word in ["1d10t", "m0r0n", "l00ser", "s.c.u.m", "a$$", "he11o", "aabb", "cl0o0wn"]:
        units = T.lattice(word)
        got = T.viterbi(units, model)
        score, want = naive_viterbi(units, model)
        assert got == want


def test_disguises_are_undone(characters):
    model = T.character_model(characters[1]).tolist()
    for word, plain in {"1d10t": "idiot", "idiooot": "idiot", "i.d.i.o.t": "idiot", "tra5h": "trash", "cl0wn!": "clown", "the,": "the", "12": "12", "": ""}.items():
        assert T.restore(word, model) == plain
    assert "idiot" in T.restore_spaced(list("idiot"), model)


def odd_words(draw, n):
    alphabets = ["ab", "abé日本кк", "ab0!.-|", "aabbcdefgh", "a日日", "abc$€+\0x", "éß€1😀😀a", "=!abcd", "abc,.;"]
    words = ["".join(draw.choice(list(a), draw.integers(0, 14))) for a in alphabets for _ in range(n)]
    return [*words, "", "aa" * 200, "ab" * 40 + "bb", "a" * 500, "ab" * 32 + "aa"]


@pytest.mark.parametrize("corpus", ["real", "empty", "random"])
def test_words_are_restored_together_as_alone(characters, corpus):
    counts = {"real": characters[1], "empty": np.zeros(T._K**3), "random": np.random.default_rng(0).integers(0, 9, T._K**3).astype(float)}[corpus]
    model = T.character_model(counts)
    words, listed = odd_words(np.random.default_rng(1), 400), model.tolist()
    restored = T._Words(model)(pa.array(words))
    assert restored.to_pylist() == [T.restore(w, listed) for w in words]
    found = zip(*[a.to_pylist() for a in T.feature_arrays(restored)])
    assert [[f for f in fs if f is not None] for fs in found] == [T.features(w) for w in restored.to_pylist()]
    assert T._Words(model)(pa.array([], pa.string())).to_pylist() == []
    assert T._Words(model)(pa.array(["aab,"], pa.large_string())).to_pylist() == [T.restore("aab,", listed)]


def test_doubled_letters_need_no_search_of_their_own(characters, monkeypatch):
    searched = []
    plain = T.viterbi
    monkeypatch.setattr(T, "viterbi", lambda units, model: searched.append(units) or plain(units, model))
    draw = np.random.default_rng(2)
    words = ["".join(draw.choice(list("aabbcdеёß"), 12)) for _ in range(2000)]
    T._Words(T.character_model(characters[1]))(pa.array([*words, "1d10t"]))
    assert len(searched) == 1


def test_counted_features_and_strengths(spark, characters):
    model = T.character_model(characters[1])
    listed = model.tolist()
    texts = ["Hello hello, 1d10t", None, "", "i d i o t x\0y", "bleed bleed a\x1cb", "=abc !=abcd abc", " \n", "hello i d i o t"]
    rows = [(i % 2, t) for i, t in enumerate(texts)]
    want = {}
    for label, text in rows:
        offsets, codes, vocabulary = encoded(pa.array([text], pa.string()))
        found = [T.restore(w, listed) for w in vocabulary.to_pylist()]
        found += [w for _, letters in T._spaced(offsets, codes, vocabulary) for w in T.restore_spaced(letters, listed)]
        for f in {f for w in found for f in T.features(w)}:
            want.setdefault(f, [0, 0])[1 - label] += 1
    got = T._counted_features(spark.createDataFrame(rows, "label int, text string").coalesce(1), model).collect()
    assert {r.feature: [r.toxic, r.clean] for r in got} == want and len(got) == len(want)
    strong = {"=hello": -1.5, "hell": -2.0, "hello": -3.0, "=abc": 2.0, "blee": 0.5, "=": 0.25}
    words = ["hello", "abc", "=abcd", "bleed", "", "hell", "x"]
    known = T._Strengths(strong)
    want = [max(strong.get(f, 0.0) for f in T.features(w)) for w in words]
    assert known(T.feature_arrays(pa.array(words, pa.large_string()))).tolist() == want == [known.of(w) for w in words]


def test_character_counts_of_odd_texts(spark):
    texts = ["a\0b  \t c", "\x0b\x0c", "\0", "É é\x1cz", "", None, "日 AbÀ\r\n"]
    want = np.zeros(T._K**3)
    for word in [w for t in texts if t for w in t.encode().split()]:
        s = [0, 0] + [T._CODE.get(c, 1) for c in word.decode().translate({x: x + 32 for x in range(65, 91)})] + [0]
        for a, b, c in zip(s, s[1:], s[2:]):
            want[(a * T._K + b) * T._K + c] += 1
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert (T.character_counts(docs) == want).all() and not T.character_counts(docs.limit(0)).any()


def test_characters_and_back():
    words = pa.array(["skip", "aé", "", "日😀", "\0"]).slice(1)
    offsets, points = tokens.characters(words)
    assert offsets.tolist() == [0, 2, 2, 4, 5] and tokens.from_characters(offsets, points).to_pylist() == words.to_pylist()


def test_toxicity_edges_and_planted(spark, characters):
    docs = characters[0]
    model = T.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = "Thntblere of then, edtioner in inea that esly ndstnd nter inor eringedwh hathre and onon thhahe"
    planted = [f"{clean} you {w} and this" for w in ("idiot", "1d10t", "i d i o t", "idiooot", "c l o w n", "m0r0n", "PATHETIC!!", "s.c.u.m")]
    rows = [(i, t) for i, t in enumerate(planted)] + [(20, clean), (21, None), (22, ""), (23, " "), (None, planted[0]), (24, clean + " " + "a " * 50_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS raw_text", "2 AS strongest", "3 AS toxicity")
    got = {r.doc_id: r.score for r in model.score(table, ["doc_id"], "score").collect()}
    assert all(got[i] >= 0.5 for i in [*range(len(planted)), None]) and all(got[i] < 0.5 for i in (20, 21, 22, 23, 24))
    assert model.score(table.limit(0), ["doc_id"], "score").collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = T.drop_toxic(table, labels)
    assert kept.columns == table.columns and T.drop_toxic(table.limit(0), labels).collect() == []


# ---- quality --------------------------------------------------------------------


def test_indicators():
    texts = ["The cat", "cat cat", None, "OF!! a1"]
    offsets, features = Q.indicators(pa.array(texts), {})
    again, same = Q.indicators(pa.array(["skip", *texts]).slice(1), {})
    assert (features == same).all() and (offsets == again).all()
    sizes = np.diff(offsets).tolist()
    assert sizes == [6, 5, 0, 6]  # words, shapes, a pair of each; a repeated word has a shape of its own
    assert [Q.shape(w) for w in ("The", "OF!!", "of%%%", "É", "a12")] == ["Aa", "A!", "a%", "Aa", "a0"]


def test_dual_coordinate_descent_reaches_the_optimum():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(60, 5))
    y = np.where(x[:, 0] + 0.3 * draw.normal(size=60) > 0, 1.0, -1.0)
    w = Q.dual_coordinate_descent([(np.arange(5), row) for row in x], y, 5, epochs=500)

    def loss(w):
        return w @ w / 2 + np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])).sum()

    assert all(loss(w) <= loss(w + 0.05 * draw.normal(size=6)) + 1e-6 for _ in range(300))


def test_log_count_ratio():
    offsets, features = np.array([0, 2, 3, 5]), np.array([0, 1, 1, 2, 1])
    got = Q.log_count_ratio(offsets, features, np.array([1, 0, 0]), 3)
    up, down = np.array([2, 2, 1]) / 5, np.array([1, 3, 2]) / 6
    assert np.allclose(got, np.log(up / down))


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 1)]])
def test_quality_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, ""), (2, "x " * 100_000)], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS raw_text")
    model = Q.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = model.score(docs, ["doc_id"], "p").collect()
    assert len(got) == 4 and all(0 <= r.p <= 1 for r in got)
    assert model.score(docs.limit(0), ["doc_id"], "p").collect() == []


@pytest.mark.parametrize(
    "name,label,divisor,held,threshold,least", [("op9_toxicity", "toxic", 5, 0, 0.5, 0.85), ("op10_quality_classifier", "quality", 4, 2, 0.7, 0.95)]
)
def test_held_out_accuracy(spark, name, label, divisor, held, threshold, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = QUERIES[name](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs)
    for r in got:
        assert r.held_out == (part(r.doc_id, divisor) == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold)
    unseen = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in unseen) >= least * len(unseen) and len(unseen) > 30
