from collections import Counter, defaultdict

import pytest

from cohortloom.llm import line_dedup as L
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def naive(docs):
    """(text, dropped places) for every row of (id, text)."""
    parsed = [[L.parse(line.encode()) for line in (text or "").split("\n")] for _, text in docs]
    keys = {p[2]: p for lines in parsed for p in lines if p}
    leaves = defaultdict(list)
    for p in keys.values():
        if p[0] >= L.LONG:
            leaves[p[1]].append(p)
    template = {k: ("line", k) for k in keys}
    for leaf, lines in leaves.items():
        usual = [min((-n, t) for t, n in Counter(p[3][i] for p in lines).items())[1] for i in range(lines[0][0])]
        for p in lines if len(lines) > 1 else ():
            if 5 * sum(a == b for a, b in zip(p[3], usual)) >= 4 * p[0]:
                template[p[2]] = ("leaf", leaf)
    holders = defaultdict(list)
    for (doc, _), lines in zip(docs, parsed):
        for k in {p[2] for p in lines if p}:
            holders[template[k], keys[k][0]].append((doc is None, doc if doc is not None else 0))
    keeper = {t: min(h) for t, h in holders.items() if len(h) >= (L.LONG_DOCS if t[1] >= L.LONG else L.SHORT_DOCS)}
    out = []
    for (doc, text), lines in zip(docs, parsed):
        own = (doc is None, doc if doc is not None else 0)
        gone = [i for i, p in enumerate(lines) if p and keeper.get((template[p[2]], p[0]), own) != own]
        kept = "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in set(gone)) if gone else text
        out.append((doc, kept, gone))
    return out


def test_parse():
    assert L.parse(b" \t") is None and L.parse(b"1 2 x") is None
    n, leaf, key, tokens = L.parse(b"Page 12 of\t30 here now")
    assert (n, tokens) == (6, [b"Page", b"<*>", b"of", b"<*>", b"here", b"now"])
    assert L.parse(b"Page 7 of 31 here now")[1:3] == (leaf, key) != L.parse(b"Page 7 of 31 here then")[1:3]


def test_templates_and_edges(spark):
    words = [f"w{chr(97 + i)}" for i in range(20)]
    line = " ".join(words)
    near = " ".join(words[:10] + ["changed"] + words[11:])
    far = " ".join(words[:6] + ["some", "quite", "other", "words", "stand", "here", "for", "once"] + words[14:])
    rows = [
        (4, f"own four\n{line}\nend"), (2, f"{line}\nown two"), (7, f"{near}\nown seven"), (8, f"{far}\nown eight"), (None, f"{line}\nlast"),
        (9, None), (10, ""), (11, "\n\n"), (2, f"{line}\nown two"), (12, "x " * 200_000 + "\n" + line), (13, f"{line}\n{line}"),
        *[(20 + i, "short line\nfiller number " + "abcdefghijkl"[i]) for i in range(10)],
        *[(40 + i, f"The value of item {i} in list {i * 7} is not known to us") for i in range(3)],
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) AS n_chars", "1 AS keys", "2 AS dropped_keys", "3 AS id")
    got = L.drop_recurring(docs, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "dropped"]
    want = naive(rows)
    assert sorted(((r.doc_id, r.text, list(r.dropped)) for r in got.collect()), key=repr) == sorted(want, key=repr)
    texts = {d: t for d, t, _ in want}
    assert texts[2] == f"{line}\nown two" and texts[4] == "own four\nend" and texts[7] == "own seven" and texts[13] == ""
    assert texts[8] == f"{far}\nown eight" and texts[None] == "last" and texts[9] is None and texts[25].startswith("filler")
    assert texts[40] and texts[41] == texts[42] == ""
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got.collect())
    assert L.drop_recurring(docs.limit(0)).collect() == []


def test_passages_over_fifty_words_stay_once(spark):
    passage = " ".join(f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(i, f"start {i} is {chr(97 + i) * 5}\n{passage}\nend of {chr(97 + i) * 4}") for i in range(6)]
    got = {r.doc_id: r.text for r in L.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [passage in got[i] for i in range(6)] == [True] + [False] * 5
    assert all(f"start {i} is" in got[i] and "end of" in got[i] for i in range(6))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = {r.doc_id: (r.text, list(r.dropped), r.n_dropped, r.n_lines) for r in QUERIES["op8_line_dedup"](spark, FOLDER).collect()}
    assert got == {d: (t, gone, len(gone), len(dict(docs)[d].split("\n"))) for d, t, gone in naive(docs)}


def test_id_column_of_text(spark):
    rows = [("b", "one two three four five six seven eight nine ten"), ("a", "one two three four five six seven eight nine ten")]
    got = {r.doc_id: r.text for r in L.drop_recurring(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": rows[1][1], "b": ""}


@pytest.mark.parametrize("line", [b"\xff\xfe broken bytes", b"\x00", "é ü".encode()])
def test_any_bytes(line):
    assert L.parse(line)[0] == len(line.split())
