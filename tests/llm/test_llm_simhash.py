import itertools
import random
import re

import pytest
import xxhash

from cohortloom.llm import simhash as S
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def naive_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(fingerprints):
    """Smallest member of the component of every fingerprint."""
    least = {f: f for f in fingerprints}

    def root(f):
        while least[f] != f:
            f = least[f]
        return f

    for a, b in itertools.combinations(sorted(least), 2):
        if (a ^ b).bit_count() <= 3:
            least[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in least}


def test_masks_cover_every_triple():
    masks = S.covering_masks()
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        change = sum(1 << b for b in bits)
        assert any(change & m == 0 for m in masks)


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "Two WORDS", "a b c", "Ä É a A\x0bb\x1cc\u00a0d", "x y z " * 70_000])
def test_fingerprint(text):
    assert S.simhash(text.encode() if text is not None else None) == naive_fingerprint(text)


@pytest.mark.parametrize("bucket", [1024, 2])
def test_links_against_all_pairs(spark, bucket):
    draw = random.Random(3)
    fps = set()
    for _ in range(12):
        center = draw.getrandbits(64)
        fps.add(center)
        for _ in range(12):
            fps.add(center ^ sum(1 << b for b in set(draw.choices(range(64), k=draw.randint(1, 4)))))
    table = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    edges = [(r.a, r.b) for r in S.links(table, bucket=bucket).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 64 for a, b in edges) and len(edges) < 15 * len(fps) * 12
    got = {r.node: r.root for r in S.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = naive_groups(fps)
    groups = {}
    for f in fps:
        groups.setdefault(got.get(S.signed(f), S.signed(f)), set()).add(f)
    wanted = {}
    for f, r in want.items():
        wanted.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_edge_cases(spark):
    rows = [(5, "a b c d", "x"), (3, "A b  c\td", None), (3, "A b  c\td", None), (None, "a b c d", "y"), (9, None, "z"), (2, "", "e"), (None, "q r s", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").selectExpr("*", "1 AS ROW_NUMBER", "2 AS fp", "3 AS root")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect())
    one, own = format(naive_fingerprint("a b c d"), "016x"), format(naive_fingerprint("q r s"), "016x")
    assert got == sorted([("5", one, 3), ("3", one, 3), ("3", one, 3), ("None", one, 3), ("9", "0" * 16, 2), ("2", "0" * 16, 2), ("None", own, None)])
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]
    empty = docs.limit(0)
    assert S.near_duplicates(empty).collect() == [] and S.keep_one_per_group(empty).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    marks = {i: naive_fingerprint(t) for i, t in texts.items()}
    group, least = naive_groups(set(marks.values())), {}
    for i, f in marks.items():
        least[group[f]] = min(least.get(group[f], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, FOLDER).collect()}
    assert got == {i: (format(f, "016x"), least[group[f]]) for i, f in marks.items()}
