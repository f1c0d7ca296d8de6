import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import rows

from cohortloom.llm import conversations as C
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
GOOD = re.compile("(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def exhausted(turns):
    """(cost, audit, lines) over all edits of few (role, text, fault)."""
    added = ["", "u", "a", "ua", "au"]
    best = None
    for edits in itertools.product("KDua", repeat=len(turns)):
        if any(e != "D" and f in "bd" for e, (_, _, f) in zip(edits, turns)):
            continue
        for between in itertools.product(added, repeat=len(turns) + 1):
            roles, audit, cost, lines = "", "", 0, []
            for at in range(len(turns) + 1):
                roles, audit, cost = roles + between[at], audit + "I" * len(between[at]), cost + 5 * len(between[at])
                lines += [f"{NAMES[r]}:" for r in between[at]]
                if at == len(turns):
                    break
                role, text, fault = turns[at]
                edit = edits[at]
                audit += edit if edit in "KD" else "R"
                cost += {"K": 0, "D": 2}.get(edit, 1) + (5 if edit != "D" and fault == "t" else 0)
                if edit != "D":
                    roles += role[:1] or "-" if edit == "K" else edit
                    lines.append(f"{role if edit == 'K' else NAMES[edit]}:{text}")
            if GOOD.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def searched(turns):
    """The same by a shortest path over (turns read, roles so far as far as they matter); another parser than the tested one."""
    end, states = len(turns), {("", 0): (0, "", ())}
    # what matters of the roles so far: nothing, s, u last, or a complete pair
    def kind(state, token):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}.get((state, token))

    import heapq

    heap, done = [(0, "", "", 0, ())], {}
    while heap:
        cost, audit, state, at, lines = heapq.heappop(heap)
        if (state, at) in done:
            continue
        done[state, at] = (cost, audit, lines)
        steps = [(5, "I", r, f"{NAMES[r]}:", 0) for r in "ua"]
        if at < end:
            role, text, fault = turns[at]
            steps.append((2, "D", None, None, 1))
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                steps.append((more, "K", role[:1], f"{role}:{text}", 1))
                steps += [(1 + more, "R", r, f"{NAMES[r]}:{text}", 1) for r in "ua"]
        for price, edit, token, line, read in steps:
            to = state if token is None else kind(state, token)
            if to is not None:
                heapq.heappush(heap, (cost + price, audit + edit, to, at + read, lines + ((line,) if line is not None else ())))
    return min(done[s, end] for s in ("", "p") if (s, end) in done)


def told(turns, parse=searched):
    """Figures of one conversation from its (turn, role, text) after damage."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ".")
        seen.add((role, text))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    cost, audit, lines = parse([(r, x, f) for (_, r, x), f in zip(turns, faults)])
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def naive(conversations):
    after = {c: [] for c, *_ in conversations}
    for conv, turn, role, text in conversations:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(((c, *told(t)) for c, t in after.items()), key=repr)


def frame(spark, conversations):
    schema = "conv_id long, turn long, role string, text string"
    return spark.createDataFrame(conversations, schema).selectExpr("*", "1 AS conv", "2 AS ROW", "3 AS block", "4 AS place", "5 AS idx")


def drawn(seed, n_convs, longest):
    draw = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", None]
    texts = ["Yes.", "no", "Well?  \n", " ", "", None, "One. Two!", "x\x1c.", "é", "why?"]
    out = []
    for c in range(n_convs):
        turn = draw.randrange(3)
        for k in range(draw.randint(1, longest)):
            alternating = ["user", "assistant"][k % 2]
            out.append((c if c else None, None if draw.random() < 0.03 else turn, alternating if draw.random() < 0.6 else draw.choice(roles), draw.choice(texts) if draw.random() < 0.4 else f"Turn {draw.randrange(9)}."))
            turn += draw.choice([1, 1, 1, 1, 2])
    draw.shuffle(out)
    return out


def test_parsers_agree():
    draw = random.Random(2)
    for n in (0, 1, 1, 2, 2, 2, 3, 3):
        for _ in range(6):
            turns = [(draw.choice(["system", "user", "assistant", "tool", ""]), f"t{i}", draw.choice("...tbd")) for i in range(n)]
            want = exhausted(turns)
            assert want == searched(turns)[:2] + (list(searched(turns)[2]),)
            initials = "".join(r[:1] if r[:1] in ("s", "u", "a") and r else "o" for r, _, _ in turns)
            tops = C.parsed(initials, "".join(f for _, _, f in turns), C.START)
            assert min(tops[t] for t in C.ACCEPT if t in tops) == want[:2]


@pytest.mark.parametrize("block", [C.BLOCK, 3])
def test_against_search(spark, monkeypatch, block):
    conversations = drawn(block, 60, 14)
    monkeypatch.setattr(C.repair, "__defaults__", (*C.repair.__defaults__[:-1], block))
    assert rows(C.repaired_conversations(frame(spark, conversations)), *COLUMNS) == naive(conversations)


def test_long_conversation(spark):
    """One conversation holds nearly all turns; it is cut into many blocks."""
    conversations = [(7, k, ["user", "assistant", "user"][k % 3], f"Turn {k % 900}." if k % 5 else "same") for k in range(3000)]
    conversations += [(8, 0, "user", "Hello."), (8, 1, "assistant", "x" * 300_000 + ".")]
    done = C.repair(frame(spark, conversations), block=64)
    got = {r.conv: r for r in done.verdicts.collect()}
    hashes = {r.conv: r.sha256 for r in C.digests(done.turns).collect()}
    for conv in (7, 8):
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes[conv]) == told([t[1:] for t in conversations if t[0] == conv])
    assert done.turns.groupBy("block").count().count() > 10


def test_odd_rows(spark):
    conversations = [(None, None, None, None), (1, None, "user", "A."), (1, None, "user", "A."), (1, 3, "assistant", "B."), (1, 3, "assistant", "B."), (2, 2**63 - 1, "user", "x"), (2, -(2**63), "assistant", "y.")]
    assert rows(C.repaired_conversations(frame(spark, conversations)).drop("gaps"), *[c for c in COLUMNS if c != "gaps"]) == [
        (r[0], *r[2:]) for r in naive(conversations)
    ]
    gone = [(c, t, "user", "Hi.") for c in range(200) for t in [0] if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert gone and rows(C.repaired_conversations(frame(spark, gone)), *COLUMNS) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone), key=repr)
    none = frame(spark, conversations).limit(0)
    done = C.repair(none)
    assert C.repaired_conversations(none).collect() == [] and done.verdicts.collect() == [] and done.turns.collect() == []


def test_turns(spark):
    done = C.repair(frame(spark, [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (2, 0, "assistant", "Only.")]))
    lines = {}
    for r in done.turns.orderBy("conv", "block", "place").collect():
        lines.setdefault(r.conv, []).append((r.role, r.text))
    assert lines == {1: [("user", "B."), ("assistant", "C.")]}
    assert rows(done.verdicts, "conv", "cost", "audit") == [(1, 2, "DKK"), (2, 2, "D")]


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert rows(QUERIES["op12_conversation_repair"](spark, FOLDER), *COLUMNS) == naive([tuple(r) for r in table.collect()])
