"""Repair of conversation structure by a generalised LR parser.

The grammar of roles is: nothing, or pairs of a user's and an assistant's turn, of which a system turn may stand
first. Every turn offers several tokens, each at a price: its own role, another role, none (it is deleted); between
turns a user's or an assistant's turn may be inserted. The parser reads all of them at once on a graph-structured
stack. Its tops are the states below; the stack under USER is one or more of START, SYSTEM and PAIRS, under the
others it is fixed, as ``user assistant`` is reduced to PAIRS as soon as it is read. So equal tops have the same
future, and are merged: the one with the smallest (cost, audit) stays. Two audits of equal cost are never prefixes
of each other, hence what is smallest now stays smallest.

A conversation may be of any length: turns are sorted over all conversations and cut into blocks. A part of a
conversation within a block is parsed from every top it may start with; parts are then put together in order.
"""

from __future__ import annotations

import hashlib
import os.path
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.ordering import with_position
from ..session import settle
from .common import BLANKS, Run, col, table

#: Turns of a block.
BLOCK = 4096
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
START, SYSTEM, USER, PAIRS = range(4)
TOPS = (START, SYSTEM, USER, PAIRS)
#: Top after a token; an assistant's turn is reduced at once.
SHIFT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (PAIRS, "u"): USER, (USER, "a"): PAIRS}
ACCEPT = (START, PAIRS)
ROLES = {"u": "user", "a": "assistant"}
#: The one token that can be inserted, or that another role can become, on a top.
FITTING = {top: token for (top, token) in SHIFT if token in ROLES}
#: Adjacent initials that are as they should be.
LEGAL = ("su", "ua", "au")


def merged(nodes) -> dict[int, tuple[int, str]]:
    """Tops with their smallest (cost, audit), after as many insertions as can pay."""
    best: dict[int, tuple[int, str]] = {}
    for top, node in nodes:
        if top not in best or node < best[top]:
            best[top] = node
    for _ in range(2):  # a third one leads back to a top that was there for less
        for top, (cost, audit) in list(best.items()):
            after, node = SHIFT[top, FITTING[top]], (cost + INSERT, audit + "I")
            if after not in best or node < best[after]:
                best[after] = node
    return best


@lru_cache(maxsize=1 << 14)
def parsed(initials: str, faults: str, start: int) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the best edits of some turns for every top that they lead to from ``start``.

    ``faults`` has b, d, t or ``.`` for a blank, duplicate, truncated or sound turn.
    """
    best = merged([(start, (0, ""))])
    for initial, fault in zip(initials, faults):
        nodes = []
        for top, (cost, audit) in best.items():
            nodes.append((top, (cost + DELETE, audit + "D")))
            if fault in "bd":
                continue
            kept = cost + (TRUNCATED if fault == "t" else 0)
            if (top, initial) in SHIFT:
                nodes.append((SHIFT[top, initial], (kept, audit + "K")))
            nodes.append((SHIFT[top, FITTING[top]], (kept + REROLE, audit + "R")))
        best = merged(nodes)
    return best


def edited(initials: str, start: int, audit: str):
    """(turn, place, role) of the turns that the edits leave: ``turn`` is None if inserted, ``role`` None if kept.

    ``place`` counts the turns read so far and those inserted since, so that it orders the result.
    """
    at, since, top = 0, 0, start
    for edit in audit:
        if edit == "I":
            since += 1
            yield None, (at, since), ROLES[FITTING[top]]
            top = SHIFT[top, FITTING[top]]
            continue
        at, since = at + 1, 0
        if edit == "K":
            yield at - 1, (at, 0), None
            top = SHIFT[top, initials[at - 1]]
        elif edit == "R":
            yield at - 1, (at, 0), ROLES[FITTING[top]]
            top = SHIFT[top, FITTING[top]]


class Joined:
    """The parts of one conversation put together in their order."""

    def __init__(self):
        # of each top: cost, and the audit without what all of them have in common
        self.nodes = {START: (0, "")}
        self.steps = []

    def add(self, paths: list[tuple[int, int, int, str]]) -> None:
        best, back = {}, {}
        for start, end, cost, audit in paths:
            if start in self.nodes:
                before, tail = self.nodes[start]
                node = (before + cost, tail + audit)
                if end not in best or node < best[end]:
                    best[end], back[end] = node, (start, audit)
        common = len(os.path.commonprefix([audit for _, audit in best.values()]))
        self.nodes = {top: (cost, audit[common:]) for top, (cost, audit) in best.items()}
        self.steps.append(back)

    def finish(self) -> tuple[int, list[tuple[int, str]]]:
        """Cost of the whole, and of each part its first top and its edits."""
        top = min((t for t in ACCEPT if t in self.nodes), key=self.nodes.get)
        cost, chosen = self.nodes[top][0], []
        for back in reversed(self.steps):
            top, audit = back[top]
            chosen.append((top, audit))
        return cost, chosen[::-1]


class Repaired(NamedTuple):
    #: One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    verdicts: DataFrame
    #: The turns that stay or are inserted: conv, role, text, and block and place (a struct), which order them.
    turns: DataFrame


def faults_of(stored: DataFrame) -> DataFrame:
    """``stored`` (row, conv, turn, role, text, mark) without the text, with ``initial`` and ``fault``.

    The first turn of equal ones is found by a minimum per (conversation, role, text) and joined by its row, so that a
    text that is repeated any number of times is no hot key.
    """
    same = stored.groupBy("conv", "role", "mark").agg(F.min(F.struct("turn", "row")).alias("least"))
    firsts = same.select(F.col("least.row").alias("row"), F.lit(True).alias("is_first"))
    bare = F.btrim("text", F.lit(BLANKS))
    own = F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t").otherwise(".")
    initial = F.left("role", F.lit(1))
    known = stored.select("row", "conv", "turn", "role", "mark", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), own.alias("own"))
    fault = F.when(F.col("own") == "b", "b").when(F.col("is_first").isNull(), "d").otherwise(F.col("own"))
    return known.join(firsts, "row", "left").withColumn("fault", fault).drop("own", "is_first")


def _runs(keys: list):
    """(start, end) of the runs of equal neighbours."""
    start = 0
    for at in range(1, len(keys) + 1):
        if at == len(keys) or keys[at] != keys[start]:
            yield start, at
            start = at


def _parts(placed: DataFrame) -> DataFrame:
    """A row for every part of a conversation that lies in one block, with its parses."""
    conv = placed.schema["conv"]
    path = "array<struct<start:int,end:int,cost:bigint,audit:string>>"
    fields = StructType([conv]).simpleString()[len("struct<") : -1].replace(":", " ", 1)
    schema = f"{fields}, block long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, paths {path}"

    def run(block):
        import pyarrow as pa

        block = block.sort_by("idx")
        convs, number = block.column("conv"), block.column("block")[0].as_py()
        initials, faults = ("".join(block.column(c).to_pylist()) for c in ("initial", "fault"))
        out, starts_at = [], []
        for a, b in _runs(convs.to_pylist()):
            i, f = initials[a:b], faults[a:b]
            paths = [
                {"start": s, "end": e, "cost": cost, "audit": audit}
                for s in (TOPS if a == 0 else (START,))  # only the first part may continue a conversation
                for e, (cost, audit) in parsed(i, f, s).items()
            ]
            illegal = sum(i[k : k + 2] not in LEGAL for k in range(len(i) - 1))
            out.append((number, b - a, f.count("b"), f.count("d"), f.count("t"), illegal, i[0], i[-1], paths))
            starts_at.append(a)
        kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
        arrays = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
        paths = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        names = ["conv", "block", "n", "blank", "duplicate", "truncated", "illegal", "first", "last", "paths"]
        return pa.Table.from_arrays([convs.take(pa.array(starts_at, pa.int64())).combine_chunks(), *arrays, pa.array([r[8] for r in out], paths)], names=names)

    return placed.select("block", "idx", "conv", "initial", "fault").groupBy("block").applyInArrow(run, schema)


def _chosen(parts: DataFrame) -> DataFrame:
    """Per part ``conv, block, start, audit``; per conversation a row with null ``block``, the whole audit and its figures."""
    figures = ["blank", "duplicate", "truncated", "illegal"]
    rest = [StructField("block", LongType()), StructField("start", IntegerType()), StructField("audit", StringType())]
    schema = StructType([parts.schema["conv"], *rest, *[StructField(n, LongType()) for n in ("cost", *figures)]])

    kinds = [LongType(), IntegerType(), StringType(), *[LongType()] * (1 + len(figures))]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        convs, rows, types, kind = [], [], [to_arrow_type(k) for k in kinds], None

        def close(value, joined, blocks, sums, _):
            cost, chosen = joined.finish()
            for block, (start, audit) in zip(blocks, chosen):
                rows.append((block, start, audit, None, *[None] * len(figures)))
            rows.append((None, None, "".join(audit for _, audit in chosen), cost, *[sums[f] for f in figures]))
            convs.extend([value] * (len(chosen) + 1))

        def flushed():
            arrays = [pa.array(convs, kind), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]]
            convs.clear()
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

        now = None  # the conversation being read: its id, parts, blocks, figures, last initial
        for batch in batches:
            kind = batch.column(0).type
            for value, row in zip(batch.column(0).to_pylist(), batch.drop_columns(["conv"]).to_pylist()):
                if now is None or value != now[0]:
                    if now:
                        close(*now)
                    now = [value, Joined(), [], dict.fromkeys(figures, 0), None]
                now[1].add([(p["start"], p["end"], p["cost"], p["audit"]) for p in row["paths"]])
                now[2].append(row["block"])
                for name in figures:
                    now[3][name] += row[name]
                if now[4] is not None:  # the pair that the cut between two blocks parted
                    now[3]["illegal"] += now[4] + row["first"] not in LEGAL
                now[4] = row["last"]
            yield flushed()
        if now:
            close(*now)
            yield flushed()

    return _by_conversation(parts).mapInArrow(run, schema)


def _by_conversation(parts: DataFrame) -> DataFrame:
    """Parts of conversations, those of one in one task and in order. Tasks are few rows but much work, so they are not merged."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(tasks, "conv").sortWithinPartitions("conv", "block")


def _kept_turns(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """``conv, block, place, row, role`` of the turns that stay (``role`` null: their own) or are inserted (``row`` null)."""
    conv = StructType([placed.schema["conv"]]).simpleString()[len("struct<") : -1].replace(":", " ", 1)
    schema = f"{conv}, block long, place struct<idx:bigint,since:int>, row long, role string"

    def run(block, paths):
        import pyarrow as pa

        block = block.sort_by("idx")
        convs, rows, idx = block.column("conv"), block.column("row").to_pylist(), block.column("idx").to_pylist()
        initials, found = "".join(block.column("initial").to_pylist()), {p["conv"]: p for p in paths.to_pylist()}
        number, out = block.column("block")[0].as_py(), []
        keys = convs.to_pylist()
        for a, b in _runs(keys):
            path = found[keys[a]]
            for turn, (at, since), role in edited(initials[a:b], path["start"], path["audit"]):
                # an insertion follows the turns read so far; before the first it has the place before
                place = {"idx": idx[a] + at - 1, "since": since}
                out.append((a, place, None if turn is None else rows[a + turn], role))
        return pa.Table.from_arrays(
            [
                convs.take(pa.array([r[0] for r in out], pa.int64())).combine_chunks(),
                pa.array([number] * len(out), pa.int64()),
                pa.array([r[1] for r in out], pa.struct([("idx", pa.int64()), ("since", pa.int32())])),
                pa.array([r[2] for r in out], pa.int64()),
                pa.array([r[3] for r in out], pa.string()),
            ],
            names=["conv", "block", "place", "row", "role"],
        )

    left = placed.select("block", "idx", "conv", "row", "initial").groupBy("block")
    return left.cogroup(chosen.select("block", "conv", "start", "audit").groupBy("block")).applyInArrow(run, schema)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> Repaired:
    """The cheapest edits that give every conversation legal roles, and the repaired turns.

    Turns are read in the order of their number, null ones first, ties by role, then by a hash of the text. A null
    role or text counts as one blank; rows of a null conversation are one conversation. A role goes by its first
    character. A turn's first fault counts: blank, duplicate (role and text were read before in the conversation), truncated
    (its last visible character is none of ``.!?``). Keeping a turn is free, another role costs 1, deletion 2, an
    inserted empty turn 5, a truncated turn that is not deleted 5 more; blank and duplicate turns must be deleted. Of
    edits that cost the same the audit (initials K, R, D, I) that is least in ASCII order counts. ``gaps`` are the numbers
    missing between the smallest and the largest turn, ``illegal`` neighbouring turns whose initials are not su, ua or au.
    An empty table gives empty results. Other columns are ignored, whatever their names. Texts of any length are read whole.
    """
    blank = F.lit(" ")
    named = rows.select(
        col(conv_col).alias("conv"),
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col), blank).alias("role"),
        F.coalesce(col(text_col), blank).alias("text"),
    )
    stored = settle(
        named.withColumns({"mark": F.unhex(F.sha2("text", 256)), "row": F.monotonically_increasing_id()}), "turns"
    )
    placed = with_position(faults_of(stored), ["conv", "turn", "role", "mark", "row"], "idx").withColumn("block", F.expr(f"idx div {block}"))
    chosen = settle(_chosen(_parts(placed)), "edits")
    kept = settle(_kept_turns(placed, chosen.where("block IS NOT NULL")), "kept-turns")
    own = stored.select("row", F.col("role").alias("own_role"), "text")
    same = kept.where("row IS NOT NULL").join(own, "row").select("conv", "block", "place", F.coalesce("role", "own_role").alias("role"), "text")
    added = kept.where("row IS NULL").select("conv", "block", "place", "role", F.lit("").alias("text"))
    # one row per number of a conversation first, so that no task counts the numbers of a long one
    numbers = stored.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce((F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")).try_cast("long"), F.lit(0)).alias("gaps")
    )
    whole = chosen.where("block IS NULL").select(F.col("conv").alias("c"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    verdicts = numbers.join(whole, F.col("conv").eqNullSafe(F.col("c")))
    return Repaired(verdicts.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), same.unionByName(added))


def digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256``: SHA-256 of every conversation's lines ``role:text``, joined by line breaks.

    The lines of a block are joined first, in parallel; what is left of a conversation is hashed piece by piece, in its
    order, as the hash demands.
    """
    line = F.concat_ws(":", "role", "text")
    listed = turns.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
    pieces = listed.select("conv", "block", F.array_join(F.col("lines.line"), "\n").cast("binary").alias("piece"))
    schema = StructType([turns.schema["conv"], StructField("sha256", StringType())])

    def run(batches):
        import pyarrow as pa

        convs, hashes, kind, now = [], [], None, None

        def flushed():
            batch = pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(hashes, pa.string())], names=["conv", "sha256"])
            convs.clear()
            hashes.clear()
            return batch

        for batch in batches:
            kind = batch.column(0).type
            for value, piece in zip(batch.column(0).to_pylist(), batch.column(2)):
                if now is None or value != now[0]:
                    if now:
                        convs.append(now[0])
                        hashes.append(now[1].hexdigest())
                    now = (value, hashlib.sha256())
                else:
                    now[1].update(b"\n")
                now[1].update(piece.as_py())
            yield flushed()
        if now:
            convs.append(now[0])
            hashes.append(now[1].hexdigest())
            yield flushed()

    return _by_conversation(pieces).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that the query repairs, dealt by ``crc32(conv_id:turn) % 20``."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    spoilt = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("times"))
    return spoilt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "copy")


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table: figures, cost, audit and hash of its repaired form.

    A conversation of which the damage leaves no row has zeros, an empty audit and the hash of the empty text.
    """
    done = repair(damaged(conversations))
    hashed = digests(done.turns).select(F.col("conv").alias("h"), "sha256")
    every = conversations.select("conv_id").distinct()
    joined = every.join(done.verdicts, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        hashed, F.col("conv_id").eqNullSafe(F.col("h")), "left"
    )
    zero, empty = F.lit(0).cast("long"), hashlib.sha256(b"").hexdigest()
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(f), zero).alias(f) for f in figures],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def op12(spark, folder):
    return repaired_conversations(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Run] = {"op12_conversation_repair": op12}


def _sql() -> str:
    """The same in SQL: one step per turn over the best edits (cost, audit, lines) of each top of all conversations."""

    def more(node: str, cost: str, edit: str, line: str | None = None, only: str = "true") -> str:
        lines = f"list_append({node}.lines, {line})" if line else f"{node}.lines"
        made = f"struct_pack(cost := {node}.cost + {cost}, audit := {node}.audit || '{edit}', lines := {lines})"
        return f"CASE WHEN {node} IS NOT NULL AND {only} THEN {made} END"

    def insert(node: str, role: str) -> str:
        return more(node, str(INSERT), "I", f"'{role}:'")

    extra, free = f"CASE WHEN fault = 't' THEN {TRUNCATED} ELSE 0 END", "fault NOT IN ('b', 'd')"
    delete = {node: more(node, str(DELETE), "D") for node in "nsup"}

    def keep(node: str, initial: str) -> str:
        return more(node, extra, "K", "role || ':' || text", f"{free} AND i = '{initial}'")

    def rerole(node: str, role: str) -> str:
        return more(node, f"{REROLE} + {extra}", "R", f"'{role}:' || text", free)

    to_user = ", ".join(f"{keep(node, 'u')}, {rerole(node, 'user')}" for node in "nsp")
    read = f"""
        SELECT conv_id, turns, {delete['n']} AS n, least({delete['s']}, {keep('n', 's')}) AS s,
               least({delete['u']}, {to_user}) AS u, least({delete['p']}, {keep('u', 'a')}, {rerole('u', 'assistant')}) AS p
        FROM (SELECT state.conv_id, state.turns + 1 AS turns, n, s, u, p, i, fault, role, text
              FROM state JOIN faults f ON f.conv_id IS NOT DISTINCT FROM state.conv_id AND f.place = state.turns + 1)"""
    by_user = ", ".join(insert(node, "user") for node in "nsp")
    once = f"SELECT conv_id, turns, n, s, least(u, {by_user}) AS u, p FROM ({read})"
    twice = f"SELECT conv_id, turns, n, s, u, least(p, {insert('u', 'assistant')}) AS p FROM ({once})"
    none = "struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := CAST([] AS VARCHAR[]))"
    begin = f"SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS turns, {none} AS n, CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])) AS s FROM conversations"
    begin = f"SELECT *, least({insert('u', 'assistant')}) AS p FROM (SELECT *, {insert('n', 'user')} AS u FROM ({begin}))"
    return f"""
WITH RECURSIVE bits AS (
    SELECT range AS byte, range AS c, 0 AS k FROM range(256)
    UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations),
kinds AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]))) % 20 AS kind
    FROM keyed, crc),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, range(2) copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
    SELECT *, left(role, 1) AS i,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place
    FROM damaged),
faults AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '.' END AS fault,
        lag(i) OVER (PARTITION BY conv_id ORDER BY place) || i AS pair
    FROM placed),
figures AS (
    SELECT conv_id, max(place) AS turns, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
           count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id),
state AS ({begin} UNION ALL {twice}),
best AS (SELECT conv_id, turns, least(n, p) AS edits FROM state)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, edits.cost AS cost, edits.audit AS audit,
       sha256(array_to_string(edits.lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
WHERE b.turns = coalesce(f.turns, 0)
""".strip()


SQL: dict[str, str] = {"op12_conversation_repair": _sql()}
