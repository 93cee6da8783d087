r"""Conversation structure repair (operator 13): cheapest edits by a dynamic programme with a persistent audit.

Rows of a conversation are kept (K), given the role user or assistant (R), deleted (D), or an empty user or
assistant row is inserted (I), so that the initials of the roles read ``(s?(ua)+)?``.  The programme has
four states (nothing yet, after s, after u, after a) and for each the cheapest edits so far and the
ASCII-least audit among these.  An audit is a linked node: its edits of the last row after the node of the rows before, so
audits share their prefixes and a step costs a few nodes.  Every node knows its ancestors 1, 2, 4, ... rows
up and a rolling hash of its whole audit.  Two audits of equal cost are compared by their longest common
prefix: ancestors with different hashes are skipped from long jumps to short, then the edits
after the last equal ancestors decide.  That these are equal is verified, node by node up to one that both share, so a
collision of hashes is noticed and the difference above it counts.  (Inserted rows go with the row
after them, so of two audits' different edits of a row none is a prefix of the other, and the first difference decides.)

A conversation of any length is spread over tasks.  Rows get their places by a scan over range partitions, and every
``CHUNK`` rows are solved for themselves, from each state they may begin in to each they may end in.  The chunks of
a conversation are then put together by the same programme whose steps are chunks and whose edits are the
chunks' audits; only these narrow results meet in one task.  Repaired rows are streamed in order with
bounded memory; their hash is a sequence, so one task reads a conversation's texts.

Defined cases: null roles and texts are one space (such a text is blank), null turns come first and don't count for gaps,
rows without a conv_id form one conversation with a null id; equal turns are ordered by role and a hash of
the text, a repeated row follows its original; a conversation without rows has zeros and empty results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, small_batches, written
from .prefix_scan import digest_of, scan
from .prefix_trie import CRC32

#: Rows that are solved at once.
CHUNK = 2048
# Fixed values of the contract: costs of the edits and of an undeleted truncated row, and the pairs of initials that may follow each other.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after s, after u, after a; the number of inserted rows that lead from one to another.
START, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = {START: {START: 0, USER: 1, ASSISTANT: 2}, SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2},
            USER: {USER: 0, ASSISTANT: 1}, ASSISTANT: {ASSISTANT: 0, USER: 1}}
#: What must still be inserted at the end.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: Modulus and base of the audits' hashes.
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51


def _ways(initial: str, fault: str) -> dict[int, dict[int, tuple[int, str]]]:
    """state -> next state -> (cost, edits) of the cheapest, ASCII-least edits of one row and inserts before it."""
    out: dict[int, dict[int, tuple[int, str]]] = {}
    for state, reached in INSERTED.items():
        best = out[state] = {}
        for at, n in reached.items():
            follows = ASSISTANT if at == USER else USER
            ways = [(DELETE, "D", at)]
            if fault not in ("blank", "duplicate"):
                late = TRUNCATED if fault == "truncated" else 0
                ways.append((RELABEL + late, "R", follows))
                if initial == "s" and at == START:
                    ways.append((late, "K", SYSTEM))
                elif initial == "a" and follows == ASSISTANT or initial == "u" and follows == USER:
                    ways.append((late, "K", follows))
            for cost, edit, to in ways:
                way = (cost + INSERT * n, "I" * n + edit)
                best[to] = min(best.get(to, way), way)
    return out


#: By a row's initial and its fault.
MOVES = {(i, f): _ways(i, f) for i in ("s", "u", "a", "") for f in ("blank", "duplicate", "truncated", "")}


def _number(edits: str) -> int:
    return int.from_bytes(hashlib.blake2b(edits.encode(), digest_size=8).digest(), "big") % PRIME


#: The numbers of one row's edits.
_SHORT = {"I" * n + e: _number("I" * n + e) for n in range(3) for e in "DKR"}


class Audit:
    """The audit of some steps: the last one's edits after the audit of those before."""

    __slots__ = ("edits", "hash", "up")

    def __init__(self, before: Audit | None, edits: str):
        self.edits = edits
        if before is None:
            self.hash, self.up = 0, ()
            return
        self.hash = (before.hash * BASE + (_SHORT[edits] if edits in _SHORT else _number(edits))) % PRIME
        up, k = [before], 0
        while k < len(up[k].up):  # the ancestor twice as far up
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def text(self) -> str:
        parts, node = [], self
        while node.up:
            parts.append(node.edits)
            node = node.up[0]
        return "".join(reversed(parts))


def difference(x: Audit, y: Audit) -> tuple[str, str] | None:
    """The edits of the first step in which two audits of equally many steps differ, None if they don't."""
    for k in reversed(range(len(x.up))):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    first = None
    while x is not y:  # the hashes of what is above are equal; that it is equal is verified up to a shared node
        if x.edits != y.edits:
            first = (x.edits, y.edits)
        x, y = x.up[0], y.up[0]
    return first


def _least(ways: Sequence[tuple[int, Audit, str]]) -> tuple[int, Audit, str]:
    """The cheapest, ASCII-least of (cost, audit before, edits)."""
    best = ways[0]
    for way in ways[1:]:
        if way[0] > best[0]:
            continue
        if way[0] == best[0]:
            a, b = (difference(way[1], best[1]) or (way[2], best[2]))
            if a >= b:
                continue
        best = way
    return best


def _step(now: dict[int, tuple[int, Audit]], moves: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, Audit]]:
    ways: dict[int, list] = {}
    for state, (cost, audit) in now.items():
        for to, (more, edits) in moves.get(state, {}).items():
            ways.setdefault(to, []).append((cost + more, audit, edits))
    out = {}
    for to, w in ways.items():
        cost, audit, edits = _least(w) if len(w) > 1 else w[0]
        out[to] = (cost, Audit(audit, edits))
    return out


def solve(rows: Sequence[tuple[str, str]], state: int = START) -> dict[int, tuple[int, str]]:
    """state after the (initial, fault) rows -> (cost, audit), from one state before them."""
    now = {state: (0, Audit(None, ""))}
    for initial, fault in rows:
        now = _step(now, MOVES[initial if initial in ("s", "u", "a") else "", fault])
    return {s: (cost, audit.text()) for s, (cost, audit) in now.items()}


def compose(chunks: Sequence[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """(cost, audit) of the whole conversation from its chunks' solutions by state before and after."""
    now = {START: (0, Audit(None, ""))}
    for solutions in chunks:
        now = _step(now, solutions)
    ends = [(cost + INSERT * CLOSING[s], audit, "I" * CLOSING[s]) for s, (cost, audit) in sorted(now.items())]
    cost, audit, edits = _least(ends)
    return cost, audit.text() + edits


# ----------------------------------------------------------------------------- Spark

_FAULTS = ("blank", "duplicate", "truncated")
_SOLVED = ("conv_id long, chunk long, first_turn long, last_turn long, n_turns long, first_initial string, last_initial string, "
           "blank long, duplicate long, truncated long, illegal long, solutions array<struct<from:int,to:int,cost:long,audit:string>>")
_WHOLE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(schema)], schema=schema)


_WAYS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SOLVED_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in _SOLVED.split(", ")[:11]]
                          + [("solutions", _WAYS)])
_WHOLE_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in _WHOLE.split(", ")])


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]) -> Iterator[tuple[tuple, list[tuple]] | None]:
    """(key, rows) of sorted rows; None after each batch."""
    now, rows = None, []
    for batch in batches:
        for key, row in zip(zip(*(batch.column(c).to_pylist() for c in keys)), zip(*(batch.column(c).to_pylist() for c in values))):
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
        yield None
    if rows:
        yield now, rows


def _emitted(groups: Iterator, of: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    for group in groups:
        if group is not None:
            done.append(of(*group))
        elif done:
            yield _batch(done, schema)
            done = []
    if done:
        yield _batch(done, schema)


def _solve_chunk(key: tuple, rows: list[tuple]) -> tuple:
    turns = [t for t, _, _ in rows if t is not None]
    initials = [i for _, i, _ in rows]
    faults = [f for _, _, f in rows]
    pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    begins = [START] if key[1] == 0 else [START, SYSTEM, USER, ASSISTANT]
    ways = [{"from": b, "to": s, "cost": cost, "audit": audit}
            for b in begins for s, (cost, audit) in sorted(solve(list(zip(initials, faults)), b).items())]
    return (*key, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), initials[0], initials[-1],
            *(faults.count(f) for f in _FAULTS), pairs, ways)


def _solve_whole(key: tuple, rows: list[tuple]) -> tuple:
    counts = [sum(r[5 + i] for r in rows) for i in range(4)]
    first = last = initial = None
    turns, chunks = 0, []
    for begin, end, n, i, j, *_, ways in rows:
        if initial is not None and initial + i not in LEGAL:
            counts[3] += 1
        initial = j
        if begin is not None:
            turns += n - (begin == last)
            first, last = begin if first is None else first, end
        by: dict[int, dict[int, tuple[int, str]]] = {}
        for w in ways:
            by.setdefault(w["from"], {})[w["to"]] = (w["cost"], w["audit"])
        chunks.append(by)
    cost, audit = compose(chunks)
    return (*key, last - first + 1 - turns if turns else 0, *counts, cost, audit)


def placed(rows: DataFrame) -> DataFrame:
    """conv_id, pos, turn, role, text, fault of the rows of all conversations, in order.

    ``rows``: conv_id, turn, role, text without null roles or texts.
    """
    text, marks = F.col("text"), rf"[.!?][{SPACE}]*\z"
    work = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        digest_of(F.col("role"), text).alias("digest"), (~text.rlike(f"[^{SPACE}]")).alias("blank"), (~text.rlike(marks)).alias("open"),
        F.monotonically_increasing_id().alias("number"))  # equal rows are interchangeable
    at = scan(work, "conv_id", [F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), F.col("number")], "repair-rows", hashed=False)
    twice = at.groupBy("conv_id", "digest").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first_pos")
    fault = (F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first_pos"), "duplicate")
             .when(F.col("open"), "truncated").otherwise(""))
    return at.join(twice, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv_id", "pos", "turn", "role", "text", fault.alias("fault"))


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: the faults of its structure, the least cost of mending them and the audit."""
    narrow = rows.select("conv_id", F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"), "pos", "turn",
                         F.substring("role", 1, 1).alias("initial"), "fault")
    solved = narrow.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "pos").mapInArrow(
        lambda b: _emitted(_grouped(b, ["conv_id", "chunk"], ["turn", "initial", "fault"]), _solve_chunk, _SOLVED_ARROW), _SOLVED)
    values = _SOLVED_ARROW.names[2:]
    return solved.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        lambda b: _emitted(_grouped(b, ["conv_id"], values), _solve_whole, _WHOLE_ARROW), _WHOLE)


_REPAIRED = "conv_id long, at long, edit string, role string, text string"
_REPAIRED_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in _REPAIRED.split(", ")])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Carries out audits: the row with pos 0 holds a conversation's audit, its rows follow in order."""
    audit, at, n, rows, state = "", 0, 0, 0, START
    out: list[tuple] = []

    def put(conv: int | None, edit: str, role: str, text: str) -> None:
        nonlocal n, state
        if edit in "IR":
            role = "assistant" if state == USER else "user"
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        n += 1
        out.append((conv, n, edit, role, text))

    def insert(conv: int | None) -> None:
        nonlocal at
        while audit[at:at + 1] == "I":
            put(conv, "I", "", "")
            at += 1

    for batch in batches:
        for conv, pos, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "pos", "role", "text"))):
            if pos == 0:
                audit, at, n, state = text, 0, 0, START
                rows = len(audit) - audit.count("I")  # each row has one other edit
                continue
            insert(conv)
            if audit[at] != "D":
                put(conv, audit[at], role, text)
            at += 1
            if pos == rows:
                insert(conv)
        if out:
            yield _batch(out, _REPAIRED_ARROW)
            out = []


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the mended conversations (conv_id, at from 1, edit, role, text); each conversation's stand in order."""
    small_batches(rows.sparkSession)
    heads = found.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text"))
    work = rows.select("conv_id", "pos", "role", "text").unionByName(heads)
    return work.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_apply, _REPAIRED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    now, sha = None, None
    for batch in batches:
        done = []
        for conv, at, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "at", "role", "text"))):
            if at == 1:
                if sha is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = conv, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if done:
            yield _batch(done, schema)
    if sha is not None:
        yield _batch([(now, sha.hexdigest())], schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's faults, dealt out by a checksum of each row's conversation and turn."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.withColumn("kind", kind).where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def repair_table(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after damage: its faults, the least cost, the audit and the repaired rows' hash."""
    rows = written(placed(damaged(conversations)), "repair-placed")
    found = written(audits(rows), "repair-audits")
    hashes = repaired_rows(rows, found).mapInArrow(_digest, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "h")
    names = found.columns[1:]
    found = found.withColumnRenamed("conv_id", "c")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    return (every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("h")), "left")
            .select("conv_id", *[F.coalesce(n, F.lit("" if n == "audit" else 0)).alias(n) for n in names],
                    F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))


def _oracle_step() -> str:
    """A step of the dynamic programme as SQL: ``a`` holds for each state the padded cost, the audit, a mark and the repaired rows."""
    cost, audit, rows = "left(a[{0}], 9)::INT", "substr(a[{0}], 10, strpos(a[{0}], chr(1)) - 10)", "substr(a[{0}], strpos(a[{0}], chr(1)) + 1)"
    ways: list[list[str]] = [[], [], [], []]
    late = "if(r[2] = 'truncated', 5, 0)"
    alive, initial = "r[2] NOT IN ('blank', 'duplicate')", "left(r[1], 1)"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    own, body = "chr(10) || r[1] || ':' || r[3]", "r[3]"
    # rows inserted first: from, to, edits, what they read
    for q, at, marks, put in ((0, 0, "", "''"), (1, 1, "", "''"), (2, 2, "", "''"), (3, 3, "", "''"), (0, 2, "I", user), (1, 2, "I", user),
                              (3, 2, "I", user), (2, 3, "I", assistant), (0, 3, "II", f"{user} || {assistant}"), (1, 3, "II", f"{user} || {assistant}")):
        base = 5 * len(marks)
        to, told = (3, assistant) if at == 2 else (2, user)
        edits = [("true", f"{base + 2}", "D", at, "''"), (alive, f"{base + 1} + {late}", "R", to, f"{told} || {body}"),
                 (f"{alive} AND {initial} = '{'a' if to == 3 else 'u'}'", f"{base} + {late}", "K", to, own)]
        if at == 0:
            edits.append((f"{alive} AND {initial} = 's'", f"{base} + {late}", "K", 1, own))
        for when, more, edit, state, read in edits:
            ways[state].append(f"CASE WHEN {when} THEN lpad(({cost.format(q + 1)} + {more})::VARCHAR, 9, '0') || {audit.format(q + 1)} "
                               f"|| '{marks}{edit}' || chr(1) || {rows.format(q + 1)} || {put} || {read} END")
    return "[" + ", ".join(f"list_min([{', '.join(w)}])" for w in ways) + "]"


ORACLE = rf"""
WITH d0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d0 WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                sha256(length(role) || ':' || role || length(text) || ':' || text)) AS pos FROM d),
f AS (SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
             count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, list([role, fault, text] ORDER BY pos) AS rows
      FROM f GROUP BY conv_id),
s AS (SELECT g.*, list_reduce(list_prepend(['000000000' || chr(1), NULL, NULL, NULL], rows), lambda a, r: {_oracle_step()}) AS a FROM g),
e AS (SELECT s.*, list_min([a[1], a[4],
          lpad((left(a[3], 9)::INT + 5)::VARCHAR, 9, '0') || substr(a[3], 10, strpos(a[3], chr(1)) - 10) || 'I' || substr(a[3], strpos(a[3], chr(1)))
              || chr(10) || 'assistant:',
          lpad((left(a[2], 9)::INT + 10)::VARCHAR, 9, '0') || substr(a[2], 10, strpos(a[2], chr(1)) - 10) || 'II' || substr(a[2], strpos(a[2], chr(1)))
              || chr(10) || 'user:' || chr(10) || 'assistant:']) AS best FROM s)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost,
       coalesce(substr(best, 10, strpos(best, chr(1)) - 10), '') AS audit, sha256(coalesce(substr(best, strpos(best, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
