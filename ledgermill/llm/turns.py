"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

A conversation's rows stand in turn order (nulls first; equal turns by role, then text, so equal rows stay together).
Edits are Keep (0), Rerole to user or assistant (2), Delete (3; blank and repeated rows must go) and Insert of an
empty user or assistant turn (2); a row that stays although it is cut off costs 1 more. Dijkstra runs on the implicit
lattice of (turn index, grammar state) with priority (cost, audit) and stops at the first accepting end node that it
pops; the audit is the edits' initials. Two equally cheap audits at one node are never one the other's beginning (what
follows could only be inserts, which cost), so the order of audits survives each appended edit.

Rows are dealt by ranges of (conversation, turn, role, text), so that a conversation with a third of all rows spreads
over many tasks. One that lies whole in a task and has at most BLOCK rows is repaired there. Others, and those at the
edge of a task, go by blocks of at most BLOCK rows: Dijkstra from each state to each state within a block, then over
the blocks in the same order of (cost, audit). A conversation's digest needs its repaired turns one after another;
they stream through one task without being held.

Defined cases: a null role or text is one space, a null turn sorts first and takes no part in gaps, a null conv_id is a
conversation of its own; a role without letters has no initial and cannot be kept; roles count by their first letter as
it is; an empty table gives no rows; a conversation of which no row is left gives zeros; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise, table

BLOCK = 256
SPACE = " \t\n\v\f\r"
#: Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: state: what a kept initial leads to.
KEEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: state: the state and the role of a turn that is inserted or given another role.
MAKES = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = ("su", "ua", "au")
WAYS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))
STEPS = pa.list_(pa.struct([("task", pa.int32()), ("block", pa.int64()), ("state", pa.int64()), ("edits", pa.string())]))
NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Turn(NamedTuple):
    initial: str
    must_go: bool
    cut: bool


def cheapest(turns: Sequence[Turn], start: int = START) -> Iterator[tuple[int, str, int]]:
    """(cost, audit, state) of the end nodes, each once, in the order of (cost, audit)."""
    heap, done, n = [(0, "", 0, start)], set(), len(turns)
    while heap:
        cost, audit, at, state = heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        made = MAKES[state][0]
        if at == n:
            yield cost, audit, state
        else:
            turn = turns[at]
            heappush(heap, (cost + 3, audit + "D", at + 1, state))
            if not turn.must_go:
                kept = KEEPS[state].get(turn.initial)
                if kept is not None:
                    heappush(heap, (cost + turn.cut, audit + "K", at + 1, kept))
                heappush(heap, (cost + 2 + turn.cut, audit + "R", at + 1, made))
        heappush(heap, (cost + 2, audit + "I", at, made))


def edited(audit: str, rows: Sequence[tuple[str, str]], state: int = START) -> list[str]:
    """``role:text`` of the turns that the audit leaves of rows (role, text)."""
    out, left = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEPS[state][role[:1]]
        else:
            state, role = MAKES[state]
        out.append(f"{role}:{text}")
    return out


def faults(rows: Sequence[tuple[str, str]], repeated: Callable[[int], bool]) -> tuple[list[Turn], int, int, int]:
    """Turns of rows (role, text), and how many are blank, repeated (by index) and cut off."""
    turns, blank, again, cut = [], 0, 0, 0
    for k, (role, text) in enumerate(rows):
        said = text.rstrip(SPACE)
        empty = not said
        same = not empty and repeated(k)
        short = not empty and not same and said[-1] not in ".!?"
        blank, again, cut = blank + empty, again + same, cut + short
        turns.append(Turn(role[:1], empty or same, short))
    return turns, blank, again, cut


def illegal_pairs(initials: Sequence[str]) -> int:
    return sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))


def repaired(turn_numbers: Sequence[int | None], rows: Sequence[tuple[str, str]]) -> tuple:
    """NUMBERS, audit and digest of a whole conversation."""
    seen: dict[tuple[str, str], int] = {}
    first = [seen.setdefault(row, k) for k, row in enumerate(rows)]
    turns, blank, again, cut = faults(rows, lambda k: first[k] != k)
    known = {x for x in turn_numbers if x is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    cost, audit, _ = next(x for x in cheapest(turns) if x[2] in ACCEPTING)
    digest = hashlib.sha256("\n".join(edited(audit, rows)).encode()).hexdigest()
    return gaps, blank, again, cut, illegal_pairs([x.initial for x in turns]), cost, audit, digest


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults that crc32(``conv_id:turn``) % 20 chooses: 0 drops the row, 1 empties its
    text, 2 takes its ``.!?``, 3 repeats it, 4 makes it a user's."""
    given = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(given("conv_id"), F.lit(":"), given("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat("kind", F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1))
    hurt = rows.withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": text})
    return hurt.withColumn("kind", F.explode(times)).drop("kind")


def _stream(kinds: list[pa.DataType], block: int):
    """Rows in order in; conversations that lie whole in the task come out repaired, rows of others with their place."""
    ids, numbers = kinds
    names = ["conv_id", *NUMBERS, "audit", "repaired_sha256", "task", "place", "turn", "role", "text"]
    types = [ids, *[pa.int64()] * len(NUMBERS), pa.string(), pa.string(), pa.int32(), pa.int64(), numbers, pa.string(), pa.string()]
    shape = pa.schema(list(zip(names, types)))

    def run(batches):
        task, place = TaskContext.get().partitionId(), 0
        out: list[tuple] = []
        conv, buffer, edge, long = None, [], True, False  # edge: the task's first conversation may have begun before

        def let_go():
            nonlocal place
            for turn, role, text in buffer:
                out.append((conv, *[None] * 8, task, place, turn, role, text))
                place += 1
            buffer.clear()

        def ended(last: bool):
            nonlocal edge, long
            if edge or long or last:
                let_go()
            else:
                out.append((conv, *repaired([x[0] for x in buffer], [x[1:] for x in buffer]), *[None] * 5))
                buffer.clear()
            edge, long = False, False

        def flushed():
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], schema=shape)

        begun = False
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text"))):
                if begun and row[0] != conv:
                    ended(False)
                begun, conv = True, row[0]
                buffer.append(row[1:])
                if len(buffer) > block:
                    long = True
                    let_go()
            yield flushed()
        ended(True)
        yield flushed()

    return run


def _paths(table: pa.Table) -> pa.Table:
    """One block's faults, its outer initials and its cheapest ways from each state to each."""
    rows = table.sort_by("place").to_pydict()
    said = list(zip(rows["role"], rows["text"]))
    turns, blank, again, cut = faults(said, lambda k: not rows["first"][k])
    initials = [x.initial for x in turns]
    ways = [{"start": s, "end": e, "cost": c, "audit": a} for s in range(4) for c, a, e in cheapest(turns, s)]
    found = {"blank": [blank], "duplicate": [again], "truncated": [cut], "illegal": [illegal_pairs(initials)], "head": [initials[0]], "tail": [initials[-1]]}
    return pa.table({**{x: table.column(x).slice(0, 1) for x in ("conv_id", "task", "block")}, **found, "ways": pa.array([ways], WAYS)})


def _chained(table: pa.Table) -> pa.Table:
    """The blocks of one conversation in order: its numbers, and each block's start and audit on the cheapest way."""
    blocks = table.sort_by([("task", "ascending"), ("block", "ascending")]).to_pydict()
    best: dict[int, tuple[int, str, tuple | None]] = {START: (0, "", None)}
    for ways in blocks["ways"]:
        reached: dict[int, tuple[int, str, tuple | None]] = {}
        for way in ways:
            if way["start"] in best:
                cost, audit, _ = before = best[way["start"]]
                new = (cost + way["cost"], audit + way["audit"])
                if way["end"] not in reached or new < reached[way["end"]][:2]:
                    reached[way["end"]] = (*new, (way, before))
        best = reached
    cost, audit, back = min((best[s] for s in ACCEPTING if s in best), key=lambda x: x[:2])
    steps = []
    while back is not None:
        way, before = back
        steps.append((way["start"], way["audit"]))
        back = before[2]
    steps = [{"task": t, "block": b, "state": s, "edits": e} for t, b, (s, e) in zip(blocks["task"], blocks["block"], reversed(steps))]
    between = sum(x + y not in LEGAL for x, y in zip(blocks["tail"], blocks["head"][1:]))
    found = {x: [sum(blocks[x])] for x in ("blank", "duplicate", "truncated", "illegal")} | {"cost": [cost], "audit": [audit]}
    found["illegal"][0] += between
    return pa.table({"conv_id": table.column("conv_id").slice(0, 1), **found, "steps": pa.array([steps], STEPS)})


def _piece(rows: pa.Table, step: pa.Table) -> pa.Table:
    """The repaired turns of one block as one text, null if there are none."""
    said, way = rows.sort_by("place").to_pydict(), step.to_pydict()
    lines = edited(way["edits"][0], list(zip(said["role"], said["text"])), way["state"][0])
    piece = pa.array(["\n".join(lines) if lines else None], pa.string())
    return pa.table({**{x: rows.column(x).slice(0, 1) for x in ("conv_id", "task", "block")}, "piece": piece})


def _digests(batches):
    """Digests of pieces that come in order, conversation after conversation; nothing but the hash is held."""
    conv, hasher, fresh = None, None, True
    for batch in batches:
        ids, out = [], []
        for new, piece in zip(batch.column("conv_id").to_pylist(), batch.column("piece").to_pylist()):
            if hasher is not None and new != conv:
                ids.append(conv)
                out.append(hasher.hexdigest())
                hasher = None
            if hasher is None:
                conv, hasher, fresh = new, hashlib.sha256(), True
            if piece is not None:
                hasher.update(piece.encode() if fresh else b"\n" + piece.encode())
                fresh = False
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("conv_id").type), pa.array(out, pa.string())], names=["conv_id", "repaired_sha256"])
    if hasher is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field("conv_id").type), pa.array([hasher.hexdigest()])], names=["conv_id", "repaired_sha256"])


def _same(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that nulls of the key meet in, too."""
    other = right.withColumnRenamed(key, f"_{key}")
    return left.join(other, F.col(key).eqNullSafe(F.col(f"_{key}"))).drop(f"_{key}")


def by_blocks(rows: DataFrame, ids: str, block: int = BLOCK) -> DataFrame:
    """The repair of conversations that do not lie whole in one task: rows (conv_id, task, place, turn, role, text)."""
    at = ["conv_id", "task", "block"]
    firsts = rows.groupBy("conv_id", "role", "text").agg(F.min(F.struct("task", "place")).alias("at")).select("at.*", F.lit(True).alias("first"))
    marked = rows.join(firsts, ["task", "place"], "left").withColumns({"first": F.coalesce("first", F.lit(False)), "block": F.floor(F.col("place") / block)})
    way = "array<struct<start:long,end:long,cost:long,audit:string>>"
    counts = "blank long, duplicate long, truncated long, illegal long"
    paths = marked.groupBy(*at).applyInArrow(_paths, f"conv_id {ids}, task int, block long, {counts}, head string, tail string, ways {way}")
    steps = "array<struct<task:int,block:long,state:long,edits:string>>"
    chained = materialise(paths.groupBy("conv_id").applyInArrow(_chained, f"conv_id {ids}, {counts}, cost long, audit string, steps {steps}"), "turns-chained")
    known = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    todo = chained.select("conv_id", F.explode("steps").alias("step")).select("conv_id", "step.*")
    pieces = marked.groupBy(*at).cogroup(todo.groupBy(*at)).applyInArrow(_piece, f"conv_id {ids}, task int, block long, piece string")
    digests = pieces.repartition("conv_id").sortWithinPartitions(*at).mapInArrow(_digests, f"conv_id {ids}, repaired_sha256 string")
    return _same(_same(chained.drop("steps"), known, "conv_id"), digests, "conv_id")


def repair_turns(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, NUMBERS, audit, repaired_sha256 of the conversations that have rows (conv_id, turn, role, text)."""
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ids, numbers = (given.schema[x].dataType.simpleString() for x in ("conv_id", "turn"))
    order = [F.col(x).asc_nulls_first() for x in ("conv_id", "turn", "role", "text")]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = [to_arrow_type(given.schema[x].dataType) for x in ("conv_id", "turn")]
    numbers_ddl = ", ".join(f"{x} long" for x in NUMBERS)
    shape = f"conv_id {ids}, {numbers_ddl}, audit string, repaired_sha256 string, task int, place long, turn {numbers}, role string, text string"
    streamed = materialise(dealt.mapInArrow(_stream(kinds, block), shape), "turns")
    out = ["conv_id", *NUMBERS, "audit", "repaired_sha256"]
    rest = streamed.where("place is not null").select("conv_id", "task", "place", "turn", "role", "text")
    return streamed.where("place is null").select(*out).unionByName(by_blocks(rest, ids, block).select(*out))


def op13_turn_repair(spark, sf_dir: str) -> DataFrame:
    """The repair of all conversations, damaged as damaged() says."""
    given = table(spark, sf_dir, "conversations")
    hurt = damaged(given)
    found = repair_turns(hurt)
    gone = F.sha2(F.lit("").cast("binary"), 256)
    every = given.select("conv_id", F.lit(False).alias("left")).unionByName(hurt.select("conv_id", F.lit(True).alias("left")))
    lost = every.groupBy("conv_id").agg(F.max("left").alias("left")).where(~F.col("left"))
    nothing = lost.select("conv_id", *(F.lit(0).cast("long").alias(x) for x in NUMBERS), F.lit("").alias("audit"), gone.alias("repaired_sha256"))
    return found.unionByName(nothing)


#: cost and audit as one text that sorts as (cost, audit).
_ADDED = "(printf('%010d', CAST(({0})[1:10] AS INTEGER) + ({1})) || ({0})[11:] || '{2}')"


def _sql() -> str:
    keep = lambda state, letter: f"CASE WHEN NOT must_go AND initial = '{letter}' THEN {_ADDED.format(state, 'cut', 'K')} END"
    made = lambda state: f"CASE WHEN NOT must_go THEN {_ADDED.format(state, '2 + cut', 'R')} END"
    gone = lambda state: _ADDED.format(state, "3", "D")
    put = lambda state: _ADDED.format(state, "2", "I")
    before_u = "least(b0, b1, b3)"
    crc = "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda j: CAST(ascii(k[j]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), kinds AS (
  SELECT *, xor({crc}, 4294967295) % 20 AS kind FROM keyed
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt
), seen AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') AS short
  FROM numbered
), rows AS (
  SELECT *, blank OR again AS must_go, CAST(NOT blank AND NOT again AND short AS INTEGER) AS cut,
         i > 1 AND (lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial) NOT IN ('su', 'ua', 'au') AS illegal
  FROM seen
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
         count(*) FILTER (illegal) AS illegal
  FROM rows GROUP BY conv_id
), steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS b0, CAST(NULL AS VARCHAR) AS b1, '0000000002I' AS b2, '0000000004II' AS b3 FROM counted
  UNION ALL
  SELECT conv_id, i, b0, b1, b2, least(b3, {put("b2")}) FROM (
    SELECT conv_id, i, b0, b1, least(b2, {put(before_u)}) AS b2, b3 FROM (
      SELECT s.conv_id, r.i, {gone("b0")} AS b0, least({gone("b1")}, {keep("b0", "s")}) AS b1,
             least({gone("b2")}, {keep(before_u, "u")}, {made(before_u)}) AS b2, least({gone("b3")}, {keep("b2", "a")}, {made("b2")}) AS b3
      FROM steps s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1))
), best AS (
  SELECT c.*, CAST(least(b0, b3)[1:10] AS BIGINT) AS cost, least(b0, b3)[11:] AS audit
  FROM counted c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n
), letters AS (
  SELECT conv_id, p, audit[p] AS edit, sum(CAST(audit[p] <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY p) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)
), kept AS (
  SELECT l.conv_id, l.edit, r.role, r.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY p) AS j
  FROM letters l LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i AND l.edit <> 'I' WHERE l.edit <> 'D'
), placed AS (
  SELECT *, j - max(CAST(j = 1 AND edit = 'K' AND left(role, 1) = 's' AS INTEGER)) OVER (PARTITION BY conv_id) AS nth FROM kept
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS told
  FROM placed GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP13_SQL = _sql()
