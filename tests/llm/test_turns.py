"""Repair of conversations against a search of all edits, in one piece and by blocks."""

import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgermill.llm.turns import ACCEPTING, OP13_SQL, Turn, cheapest, damaged, op13_turn_repair, repair_turns

ROWS = "conv_id long, turn int, role string, text string"
SPACE = " \t\n\v\f\r"


def plain(rows):
    """numbers, audit, digest of rows (turn, role, text) by trying every edit, two inserts in a row at most."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    seen, kinds = set(), []
    for _, role, text in rows:
        kinds.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    begun = re.compile("(s?(ua)*u?)?")

    def ways(k, inserts, so_far):
        """(cost, audit, roles and texts) of all edits from row k on whose roles may still become right."""
        if not begun.fullmatch(so_far):
            return
        if k == len(rows) and so_far[-1:] not in ("s", "u"):
            yield 0, "", ()
        steps = [("I", 2, k, r, "") for r in ("user", "assistant") if inserts < 2]
        if k < len(rows):
            _, role, text = rows[k]
            cut = kinds[k] == "truncated"
            steps.append(("D", 3, k + 1, None, None))
            if kinds[k] not in ("blank", "duplicate"):
                steps += [("K", cut, k + 1, role, text)] * bool(role) + [("R", 2 + cut, k + 1, r, text) for r in ("user", "assistant")]
        for edit, cost, at, role, text in steps:
            own = () if role is None else ((role, text),)
            for c, a, t in ways(at, inserts + 1 if edit == "I" else 0, so_far + (role or "")[:1]):
                yield c + cost, edit + a, own + t

    cost, audit, told = min(ways(0, 0, ""))
    turns = [x[0] for x in rows if x[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in told).encode()).hexdigest()
    return (gaps, *(kinds.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def drawn(seed, most):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(6)]), rng.choice(["system", "user", "assistant", "tool", " ", ""]), rng.choice(["Yes.", "no", "", " \n", "why? ", "é!"])) for _ in range(rng.randint(1, most))]


def test_equals_every_edit(spark):
    """Drawn conversations, among them null turns, equal turns, repeated rows, roles out of the grammar."""
    convs = {k: drawn(k, 4) for k in range(150)} | {None: drawn(999, 4)}
    frame = spark.createDataFrame([(k, *x) for k, v in convs.items() for x in v], ROWS).withColumns({x: F.lit(7) for x in ("task", "place", "first", "block", "kind")})
    for block in (1, 256):
        got = {x.conv_id: tuple(x)[1:] for x in repair_turns(frame, block).collect()}
        assert got == {k: plain(v) for k, v in convs.items()}
    assert repair_turns(frame.where("false")).collect() == []


def test_long_conversation_goes_by_blocks(spark):
    """A conversation with nearly all rows, in blocks over several tasks, as in one piece."""
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice([f"text {k}.", f"cut {k}", "again.", ""])) for k in range(3000)] + [(2, 0, "user", "Hello."), (3, 0, "user", None)]
    got = {x.conv_id: x for x in repair_turns(spark.createDataFrame(rows, ROWS), 64).collect()}
    seen, turns = set(), []
    for _, _, role, text in rows[:3000]:
        turns.append(Turn(role[:1], not text or (role, text) in seen, text[-1:] != "."))
        seen.add((role, text))
    cost, audit, _ = next(x for x in cheapest(turns) if x[2] in ACCEPTING)
    assert (got[1].cost, got[1].audit) == (cost, audit) and got[1].gaps == 0
    assert got[1].illegal == sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip([r[2] for r in rows[:3000]], [r[2] for r in rows[1:3000]]))
    assert got[2].audit == "KI" and got[3].audit == "D" and got[3].blank == 1


def test_query_equals_sql(spark, tmp_path):
    """Damage and repair as in SQL, with nulls, conversations of which nothing is left, long texts and repeated rows."""
    rows = [(k, t, ["user", "assistant", "system", None][(k + t) % 4], [f"Said {t}.", "cut", None, " ", "x" * 50_000 + "?"][(k * t) % 5]) for k in range(60) for t in range(k % 7 + 1)]
    rows += [(k, 0, "user", "Hello.") for k in range(100, 180)] + [(None, None, None, None), (None, 3, "user", "a."), (None, 3, "user", "a."), (7, None, "user", "b.")]
    frame = spark.createDataFrame(rows, ROWS)
    frame.withColumn("task", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op13_turn_repair(spark, str(tmp_path))
    conversations = pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), x)) for x in rows])  # noqa: F841
    wanted = duckdb.sql(OP13_SQL)
    assert got.columns == wanted.columns and got.count() == len({x[0] for x in rows})
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted.fetchall(), key=repr)
    assert damaged(frame).count() != len(rows)


@pytest.mark.parametrize("start", range(4))
def test_nothing_left(start):
    assert next(x for x in cheapest([], start) if x[2] in ACCEPTING)[:2] == [(0, ""), (4, "II"), (2, "I"), (0, "")][start]
