"""Every stage and operator on nulls, repeats, ties, empty tables, long texts and clashing columns."""

import pytest
from pyspark.sql import functions as F

from ledgermill.llm.filter_audit import failures
from ledgermill.llm.near_copies import keep_one
from ledgermill.llm.packing import pack
from ledgermill.llm.pieces import segment
from ledgermill.llm.pii import find_pii, redact
from ledgermill.llm.quality import keep_good, quality_rules
from ledgermill.llm.repeats import repeats
from ledgermill.llm.sharding import shard_by_bytes
from ledgermill.llm.simhash import simhash_components
from ledgermill.llm.token_files import read_token_files, write_token_files
from ledgermill.llm.tool_calls import link_tool_calls
from ledgermill.llm.toxicity import keep_clean, toxicity
from ledgermill.shared import fresh_path

GOOD = "the cat sat on the mat with another cat near a warm wall while rain fell over all of the old town again and again in spring"
TEXTS = [None, "", " \n", GOOD, GOOD, GOOD + " today", "x" * 300_000, "7" * 100_000, "word " * 60_000, "call +1 (415) 555-2671 or ann@example.com"]
IDS = [None, None, 4, 4, 4, 5, 6, 7, 8, -1]

STAGES = {
    "quality": lambda d, known: keep_good(d, known),
    "toxicity": lambda d, known: keep_clean(d, known),
    "near_duplicates": lambda d, known: keep_one(d),
    "personal_data": lambda d, known: redact(d),
}
OPERATORS = {
    "op1": lambda d, known: find_pii(d),
    "op3": lambda d, known: pack(d),
    "op4": toxicity,
    "op5": lambda d, known: simhash_components(d),
    "op6": lambda d, known: shard_by_bytes(d),
    "op7": lambda d, known: read_token_files(write_token_files(d, fresh_path(d.sparkSession, "tokens"))),
    "op8": lambda d, known: segment(d),
    "op9": lambda d, known: quality_rules(d, known),
    "op11": lambda d, known: failures(d),
    "op12": lambda d, known: repeats(d),
}


@pytest.fixture()
def known(labels):
    return labels([(3, 1, 0), (4, 1, 0), (5, 1, 1), (6, None, None), (None, 1, 1), (5, 0, 0)])


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, docs, known, name):
    """Columns of any name stay as they were, and rows keep theirs."""
    frame = docs(*TEXTS, ids=IDS)
    out = STAGES[name](frame, known)
    assert out.columns == frame.columns and [x.dataType for x in out.schema] == [x.dataType for x in frame.schema]
    rows = out.collect()
    given = {(i, x) for i, x in zip(IDS, TEXTS)}
    own = ("doc_id", "text", "lang", "source", "n_chars")
    assert all(v == 7 for x in rows for k, v in x.asDict().items() if k not in own) and all(x.lang == "en" for x in rows)
    if name != "personal_data":
        assert {(x.doc_id, x.text) for x in rows} <= given
    if name == "near_duplicates":
        # One text of each: without words, GOOD (and the one that is similar), the long ones, the last.
        assert len(rows) == 6 and sorted(str(x.doc_id) for x in rows) == ["-1", "4", "4", "6", "7", "8"]
    if name == "personal_data":
        assert len(rows) == len(TEXTS) and "call [PHONE] or [EMAIL]" in {x.text for x in rows}
    assert STAGES[name](frame.where("false"), known).collect() == []
    assert STAGES[name](frame.where("false"), known.where("false")).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, docs, known, name):
    frame = docs(*TEXTS, ids=IDS)
    out = OPERATORS[name](frame, known).collect()
    ids = sorted((x.doc_id for x in out), key=str)
    assert sorted(set(map(str, ids))) == sorted(set(map(str, IDS))) and (name == "op3" or ids == sorted(IDS, key=str))
    assert OPERATORS[name](frame.where("false"), known).collect() == []


def test_tool_calls_keep_long_contents(spark):
    long = "y" * 500_000
    rows = [(1, 0, "assistant", '{"tool_calls":[{"id":"a","name":"f","arguments":{"x":"' + long + '"}}]}'), (1, 1, "tool", '{"tool_call_id":"a","content":"' + long + '"}'), (None, 0, "assistant", None), (2, None, "tool", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({x: F.lit(7) for x in ("id", "calls", "at", "level", "errors", "result", "dep")})
    out = link_tool_calls(frame, {"f": {"x": ("string", True)}}).collect()
    assert len(out) == 1 and out[0].errors == [] and out[0].canonical == '{"arguments":{"x":"' + long + '"},"id":"a","name":"f","result":"' + long + '"}'
    assert link_tool_calls(frame.where("false"), {}).count() == 0
