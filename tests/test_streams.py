"""Streams with state and sources and sinks of their own: lost messages, versions, restarts."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.fallback import completed
from ledgermill.plans.drive import whole
from ledgermill.plans.senate import extract_senate
from ledgermill.sinks import expire, read_silver, write_silver
from ledgermill.sources.files import bronze_files
from ledgermill.sources.index_stream import ENTRIES, index_stream
from ledgermill.sources.pages import read_pages
from ledgermill.streaming.attempts import OUTCOMES, fates, outcome_stream, write_fates
from ledgermill.streaming.ingest import batch_writer, message_stream, run_available
from ledgermill.streaming.message_sink import MessageSink, _Writer, sent_messages

from .conftest import values
from .test_plans import page
from .test_sinks_and_stream import ROW

DOCUMENTS = "doc_id string, bronze_key string, content binary"


def key(name, year=2025):
    return f"bronze/senate/year={year}/{name}.html"


def line(name):
    return json.dumps({"bronze_key": key(name)}) + "\n"


def lines(n):
    return page([[str(k + 1), *ROW[1:]] for k in range(n)])


def test_versions_and_lost_messages(spark, tmp_path):
    """A document and its versioned key in one batch, a key without an object, null and unreadable bodies, and an old version
    that comes late."""
    store = spark.createDataFrame([("a", key("a"), lines(1)), ("a", key("a.01234567"), lines(2)), ("b", key("b"), lines(3)), ("bad", key("bad"), page([ROW[:3]]))], DOCUMENTS)
    load = lambda keys: store.join(keys, "bronze_key", "left_semi")
    silver, lost, outcomes, told = str(tmp_path / "silver"), str(tmp_path / "lost"), str(tmp_path / "outcomes"), []
    writer = batch_writer(load, extract_senate, silver, lost, tell=told.append, outcomes=outcomes)
    at = lambda k: f"2026-01-01 00:00:0{k}"
    rows = [(line("a.01234567"), at(2)), (line("a"), at(1)), (line("gone"), at(1)), (None, at(1)), ('{"x":1}', at(1)), (line("b"), at(5)), (line("bad"), at(1))]
    writer(spark.createDataFrame(rows, "body string, arrived string").selectExpr("body", "cast(arrived as timestamp) as arrived"), 0)
    assert values(read_silver(spark, silver, "filings"), "doc_id", "bronze_key") == [("a", key("a.01234567")), ("b", key("b"))]
    assert values(read_silver(spark, silver, "transactions").groupBy("doc_id").count()) == [("a", 2), ("b", 3)]
    nothing = "message-" + hashlib.sha256(b"").hexdigest()
    unread = "message-" + hashlib.sha256(b'{"x":1}').hexdigest()
    assert {(x.doc_id, x.reason) for x in spark.read.parquet(lost).collect()} == {("gone", "no_object"), (nothing, "unrecognized_event"), (unread, "unrecognized_event"), ("bad", "amount,asset_description,cells,transaction_type")}
    event = json.loads(told[0])
    assert {k: event[k] for k in ("documents", "filings", "transactions", "failed", "dead", "no_object")} == {"documents": 2, "filings": 2, "transactions": 5, "failed": 4, "dead": 0, "no_object": 1}
    # The old version of a, and b before what is known of it: both come late and change nothing. Without a time the newest wins.
    late = spark.createDataFrame([(line("a"), at(1)), (line("b"), at(4))], "body string, arrived string").selectExpr("body", "cast(arrived as timestamp) as arrived")
    writer(late, 1)
    assert values(read_silver(spark, silver, "filings"), "doc_id", "bronze_key") == [("a", key("a.01234567")), ("b", key("b"))]
    assert expire(spark, silver) == 2 and values(read_silver(spark, silver, "transactions").groupBy("doc_id").count()) == [("a", 2), ("b", 3)]
    writer(spark.createDataFrame([(line("a"),)], "body string"), 2)
    assert values(read_silver(spark, silver, "transactions").groupBy("doc_id").count()) == [("a", 1), ("b", 3)]
    assert expire(spark, silver) == 0  # b is still read from the first version
    assert values(spark.read.parquet(outcomes).where("batch_id = 0"), "doc_id", "ok") == sorted([("a", True), ("b", True), ("bad", False), ("gone", False), (nothing, False), (unread, False)])
    with pytest.raises(ValueError):
        whole(extract_senate, search=lambda x: x)


def test_arrival_is_the_file_time(spark, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    for name, text, when in (("1.json", line("a.01234567"), 2_000_000_000), ("2.json", line("a"), 1_000_000_000)):
        (queue / name).write_text(text)
        os.utime(queue / name, (when, when))
    store = spark.createDataFrame([("a", key("a"), lines(1)), ("a", key("a.01234567"), lines(2))], DOCUMENTS)
    writer = batch_writer(lambda keys: store.join(keys, "bronze_key", "left_semi"), extract_senate, str(tmp_path / "silver"), str(tmp_path / "lost"), tell=lambda _: None)
    run_available(message_stream(spark, str(queue)), writer, str(tmp_path / "checkpoint"))
    assert values(read_silver(spark, str(tmp_path / "silver"), "filings"), "bronze_key") == [(key("a.01234567"),)]


def test_counts_of_writes(spark, tmp_path):
    docs = spark.createDataFrame([("a", key("a"), lines(2)), ("b", key("b"), lines(1))], DOCUMENTS)
    filings, rows, _ = extract_senate(docs)
    assert write_silver(filings, rows, docs, str(tmp_path)) == {"transactions": 3, "filings": 2, "documents": 2}
    assert write_silver(filings.where("false"), rows.where("false"), docs.where("false"), str(tmp_path)) == {"transactions": 0, "filings": 0, "documents": 0}


def test_repeated_line_numbers_are_answered_once(spark):
    rows = spark.createDataFrame([("a", 1, "x", ["owner"]), ("a", 1, "y", ["owner"]), ("a", 1, "z", []), ("a", 2, "x", ["owner"]), ("a", 2, "x", ["owner"])], "doc_id string, line_no int, description string, needed array<string>")
    out = completed(rows.withColumn("given", F.col("description")), lambda prompt, given, schema: {"owner": given}, "given")
    assert values(out, "line_no", "description", "answer") == [(1, "x", '{"owner": "x"}'), (1, "y", '{"owner": "y"}'), (1, "z", None), (2, "x", '{"owner": "x"}'), (2, "x", '{"owner": "x"}')]


def outcomes(spark, folder, rows):
    frame = spark.createDataFrame([(d, b, f"2026-01-01 {t}", ok, r, f"body {d}") for d, b, t, ok, r in rows], OUTCOMES.replace("timestamp", "string"))
    frame.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)


def test_attempts_survive_restarts(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("outcomes", "fates", "checkpoint"))

    def told():
        write_fates(fates(outcome_stream(spark, folder), 60), out, checkpoint)
        return values(spark.read.parquet(out), "doc_id", "kind", "attempts", "reason", F.date_format("at", "HH:mm:ss"))

    outcomes(spark, folder, [("a", 1, "00:00:00", False, "x"), ("b", 1, "00:00:00", False, "x"), (None, 1, "00:00:00", False, "x"), ("c", 1, "00:00:30", True, None)])
    assert told() == [] and told() == []  # no timer is due yet
    outcomes(spark, folder, [("b", 2, "00:00:40", True, None), ("a", 1, "00:00:50", False, "x"), ("c", 2, "00:01:00", False, "y")])
    assert told() == [("a", "redelivered", 1, "x", "00:01:00")]  # b succeeded before; the same outcome of a counts once
    outcomes(spark, folder, [("a", 3, "00:02:00", False, "x2"), ("a", 4, "00:05:00", False, "x3"), ("c", 3, "00:05:00", False, "y")])
    first = [("a", "dead", 3, "x3", "00:05:00"), ("a", "redelivered", 1, "x", "00:01:00"), ("a", "redelivered", 2, "x2", "00:03:00"), ("c", "redelivered", 1, "y", "00:02:00")]
    assert told() == first and told() == first
    outcomes(spark, folder, [("a", 5, "00:10:00", False, "new"), ("d", 1, "01:00:00", True, None)])
    assert told() == sorted([*first, ("c", "redelivered", 2, "y", "00:06:00"), ("a", "redelivered", 1, "new", "00:11:00")])


def test_index_stream(spark, tmp_path):
    """Two runs of two entries, the index grows, a failed run is taken again from its offset."""
    path, checkpoint, seen = str(tmp_path / "index"), str(tmp_path / "checkpoint"), []
    entry = lambda *rows: spark.createDataFrame([(f"d{k}", 2026, "ptr", k, f"u/{k}") for k in rows], ENTRIES).coalesce(1).write.mode("append").parquet(f"file://{path}")

    def keep(batch, batch_id):
        found = [x.doc_id for x in batch.orderBy("index_row").collect()]
        if "d2" in found and not seen[1:]:
            seen.append("failed")
            raise ValueError("blocked")
        seen.append(found)

    run = lambda: run_available(index_stream(spark, f"file://{path}", 2), keep, checkpoint)
    entry(2, 0, 1)
    run()
    with pytest.raises(Exception, match="blocked"):
        run()
    entry(3, 4)
    run()
    run()
    run()
    assert seen[0] == ["d0", "d1"] and seen[1] == "failed" and sorted(x for y in seen[2:] for x in y) == ["d2", "d3", "d4"]


def test_message_sink_takes_a_batch_once(spark, tmp_path):
    queue = f"file://{tmp_path}/queue"
    first, other, again = _Writer(queue), _Writer(queue), _Writer(queue)
    parts = [first.write(iter([("a",), ("b",)])), first.write(iter([])), first.write(iter([("c",)]))]
    first.write(iter([("a",)]))  # an attempt that did not count
    assert not [x for x in (tmp_path / "queue").iterdir() if not x.name.startswith("_")]
    _Writer(queue).commit([parts[0], parts[1], None, parts[2]], 0)
    lost = [other.write(iter([("x",)])), None]
    other.abort(lost, 1)
    repeated = [again.write(iter([("a",), ("b",), ("c",)]))]
    again.commit(repeated, 0)
    again.commit([again.write(iter([("d",)]))], 1)
    assert values(sent_messages(spark, queue)) == [("a",), ("b",), ("c",), ("d",)] and MessageSink.name() == "ledgermill_messages"


class Reader:
    def count(self, content):
        return int(content)

    def page(self, content, page_no):
        return (f"p{page_no}", b"i") if page_no % 2 else (None, None)


def test_long_document_is_read_in_ranges(spark, tmp_path):
    spark.createDataFrame([("long", b"7"), ("none", b"0"), ("bad", b"x"), ("one", b"1")], "doc_id string, content binary").write.parquet(f"file://{tmp_path}/docs")
    pages = read_pages(spark, f"file://{tmp_path}/docs", Reader(), pages_a_task=2)
    assert pages.rdd.getNumPartitions() >= 4
    found = values(pages, "doc_id", "page_no", "text", "image")
    assert found == sorted([("bad", 1, None, None), *(("long", k, f"p{k}" if k % 2 else None, b"i" if k % 2 else None) for k in range(1, 8)), ("one", 1, "p1", b"i")], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert pages.where("error is not null").first().error.startswith("ValueError")


def test_bronze_files(spark, tmp_path):
    place = tmp_path / "bronze" / "house" / "year=2026"
    place.mkdir(parents=True)
    (place / "20012345.pdf").write_bytes(b"x")
    (place / "notes.txt").write_bytes(b"y")
    found = bronze_files(spark, str(tmp_path), "*.pdf").first()
    assert (found.bronze_key, found.chamber, found.year, found.doc_id, bytes(found.content)) == ("bronze/house/year=2026/20012345.pdf", "house", 2026, "20012345", b"x")
