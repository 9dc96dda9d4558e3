import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.collect import bronze_plan
from ledgermill.plans.collect import collect_run, run_result
from ledgermill.plans.drive import by_kind, house_digital, recovery, whole
from ledgermill.plans.senate import extract_senate
from ledgermill.schemas import split_valid
from ledgermill.shared import held, holding
from ledgermill.sinks import compact, manifest, read_silver, write_silver
from ledgermill.streaming.ingest import batch_writer, message_stream, redelivered, run_available, stale
from ledgermill.streaming.run_log import logged, progress

from .conftest import values
from .test_plans import page

ROW = ["1", "01/02/2026", "Self", "abc", "Big Co", "Stock", "Purchase", "$1,001 - $15,000", ""]


def documents(spark, pages):
    rows = [(k, f"bronze/senate/year=2025/{k}.html", v) for k, v in pages.items()]
    return spark.createDataFrame(rows, "doc_id string, bronze_key string, content binary")


def test_replace_per_document(spark, tmp_path):
    first = documents(spark, {"a": page([ROW, ["2", *ROW[1:]]]), "b": page([ROW])})
    write_silver(*extract_senate(first)[:2], first, str(tmp_path))
    again = documents(spark, {"a": page([])})
    write_silver(*extract_senate(again)[:2], again, str(tmp_path))
    assert values(read_silver(spark, str(tmp_path), "transactions"), "doc_id", "line_no", "bronze_year") == [("b", 1, 2025)]
    assert values(read_silver(spark, str(tmp_path), "filings"), "doc_id", "year", "bronze_year") == [("a", 2026, 2025), ("b", 2026, 2025)]
    compact(spark, str(tmp_path), "filings", str(tmp_path / "small"))
    assert spark.read.parquet(str(tmp_path / "small")).count() == 2


def test_lost_run_changes_nothing(spark, tmp_path):
    docs = documents(spark, {"a": page([ROW])})
    write_silver(*extract_senate(docs)[:2], docs, str(tmp_path), version=1)
    filings, rows, _ = extract_senate(documents(spark, {"a": page([ROW, ["2", *ROW[1:]]])}))
    write_silver(filings, rows, docs.where("false"), str(tmp_path), version=2)  # lost before its list of documents
    assert values(read_silver(spark, str(tmp_path), "transactions"), "doc_id", "line_no", "version") == [("a", 1, 1)]
    write_silver(filings, rows, docs, str(tmp_path), version=3)
    assert values(read_silver(spark, str(tmp_path), "transactions"), "line_no", "version") == [(1, 3), (2, 3)]


def test_collect_again(spark, tmp_path):
    entries = spark.createDataFrame([("a", 2026, "ptr", 0, "u/a"), ("b", 2026, "ptr", 1, "u/b"), ("c", 2026, "ptr", 2, "u/c")], "doc_id string, year int, kind string, index_row int, source_url string")
    path, queue = str(tmp_path / "bronze"), str(tmp_path / "queue")

    def broken(address):
        if address == "u/b":
            raise OSError("down")
        return 200, b"\xff" + address.encode()

    first = collect_run(entries, broken, path, queue, "senate", "html")
    assert values(first, "doc_id", "action", "outcome") == [("a", "write", "cleared"), ("b", "blocked", "error")]
    second = collect_run(entries, lambda address: (200, b"" if address == "u/c" else b"page"), path, queue, "senate", "html", mark=b"page")
    assert values(second, "doc_id", "action", "outcome") == [("b", "write", "cleared"), ("c", "blocked", "ambiguous")]
    assert run_result(second).first().asDict() == {"written": 1, "unchanged": 0, "stopped_by": "ambiguous"}
    assert values(manifest(spark, path), "doc_id", "chamber", "ext", "kind") == [("a", "senate", "html", "ptr"), ("b", "senate", "html", "ptr")]
    assert values(spark.read.text(queue)) == [(f'{{"bronze_key":"bronze/senate/year=2026/{x}.html"}}',) for x in "ab"]
    third = collect_run(entries.where("false"), lambda address: 1 / 0, path, None, "senate", "html")
    assert third.count() == 0


def test_readers_fail_alone(spark):
    docs = spark.createDataFrame([("200", "bronze/house/year=2026/200.pdf", b"x"), ("201", "bronze/house/year=2026/201.pdf", b"")], "doc_id string, bronze_key string, content binary")
    text = lambda doc, content: [{"page_no": 1, "text": f"Filing ID #{doc}\nName: A B\nDigitally Signed: A B, 02/01/2026"}] if content[0] else []
    chunk = lambda doc, content: [{"page_no": 1, "seq": 0, "x": 1.0, "y": 9.0, "text": "$200?", "font": "/F1"}]
    filings, _, failed = whole(by_kind({"digital": house_digital(chunk, text)}))(docs)
    assert values(filings, "doc_id", "filer_name") == [("200", "A B")]
    assert values(failed, "doc_id", "reasons") == [("201", ["filer_name", "filing_date", "filing_id"])]


def test_run_log():
    told = []
    with logged("s", told.append, function="f") as event:
        event["written"] = 2
    progress("s", told.append, doc_id="a")
    with pytest.raises(ValueError), logged("s", told.append):
        raise ValueError("no")
    first, step, last = map(json.loads, told)
    assert (first["outcome"], first["written"], first["function"]) == ("success", 2, "f") and first["duration_ms"] >= 0
    assert (step["type"], step["doc_id"]) == ("progress", "a") and last["error"] == {"type": "ValueError", "message": "no"}


def test_validity(spark):
    docs = documents(spark, {"a": page([ROW]), "b": page([ROW])})
    filings, rows, _ = extract_senate(docs)
    broken = rows.withColumn("value_min", F.when(F.col("doc_id") == "a", F.lit(-1.0)).otherwise(F.col("value_min")))
    good, lines, bad = split_valid(filings, broken)
    assert values(good, "doc_id") == [("b",)] and values(lines, "doc_id") == [("b",)] and values(bad) == [("a", ["value_range"])]


def test_hash_gate(spark):
    fetched = spark.createDataFrame([("a", 2026, b"x"), ("b", 2026, b"x"), ("c", 2026, b"x")], "doc_id string, year int, content binary")
    same = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    plan = bronze_plan(fetched, spark.createDataFrame([("a", same), ("b", "0" * 64)], "doc_id string, sha256 string"), "house", "pdf")
    assert values(plan, "doc_id", "action", "bronze_key") == [("a", "noop", "bronze/house/year=2026/a.pdf"), ("b", "versioned", f"bronze/house/year=2026/b.{same[:8]}.pdf"), ("c", "write", "bronze/house/year=2026/c.pdf")]


def test_stream(spark, tmp_path):
    pages = {"a": page([ROW]), "bad": page([ROW[:3]])}
    store = documents(spark, pages)
    queue = tmp_path / "queue"
    queue.mkdir()
    (queue / "1.json").write_text('{"bronze_key":"bronze/senate/year=2025/a.html"}\n{"bronze_key":"bronze/senate/year=2025/bad.html"}\n{"x":1}\n')
    load = lambda keys: store.join(keys, "bronze_key", "left_semi")
    told = []
    writer = batch_writer(load, extract_senate, str(tmp_path / "silver"), str(tmp_path / "quarantine"), tell=told.append)
    run_available(message_stream(spark, str(queue)), writer, str(tmp_path / "checkpoint"))
    assert values(read_silver(spark, str(tmp_path / "silver"), "transactions"), "doc_id") == [("a",)]
    (queue / "2.json").write_text('{"bronze_key":"bronze/senate/year=2025/bad.html"}\n{"bronze_key":"bronze/senate/year=2025/a.html"}\n')
    run_available(message_stream(spark, str(queue)), writer, str(tmp_path / "checkpoint"))
    assert values(read_silver(spark, str(tmp_path / "silver"), "filings"), "doc_id") == [("a",)]
    failed = spark.read.parquet(str(tmp_path / "quarantine"))
    unread = "message-" + hashlib.sha256(b'{"x":1}').hexdigest()
    assert values(failed, "doc_id", "attempts", "batch_id") == [("bad", 1, 0), ("bad", 2, 1), (unread, 1, 0)]
    assert values(failed.where("batch_id = 0"), "body") == [('{"bronze_key":"bronze/senate/year=2025/bad.html"}',), ('{"x":1}',)]
    assert values(redelivered(spark, str(tmp_path / "quarantine"), 1)) == [('{"bronze_key":"bronze/senate/year=2025/bad.html"}',)]
    assert len(told) == 2 and '"outcome": "success"' in told[0]


def test_gate_and_errors_lose_no_document(spark, tmp_path):
    store = documents(spark, {"a": page([ROW])})
    queue = tmp_path / "queue"
    queue.mkdir()
    (queue / "1.json").write_text('{"bronze_key":"bronze/senate/year=2025/a.html"}\n')
    load = lambda keys: store.join(keys, "bronze_key", "left_semi")
    told = []
    held = batch_writer(load, extract_senate, str(tmp_path / "silver"), str(tmp_path / "quarantine"), gate=lambda rows: False, tell=told.append)
    run_available(message_stream(spark, str(queue)), held, str(tmp_path / "checkpoint"))
    failed = spark.read.parquet(str(tmp_path / "quarantine"))
    assert values(failed, "doc_id", "reason", "dead") == [("a", "quality_gate", False)] and '"outcome": "gate"' in told[0]
    assert not (tmp_path / "silver").exists()
    (queue / "2.json").write_text(redelivered(spark, str(tmp_path / "quarantine"), 0).first().body + "\n")
    broken = batch_writer(lambda keys: 1 / 0, extract_senate, str(tmp_path / "silver"), str(tmp_path / "quarantine"), tell=told.append)
    with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
        run_available(message_stream(spark, str(queue)), broken, str(tmp_path / "checkpoint"))
    assert '"outcome": "error"' in told[1] and "ZeroDivisionError" in told[1]
    passed = batch_writer(load, extract_senate, str(tmp_path / "silver"), str(tmp_path / "quarantine"), tell=told.append)
    run_available(message_stream(spark, str(queue)), passed, str(tmp_path / "checkpoint"))
    assert values(read_silver(spark, str(tmp_path / "silver"), "filings"), "doc_id") == [("a",)]


def test_stale(spark):
    log = spark.sql("select * from values ('a','success',timestamp'2026-01-01 00:00:00'),('b','success',timestamp'2026-01-03 00:00:00'),('c','failed',timestamp'2026-01-03 00:00:00') t(stage,outcome,at)")
    from datetime import datetime

    assert values(stale(log, datetime(2026, 1, 4)), "stage") == [("a",), ("c",)]


def test_completions_are_asked_once(spark, tmp_path):
    log = tmp_path / "asked"

    def complete(prompt, given, schema):
        with open(log, "a") as f:
            f.write(f"{given}\n")
        return {"owner": "dog" if given == "b" else "spouse"}

    rows = extract_senate(documents(spark, {"a": page([ROW]), "b": page([ROW]), "c": page([ROW])}))[1]
    doubtful = rows.withColumn("field_confidence", F.create_map(F.lit("owner"), F.when(F.col("doc_id") == "c", 1.0).otherwise(0.0)))
    good, bad = recovery(["owner"], complete, spark.createDataFrame([(x, x) for x in "abc"], "doc_id string, given string"))(doubtful)
    for _ in range(2):
        assert values(good, "doc_id", "owner") == [("a", "spouse"), ("c", "self")] and values(bad) == [("b", ["owner"])]
    assert sorted(log.read_text().split()) == ["a", "b"]


def test_held_tables_are_let_go(spark):
    rows = spark.range(3)
    assert held(rows) is rows and not rows.is_cached
    with pytest.raises(ValueError), holding():
        kept = held(rows)
        assert kept.is_cached and kept.count() == 3
        with holding():
            inner = held(spark.range(5))
        assert kept.storageLevel.useMemory and not inner.storageLevel.useMemory
        raise ValueError
    assert not kept.storageLevel.useMemory and held(rows) is rows
