"""Reports read back, records of who runs where, names in queries that vary."""

import json

from pyspark.sql import functions as F

from ledgermill.functions.dates import stamp_date
from ledgermill.functions.names import scanned_filer
from ledgermill.operators.evaluate import failures_by_kind, report_json
from ledgermill.operators.fallback import fallback_enabled, report_scores
from ledgermill.operators.providers import provider_from_env
from ledgermill.streaming.run_log import ProgressLines, line

from .conftest import values


def test_report_is_read_back(spark, tmp_path):
    scores = spark.createDataFrame([("digital", "owner", 0.5), ("digital", "description", 0.9), ("scanned", "owner", 0.1), ("overall", "owner", 0.3)], "kind string, field string, score double")
    filings = spark.createDataFrame([("digital", None), ("scanned", "x")], "kind string, error string")
    path = str(tmp_path / "report")
    assert report_scores(spark, path) == {} and fallback_enabled("1", "digital", report_scores(spark, path), ["owner"]) == []
    report_json(scores, failures_by_kind(filings)).write.text(path)
    report = report_scores(spark, path)
    assert report["overall"] == {"owner": 0.3} and report["by_kind"]["scanned"] == {"owner": 0.1}
    # A field without a score counts as 1; scanned filings are never recovered.
    assert fallback_enabled("true", "digital", report, ["owner", "description", "sub_owner"]) == ["owner"]
    assert fallback_enabled("true", "scanned", report, ["owner"]) == [] and fallback_enabled("0", "digital", report, ["owner"]) == []
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.txt").write_text("no json")
    assert report_scores(spark, str(tmp_path / "other")) == {}


def test_provider_is_named_by_the_environment():
    asked = []
    complete = provider_from_env({"LLM_FALLBACK_PROVIDER": "gemini"}, lambda prompt, given, schema: asked.append(schema) or {})
    complete("p", b"image", {"type": ["string", "null"], "additionalProperties": False})
    assert asked == [{"type": "string", "nullable": True}]


def test_run_log_lines(monkeypatch):
    monkeypatch.setenv("AWS_REQUEST_ID", "r1")
    told = json.loads(line("s", env=("AWS_REQUEST_ID", "NOT_SET"), written=1))
    assert told["environment"] == {"AWS_REQUEST_ID": "r1"} and told["written"] == 1
    assert "environment" not in json.loads(line("s"))


def test_stream_tells_its_progress(spark, tmp_path):
    told = []
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("a\nb\n")
    listener = ProgressLines("extract", told.append)
    spark.streams.addListener(listener)
    try:
        query = spark.readStream.text(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        for _ in range(100):
            if any("ended" in x for x in told):
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    lines = [json.loads(x) for x in told]
    assert {"started", "ended"} <= {x.get("state") for x in lines} and sum(x.get("rows", 0) for x in lines) == 2


def test_names_and_stamps_vary(spark):
    texts = ["NAME: Jane Q. O'Neil OFFICE of", "name ; Jo-Ann Doe, TELEPHONE 5", "Name.Al Member of", "no label", "NAME: 12", "name: Bo"]
    out = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", scanned_filer(F.col("t")).alias("f"))
    assert [x[1] for x in values(out)] == ["Jane Q. O'Neil", "Jo-Ann Doe", "Al", None, None, "Bo"]
    stamps = spark.createDataFrame([(0, "2026 JAN 5 PH 5:39"), (1, "26 FEB 1"), (2, "x")], "n int, t string").select("n", stamp_date(F.col("t")).alias("d"))
    found = [None if x[1] is None else str(x[1]) for x in values(stamps)]
    assert found[0] == "2026-01-05" and found[2] is None
