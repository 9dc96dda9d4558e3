import random
from datetime import date

from pyspark.sql import functions as F

from ledgermill.operators.evaluate import SCORED, consistency, filing_scores, gold_set_scores, line_scores, seeded_sample, unequal_runs, weakest
from ledgermill.operators.fallback import applied, completed, eligible_fields, fallback_enabled, fallback_schema, needed_fields, unreadable_fields
from ledgermill.operators.providers import Pace, UnknownProviderError, VisionUnsupportedError, gemini_schema, provider
from ledgermill.operators.quality_gate import gate
from ledgermill.plans.house_digital import extract_house_digital
from ledgermill.plans.house_scanned import extract_house_scanned
from ledgermill.plans.llm_extract import extract_by_completion
from ledgermill.plans.senate import extract_senate

from .conftest import values

CHUNKS = "doc_id string, page_no int, seq int, x double, y double, text string, font string"


def digital(spark, lines, doc="20001", head=True):
    rows = [(doc, page, i, float(x), float(y), text, "/F1") for i, (page, x, y, text) in enumerate(lines)]
    texts = spark.createDataFrame([(doc, 1, f"Filing ID #{doc}\nName:  Hon. A B\nDigitally Signed: Hon. A B , 02/01/2026" if head else "nothing")], "doc_id string, page_no int, text string")
    keys = spark.createDataFrame([(doc, f"bronze/house/year=2026/{doc}.pdf")], "doc_id string, bronze_key string")
    return extract_house_digital(spark.createDataFrame(rows, CHUNKS), texts, keys)


def test_digital_rows(spark):
    lines = [
        (1, 0, 700, "ignored"), (1, 0, 690, "$200?"),
        (1, 0, 660, "SP Alpha Corp"), (1, 200, 660, "P 01/02/2026 01/05/2026 $1,001 -"), (1, 0, 650, "Common (ALP) [ST] $15,000"), (1, 0, 640, "Filing Status: New"), (1, 0, 630, "D\0\0\0\0\0\0\0\0\0\0: first"), (1, 0, 620, "second"), (1, 0, 610, "Description: again"),
        (1, 0, 580, "Beta Fund"), (1, 200, 580, "S (partial) 01/03/2026 01/05/2026 Over $50,000,000"),
        (1, 0, 5, "Filing ID #20001"),
        (2, 0, 700, "$200?"), (2, 0, 670, "tail of beta [EF]"), (2, 0, 640, "Gamma [XX]"), (2, 200, 640, "E 01/04/2026 01/05/2026 $9.00"), (2, 0, 630, "Location: US"), (2, 0, 600, "* For the complete list of asset type abbreviations, see"), (2, 0, 560, "P 01/04/2026 01/05/2026 $9.00"),
    ]
    filings, rows, quarantine = digital(spark, lines)
    assert quarantine.count() == 0
    assert values(filings, "doc_id", "filer_name", "filing_date", "year") == [("20001", "Hon. A B", date(2026, 2, 1), 2026)]
    assert values(rows, "line_no", "owner", "transaction_type", "asset_type", "asset_description", "value_min", "value_max", "ticker", "filing_status", "description", "disclosure_lag") == [
        (1, "spouse", "purchase", "stock", "Alpha Corp Common (ALP) [ST]", 1001.0, 15000.0, "ALP", "New", "first second", 30),
        (2, "self", "sale_partial", "etf", "Beta Fund tail of beta [EF]", 50000001.0, None, None, None, None, 29),
        (3, "self", "exchange", "other", "Gamma [XX]", 9.0, 9.0, None, None, None, 28),
    ]


def test_digital_faults(spark):
    good = [(1, 0, 690, "$200?"), (1, 0, 660, "A P 01/02/2026 01/05/2026 $9.00")]
    assert digital(spark, good)[1].count() == 1
    reasons = lambda *a, **b: digital(spark, *a, **b)[2].first()["reasons"]
    assert reasons(good[1:]) == ["no_table_header"]
    assert reasons([*good, (1, 0, 650, "B P 01/02/2026 01/05/2026 $9.00")]) == ["two_anchors"]
    assert "amount" in reasons([good[0], (1, 0, 660, "A P 01/02/2026 01/05/2026 lots")])
    assert set(reasons(good, head=False)) == {"filing_id", "filer_name", "filing_date"}


def test_scanned(spark):
    words = []

    def line(page, crop, n, text):
        words.extend(("82001", page, crop, 1, 1, n, 10 * i, n * 20, w) for i, w in enumerate(text.split()))

    line(1, "full", 1, "NAME: Jane Doe OFFICE")
    line(2, "full", 1, "2021 JUL 28 PH 5:39")
    for n, (asset, dates) in enumerate([("SP Apple Computer (AAPL) [ST]", "7/1/21 7/5/2021"), ("Example: Mega Corp", "7/2/21"), ("Banana Republic Bonds", "nothing"), ("Cherry Holdings", "7/4/2021")], 1):
        line(1, "asset", n, asset)
    for n, dates in enumerate(["7/1/21 7/5/2021", "nothing", "7/4/2021"], 1):
        line(1, "dates", n, dates)
    schema = "doc_id string, page_no int, crop string, block_num int, par_num int, line_num int, left int, top int, text string"
    keys = spark.createDataFrame([("82001", "k1"), ("82002", "k2")], "doc_id string, bronze_key string")
    filings, rows, quarantine = extract_house_scanned(spark.createDataFrame(words, schema), keys)
    assert values(filings, "doc_id", "filer_name", "filing_date") == [("82001", "Jane Doe", date(2021, 7, 28))]
    assert values(rows, "line_no", "owner", "asset_description", "transaction_date", "notification_date", "confidence", "disclosure_lag") == [
        (1, "spouse", "Apple Computer (AAPL) [ST]", date(2021, 7, 1), date(2021, 7, 5), 0.0, 27), (2, "self", "Cherry Holdings", date(2021, 7, 4), None, 0.0, 24),
    ]
    assert values(quarantine, "doc_id") == [("82002",)]


def page(rows, header="Ms. A B (B, A)", filed="Filed 02/01/2026"):
    body = "".join("<tr>" + "".join(f"<td>{x}</td>" for x in r) + "</tr>" for r in rows)
    return f'<h2 class="filedReport">{header}</h2><p class="muted">{filed}</p><table class="table-striped"><tbody>{body}</tbody></table>'.encode()


def test_senate(spark):
    row = ["2", "01/02/2026", "Self", "--", "Big Co<br>(Received)", "Stock Option", "Sale (Partial)", "$1,001 - $15,000", "c"]
    bad = {"cells": row[:8], "owner": [*row[:2], "Dog", *row[3:]], "amount": [*row[:7], "much", "c"], "transaction_type": [*row[:6], "Gift", *row[7:]]}
    docs = [("ok", page([row, ["1", *row[1:]]])), ("none", page([])), *((k, page([row, r])) for k, r in bad.items()), ("filer_name", page([row], header="(x)")), ("filing_date", page([row], filed="")), ("table", b'<h2 class="filedReport">A</h2><p class="muted">Filed 02/01/2026</p>')]
    documents = spark.createDataFrame(docs, "doc_id string, content binary").withColumn("bronze_key", F.concat(F.lit("bronze/senate/year=2026/"), "doc_id", F.lit(".html")))
    filings, rows, quarantine = extract_senate(documents)
    assert values(filings, "doc_id", "filer_name") == [("none", "A B"), ("ok", "A B")]
    assert values(rows, "doc_id", "line_no", "asset_type", "asset_description", "description", "ticker", "disclosure_lag") == [("ok", n, "option", "Big Co", "(Received)", None, 30) for n in (1, 2)]
    assert {x.doc_id: x.reasons for x in quarantine.collect()} == {k: [k] for k in ("owner", "amount", "transaction_type", "filer_name", "filing_date", "table")} | {"cells": ["cells"]}


def lines(spark, rows, extra=""):
    names = ("owner", "asset_description")
    base = spark.createDataFrame(rows, "doc_id string, line_no int, position long, owner string, asset_description string" + extra)
    dates, numbers = ("transaction_date", "notification_date"), ("value_min", "value_max")
    return base.withColumns({x: F.lit(None).cast("date" if x in dates else "double" if x in numbers else "string") for x in SCORED if x not in names})


def test_evaluation(spark):
    gold = lines(spark, [("a", 1, 0, "self", "xy"), ("a", 2, 1, "joint", "q"), ("b", 1, 0, "self", "z"), ("b", 1, 1, "joint", "zz")])
    predicted = lines(spark, [("a", 1, 0, "self", "xz"), ("b", 1, 0, "joint", "zz"), ("c", 9, 0, "self", "ghost")])
    filings = spark.createDataFrame([("a", "digital"), ("b", "digital"), ("c", "digital"), ("d", "digital")], "doc_id string, kind string")
    scores = filing_scores(filings, line_scores(gold, predicted))
    owner = {x.doc_id: x.score for x in scores.where("field = 'owner'").collect()}
    assert owner == {"a": 0.5, "b": 1.0, "c": 0.0, "d": 1.0}
    assert {x.doc_id: x.score for x in scores.where("field = 'asset_description'").collect()}["a"] == 0.25
    total = {(x.kind, x.field): x.score for x in gold_set_scores(scores).collect()}
    assert total["overall", "owner"] == total["digital", "owner"] == 0.625 and total["scanned", "owner"] == 1.0
    low = [x.field for x in weakest(gold_set_scores(scores).where("kind = 'overall'")).collect()]
    assert low == ["asset_description", "owner", "transaction_type"]


def test_consistency(spark):
    rows = [("a", 1, 0, v, "t", r) for r, v in ((1, "self"), (2, "self"), (3, "joint"))]
    runs = lines(spark, rows, ", run int")
    assert {x.field: round(x.score, 6) for x in consistency(runs).collect()}["owner"] == round(1 / 3, 6)
    assert values(unequal_runs(runs)) == [("a",)]
    ids = lambda *x: spark.createDataFrame([(y,) for y in x], "id string")
    assert values(seeded_sample(ids("c", "a", "b"), 5)) == [(0, "a"), (1, "b"), (2, "c")]
    many = [str(k * k) for k in range(500)] + ["9", "é"]
    for n, seed in ((10, 0), (300, 7)):
        assert [x.id for x in seeded_sample(ids(*many), n, seed).orderBy("nth").collect()] == random.Random(seed).sample(sorted(many), n)


def test_gate(spark):
    rows = [(1, 10, 5, {"a": 0}, None), (2, 10, 4, {"a": 0}, None), (3, 0, 0, {"a": 2, "b": 1}, 0), (4, 10, 10, {"a": 0}, 9)]
    found = gate(spark.createDataFrame(rows, "k int, prior_count long, row_count long, null_counts map<string,long>, announced_count long")).orderBy("k").collect()
    assert [x.passed for x in found] == [True, False, False, False]
    assert [[f.reason for f in x.failures] for x in found] == [[], ["volume_regression"], ["incomplete"], ["row_count_divergence"]]
    assert found[2].failures[0].detail == "a,b"


def test_fallback(spark):
    rows = spark.createDataFrame([("d", 1, "self", None, 1.0, {"owner": 0.0}, 1.0, "x", "page"), ("d", 2, "self", 3.0, 4.0, {"owner": 1.0}, 0.9, "x", "page")],
                                 "doc_id string, line_no int, owner string, value_min double, value_max double, field_confidence map<string,double>, confidence double, extractor string, given string")
    fields = ["owner", "value_min"]
    needed = rows.withColumn("needed", needed_fields(fields))
    seen = spark.sparkContext.accumulator(0)

    def complete(prompt, given, schema):
        seen.add(1)
        return {"owner": None, "value_min": "7"} if set(schema["required"]) == {"owner", "value_min"} else {}

    answered = completed(needed, complete, "given").persist()
    out = {x.line_no: x for x in applied(answered, fields).collect()}
    assert seen.value == 1
    assert (out[1].owner, out[1].value_min, out[1].value_max, out[1].confidence, out[1].extractor) == (None, 7.0, 1.0, 0.5, "x+llm-fallback")
    assert out[1].field_confidence == {"owner": 0.5, "value_min": 0.5}
    assert (out[2].owner, out[2].value_min, out[2].confidence, out[2].extractor) == ("self", 3.0, 0.9, "x")
    wrong = answered.withColumn("answer", F.lit('{"owner":"dog","value_min":"x"}')).where("line_no = 1")
    assert wrong.select(unreadable_fields(fields).alias("u")).first()["u"] == fields
    assert eligible_fields({"owner": 0.8, "ticker": 0.1}, ["owner", "ticker", "new"]) == ["ticker"]
    assert fallback_enabled("true", "digital", {"by_kind": {"digital": {"owner": 0.1}}}, fields) == ["owner"]
    assert fallback_enabled(None, "digital", {"by_kind": {}}, fields) == [] and fallback_enabled("1", "scanned", {}, fields) == []
    assert fallback_schema(["value_min"])["properties"] == {"value_min": {"type": ["number", "null"]}}


def test_completion_rows(spark):
    answer = {"transactions": [{"asset_description": "A", "transaction_date": "2026-01-02", "value_min": 1}, {"asset_description": "B", "transaction_date": "soon"}, {"asset_description": " ", "transaction_date": "2026-01-02"}, {"asset_description": "C", "transaction_date": "2026-01-03", "owner": "cat"}, {"asset_description": "D", "transaction_date": "2026-01-04", "owner": "joint"}]}
    pages = spark.createDataFrame([("d", 1, "p"), ("d", 2, "p")], "doc_id string, page_no int, given string")
    rows = extract_by_completion(pages, lambda prompt, given, schema: answer)
    assert values(rows, "line_no", "asset_description", "owner", "asset_type", "value_min") == [(1, "A", "self", "other", 1.0), (2, "D", "joint", "other", None), (3, "A", "self", "other", 1.0), (4, "D", "joint", "other", None)]


def test_providers():
    now, slept = [0.0], []
    pace = Pace(2.0, lambda: now[0], slept.append)
    pace.wait()
    now[0] = 0.5
    pace.wait()
    assert slept == [1.5]
    assert provider("groq", lambda p, g, s: {"ok": g})("p", "text", {}) == {"ok": "text"}
    for wrong, error in ((lambda: provider("groq", print)("p", b"img", {}), VisionUnsupportedError), (lambda: provider("x", print), UnknownProviderError)):
        try:
            wrong()
            raise AssertionError
        except error:
            pass
    assert gemini_schema({"type": ["string", "null"], "additionalProperties": False, "properties": {"a": {"type": ["number", "null"]}}}) == {"type": "string", "nullable": True, "properties": {"a": {"type": "number", "nullable": True}}}
