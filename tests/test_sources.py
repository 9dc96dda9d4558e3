import io
import json
import zipfile

import numpy as np
from pyspark.sql import functions as F

from ledgermill.operators.routing import search_outcome
from ledgermill.sources.house_index import house_entries, index_members
from ledgermill.sources.lookups import company_listing, search_candidates
from ledgermill.sources.messages import decoded_messages
from ledgermill.sources.scans import upright_angle, usable_chunks
from ledgermill.sources.senate_html import read_page
from ledgermill.sources.senate_index import RESPONSE, senate_entries

from .conftest import values


def archive(xml, name="2026FD.xml"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, xml)
    return out.getvalue()


def test_house_index(spark):
    member = lambda kind, doc: f"<Member><FilingType>{kind}</FilingType><DocID>{doc}</DocID></Member>"
    xml = "<FD>" + member("P", "20012345") + member("C", "20000001") + member("P", "8219999") + member("P", " ") + member("P", "5000") + member("P", "20012345") + "</FD>"
    members = index_members(spark.createDataFrame([("a", archive(xml)), ("b", archive("x", "a.txt")), ("c", b"junk")], "path string, content binary"))
    assert members.where("error is not null").count() == 2
    assert values(house_entries(members, 2026)) == [("20012345", 2026, "digital", 0), ("20012345", 2026, "digital", 5), ("8219999", 2026, "scanned", 2)]


def test_senate_index(spark):
    uid = "b999bc0e-3eb0-4ca9-ab07-8e8f2e04b41f"
    link = lambda kind: f'<a href="/search/view/{kind}/{uid}/" target="_blank">x</a>'
    rows = [["a", "b", "c", link("ptr"), "01/02/2026"], ["a"], ["a", "b", "c", link("paper"), "01/02/2026"], ["a", "b", "c", link("extension-notice/regular"), "01/02/2026"], ["a", "b", "c", "none", "01/02/2026"], ["a", "b", "c", link("ptr"), "soon"], ["a", "b", "c", link("ptr"), " 03/04/2025 "]]
    body = spark.createDataFrame([(json.dumps({"draw": 1, "data": rows}),)], "body string").select(F.from_json("body", RESPONSE)["data"].alias("data"))
    assert values(senate_entries(body)) == [(uid, 2025, "ptr", 6), (uid, 2026, "ptr", 0)]


def test_messages(spark):
    bodies = [
        '{"bronze_key":"k1"}', json.dumps({"Records": [{"eventSource": "aws:sqs", "messageId": "m", "body": '{"bronze_key":"k2"}'}, {"eventSource": "aws:s3", "s3": {"object": {"key": "a%3D1/b+c"}}}]}),
        '{"Records":[{"eventSource":"other"}]}', "{}", "no json",
    ]
    found = decoded_messages(spark.createDataFrame([(x,) for x in bodies], "body string"))
    assert values(found) == sorted([("k1", None, None), ("k2", "m", None), ("a=1/b c", None, None), (None, None, "unrecognized_record"), (None, None, "unrecognized_event"), (None, None, "unrecognized_event")], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_lookups(spark):
    body = json.dumps({"data": [{"ticker": "", "name": "x"}, {"ticker": "B", "name": "b"}, {"ticker": "C", "name": None}]})
    responses = spark.createDataFrame([("q", body), ("r", '{"error":"none"}')], "query string, body string")
    assert values(search_candidates(responses)) == [("q", 1, "B", "b")]
    listing = spark.createDataFrame([(json.dumps({"0": {"cik_str": 1, "ticker": "A", "title": "Aa"}, "1": {"cik_str": 2, "ticker": "", "title": "Bb"}, "2": {"cik_str": 3, "ticker": "C", "title": "Cc"}}),)], "body string")
    assert values(company_listing(listing)) == [(0, "A", "Aa"), (2, "C", "Cc")]


def test_page_parser():
    page = read_page('<h2 class="filedReport x">A  B</h2><p class="muted">Filed 01/02/2026</p><table class="table table-striped"><thead><tr><td>no</td></tr></thead><tbody><tr>'
                     '<td>1<td>2</td><td>3</td><td>4</td><td>One<br>two &amp; x<div class="text-muted"><em>Rate:</em> 5%</div><div class="text-muted">more</div></td></tr></tbody></table><table class="table-striped"><tbody><tr><td>z</td></tr></tbody></table>')
    assert (page.header, page.filed, page.tables, len(page.rows)) == ("A B", "Filed 01/02/2026", 1, 1)
    assert page.rows[0]["cells"][:4] == ["1", "2", "3", "4"]
    assert page.rows[0]["asset_lines"] == ["One", "two & x"] and page.rows[0]["asset_muted"] == ["Rate: 5%", "more"]


def test_scans(spark):
    rows = [("d", 0, 90, "HOUSE asset"), ("d", 1, 270, "House ASSET"), ("e", 0, 90, "x"), ("e", 1, 270, "name")]
    assert values(upright_angle(spark.createDataFrame(rows, "doc_id string, ord int, angle int, text string"))) == [("d", 90), ("e", 270)]
    chunks = spark.createDataFrame([("d", 1, 1, 0.0, 1.25, "a", "/F1"), ("d", 1, 2, 0.0, 1.0, "b", "/XMarlett"), ("d", 1, 3, 0.0, 1.0, " ", "/F1"), ("d", 1, 4, 0.0, 1.0, "c", None)], "doc_id string, page_no int, seq int, x double, y double, text string, font string")
    assert values(usable_chunks(chunks), "y", "text") == [(1.2, "a")]


def test_search_outcome(spark):
    rows = [(200, '{"data":[]}'), (200, '{"data":1}'), (200, "x"), (403, ""), (403, "y"), (500, "Access Denied")]
    found = spark.createDataFrame(rows, "s int, b string").select(search_outcome(F.col("s"), F.col("b")).alias("o")).collect()
    assert [x.o for x in found] == ["cleared", "ambiguous", "ambiguous", "blocked_akamai", "blocked_other", "blocked_other"]


def test_one_page_that_cannot_be_parsed(spark):
    """Its document goes to quarantine; the rest of the batch is read."""
    from ledgermill.sources import senate_html

    frame = spark.createDataFrame([("a", "k", b"<html></html>"), ("b", "k", None)], "doc_id string, bronze_key string, content binary")
    rows = {x.doc_id: x for x in senate_html.filing_pages(frame).collect()}
    assert rows["a"].n_tables == rows["b"].n_tables == 0 and rows["a"].bronze_key == "k"
    from ledgermill.plans.senate import extract_senate

    filings, lines, lost = extract_senate(frame)
    assert filings.count() == lines.count() == 0 and {x.doc_id: x.reasons for x in lost.collect()} == {x: ["filer_name", "filing_date", "table"] for x in "ab"}


def test_gridlines():
    from ledgermill.sources.scans import without_gridlines

    grey = np.full((9, 12), 255, np.uint8)
    grey[4, :], grey[1, 1], grey[8, 3] = 0, 0, 0
    out = without_gridlines(grey)
    assert out[1, 1] == 0 and out[8, 3] == 0 and (out[2:7] == 255).all() and grey[4, 0] == 0
    assert (without_gridlines(grey.T) == out.T).all() and (without_gridlines(np.zeros((1, 2), np.uint8)) == 255).all()
