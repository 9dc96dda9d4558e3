"""Queries on tables whose keys, counts or shapes lie beyond those of the smallest ones."""

import glob
import json
import os
import random
import re
from difflib import SequenceMatcher

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgermill.functions.similarity import LONG, SEGMENTED, near_candidates, near_names
from ledgermill.operators.fallback import completed
from ledgermill.plans import catalog, catalog_runs, catalog_streams  # noqa: F401
from ledgermill.plans.house_digital import extract_house_digital
from ledgermill.sources import pages, scans
from ledgermill.sources.scans import CHUNKS
from ledgermill.sources.senate_html import FilingPage, read_page

from .conftest import values
from .test_catalog import DATA, rows

needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def changed(spark, folder, **tables):
    """The smallest tables with some of them changed, and a DuckDB that sees the same."""
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[:-8]
        place = f"{folder}/{name}.parquet"
        if name in tables:
            tables[name](spark.read.parquet(path)).write.parquet(place)
        else:
            os.symlink(path, place)
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{place}{'/*.parquet' if os.path.isdir(place) else ''}'")
    return str(folder), con


def agrees(spark, name, folder, con):
    found, wanted = catalog.QUERIES[name](spark, folder), con.sql(catalog.ORACLES[name])
    return rows(found.columns, [tuple(x) for x in found.collect()]) == rows(wanted.columns, wanted.fetchall())


@needs_tables
def test_scanned_words_with_long_supplier_numbers(spark, tmp_path):
    longer = lambda lines: lines.withColumn("l_suppkey", F.col("l_suppkey") * F.when(F.col("l_partkey") % 2 == 0, 1234567).otherwise(9))
    assert agrees(spark, "scanned_words", *changed(spark, tmp_path, lineitem=longer))


def test_few_names_meet_that_are_not_near(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("0123456789abcdef") for _ in range(24)) for _ in range(3000)]
    left = spark.createDataFrame([(x,) for x in names], "left string")
    right = spark.createDataFrame([(f"{x[:5]}z{x[6:]}",) for x in names], "right string")
    assert {(x.left, x.right) for x in near_candidates(left, right, 0.9).collect()} == {(x, f"{x[:5]}z{x[6:]}") for x in names}


def test_long_names_lose_no_pair(spark):
    rng = random.Random(6)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randint(LONG - 3, SEGMENTED + 12))) for _ in range(40)]
    for x in names[:40]:
        for edits in (1, 3, 6):
            y = list(x)
            for _ in range(edits):
                at = rng.randrange(len(y))
                y[at : at + rng.randint(0, 2)] = rng.choice(["", "x", "yz"])
            names.append("".join(y))
    frame = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    wanted = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if SequenceMatcher(None, a, b).ratio() >= 0.9}
    assert {(x.left, x.right) for x in near_names(frame, frame).collect()} == wanted and len(wanted) > 300


def test_digital_forms_become_lines_once(spark):
    chunks = [("201", 1, 0, 20.0, 760.0, "$200?", "f"), ("202", 1, 0, 20.0, 760.0, "other", "f"), ("203", 1, 0, 20.0, 700.0, "P 01/02/2020 01/03/2020 $5", "f"), ("203", 2, 0, 20.0, 760.0, "$200?", "f"), ("203", 2, 1, 20.0, 700.0, "x [ST] P 01/02/2020 01/03/2020 $5", "f")]
    texts = [(x, 1, f"Filing ID #{x}\nName: A B\nDigitally Signed: A B, 02/01/2020") for x in ("201", "202", "203")]
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    filings, lines, lost = extract_house_digital(frame(chunks, CHUNKS), frame(texts, "doc_id string, page_no int, text string"), frame([(x, f"bronze/house/year=2020/{x}.pdf") for x in ("201", "202", "203", "204")], "doc_id string, bronze_key string"))
    assert sorted(x.doc_id for x in filings.collect()) == ["201", "203"]
    assert [(x.doc_id, x.line_no, x.asset_description) for x in lines.collect()] == [("203", 1, "x [ST]")]
    assert {x.doc_id: x.reasons for x in lost.collect()} == {"202": ["no_table_header"], "204": ["filer_name", "filing_date", "filing_id", "no_table_header"]}
    grouped = re.findall(r"Aggregate \[doc_id#\d+, page_no#\d+, y#\d+", lines._jdf.queryExecution().optimizedPlan().toString())
    assert len(grouped) == 1


class _Parser(FilingPage):
    """The page as the standard library's parser reads it."""


def test_plain_pages_need_no_parser(monkeypatch):
    rng = random.Random(7)
    pieces = ["<table class=\"table table-striped\">", "<tbody>", "<tr>", "<td>", "</td>", "</tr>", "</tbody>", "</table>", '<h2 class="filedReport">', "</h2>", '<p class="muted">', "</p>", '<div class="x text-muted" id="d">', "</div>", "<br>", "<a href=\"x\">", "</a>", "a &amp; b", "&lt;c", "&am", "&#8203;", " \n", ">", "Filed 01/02/2020", "<em>", "</em>"]
    other = ["<br/>", "<script>", "<!-- x -->", "<td colspan=2>", "<TD>", "<", "</td x>", "<?x>", "<title>"]
    read = lambda page: (page.header, page.filed, page.tables, page.rows)
    for k in range(3000):
        html = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))
        if k % 2:
            html = html.replace("a &amp; b", rng.choice(other))
        page = _Parser()
        page.feed(html)
        page.close()
        page._end_cell()
        assert read(read_page(html)) == read(page), html
    monkeypatch.setattr(FilingPage, "feed", None)
    assert read_page('<p class="muted">Filed</p><table class="table-striped"><tbody><tr><td>1</td></tr></tbody></table>').rows[0]["cells"] == ["1"]


class _Halves:
    def count(self, content):
        return len(content) // 2

    def page(self, content, page_no):
        return content.decode()[2 * page_no - 2 : 2 * page_no], None


def test_a_task_reads_one_file_and_its_neighbours(spark, tmp_path):
    docs = [(f"{k:03}", bytes("ab" * (k % 9), "ascii")) for k in range(60)]
    place = f"file://{tmp_path}/some docs"
    spark.createDataFrame(docs, "doc_id string, content binary").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.parquet(place)
    found = pages.read_pages(spark, place, _Halves(), 10)
    assert values(found, "doc_id", "page_no") == sorted((d, k) for d, c in docs for k in range(1, len(c) // 2 + 1))
    tasks = spark.read.parquet(*[f"file://{x}" for x in _plans(spark)[-1:]]).select("file", "task", "doc_id").collect()
    by_task = {}
    for x in tasks:
        by_task.setdefault((x.file, x.task), set()).add(x.doc_id)
    assert len({f for f, _ in by_task}) == 5 and max(map(len, by_task.values())) < 20
    assert not any(min(b) < max(a) and min(a) < max(b) for i, a in by_task.items() for j, b in by_task.items() if i != j)


def _plans(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return [x for _, x in sorted((os.path.getmtime(x), x) for x in glob.glob(f"{folder}/page-plan-*"))]


def test_rasters_go_out_in_batches(spark, monkeypatch):
    made = []
    batch = scans._raster_batch
    monkeypatch.setattr(scans, "_raster_batch", lambda rows: made.append(len(rows)) or batch(rows))
    turn = []

    class Pages:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            turn.append(run)

    scans.upright_candidates(Pages(), (0, 90))
    pages = pa.RecordBatch.from_pylist([{"doc_id": str(k), "page_no": 1, "width": 3, "pixels": bytes([k, 255, 0] * 2)} for k in range(200)])
    out = list(turn[0](iter([pages, pages])))
    assert made == [800] and [x.num_rows for x in out] == [800]


def test_rows_to_complete_are_dealt_by_document_alone(spark):
    rows_ = [(d, n % 3, "a" * (n % 4) or None, ["owner"] if n % 2 else [], {"x": float(n)}, f"{d}") for d in ("p", "q") for n in range(12)]
    frame = spark.createDataFrame(rows_, "doc_id string, line_no int, text string, needed array<string>, sure map<string,double>, given string").repartition(3, "doc_id")
    out = completed(frame, lambda prompt, given, schema: {"owner": given, "line": prompt.split(" of line ")[1].split()[0]}, "given")
    found = {(x.doc_id, x.sure["x"]): x.answer and json.loads(x.answer) for x in out.collect()}
    assert found == {(d, sure["x"]): {"owner": d, "line": str(n)} if need else None for d, n, _, need, sure, _ in rows_}
    assert not re.search(r"hashpartitioning\(doc_id#\d+, line_no", out._jdf.queryExecution().executedPlan().toString())
