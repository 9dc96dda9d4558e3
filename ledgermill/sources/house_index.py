"""The House's yearly index: an XML file inside a ZIP."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.routing import house_kind

MEMBERS = "path string, index_row int, doc_id string, filing_type string, error string"


def index_members(archives: DataFrame) -> DataFrame:
    """Every <Member> of archives (path, content), in order; one error row for an archive without XML."""

    def unzip(batches):
        schema = pa.schema([("path", pa.string()), ("index_row", pa.int32()), ("doc_id", pa.string()), ("filing_type", pa.string()), ("error", pa.string())])
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        name = next((x for x in archive.namelist() if x.lower().endswith(".xml")), None)
                        if name is None:
                            raise ValueError("no XML member")
                        for i, member in enumerate(ElementTree.fromstring(archive.read(name)).iter("Member")):
                            rows.append((path, i, (member.findtext("DocID") or "").strip(), (member.findtext("FilingType") or "").strip(), None))
                except (ValueError, zipfile.BadZipFile, ElementTree.ParseError) as wrong:
                    rows = [(path, None, None, None, f"{type(wrong).__name__}: {wrong}")]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in rows], schema=schema)

    return archives.select("path", "content").mapInArrow(unzip, MEMBERS)


def house_entries(members: DataFrame, year: int) -> DataFrame:
    """doc_id, year, kind, index_row of periodic reports with an id of a known kind."""
    kept = members.where((F.col("filing_type") == "P") & (F.col("doc_id") != ""))
    return kept.select("doc_id", F.lit(year).alias("year"), house_kind(F.col("doc_id")).alias("kind"), "index_row").where(F.col("kind").isNotNull())
