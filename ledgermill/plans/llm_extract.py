"""Transactions read by an injected completion, one call a page."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import SCORED
from ..operators.fallback import ENUMS, fallback_schema
from ..operators.lines import renumbered
from ..shared import written

EXTRACTOR = "llm"
ROWS = "transactions array<struct<" + ",".join(f"{x}:string" for x in SCORED) + ">>"


def transaction_schema() -> dict:
    return fallback_schema(SCORED)


def page_schema() -> dict:
    return {"type": "object", "properties": {"transactions": {"type": "array", "items": transaction_schema()}}, "required": ["transactions"], "additionalProperties": False}


PROMPT = "List every transaction of this page as JSON by the schema; null where the page does not say."


def extract_by_completion(pages: DataFrame, complete: Callable[[str, object, dict], dict]) -> DataFrame:
    """Scored columns with doc_id and line_no from pages (doc_id, page_no, given). A row with a value that is none of its
    kind, without a date or without a description is dropped; numbers run over the rows kept. Answers are written to the
    shared folder first, so that each page is asked about once."""

    def ask(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "page_no": pdf.page_no, "answer": [json.dumps(complete(PROMPT, x, page_schema())) for x in pdf.given]})

    answers = written(pages.select("doc_id", "page_no", "given").mapInPandas(ask, "doc_id string, page_no int, answer string"), "answers")
    rows = answers.select("doc_id", "page_no", F.posexplode(F.from_json("answer", ROWS)["transactions"]).alias("nth", "t")).select("doc_id", "page_no", "nth", "t.*")
    dated = {x: F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date") for x in ("transaction_date", "notification_date")}
    number = {x: F.col(x).try_cast("double") for x in ("value_min", "value_max")}
    fine = F.lit(True)
    for x, value in (dated | number).items():
        fine = fine & (F.col(x).isNull() | value.isNotNull())
    for x, values in ENUMS.items():
        fine = fine & (F.col(x).isNull() | F.col(x).isin(*values))
    kept = rows.where(fine & F.col("transaction_date").isNotNull() & (F.coalesce(F.trim("asset_description"), F.lit("")) != ""))
    typed = kept.withColumns(dated | number | {"owner": F.coalesce("owner", F.lit("self")), "asset_type": F.coalesce("asset_type", F.lit("other")), "confidence": F.lit(0.5), "extractor": F.lit(EXTRACTOR)})
    return renumbered(typed, ["doc_id"], ["page_no", "nth"]).drop("page_no", "nth")
