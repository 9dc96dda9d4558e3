"""Text functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from unicodedata import is_normalized

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once however often it is used."""
    return F.transform(F.array(value), use)[0]


def collapsed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def grabbed(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without a match (an empty group stays empty)."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def snake(text: Column) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one underscore, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_"), F.lit("_"))


# Characters that source text must not hold.
FORBIDDEN = {
    "nul": "\\x{0000}",
    "replacement": "\\x{FFFD}",
    "zero_width_space": "\\x{200B}",
    "zero_width_non_joiner": "\\x{200C}",
    "zero_width_joiner": "\\x{200D}",
    "word_joiner": "\\x{2060}",
    "bidi_control": "[\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}]",
}


def unicode_findings(text: Column) -> Column:
    """Names of the forbidden kinds of characters that a text holds, and ``bom`` for a leading one."""
    found = [F.when(text.rlike(p), F.lit(k)) for k, p in FORBIDDEN.items()]
    return F.array_compact(F.array(F.when(text.startswith("﻿"), F.lit("bom")), *found))


def file_findings(content: Column) -> Column:
    """Findings of a file's bytes: ``invalid_utf8`` alone where they are no UTF-8, else those of the text."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), unicode_findings(text)).otherwise(F.array(F.lit("invalid_utf8")))


#: Characters that are normal wherever they stand: none of these decomposes or composes with the one before. Up to U+02FF all
#: letters come before the combining marks; the rest are punctuation, currency signs and Han.
_PLAIN = r"^[\x{0000}-\x{02FF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20A0}-\x{20C0}\x{4E00}-\x{9FFF}]*$"


@F.pandas_udf(BooleanType())
def _normalised(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else is_normalized("NFC", x))


def nfc_in_doubt(text: Column) -> Column:
    """Whether only a full look can tell that a text is NFC-normalised."""
    return ~text.rlike(_PLAIN)


def is_nfc(text: Column) -> Column:
    """Whether a text is NFC-normalised: by its characters' classes, and only where those leave it open in Python."""
    doubt = nfc_in_doubt(text)
    return F.when(text.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(_normalised(F.when(doubt, text)), F.lit(True)))
