"""Token-level column expressions (all JVM-side, no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.constants import (
    ANSWER_ID,
    ANSWER_TEXT,
    CODEPOINT_OFFSET,
    DEFAULT_PAD_ID,
    EOS_ID,
    EOS_TEXT,
    IGNORE_INDEX,
    QUESTION_ID,
    QUESTION_TEXT,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_int_array() -> Column:
    return F.array().cast("array<int>")


def codepoint_ids(text) -> Column:
    """Text -> ``array<int>`` of ``codepoint + 256``; NULL stays NULL, '' gives ``[]``.

    ``split(s, '')`` cuts by code point (characters beyond the BMP stay whole) and
    ``ascii`` returns the code point of a one-character string.
    """
    t = _col(text)
    ids = F.transform(F.split(t, ""), lambda c: F.ascii(c) + F.lit(CODEPOINT_OFFSET))
    return F.when(F.length(t) == 0, empty_int_array()).otherwise(ids)


def token_count(text) -> Column:
    """Number of codepoint tokens without building the array."""
    return F.length(_col(text)).cast("int")


def ones_like(ids) -> Column:
    return F.transform(_col(ids), lambda _x: F.lit(1))


def _piece(i: Column) -> Column:
    cp = i - F.lit(CODEPOINT_OFFSET)
    char = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return (F.when(i >= CODEPOINT_OFFSET, char)
            .when(i == QUESTION_ID, F.lit(QUESTION_TEXT))
            .when(i == ANSWER_ID, F.lit(ANSWER_TEXT))
            .when(i == EOS_ID, F.lit(EOS_TEXT))
            .otherwise(F.lit("")))


def decode_ids(ids) -> Column:
    """Ids -> text. Codepoint ids decode through UTF-32 (whole Unicode range); the reserved
    markers and eos decode to their text; pad and other reserved ids decode to ''."""
    return F.array_join(F.transform(_col(ids), _piece), "")


def labels_for_display(labels, pad_id: int = DEFAULT_PAD_ID) -> Column:
    """Replace the ignore id by pad so that labels can be decoded."""
    return F.transform(_col(labels), lambda x: F.when(x == IGNORE_INDEX, F.lit(pad_id)).otherwise(x))


def ids_text(ids) -> Column:
    """Comma-joined ids: a stable text form for comparisons and reports."""
    return F.array_join(_col(ids), ",")
