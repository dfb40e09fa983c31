"""Scalar text functions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: everything that is neither a Unicode letter or number, an underscore nor white space
PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]"
# fixed values: texts that count as an empty key part
BLANK_KEYS = ("", "null", "undefined")
# fixed value: the literal that stands for NULL in delimited text
NULL_LITERAL = "NULL"


def upper_case(column: str | Column) -> Column:
    return F.upper(column)


def strip_punctuation(column: str | Column) -> Column:
    """Remove every character that is not a word character or white space (Unicode-aware)."""
    return F.regexp_replace(column, PUNCTUATION + "+", "")


def split_list(column: str | Column, separator: str = ",") -> Column:
    """Split a separated list into an array, trimming the items and dropping empty ones."""
    # white space as Python's str.strip sees it
    trimmed = F.transform(
        F.split(column, _quote(separator)), lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    )
    return F.filter(trimmed, lambda x: x != "")


def normalize_text(column: Column, ignore_whitespace: bool = False, ignore_case: bool = False) -> Column:
    """The form in which texts are compared."""
    if ignore_whitespace:
        column = F.regexp_replace(column, r"^\s+|\s+$", "")
    if ignore_case:
        column = F.lower(column)
    return column


def key_part(column: Column, ignore_whitespace: bool = False, ignore_case: bool = False) -> Column:
    """Key text of one column; blank keys (null, '', 'null', 'undefined') all become ''."""
    text = normalize_text(column.cast("string"), ignore_whitespace, ignore_case)
    return F.when(text.isNull() | text.isin(*BLANK_KEYS), F.lit("")).otherwise(text)


def key_text(columns: Sequence[Column], ignore_whitespace: bool = False, ignore_case: bool = False) -> Column:
    """Readable composite key: the parts joined by ' // '."""
    return F.concat_ws(" // ", *[key_part(c, ignore_whitespace, ignore_case) for c in columns])


def escape_null(column: Column) -> Column:
    """Text form in which NULL is written as the literal and a literal text gains an underscore."""
    text = column.cast("string")
    escaped = F.regexp_replace(text, f"^(_*){NULL_LITERAL}$", f"_$1{NULL_LITERAL}")
    return F.coalesce(escaped, F.lit(NULL_LITERAL))


def unescape_null(column: Column) -> Column:
    """Inverse of :func:`escape_null`."""
    plain = F.regexp_replace(column, f"^_(_*){NULL_LITERAL}$", f"$1{NULL_LITERAL}")
    return F.when(column != NULL_LITERAL, plain)


def _quote(separator: str) -> str:
    return "\\Q" + separator + "\\E"
