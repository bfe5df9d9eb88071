"""Expressions that take a traffic line apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import FIELD_DELIMITER

# Fixed value: the characters that count as white space at the ends of a line.
LINE_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

COUNT_PATTERN = "^[+-]?[0-9]+$"


def strip_line(value: Column) -> Column:
    """Remove white space from both ends. It runs before the split, so an empty first field shifts the rest."""
    return F.btrim(value, F.lit(LINE_BLANKS))


def line_fields(value: Column) -> Column:
    return F.split(value, FIELD_DELIMITER)


def count_value(text: str) -> str:
    """SQL for a whole number as BIGINT; anything else, or a number out of range, is NULL."""
    return f"CASE WHEN rlike({text}, '{COUNT_PATTERN}') THEN try_cast({text} AS BIGINT) END"
