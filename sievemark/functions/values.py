"""Date, number and null-safe compare expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemark.functions.text import _col, null_if_blank

INPUT_DATE = "MM/dd/yyyy HH:mm:ss"
REQUEST_DATE = "dd-MMM-yy HH:mm:ss"


def decade(c: Column | str) -> Column:
    """``1990s`` style label; a NULL date gives ``0s``."""
    return F.concat(F.coalesce(F.substring(F.year(_col(c)).cast("string"), 1, 3), F.lit("")), F.lit("0s"))


def number(c: Column | str) -> Column:
    """Text as a number, NULL where it is none."""
    return _col(c).try_cast("decimal(38,10)")


def differs(a: Column | str, b: Column | str) -> Column:
    """Plain inequality: NULL on either side drops the row."""
    return _col(a) != _col(b)


def differs_null_safe(a: Column | str, b: Column | str, sentinel: str = "none") -> Column:
    """Inequality with NULL read as ``sentinel``; a real value equal to the sentinel counts as NULL."""
    return F.coalesce(_col(a), F.lit(sentinel)) != F.coalesce(_col(b), F.lit(sentinel))


def yes_no(c: Column | str) -> Column:
    return F.nvl2(_col(c), F.lit("Yes"), F.lit("No"))


def null_label(c: Column | str, label: str) -> Column:
    return F.coalesce(_col(c), F.lit(label))


def request_date(c: Column | str, now: Column | None = None) -> Column:
    """Input date re-formatted for a request; blank means ``now``; NULL where it cannot be read."""
    text = F.coalesce(null_if_blank(c), F.date_format(F.lit(now) if now is not None else F.current_timestamp(), INPUT_DATE))
    return F.date_format(F.try_to_timestamp(text, F.lit(INPUT_DATE)), REQUEST_DATE)


def flag(cond: Column, value: str = "Y") -> Column:
    """``value`` where the condition holds, else NULL."""
    return F.when(cond, F.lit(value))
