"""Null literals, safe casts and text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.constants import BLANK_KEY, NULL_TEXT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """Empty fields come out of the reader as NULL; keys need the empty text."""
    return F.coalesce(_col(c), F.lit(""))


def zero_if_null_text(c: Column | str) -> Column:
    """``'null'`` as the whole value becomes ``'0'``; anything else is kept."""
    c = _col(c)
    return F.when(c == NULL_TEXT, F.lit("0")).otherwise(c)


def replace_null_text(c: Column | str, by: str) -> Column:
    """Every occurrence of ``null`` inside the text is replaced."""
    return F.replace(_col(c), F.lit(NULL_TEXT), F.lit(by))


def present(c: Column | str) -> Column:
    """A number, with NaN as NULL: the one meaning of a missing number in all operators."""
    c = _col(c)
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), c)


def as_double(c: Column | str) -> Column:
    """Number of a text column, 0 for the null literal, NULL if malformed or not finite."""
    number = zero_if_null_text(c).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def as_long(c: Column | str) -> Column:
    """Whole number of a text column, decimals cut towards zero."""
    text = zero_if_null_text(c)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def blank_to(c: Column | str, label: str = BLANK_KEY) -> Column:
    c = _col(c)
    return F.when(c == "", F.lit(label)).otherwise(c)


def without_quotes(c: Column | str) -> Column:
    return F.translate(_col(c), '"', "")


def constant(value) -> Column:
    """The same value on every row."""
    return F.lit(value)
