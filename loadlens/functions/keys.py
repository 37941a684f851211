"""Composite keys and flags derived from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.constants import COUNTRY_WITH_REGIONS, NULL_TEXT
from loadlens.functions.cleaning import filled


def joined(*parts: Column | str, sep: str = "") -> Column:
    """Concatenate text columns; a missing part counts as empty text."""
    return F.concat_ws(sep, *[filled(p) for p in parts])


def collapse_null_key(c: Column, widths: tuple[int, ...] = (2, 3)) -> Column:
    """A key made only of ``widths`` null literals is one null literal."""
    hollow = ["_".join([NULL_TEXT] * n) for n in widths]
    return F.when(c.isin(hollow), F.lit(NULL_TEXT)).otherwise(c)


def country_region(country: Column | str, region: Column | str) -> Column:
    """``country_region`` for the country that is split by region, else the country.

    The country is the text before the first underscore, so an underscore inside
    a country name cuts it there.
    """
    name = F.substring_index(filled(country), "_", 1)
    return F.when(name.contains(COUNTRY_WITH_REGIONS), joined(country, region, sep="_")).otherwise(name)


def same(left: Column | str, right: Column | str) -> Column:
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    return left == right
