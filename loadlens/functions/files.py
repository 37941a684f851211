"""Sizes out of the JSON text that lists the files of an ad.

Everything is built-in string and array functions, so no Python worker starts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_FILES = "array<struct<type:string,size:bigint>>"


def _total(numbers: Column) -> Column:
    return F.aggregate(
        numbers,
        F.lit(0).cast("bigint"),
        lambda acc, token: acc + F.coalesce(token.try_cast("bigint"), F.lit(0).cast("bigint")),
    )


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def size_of_type(c: Column | str, kind: str, quoted: bool = False) -> Column:
    """Sum of the sizes of one file type, by comma-separated tokens.

    Brackets and the ``type,size`` lead-in of ``kind`` are dropped; what then
    stands between two commas and is all digits is a size. ``quoted`` is for
    text that still has its double quotes.
    """
    lead = f'{{"type":"{kind}","size":' if quoted else f"{{type:{kind},size:"
    bare = F.replace(F.translate(_column(c), "[]}", ""), F.lit(lead), F.lit(""))
    return F.coalesce(_total(F.regexp_extract_all(bare, F.lit("(?<![^,])[0-9]+(?![^,])"), F.lit(0))), F.lit(0))


def image_size(c: Column | str, quoted: bool = False) -> Column:
    return size_of_type(c, "image", quoted)


def video_size(c: Column | str, quoted: bool = False) -> Column:
    return size_of_type(c, "video", quoted)


def total_size(c: Column | str) -> Column:
    """Sum of all numbers left once everything but digits and commas is gone.

    A digit inside a type name counts as well.
    """
    kept = F.regexp_replace(_column(c), "[^,0-9]", "")
    return F.coalesce(_total(F.split(kept, ",")), F.lit(0))


def json_size(c: Column | str, kind: str | None = None) -> Column:
    """Same sums from parsed JSON, whatever the order of the attributes."""
    files = F.from_json(_column(c), _JSON_FILES)
    wanted = files if kind is None else F.filter(files, lambda f: f["type"] == kind)
    return F.coalesce(_total(F.transform(wanted, lambda f: f["size"])), F.lit(0))
