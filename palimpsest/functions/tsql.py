"""Expressions with the semantics of the reference's SQL dialect, where they differ from Spark's."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def tsql_len(text: Column) -> Column:
    """Length in characters without trailing blanks."""
    return F.length(F.rtrim(text)).cast("long")


def utf16_len(text: Column) -> Column:
    """Length in UTF-16 units: an astral character counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("long")


def datediff_boundaries(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``: 00:00:59 to 00:01:01 is one minute."""
    micros = lambda c: F.unix_micros(F.date_trunc(unit, c.cast("timestamp")))
    size = {"MILLISECOND": 1_000, "SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000}[unit.upper()]
    return ((micros(end) - micros(start)) / size).cast("long")


def avg_int(total: Column, count: Column) -> Column:
    """Integer average: the quotient without its fraction; null for no rows."""
    return F.when(count > 0, F.call_function("div", total, count))


def ci_like(text: Column, pattern: str) -> Column:
    """LIKE without regard to case."""
    return text.ilike(pattern)


def ci_in(text: Column, values: list[str]) -> Column:
    """IN without regard to case and trailing blanks."""
    return F.lower(F.rtrim(text)).isin([v.rstrip().lower() for v in values])


def after_first(text: Column, mark: str, length: int = 99) -> Column:
    """The part after the first ``mark``, up to ``length`` characters; the whole text without one."""
    return F.substring(text, F.instr(text, mark) + 1, F.lit(length))


def iso_seconds(ts: Column, twelve_hours: bool = False) -> Column:
    """ISO 8601 to the second; ``twelve_hours`` repeats the reference's 12-hour clock without a day half."""
    return F.date_format(ts, "yyyy-MM-dd'T'hh:mm:ss" if twelve_hours else "yyyy-MM-dd'T'HH:mm:ss")


def gzip_length(text: Column) -> Column:
    """Bytes of the gzip-compressed text; the count is not comparable across compressors."""

    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(gzip.compress(t.encode(), mtime=0)) for t in texts], dtype="Int64")

    return F.pandas_udf(size, "long")(text)


def gzip_bytes(text: Column) -> Column:
    """The gzip-compressed text."""

    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else gzip.compress(t.encode(), mtime=0))

    return F.pandas_udf(pack, "binary")(text)


def gunzip(data: Column) -> Column:
    """The text of gzip-compressed bytes."""

    def unpack(parts: pd.Series) -> pd.Series:
        return parts.map(lambda b: None if b is None else gzip.decompress(b).decode())

    return F.pandas_udf(unpack, "string")(data)
