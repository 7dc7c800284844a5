"""One spelling for IP addresses, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _groups(part: Column) -> Column:
    return F.filter(F.split(part, ":"), lambda g: g != "")


def _plain(group: Column) -> Column:
    """A group without leading zeros; at least one digit stays."""
    return F.regexp_replace(group, r"^0+(?=.)", "")


def canonical_ip(address: Column) -> Column:
    """Lower case, no blanks, no leading zeros, ``::`` written out; an IPv4 address inside IPv6 is that IPv4 address.

    Null stays null, a blank text becomes null.  A text that is no address is only trimmed and put in lower case.
    """
    text = F.lower(F.regexp_replace(address, r"\s+", ""))
    text = F.regexp_replace(text, r"^\[|\]$|%.*$|/(32|128)$", "")
    mapped = F.regexp_extract(text, r"^(?:0{0,4}:){1,6}(?:ffff:)?(\d{1,3}(?:\.\d{1,3}){3})$", 1)
    four = F.when(mapped != "", mapped).otherwise(text)
    v4 = F.array_join(F.transform(F.split(four, r"\."), _plain), ".")
    head = _groups(F.substring_index(text, "::", 1))
    tail = F.when(F.instr(text, "::") > 0, _groups(F.substring_index(text, "::", -1))).otherwise(F.array().cast("array<string>"))
    gap = F.greatest(F.lit(0), F.lit(8) - F.size(head) - F.size(tail))
    filled = F.when(F.instr(text, "::") > 0, F.concat(head, F.array_repeat(F.lit("0"), gap), tail)).otherwise(head)
    v6 = F.array_join(F.transform(filled, _plain), ":")
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .when(four.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), v4)
        .when(text.rlike(r"^[0-9a-f:]*:[0-9a-f:]*$"), v6)
        .otherwise(text)
    )
