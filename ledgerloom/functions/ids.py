"""Bank codes, display names, record ids, form numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import col, strip
from ledgerloom.schema import sentinel_to_null

_URL = uuid.NAMESPACE_URL.hex


def bank_code(c: str | Column) -> Column:
    """11 characters, upper case; null unless there are 8 or 11."""
    s = F.upper(strip(c))
    return F.when(F.length(s) == 8, F.concat(s, F.lit("XXX"))).when(F.length(s) == 11, s)


def is_bank_code(c: str | Column) -> Column:
    """D7."""
    return F.coalesce(strip(c).rlike("^(?i)[A-Z0-9]{8}([A-Z0-9]{3})?$"), F.lit(False))


def display_name(name: str | Column, code: str | Column) -> Column:
    """B17."""
    return strip(F.concat_ws(" ", sentinel_to_null(name), sentinel_to_null(code)))


def shorten_name(c: str | Column, limit: int = 50) -> Column:
    """The last word stays; of the others as many as fit, but one at least."""
    s = strip(c)
    words = F.split(s, r"\s+")
    n = F.size(words)
    last = F.element_at(words, -1)
    fits = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.length(F.array_join(F.slice(words, 1, k), " ")) + 1 + F.length(last) <= limit)
    k = F.coalesce(F.array_max(fits), F.lit(1))
    cut = F.concat_ws(" ", F.array_join(F.slice(words, 1, k), " "), last)
    return F.when((F.length(s) <= limit) | (n < 2), s).otherwise(cut)


def uuid5(name: str | Column) -> Column:
    """UUID version 5 in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(_URL)), F.encode(col(name), "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def record_id(prefix: str, *parts: str | Column) -> Column:
    return uuid5(F.concat_ws("|", F.lit(prefix), *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]))


def form_text(c: str | Column) -> Column:
    """A form number as text, without .0 and leading zeros; blank text is 0, null is empty."""
    s = F.regexp_replace(strip(col(c).cast("string")), r"\.0+$", "")
    return F.coalesce(F.when(s.isNotNull(), F.coalesce(F.nullif(F.regexp_replace(s, "^0+", ""), F.lit("")), F.lit("0"))), F.lit(""))


def form_numbers(c: str | Column) -> Column:
    """The numbers of `12030-None-12028`."""
    parts = F.transform(F.split(F.coalesce(col(c).cast("string"), F.lit("")), "-"), lambda x: F.regexp_extract(x, r"(\d+)", 1))
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.coalesce(F.nullif(F.regexp_replace(x, "^0+", ""), F.lit("")), F.lit("0")))


def usable(c: str | Column, loose: bool = False) -> Column:
    """Whether a form can be taken over; the loose rule only knows empty and none."""
    s = F.lower(strip(col(c)))
    return F.coalesce(~s.isin(*(("", "none") if loose else ("", "none", "nan", "nat"))), F.lit(False))
