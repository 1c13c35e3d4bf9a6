"""Dates of ledgers, mails, scanned pages and folder names; unparseable values are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import col, found, let, rx, squash, strip
from ledgerloom.schema import sentinel_to_null

#: Month texts as scanners read them, and Spanish names in the order in which they are looked for.
MONTHS = {m: m for m in ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")} | {"PEB": "FEB", "FEE": "FEB", "SEPT": "SEP"}
MESES = (("ENERO", 1), ("FEBRERO", 2), ("MARZO", 3), ("ABRIL", 4), ("MAYO", 5), ("JUNIO", 6), ("JULIO", 7), ("AGOSTO", 8), ("SEPTIEMBRE", 9), ("SETIEMBRE", 9), ("OCTUBRE", 10), ("NOVIEMBRE", 11), ("DICIEMBRE", 12))
_NUMBER = {m: k + 1 for k, m in enumerate(dict.fromkeys(MONTHS.values()))}


def try_date(y: Column, m: Column, d: Column) -> Column:
    """A date from numbers as text; null if there is none such."""
    return F.try_to_timestamp(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def _lookup(c: Column, of: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[c]


def _month(word: Column) -> Column:
    known = {k: _NUMBER[v] for k, v in MONTHS.items()}
    return F.coalesce(_lookup(F.substring(word, 1, 4), known), _lookup(F.substring(word, 1, 3), known))


def iso_date(c: str | Column) -> Column:
    s = col(c)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date"))


def clean_date_token(c: str | Column) -> Column:
    """B25."""
    return squash(F.translate(F.upper(col(c)), ",.-/", "    "))


def scanned_date(c: str | Column) -> Column:
    """Day, month word and year, with the scanner's O and I in years."""
    part = lambda s, k: F.regexp_extract(s, rx(r"^(\d{1,2})\s+([A-Z]{2,4})\s+(\w{4})$"), k)
    date = lambda s, year: F.when(year.rlike(r"^\d{4}$"), try_date(year, let(part(s, 2), _month).cast("string"), part(s, 1)))
    return let(clean_date_token(c), lambda s: let(F.translate(part(s, 3), "OI", "01"), lambda year: date(s, year)))


def printed_date(c: str | Column) -> Column:
    """As B23 without what scanners get wrong in years and separators."""
    part = lambda s, k: F.regexp_extract(s, rx(r"^(\d{1,2})\s+([A-Z]{3,})\s+(\d{4})$"), k)
    date = lambda s, year: F.when(year != "", try_date(year, let(part(s, 2), _month).cast("string"), part(s, 1)))
    return let(F.upper(squash(c)), lambda s: let(part(s, 3), lambda year: date(s, year)))


def ledger_date(c: str | Column) -> Column:
    """Days since 1899-12-30, ISO, or day first."""
    s = strip(col(c).cast("string"))
    serial = F.when(s.rlike(r"^\d{1,6}(\.\d+)?$"), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(s.try_cast("double")).cast("int")))
    p = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
    iso = iso_date(F.substring(s, 1, 10))
    return F.coalesce(serial, iso, try_date(found(s, p, 3), found(s, p, 2), found(s, p, 1)))


def mail_date(c: str | Column) -> Column:
    """ISO text where one of four formats fits, else the text as it is."""
    s = sentinel_to_null(c)
    words, p = r"^(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})$", r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$"
    month = _lookup(F.upper(found(s, words, 2)), _NUMBER).cast("string")
    same = s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") | s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$")
    date = F.coalesce(
        try_date(found(s, words, 3), month, found(s, words, 1)), iso_date(s), F.when(same, try_date(found(s, p, 3), found(s, p, 2), found(s, p, 1)))
    )
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), s)


def is_date(c: str | Column) -> Column:
    """Whether one of seven formats fits."""
    s, day = strip(c), r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$"
    word = r"^(\d{1,2})\s*([A-Za-z]{3})\s*(\d{4})$"
    packed = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date"))
    us = F.when(s.contains("/"), try_date(found(s, day, 3), found(s, day, 1), found(s, day, 2)))
    month = _lookup(F.upper(found(s, word, 2)), _NUMBER).cast("string")
    return F.coalesce(
        packed, iso_date(s), try_date(found(s, word, 3), month, found(s, word, 1)), try_date(found(s, day, 3), found(s, day, 2), found(s, day, 1)), us
    ).isNotNull()


def folder_month(c: str | Column) -> Column:
    """A10: the first Spanish month, in table order, that the name holds."""
    s = F.upper(strip(c))
    return F.coalesce(*[F.when(s.contains(name), F.lit(k)) for name, k in MESES])


def folder_day(c: str | Column, year: Column) -> Column:
    """`26 NOVIEMBRE` in the given year."""
    s, p = F.upper(strip(c)), r"^(\d{1,2})\s+([A-ZÁÉÍÓÚÑ]+)$"
    return try_date(year.cast("string"), _lookup(found(s, p, 2), dict(MESES)).cast("string"), found(s, p, 1))


def file_date(c: str | Column) -> Column:
    """The first eight digits, DDMMYYYY, of a name without its extension and spaces."""
    s = F.replace(F.regexp_replace(col(c), r"\.[^.]*$", ""), F.lit(" "), F.lit(""))
    digits = found(s, r"^(\d{8})")
    return try_date(F.substring(digits, 5, 4), F.substring(digits, 3, 2), F.substring(digits, 1, 2))
