"""Amounts: three parsers, named by origin, that must not be mixed in one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import col, let, rx, strip
from ledgerloom.schema import sentinel_to_null

#: Largest difference of amounts that count as equal, in binary doubles.
TOLERANCE = 0.05


def _number(s: Column) -> Column:
    """Text of digits with at most one dot as a double, else null (never NaN)."""
    return F.when(s.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), s.try_cast("double"))


def decimal_text(c: str | Column) -> Column:
    """The text with a dot as its only separator, by what the separators look like: one alone is decimal, several
    alike are thousands, of two kinds the later is decimal."""
    s = F.regexp_replace(col(c), "[^0-9.,]", "")
    dots, commas = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit(""))), F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    no_dots, no_commas = F.replace(s, F.lit("."), F.lit("")), F.replace(s, F.lit(","), F.lit(""))
    comma_last = F.locate(",", F.reverse(s)) < F.locate(".", F.reverse(s))
    as_dot = lambda x: F.replace(x, F.lit(","), F.lit("."))
    return (
        F.when((dots == 0) & (commas == 1), as_dot(s))
        .when((dots == 0) | (commas == 0), F.when(dots + commas > 1, F.regexp_replace(s, "[.,]", "")).otherwise(s))
        .when(comma_last, as_dot(no_dots))
        .otherwise(no_commas)
    )


def clean_amount(c: str | Column) -> Column:
    """Two decimals as text, null if it isn't an amount; the sign is lost."""
    n = _number(decimal_text(c))
    return F.when(n.isNotNull(), F.format_string("%.2f", n))


def parse_money(c: str | Column) -> Column:
    """A double, sign kept; with both separators the dot is always for thousands."""
    s = F.regexp_replace(F.regexp_replace(col(c).cast("string"), rx(r"\s+"), ""), r"[^0-9.,\-]", "")
    both = s.contains(".") & s.contains(",")
    s = F.when(both, F.replace(s, F.lit("."), F.lit(""))).otherwise(s)
    return _number(F.replace(s, F.lit(","), F.lit(".")))


def mail_amount(c: str | Column) -> Column:
    """Amounts of mail sheets, with # around them."""
    s = strip(F.replace(sentinel_to_null(c), F.lit("#"), F.lit("")))
    european = s.rlike(r"\d\.\d{3},")
    s = F.replace(F.when(european, F.replace(s, F.lit("."), F.lit(""))).otherwise(s), F.lit(","), F.lit("."))
    return clean_amount(s)


def fix_open_decimals(c: str | Column) -> Column:
    """00 behind a separator at the end."""
    return F.regexp_replace(strip(c), r"([,.])$", "$100")


def fix_decimals(c: str | Column) -> Column:
    """At least two decimals."""

    def longer(s: Column) -> Column:
        return (
            F.when(s.rlike(r"[.,]$"), F.concat(s, F.lit("00")))
            .when(s.rlike(r"[.,]\d$"), F.concat(s, F.lit("0")))
            .when(s.rlike(r"[.,]\d{2,}$"), s)
            .otherwise(F.concat(s, F.lit(".00")))
        )

    return let(strip(c), longer)


def amount_close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """False where one is null."""
    return F.coalesce(F.abs(a.cast("double") - b.cast("double")) <= F.lit(tolerance), F.lit(False))
