"""Fields of scanned payment messages: two layouts, incoming (imp) and outgoing (exp).

Everything is a built-in expression over the text of a page or message. A text is cut into lines once; a field is
looked for behind a label (behind()), in the lines below an anchor (windows()), or in a block from one tag to the next
(block()), and what is found there is read by small functions for codes, numbers and dates. Incoming fields are taken
per page, and the first page that has a field wins (first_by_page); outgoing ones from the whole text (full_text).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import iso_date, printed_date, scanned_date
from ledgerloom.functions.money import fix_decimals, fix_open_decimals
from ledgerloom.functions import text as plain
from ledgerloom.functions.text import col, let, rx, some, squash, strip

#: Country lines under a beneficiary, words that look like bank codes, and currencies before amounts.
NOT_NAMES = ("CHINA", "TURKEY", "COLOMBIA", "PANAMA", "US", "USA")
NOT_CODES = ("RECEIVER", "SENDER", "MESSAGE", "TRANSFER", "CUSTOMER", "CREDIT", "PAYMENT", "FINANCIAL", "INFORMATION")
CURRENCIES = ("USD", "EUR", "GBP", "CHF", "JPY", "CAD", "AUD")
#: Lines behind an anchor that belong to it.
WINDOW = 11


class Cut:
    """A text whose lines have been cut into columns before, so that fields share them (read_fields)."""

    def __init__(self, text: str, lines: str, raw: str):
        self.text, self.lines, self.raw = F.col(text), F.col(lines), F.col(raw)


Text = str | Column | Cut


def lines(text: Text) -> Column:
    return text.lines if isinstance(text, Cut) else plain.lines(text)


def raw_lines(text: Text) -> Column:
    return text.raw if isinstance(text, Cut) else plain.raw_lines(text)


def whole(text: Text) -> Column:
    return text.text if isinstance(text, Cut) else col(text)


# --- places ------------------------------------------------------------------------------------------------------


def first_line(ls: Column, f: Callable[[Column], Column]) -> Column:
    """The first result of f that isn't null; what comes behind it isn't looked at."""
    return F.aggregate(ls, F.lit(None).cast("string"), lambda acc, x: F.coalesce(acc, f(x)))


def behind(text: Column, label: str, ends: str = ":;", whole: bool = True) -> Column:
    """What follows each label and the sign that ends it, without the spaces between; null or empty without the label."""
    edge = r"\b" if whole else ""
    words = edge + label.replace(" ", r"\s+") + edge
    pattern = rx(rf"(?i){words}\s*[{ends}]\s*")
    last = label.rpartition(" ")[2].lower()

    def pieces(x: Column) -> Column:
        # splitting compiles its pattern for each text, replacing compiles it once
        return F.slice(F.when(x.contains("\x00"), F.split(x, pattern)).otherwise(F.split(F.regexp_replace(x, pattern, "\x00"), "\x00")), 2, 1000)

    return let(text, lambda x: F.when(F.lower(x).contains(last), pieces(x)) if last.isalpha() else pieces(x))


def windows(ls: Column, anchor: str, before: int = 1, length: int = WINDOW) -> Column:
    """For each line with the anchor, the lines from `before` behind it on."""
    tag = (re.findall(r"\d\d", anchor) or [""])[0]  # digits of a tag, which are found faster than patterns match
    has = lambda x: x.contains(tag) & x.rlike(rx(anchor))
    spots = F.filter(F.transform(ls, lambda x, i: F.when(has(x), i)), lambda i: i.isNotNull())
    return F.transform(spots, lambda i: F.slice(ls, i + before + 1, length))


def block(ls: Column, opens: str, closes: str) -> Column:
    """The lines from the first one that opens, without what opens it, to the first that closes, which is left out;
    null without. What closes must have something before it other than blank lines."""

    def cut(own: Column) -> Column:
        head = strip(F.regexp_replace(own[0], rx("^.*?" + opens), ""))
        rest = F.transform(F.slice(own, 2, F.size(own)), lambda x, i: F.struct(i.alias("i"), x.rlike(r"\S").alias("some"), x.rlike(rx(closes)).alias("ends")))

        def end(head: Column, rest: Column) -> Column:
            begun = F.when(head != "", F.lit(-1)).otherwise(F.coalesce(F.array_min(F.transform(F.filter(rest, lambda x: x["some"]), lambda x: x["i"])), F.size(own)))
            stop = let(begun, lambda b: F.array_min(F.transform(F.filter(rest, lambda x: x["ends"] & (x["i"] > b)), lambda x: x["i"])))
            return F.concat(F.array(head), F.transform(F.slice(own, 2, F.coalesce(stop, F.size(own))), strip))

        return let(head, lambda h: let(rest, lambda r: end(h, r)))

    start = F.array_position(F.transform(ls, lambda x: x.rlike(rx(opens))), True).cast("int")
    return let(start, lambda i: F.when(i > 0, let(F.slice(ls, F.greatest(i, F.lit(1)), F.size(ls)), cut)))


# --- what stands there -------------------------------------------------------------------------------------------


def code_at_start(x: Column) -> Column:
    """A bank code that a text begins with: 11 letters and digits, else 8."""
    return let(F.regexp_extract(x, "^[A-Za-z0-9]{8,11}", 0), lambda run: F.when(F.length(run) == 11, run).when(run != "", F.substring(run, 1, 8)))


def codes(x: Column) -> Column:
    """The words of 8 or 11 letters and digits, in upper case."""
    return F.filter(F.regexp_extract_all(F.upper(x), F.lit(rx(r"\w+")), 0), lambda w: F.length(w).isin(8, 11) & w.rlike("^[A-Z0-9]+$"))


def named_code(x: Column) -> Column:
    """Whether a code begins with four letters, as those of banks do."""
    return x.rlike("^[A-Za-z]{4}")


def iso_text(x: Column) -> Column:
    return F.when(x.contains("-"), let(F.regexp_extract(x, rx(r"\b\d{4}-\d\d-\d\d\b"), 0), lambda v: _iso(iso_date(v))))


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def number(x: Column) -> Column:
    """The first digit and the digits, dots and commas behind it."""
    return some(F.regexp_extract(x, rx(r"[0-9][0-9.,]*"), 0))


def between_signs(x: Column) -> Column:
    """What stands between the first two # that have something between them."""
    inner = lambda parts: F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: p != "")
    return F.try_element_at(let(F.split(x, "#"), inner), F.lit(1))


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """As text.found(), for use inside of arrays."""
    return some(F.regexp_extract(x, rx(pattern), group))


def is_name(x: Column) -> Column:
    return x.rlike("[A-Za-z]") & ~F.upper(x).isin(*NOT_NAMES)


# --- incoming, layout V1 -----------------------------------------------------------------------------------------


def receiver_v1(text: Text) -> Column:
    """Behind the label, else the first code near it."""
    label = r"Recei\s*ver"

    def near(t: Column) -> Column:
        place = F.regexp_instr(t, F.lit(rx("(?i)" + label)))
        around = F.substring(t, F.greatest(place - 40, F.lit(1)), F.lit(40 + 9 + 120))
        return F.when(place > 0, F.try_element_at(codes(around), F.lit(1)))

    return let(squash(whole(text)), lambda t: F.upper(F.coalesce(first_line(behind(t, label, whole=False), code_at_start), near(t))))


def window_amount(w: Column) -> Column:
    """C4: between # behind the label (empty: none), between any #, a line of digits, the first number."""
    bare = lambda x: F.regexp_replace(x, rx(r"\s+"), "")
    digits = lambda x: let(bare(x), lambda y: F.when(y.rlike(r"^[\d.,]{3,}$"), y))
    loose_number = lambda x: let(bare(F.regexp_extract(x, rx(r"[0-9][0-9.,\s]*"), 0)), lambda y: F.when(F.length(y) >= 3, y))

    def read(full: Column) -> Column:
        signed = F.split(F.when(F.lower(full).contains("amount"), found(full, r"(?i)\bAmount\b\s*[:;]\s*(#.*)")), "#")
        loose = let(between_signs(full), lambda x: F.when(x.rlike(rx(r"\d")), x))
        other = F.coalesce(loose, first_line(w, digits), first_line(w, loose_number))
        return let(signed, lambda s: F.when(F.size(s) > 2, some(fix_open_decimals(s[1]))).otherwise(fix_open_decimals(other)))

    return let(F.array_join(w, " "), read)


def _words(x: Column) -> Column:
    written = F.regexp_extract(x, rx(r"\b\d{1,2} [A-Za-z]{3,4} [0-9A-Za-z]{4}\b"), 0)
    return F.when(x.rlike("[0-9]"), let(written, lambda v: F.when(v != "", _iso(scanned_date(v)))))


def window_date(w: Column) -> Column:
    """An ISO date in any line, else day, month word and year."""
    return F.coalesce(first_line(w, iso_text), first_line(w, _words))


def fallback_date(text: Text) -> Column:
    """A labelled ISO date, else the rest of a line behind a date label."""
    labelled = lambda x: first_line(behind(x, "Interbank Settlement Date", whole=False), lambda v: let(F.substring(v, 1, 10), lambda y: _iso(iso_date(y))))
    words = lambda x: let(F.try_element_at(behind(x, "Date"), F.lit(1)), lambda v: F.when(v.isNotNull(), _iso(scanned_date(v))))
    return let(lines(text), lambda ls: F.coalesce(first_line(ls, labelled), first_line(ls, words)))


def date_v1(text: Text) -> Column:
    below = let(lines(text), lambda ls: first_line(windows(ls, r"(?i)\b32A\b"), window_date))
    return F.coalesce(below, fallback_date(text))


def amount_v1(text: Text) -> Column:
    """In the windows of 32A, else of 33B."""
    below = lambda ls, tag: first_line(windows(ls, rf"(?i)\b{tag}\b"), window_amount)
    return let(lines(text), lambda ls: F.coalesce(below(ls, "32A"), below(ls, "33B")))


def beneficiary_v1(text: Text) -> Column:
    """The first name in the window of tag 59."""
    wanted = lambda x: F.when(is_name(x) & ~x.startswith("/") & ~x.rlike("(?i)Beneficiary Customer"), x)
    return let(lines(text), lambda ls: first_line(windows(ls, r"(^| )59 ?[:;]"), lambda w: first_line(w, wanted)))


# --- incoming, layout V2 -----------------------------------------------------------------------------------------


def receiver_v2(text: Text) -> Column:
    """A whole word behind the label."""
    word = lambda x: let(F.upper(F.regexp_extract(x, rx(r"^\w+"), 0)), lambda w: F.when(F.length(w).isin(8, 11) & w.rlike("^[A-Z0-9]+$"), w))
    return let(lines(text), lambda ls: first_line(ls, lambda x: first_line(behind(x, "Receiver"), word)))


def date_v2(text: Text) -> Column:
    """An ISO date anywhere, else a date in words, first on lines with a date label."""
    words = lambda x: F.when(x.rlike("[0-9]"), let(F.regexp_extract(x, rx(r"\b\d{1,2} [A-Za-z]{3,} \d{4}\b"), 0), lambda v: F.when(v != "", _iso(printed_date(v)))))
    tail = lambda x: F.when(F.lower(x).contains("date"), F.regexp_extract(x, rx(r"(?i)\bDate\b(.+)$"), 1))
    return let(lines(text), lambda ls: F.coalesce(first_line(ls, iso_text), first_line(ls, lambda x: words(tail(x))), first_line(ls, words)))


def amount_v2(text: Text) -> Column:
    """The settlement amount, else the instructed one; the number behind USD goes before others."""

    def labelled(ls: Column, label: str) -> Column:
        amount = lambda v: F.coalesce(number(found(v, r"(?i)\bUSD\s*(\d.*)")), number(v))
        read = lambda v: F.when(v.isNotNull(), fix_decimals(amount(v)))
        return first_line(ls, lambda x: let(F.try_element_at(behind(x, label + " Amount"), F.lit(1)), read))

    return let(lines(text), lambda ls: F.coalesce(labelled(ls, "Interbank Settlement"), labelled(ls, "Instructed")))


def supplier_v2(text: Text) -> Column:
    """Below Creditor, behind its code, which is on the same line or the next."""

    def name(w: Column) -> Column:
        same_line = F.regexp_extract(F.element_at(w, 1), r"^[^:;]*[:;](.*)$", 1).rlike(r"\S")
        skip = F.when(same_line | (F.size(w) < 2), 1).otherwise(2)
        from_ = lambda k: first_line(F.slice(w, k + 1, 12), lambda x: F.when(is_name(x), x))
        return F.coalesce(let(skip, from_), from_(F.lit(1)))

    return let(lines(text), lambda ls: first_line(windows(ls, r"(?i)\bCreditor ?[:;]", before=0, length=12), name))


# --- outgoing, layout V1 -----------------------------------------------------------------------------------------

_NEXT_TAG = r"(?i)^\d\d[A-Z]:"


def sender_v1(text: Text) -> Column:
    """C11: the first code behind the label."""
    bank = lambda x: let(code_at_start(x), lambda c: F.when(named_code(c), c))
    return F.upper(first_line(behind(whole(text), "Sender", ":", whole=False), bank))


def _labelled_32a(text: Text, label: str, more: int, f: Callable[[Column], Column]) -> Column:
    """The first result of f on a line with the label, joined with the lines below it, from 32A to the next tag."""

    def inside(ls: Column) -> Column:
        def look(n: Column) -> Column:
            start = n["start"]
            has = lambda x: F.lower(x).contains(label.lower()) & x.rlike(rx(rf"(?i)\b{label}\b"))
            at = lambda i: F.when(let(F.try_element_at(ls, i), has), let(F.array_join(F.slice(ls, i, more + 1), " "), f))
            return F.when(start > 0, first_line(F.sequence(start, F.greatest(n["stop"], start)), at))

        marks = F.transform(ls, lambda x, i: F.struct((i + 1).alias("i"), (x.contains("32") & x.rlike(rx(r"(?i)\b32A\b"))).alias("opens"), x.rlike(_NEXT_TAG).alias("tag")))

        def bounds(ms: Column) -> Column:
            start = F.coalesce(F.array_min(F.transform(F.filter(ms, lambda m: m["opens"]), lambda m: m["i"])), F.lit(0))
            stop = F.array_min(F.transform(F.filter(ms, lambda m: m["tag"] & ~m["opens"] & (m["i"] > start)), lambda m: m["i"]))
            return F.struct(start.alias("start"), F.coalesce(stop, F.size(ms)).alias("stop"))

        return let(let(marks, bounds), look)

    return let(raw_lines(text), inside)


def date_v1_exp(text: Text) -> Column:
    """As it is written."""
    written = lambda v: some(F.regexp_extract(v, r"^\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}", 0))
    return _labelled_32a(text, "Date", 2, lambda s: first_line(behind(s, "Date", ":", whole=False), written))


def amount_v1_exp(text: Text) -> Column:
    """Between #, else the number behind the label."""
    plain = lambda v: some(F.regexp_extract(F.ltrim(F.regexp_replace(v, "^[#$]", "")), r"^[\d.,]+", 0))
    hashed = lambda s: let(strip(between_signs(s)), lambda x: F.when(x.rlike(r"\d"), x))
    return _labelled_32a(text, "Amount", 3, lambda s: F.coalesce(hashed(s), first_line(behind(s, "Amount", ":", whole=False), plain)))


def ordering_customer(text: Text) -> Column:
    """C14: the first line of the block of 50K or 50F that is neither an account, a label nor digits. Tags with nothing
    or the label behind them go before others."""
    label, tag = r"ordering\s+customer", "(?i)50[KF]:"

    def name(own: Column) -> Column:
        kept = lambda x: ~x.startswith("/") & ~x.rlike(rx(rf"(?i)^{label}")) & ~x.rlike(r"^[\[{]\d")
        bare = lambda x: let(strip(F.regexp_replace(x, r"^(\d+/){1,2}", "")), lambda y: F.when(y.rlike(rx(r"[^\d\s]")), y))
        return first_line(own, lambda x: F.when(kept(x), bare(x)))

    below = lambda ls: let(block(ls, rf"{tag}\s*({label})?$", _NEXT_TAG), lambda b: F.when(F.size(b) > 1, b))
    return let(raw_lines(text), lambda ls: let(F.coalesce(below(ls), block(ls, tag, _NEXT_TAG)), name))


# --- outgoing, layout V2 -----------------------------------------------------------------------------------------


def sender_v2(text: Text, own_codes: Sequence[str] = ()) -> Column:
    """On the line of the label, else on the next unless that has a label; own codes don't count."""
    code = lambda x: F.try_element_at(F.filter(codes(x), lambda k: named_code(k) & ~k.isin(*NOT_CODES, *own_codes)), F.lit(1))

    def at(ls: Column) -> Column:
        below = lambda i: let(F.try_element_at(ls, i + 2), lambda x: F.when(F.locate(":", x).between(1, 20), None).otherwise(code(x)))
        spots = F.filter(F.transform(ls, lambda x, i: F.when(x.contains(":") & x.rlike(rx(r"(?i)Sender\s*:")), i)), lambda i: i.isNotNull())
        return first_line(spots, lambda i: F.coalesce(code(F.element_at(ls, i + 1)), below(i)))

    return let(raw_lines(text), at)


def date_v2_exp(text: Text) -> Column:
    """C16."""
    return first_line(behind(whole(text), "Interbank Settlement Date", ":", whole=False), lambda v: some(F.regexp_extract(v, r"^\d{4}(-\d\d){2}", 0)))


def amount_v2_exp(text: Text) -> Column:
    """Behind the label and a currency."""
    bare = lambda v: F.when(F.upper(F.substring(v, 1, 3)).isin(*CURRENCIES), F.substring(v, 4, 1000)).otherwise(v)
    return first_line(behind(whole(text), "Interbank Settlement Amount", ":", whole=False), lambda v: found(strip(bare(v)), r"^[\d.,]+", 0))


def debtor_name(text: Text) -> Column:
    """C17: the first line from the debtor to its agent that is neither digits nor a country code."""
    name = lambda own: first_line(own, lambda x: F.when((x != "") & ~x.rlike(r"^(\d+|[A-Z]{2,3})$"), x))
    return let(plain.raw_lines(whole(text), False), lambda ls: let(block(ls, r"(?i)Debtor\s*:", r"(?i)^Debtor\s+Agent\s*:"), name))


# --- messages ----------------------------------------------------------------------------------------------------

#: receiver, date, amount, beneficiary by kind and layout.
FIELDS: dict[tuple[str, str], tuple[Callable[[str], Column], ...]] = {
    ("imp", "V1"): (receiver_v1, date_v1, amount_v1, beneficiary_v1),
    ("imp", "V2"): (receiver_v2, date_v2, amount_v2, supplier_v2),
    ("exp", "V1"): (sender_v1, date_v1_exp, amount_v1_exp, ordering_customer),
    ("exp", "V2"): (sender_v2, date_v2_exp, amount_v2_exp, debtor_name),
}
NAMES = ("receiver", "date", "amount", "beneficiary")


def fields(kind: str, version: str, text: Text = "text", own_codes: Sequence[str] = ()) -> list[Column]:
    readers = [partial(f, own_codes=own_codes) if f is sender_v2 else f for f in FIELDS[kind, version]]
    return [f(text).alias(n) for n, f in zip(NAMES, readers)]


#: Which lines the fields of a layout look at: those that aren't blank, squashed, or all.
_RAW = {("exp", "V1"), ("exp", "V2")}


def read_fields(df: DataFrame, kind: str, version: str, keep: Iterable[str] = (), text: str = "text", own_codes: Sequence[str] = ()) -> DataFrame:
    """The columns keep and the fields of each text, whose lines are cut once, as a column that all fields look at."""
    keep = list(keep)
    raw = (kind, version) in _RAW
    cut = plain.raw_lines(text) if raw else plain.lines(text)
    both = df.select(*keep, F.col(text).alias("_text"), cut.alias("_lines"))
    return both.select(*keep, *fields(kind, version, Cut("_text", "_lines", "_lines"), own_codes))


def first_by_page(df: DataFrame, key: str, page: str, names: Iterable[str] = NAMES) -> DataFrame:
    """Each field from the first page that has it; pages_scanned: the page at which all were known, else all."""
    names = list(names)
    values = [F.min_by(n, F.when(F.col(n).isNotNull(), F.col(page))).alias(n) for n in names]
    spots = [F.min(F.when(F.col(n).isNotNull(), F.col(page))).alias(f"_{n}") for n in names]
    out = df.groupBy(key).agg(*values, *spots, F.max(page).alias("_last"))
    known = F.greatest(*[F.col(f"_{n}") for n in names])
    all_known = F.forall(F.array(*[F.col(f"_{n}").isNotNull() for n in names]), lambda x: x)
    return out.select(key, *names, F.when(all_known, known).otherwise(F.col("_last")).alias("pages_scanned"))


def full_text(df: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """The pages of a message in order, joined by newlines."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return df.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias(text))


def extract(pages: DataFrame, kind: str, version: str, own_codes: Sequence[str] = ()) -> DataFrame:
    """(file_path, file_name, receiver, date, amount, beneficiary, pages_scanned, estado) of each file of
    pages. A file that couldn't be opened has no fields and is incomplete."""
    pages = pages if "file_path" in pages.columns else pages.withColumn("file_path", F.col("file_name"))
    named = pages.select("file_path", "file_name").distinct()
    if kind == "imp":
        out = first_by_page(read_fields(pages, kind, version, ["file_path", "page_no"]), "file_path", "page_no")
    else:
        n = pages.groupBy("file_path").agg(F.max("page_no").alias("pages_scanned"))
        out = read_fields(full_text(pages, "file_path", "page_no", "text"), kind, version, ["file_path"], own_codes=own_codes).join(n, "file_path")
        if version == "V1":
            out = out.withColumn("date_raw", F.col("date")).withColumn("date", F.coalesce(_iso(printed_date("date_raw")), F.col("date")))
    whole = F.forall(F.array(*[F.coalesce(F.col(n) != "", F.lit(False)) for n in NAMES]), lambda x: x)
    return named.join(out, "file_path").withColumn("estado", F.when(whole, "Completo").otherwise("Incompleto"))
