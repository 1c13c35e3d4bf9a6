"""Text: keys, tokens, names (all built-in expressions)."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say nothing about a company, in ledgers and in message names.
NOISE = ("llc", "inc", "ltd", "co", "corp", "corporation", "company", "sa", "sas", "sl", "srl", "spa", "plc", "gmbh", "bv", "nv", "limited", "holdings", "holding")
LEGAL = ("SA", "SAS", "LTDA", "LTD", "LIMITED", "CO", "COMPANY", "INC", "CORP", "CORPORATION", "LLC", "SPA", "GMBH", "BV", "SRL", "AG", "NV")
COUNTRIES = ("CHINA", "TURKEY", "COLOMBIA", "PANAMA", "US", "USA", "ESPANA", "SPAIN")
#: Company forms, longest first, written with a dot behind each letter.
FORMS = ("SAS", "SAC", "SRL", "SA", "BV", "NV")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rx(pattern: str) -> str:
    r"""With Unicode classes, as \s, \d, \w and \b are meant."""
    return "(?U)" + pattern


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one or if it is empty."""
    return F.nullif(F.regexp_extract(c, rx(pattern), group), F.lit(""))


def some(c: Column) -> Column:
    """The text, null if it is empty; it is computed once, which nullif() doesn't where code isn't compiled."""
    return let(c, lambda v: F.when(v != "", v))


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


#: What (?U)\s stands for.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: str | Column) -> Column:
    return F.trim(col(c), F.lit(_SPACES))


def squash(c: str | Column) -> Column:
    """White space runs as one space, none at the ends."""
    # single blanks are left as they are; Unicode classes are slow, and ASCII doesn't need them
    pattern = r"\s{2,}|[^\S ]"
    return F.trim(_unless_ascii(col(c), lambda x: F.regexp_replace(x, pattern, " "), lambda x: F.regexp_replace(x, rx(pattern), " ")))


#: White space that ends a line, and other white space.
_BREAKS = r"\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029"
_BLANK = r"[ \t\u001f\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]"


def _plain_or(c: Column, plain, full) -> Column:
    """plain of texts whose only breaks are newlines and whose only other white space is blanks, full of others: splitting
    by a pattern compiles it for each text, and wide classes of characters are slow."""
    return F.when(~c.rlike(r"[^\n -~]"), plain(c)).otherwise(full(c))


def raw_lines(c: str | Column, stripped: bool = True) -> Column:
    """All lines, without the white space at their ends unless they are wanted as they are."""
    if not stripped:
        return _plain_or(col(c), lambda x: F.split(x, "\n"), lambda x: F.split(x, rf"\r\n|[{_BREAKS}]"))
    inner = lambda x: F.regexp_replace(x, rf"{_BLANK}*(\r\n|[{_BREAKS}]){_BLANK}*", "\n")
    full = lambda x: F.split(F.regexp_replace(inner(x), rf"^{_BLANK}+|{_BLANK}+$", ""), "\n")
    return _plain_or(col(c), lambda x: F.transform(F.split(x, "\n"), lambda y: F.trim(y)), full)


def lines(c: str | Column) -> Column:
    """The lines that aren't blank, squashed."""
    even = lambda x: F.when(x.contains("  "), F.regexp_replace(x, " {2,}", " ")).otherwise(x)
    full = lambda x: F.split(F.regexp_replace(x, rf"{_BLANK}+", " "), rf"[{_BREAKS}]+")
    cut = _plain_or(col(c), lambda x: F.split(even(x), "\n"), full)
    return F.filter(F.transform(cut, lambda x: F.trim(x)), lambda x: x != "")


def _changes(f) -> tuple[str, str, str, list[str]]:
    """What f does to single characters: those that become another one and that one, those that become several or none,
    and what they become. Hangul syllables and surrogates aren't among them."""
    one, many = {}, {}
    for code in (*range(0x80, 0xAC00), *range(0xE000, 0x110000)):
        to = f(chr(code))
        if to != chr(code):
            (one if len(to) == 1 else many)[chr(code)] = to
    return "".join(one), "".join(one.values()), "".join(many), list(many.values())


def _bare(x: str) -> str:
    return "".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k))


_ACCENTED, _BARE, _several, _apart = _changes(_bare)
#: Characters without a match in the second text of translate() are deleted.
_MARKS = "".join(k for k, to in zip(_several, _apart) if not to)
_JOINED, _PARTS = "".join(k for k, to in zip(_several, _apart) if to), [to for to in _apart if to]
#: What case folding changes in letters that are lower case already; it is short, as it stands in every plan with keys.
_CASED, _FOLDED, _CASED_JOINED, _CASED_PARTS = _changes(lambda x: x.casefold() if x == x.lower() else x)
#: The first letters of each row of Hangul, which make its syllables by arithmetic.
_SYLLABLE, _LEAD, _VOWEL, _TAIL = 0xAC00, 0x1100, 0x1161, 0x11A8
_VOWELS, _TAILS = 21, 27


def _row(first: int, n: int) -> str:
    return "".join(map(chr, range(first, first + n)))


def _letters(x: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    n = F.ascii(x) - _SYLLABLE
    tail = n % (_TAILS + 1)
    at = lambda first, size, k: F.substr(F.lit(_row(first, size)), k + 1, F.lit(1))
    lead = at(_LEAD, 19, F.floor(n / (_VOWELS * (_TAILS + 1))).cast("int"))
    vowel = at(_VOWEL, _VOWELS, F.floor(n / (_TAILS + 1)).cast("int") % _VOWELS)
    return F.concat(lead, vowel, F.when(tail > 0, at(_TAIL, _TAILS, tail - 1)).otherwise(""))


def _ranges(joined: str, gap: int = 64) -> str:
    """A few ranges for a pattern that hold all characters of joined, and some between them; patterns try each range."""
    codes = sorted(map(ord, joined))
    ends = [k for k in range(1, len(codes)) if codes[k] - codes[k - 1] > gap]
    return "".join(f"{chr(codes[a])}-{chr(codes[b - 1])}" for a, b in zip([0, *ends], [*ends, len(codes)]))


def _part(x: Column, joined: str, parts: list[str]) -> Column:
    """The part of a character, null if it isn't among joined, which are sorted: by halves down to some that instr() tries
    one after another."""
    if len(joined) <= 100:
        return F.get(F.split(F.lit("\x00".join(parts)), "\x00"), F.instr(F.lit(joined), x) - 1)
    half = len(joined) // 2
    return F.when(x < joined[half], _part(x, joined[:half], parts[:half])).otherwise(_part(x, joined[half:], parts[half:]))


def _spread(c: Column, joined: str, parts: list[str], hangul: bool) -> Column:
    """Each character of joined as its part, and Hangul syllables as their letters; only texts that may hold one are cut."""
    ranges = _ranges(joined) + ("가-힣" if hangul else "")
    # most characters are ASCII: they are told by one range before the others are tried
    some, rest = rf"[[^\x00-\x7f]&&[{ranges}]]", rf"[\x00-\x7f[^{ranges}]]"

    def part(x: Column) -> Column:
        to = F.coalesce(_part(x, joined, parts), x)
        return F.when(F.length(x) > 1, x).otherwise(F.when(x.between("가", "힣"), _letters(x)).otherwise(to) if hangul else to)

    cut = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit(f"{some}|{rest}+"), 0), part), "")
    return let(c, lambda x: F.when(x.rlike(some), cut(x)).otherwise(x))


def _unless_ascii(c: Column, simple, full) -> Column:
    return let(c, lambda x: F.when(F.length(x) == F.octet_length(x), simple(x)).otherwise(full(x)))


def fold(c: str | Column) -> Column:
    """As NFKD without combining marks, for all of Unicode: characters that are one letter and marks, or another form
    of one, by translate(); ligatures, fractions, units and the like by a table of what they consist of; Hangul by
    arithmetic."""
    return _unless_ascii(col(c), lambda x: x, lambda x: _spread(F.translate(x, _ACCENTED + _MARKS, _BARE), _JOINED, _PARTS, True))


def case_fold(c: str | Column) -> Column:
    """Full case folding, for all of Unicode (letters newer than Python's tables by lower case alone): lower case, then final sigma and the like by translate(), sharp s and the
    like by a table."""
    return _unless_ascii(F.lower(col(c)), lambda x: x, lambda x: _spread(F.translate(x, _CASED, _FOLDED), _CASED_JOINED, _CASED_PARTS, False))


def normalize_text(c: str | Column) -> Column:
    """B1: squashed, without accents, upper case; null as empty."""
    return F.upper(squash(fold(F.coalesce(col(c), F.lit("")))))


def normalize_text_key(c: str | Column) -> Column:
    """B2: B1 with A-Z, 0-9 and spaces only."""
    return F.regexp_replace(normalize_text(c), "[^A-Z0-9 ]", "")


def text_key(c: str | Column) -> Column:
    """Squashed and case-folded; accents stay; null as empty."""
    return case_fold(squash(F.coalesce(col(c), F.lit(""))))


def tokens(c: str | Column) -> Column:
    """Runs of a-z and 0-9 of the key, so accented letters split words."""
    return F.regexp_extract_all(text_key(c), F.lit("([a-z0-9]+)"), 1)


def drop_noise(t: Column) -> Column:
    useful = F.filter(t, lambda x: ~x.isin(*NOISE))
    return F.when(F.size(useful) > 0, useful).otherwise(t)


def meaningful_tokens(c: str | Column) -> Column:
    """Tokens without company suffixes, or all tokens if none is left."""
    return drop_noise(tokens(c))


def clean_detail(c: str | Column) -> Column:
    """Key of what stands before the first #."""
    return text_key(F.split_part(F.coalesce(col(c), F.lit("")), F.lit("#"), F.lit(1)))


def clean_file_name(c: str | Column) -> Column:
    """Key without .pdf and without leading numbers."""
    bare = strip(F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), rx(r"(?i)\.pdf\s*$"), ""))
    return text_key(F.regexp_replace(bare, rx(r"^(?:\d+\s+)+"), ""))


def normalize_name(c: str | Column) -> Column:
    """Upper-case words without accents, legal forms and countries; all words if none is left."""
    bare = squash(F.regexp_replace(F.upper(fold(F.coalesce(col(c), F.lit("")))), "[^A-Z0-9]", " "))
    words = F.filter(F.split(bare, " "), lambda x: ~x.isin(*LEGAL, *COUNTRIES))
    kept = F.array_join(words, " ")
    return F.when(kept != "", kept).otherwise(bare)


def company_forms(c: str | Column) -> Column:
    """Company forms with dots, and a space between a form and the bank code behind it."""

    def dotted(s: Column, form: str) -> Column:
        letters = list(form)
        after = r"(?!\.|\w)" if form == "SA" else r"(?!\.|[A-Za-z0-9])"
        return F.regexp_replace(s, rx(r"(?i)\b" + r"[\s.]*".join(letters) + r"[\s.]*" + after), "".join(f"{x}." for x in letters))

    s = reduce(dotted, FORMS, col(c))
    s = F.regexp_replace(s, r"(\.)([A-Z]{4}[A-Z0-9]{4})", "$1 $2")
    return strip(F.regexp_replace(s, " {2,}", " "))
