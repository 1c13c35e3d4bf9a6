"""Token predicates on arrays of words, and what names ask of rows so that no pairs are made in vain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO, OVERLAP = 0.60, 2
#: Rows from which on a word is one that many rows have; there are no more such words than words of all rows by this.
HOT = 10_000

#: Fewest and most bits for a set of keys, and bits for each key in between; they are sent to all tasks, 64 MB at most.
LEAST_BITS, MOST_BITS, BITS_PER_KEY = 1 << 18, 1 << 29, 8
#: Bits of one row of such a set, as bitmap_construct_agg() makes them.
_ROW = 1 << 15


def among(df: DataFrame, keys: DataFrame, on: Sequence[str], n: int) -> DataFrame:
    """The rows of df whose columns on may be a row of keys, which are about n: all that are one, and a few others.

    The keys travel as bits of their hashes, so rows that a join behind this would drop are dropped before they move.
    Where there are more keys than bits can tell apart, more others stay; no row that is among the keys is lost."""
    bits = max(LEAST_BITS, min(MOST_BITS, 1 << (BITS_PER_KEY * n).bit_length()))
    slot = F.pmod(F.xxhash64(*on), F.lit(bits))
    part, at = F.floor(slot / _ROW).cast("int"), (slot % _ROW).cast("int")
    sets = keys.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(at.cast("long")).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), at % 8)) != 0
    return df.withColumn("_part", part).join(F.broadcast(sets), "_part").where(bit).select(*df.columns)


def hot_words(often: DataFrame) -> DataFrame:
    """(word, n) of the words that many rows have, few enough to be sent to all tasks."""
    return often.where(F.col("n") >= HOT)


def overlap(source: Column, target: Column) -> Column:
    """How many source words, each as often as it stands there, the target has."""
    return F.size(F.filter(source, lambda t: F.array_contains(target, t)))


def tokens_match(source: Column, detail: Column, ratio: float = RATIO, least: int = OVERLAP) -> Column:
    """Source without noise words against all words of the detail."""
    n, both = F.size(source), overlap(source, detail)
    first_two = F.array_contains(detail, F.try_element_at(source, F.lit(1))) & F.array_contains(detail, F.try_element_at(source, F.lit(2)))
    return F.coalesce(F.when(n >= 2, first_two & (both >= least) & (both / n >= ratio)).when(n == 1, both == 1).otherwise(False), F.lit(False))


def set_ratio(source: Column, target: Column) -> Column:
    """E14's score: share of the distinct source words that the target has."""
    n = F.size(F.array_distinct(source))
    return F.when(n > 0, F.size(F.array_intersect(source, target)) / n).otherwise(0.0)


def positional_match(source: Column, target: Column, n: int = 2, least: int = OVERLAP, ratio: float = RATIO) -> Column:
    """The first words are the same in order, and enough distinct source words are in the target."""
    k = F.least(F.lit(n), F.size(source), F.size(target))
    same = F.size(F.array_intersect(source, target))
    return (F.size(source) > 0) & (F.size(target) > 0) & (F.slice(source, 1, k) == F.slice(target, 1, k)) & (same >= least) & (set_ratio(source, target) >= ratio)


def overlap_ratio(source: Column, target: Column, ratio: float = RATIO, least: int = OVERLAP) -> Column:
    """Share of the longer side, null where the words don't match."""
    both = overlap(source, target)
    share = both / F.greatest(F.size(source), F.size(target), F.lit(1))
    first_two = (F.size(source) < 2) | (F.array_contains(target, F.try_element_at(source, F.lit(1))) & F.array_contains(target, F.try_element_at(source, F.lit(2))))
    return F.when(first_two & (both >= least) & (share >= ratio), share)


def peel(names: DataFrame, index: DataFrame, keys: Sequence[str] = (), ratio: float = RATIO, least: int = OVERLAP) -> DataFrame:
    """What each name asks of the rows: (keys, src, q, two, c, need, total, tail, word, lead).

    names have keys and src, an array of words; index is rows by word (keys, word). A name matches rows that have its first
    two words, and need of its words in all. Besides those two, c of its words, it has others, here from the rarest
    on. Rows are told apart by the first of these others that they have: a name asks for the rows that have the i-th, word by
    word, with the tail from there on, and, with an empty tail, for rows by the two words alone. The tail no longer holds
    what the row doesn't have, so names that differ by rare words ask the same, and what they ask is answered once; q
    tells questions apart. Questions that can't reach need aren't asked, nor those about words that no row has.
    word is the rarest word that a row must have, lead the rarer one of the two."""
    keys = list(keys)
    often = index.groupBy(*keys, "word").agg(F.count("*").alias("n"))
    asked = names.select(*keys, "src").distinct().where(F.size("src") > 0)
    each = asked.withColumn("word", F.explode(F.array_distinct("src")))
    if keys:
        each = each.join(often, [*keys, "word"])
    else:  # names that have a word that many rows have don't all meet in one task
        known = each.join(F.broadcast(hot_words(often)), "word", "left")
        rest = known.where("n IS NULL").drop("n").join(often.where(F.col("n") < HOT), "word")
        each = known.where("n IS NOT NULL").unionByName(rest)
    known = each.groupBy(*keys, "src").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("known"))
    two, total = F.array_sort(F.array_distinct(F.slice("src", 1, 2))), F.size("src")
    k = known.withColumns({"two": two, "total": total}).withColumn("firsts", F.filter("known", lambda x: F.array_contains("two", x["word"])))
    k = k.where(F.size("firsts") == F.size("two"))
    reach = F.filter(F.sequence(F.lit(1), F.col("total")), lambda o: ((o >= least) & (o / F.col("total") >= ratio)) | (F.col("total") == 1))
    times = lambda w: F.size(F.filter("src", lambda t: t == w))
    others = F.filter("known", lambda x: ~F.array_contains("two", x["word"]))
    k = k.withColumns({
        "c": F.size(F.filter("src", lambda t: F.array_contains("two", t))), "need": F.try_element_at(reach, F.lit(1)),
        "others": F.flatten(F.transform(others, lambda x: F.array_repeat(x, times(x["word"])))),
    }).where("need IS NOT NULL")
    words = lambda xs: F.transform(xs, lambda x: x["word"])
    last = F.least(F.size("others"), F.size("others") + F.col("c") - F.col("need") + 1)
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    tails = F.transform(places, lambda i: F.slice("others", i, F.size("others")))
    base = F.when(F.col("c") >= F.col("need"), F.array(F.slice("others", 1, 0))).otherwise(F.slice(tails, 1, 0))
    q = k.withColumn("rest", F.explode(F.concat(base, tails)))
    rarest = F.array_min(F.concat("firsts", F.slice("rest", 1, 1)))["word"]
    q = q.select(*keys, "src", "two", "c", "need", "total", words("rest").alias("tail"), rarest.alias("word"), F.element_at("firsts", 1)["word"].alias("lead"))
    return q.withColumn("q", F.concat_ws("\x1f", F.array_join("two", "\x1e"), F.array_join("tail", "\x1e"), "c", "need", "total"))


def has_all(words: Column, some: Column) -> Column:
    return F.forall(some, lambda t: F.array_contains(words, t))


def match_pairs(sources: DataFrame, details: DataFrame, ratio: float = RATIO, least: int = OVERLAP) -> DataFrame:
    """(source, detail) of the sources (source, st) and details (detail, dt) that match. They meet on the rarer of a
    source's first two words, both of which the detail must have."""
    index = details.withColumn("word", F.explode(F.array_distinct("dt")))
    often = index.groupBy("word").agg(F.count("*").alias("n"))
    two = sources.withColumn("two", F.array_distinct(F.slice("st", 1, 2))).withColumn("word", F.explode("two")).join(often, "word")
    lead = two.groupBy("source", "st").agg(F.min_by("word", F.struct("n", "word")).alias("word"), F.count("*").alias("has"), F.max(F.size("two")).alias("k"))
    both = lead.where("has = k").select("source", "st", "word").join(index, "word")
    return both.where(tokens_match(F.col("st"), F.col("dt"), ratio, least)).select("source", "detail")


def positional_pairs(sources: DataFrame, details: DataFrame, n: int = 2, least: int = OVERLAP, ratio: float = RATIO) -> DataFrame:
    """(source, detail, score) of the sources (source, st) and details (detail, dt) that match by position. They meet
    on as many first words as both must have in common."""
    k = max(1, min(n, least))
    head = lambda df, words: df.withColumn("head", F.slice(words, 1, k)).where(F.size("head") == k)
    st, dt = F.col("st"), F.col("dt")
    both = head(sources, "st").join(head(details, "dt"), "head").where(positional_match(st, dt, n, least, ratio))
    return both.select("source", "detail", set_ratio(st, dt).alias("score"))
