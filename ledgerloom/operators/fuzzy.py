"""E3/E4 as a similarity join: the best choice of a name from a threshold on, without comparing all with all.

The score of two texts is the largest of three shares of characters (argmax.token_set). With I the words in common, A and
B the others of the two, and c what a score may lack of 1, a pair reaches the threshold in one of two ways:

* By words: I is nearly all of one text. The words that this text has alone weigh (a word weighs its length and a
  space) no more than 2c / (1 + c) of it, so its rarest words, until they weigh more, hold one that the other text has.
* By characters: texts of I A and I B differ by ind <= c (L1 + L2) insertions and deletions. Texts are cut into grams of three
  characters of a word, two blanks before and behind it; the order of words doesn't matter to them. A deletion takes
  three grams with it (four if it is a blank), an insertion two, so texts of given lengths have a number of grams in common
  at least, and both have one of these among their rarest grams, so many that fewer would be left.

Rarest words and grams are keys of an inverted index, and pairs come from joins on equal keys. What a pair lacks is then
bounded again by its own lengths and by the bits that the two texts' grams have in common, all in built-in expressions, and
only pairs that are left are scored. No pair that reaches the threshold is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import col, let, normalize_name
from ledgerloom.operators.argmax import best_fuzzy, keep_first, token_set

#: Below this threshold texts needn't have grams in common, and every name meets every choice.
LEAST = 82
#: Words of 64 bits for the grams of a text.
WORDS = 4
#: Names that have a choice of this score aren't held against those that score less.
NEAR = 95
#: Pairs up to which names simply meet all choices, in cells; the rows are the same.
FEW = 20_000_000


def _grams(words: Column) -> Column:
    """Grams of all words, each with how many equal ones stand before it."""
    three = lambda w: F.transform(F.sequence(F.lit(1), F.char_length(w) + 2), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit("  ")), i, 3))
    every = F.array_sort(F.flatten(F.transform(words, three)))
    return let(every, lambda gs: F.transform(gs, lambda g, i: F.concat(g, (i - F.array_position(gs, g)).cast("string"))))


def _texts(norms: DataFrame) -> DataFrame:
    """words, len, grams, b0.. and lost of distinct normalised texts (norm); other columns stay."""
    words = F.array_sort(F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != "")))
    t = norms.withColumn("words", words).where(F.size("words") > 0)
    t = t.withColumns({"len": F.char_length(F.array_join("words", " ")), "grams": _grams(F.col("words"))})
    spot = lambda g: F.pmod(F.xxhash64(g), F.lit(64 * WORDS)).cast("int")
    spots = t.withColumn("spots", F.array_distinct(F.transform("grams", spot)))
    one = F.lit(1).cast("long")
    bits = lambda k: F.aggregate(F.filter("spots", lambda s: F.floor(s / 64) == k), F.lit(0).cast("long"), lambda acc, s: acc.bitwiseOR(F.call_function("shiftleft", one, s % 64)))
    return spots.withColumns({f"b{k}": bits(k) for k in range(WORDS)}).withColumn("lost", F.size("grams") - F.size("spots")).drop("spots")


def _least_common(l1: Column, l2: Column, c: float) -> Column:
    """Grams that texts of l1 and l2 characters have in common at least; negative if their lengths are too different."""
    ind = F.floor(F.lit(c) * (l1 + l2) + 1e-9)
    d1 = F.floor((ind + l1 - l2) / 2)
    d2 = d1 - l1 + l2
    own = lambda n, d, i: n + 2 - 3 * d - 2 * i
    return F.when((d1 < 0) | (d2 < 0), -1).otherwise(F.greatest(own(l1, d1, d2), own(l2, d2, d1)))


def _ranked(texts: DataFrame) -> DataFrame:
    """texts with rare_words and rare_grams: (n, t) of each text, those that the fewest choices have first."""
    each = F.explode(F.concat(*[F.transform(k, lambda t: F.struct(F.lit(k).alias("kind"), t.alias("t"))) for k in ("words", "grams")])).alias("x")  # noqa: B023
    found = texts.select("norm", "offers", each).select("norm", "offers", "x.kind", "x.t")
    often = found.where("offers").groupBy("kind", "t").agg(F.count("*").alias("n"))
    found = found.join(often, ["kind", "t"], "left").withColumn("x", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))
    rare = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("x")))).alias(f"rare_{k}") for k in ("words", "grams")]
    return texts.join(found.groupBy("norm").agg(*rare), "norm")


def index(left: DataFrame, right: DataFrame, stash: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """The texts (norm) of two tables, as near() takes them; right are the choices. Texts that both have are cut once."""
    # short texts are few bytes and much work, so they are dealt to all tasks
    spark = left.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    of = lambda t, is_choice: t.select("norm", F.lit(not is_choice).alias("asks"), F.lit(is_choice).alias("offers"))
    norms = of(left, False).union(of(right, True)).groupBy("norm").agg(F.bool_or("asks").alias("asks"), F.bool_or("offers").alias("offers"))
    ranked = stash(_ranked(stash(_texts(norms.repartition(tasks, "norm", "asks")))).repartition(tasks, "norm", "len"))
    return ranked.where("asks"), ranked.where("offers")


def _lead(c: float) -> Column:
    """The rarest words of a text: a word is in, if those before it may all be missing in the other one."""
    before = lambda i: F.aggregate(F.slice("rare_words", 1, i), F.lit(0), lambda acc, x: acc + F.char_length(x["t"]) + 1)
    return F.filter("rare_words", lambda x, i: before(i) <= F.col("len") * F.lit(2 * c / (1 + c) + 1e-9))


def _prefix(c: float) -> Column:
    """The rarest grams of a text, so many that what any text of a fitting length has in common with it isn't only behind
    them."""
    low, high = F.greatest(F.lit(1), F.floor(F.col("len") * ((1 - c) / (1 + c)) - 1)), F.ceil(F.col("len") * ((1 + c) / (1 - c)) + 1)
    fit = F.filter(F.transform(F.sequence(low.cast("int"), high.cast("int")), lambda m: _least_common(F.col("len"), m, c)), lambda x: x >= 0)
    left = F.greatest(F.lit(1), F.array_min(fit).cast("int"))
    return F.slice("rare_grams", 1, F.greatest(F.size("rare_grams") - left + 1, F.lit(0)))


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(x, y) of the texts (norm) of two tables that may score the threshold (0 to 1), each pair once."""
    return near(*index(left, right), threshold)


def near(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """candidates() of the tables of index(), or of some of their rows."""
    c = 1 - threshold + 1e-9

    def meet(x: Column, y: Column, more: list[str]) -> DataFrame:
        side = lambda t, keys, p: t.select(F.explode(keys).alias("key"), *[F.col(n).alias(p + n) for n in ("norm", *more)])
        return side(a, x, "x_").join(side(b, y, "y_"), "key")

    x, y = (lambda n: F.col(f"x_{n}")), (lambda n: F.col(f"y_{n}"))
    names = lambda rare: F.transform(rare, lambda r: r["t"])
    # by words: what is in common decides alone; besides it there are a blank and the words that one text has alone
    shared = F.char_length(F.array_join(F.array_intersect(x("words"), y("words")), " "))
    share = lambda n: 1 - (n - shared) / (shared + n)
    lead, every = names(_lead(c)), F.col("words")
    worded = meet(lead, every, ["words", "len"]).union(meet(every, lead, ["words", "len"]))
    worded = worded.where(F.greatest(share(x("len")), share(y("len"))) >= F.lit(threshold - 1e-9))
    # by characters: bits in common, but for grams that share a bit
    bits = sum((F.bit_count(x(f"b{k}").bitwiseAND(y(f"b{k}"))) for k in range(WORDS)), F.lit(0))
    # _least_common() by the sum of lengths, in a few operations: longer code isn't compiled, and it runs for each pair
    spelled = meet(names(_prefix(c)), names(_prefix(c)), ["len", "lost", *(f"b{k}" for k in range(WORDS))])
    size = x("len") + y("len")
    ind = F.floor(F.lit(c) * size + 1e-9)
    ind = ind - (ind + size) % 2  # lengths and edits are both even or both odd
    spelled = spelled.where((F.abs(x("len") - y("len")) <= ind) & (bits + F.least(x("lost"), y("lost")) >= 2 + 0.5 * size - 2.5 * ind))
    both = [p.select(x("norm").alias("x"), y("norm").alias("y")) for p in (worded, spelled)]
    return both[0].union(both[1]).distinct()


def fuzzy_matches(
    names: DataFrame, master: DataFrame, threshold: int = 85, normalize: Callable[[Column], Column] = normalize_name, rounded: bool = False, few: int = FEW,
    check: Callable[[Column, Column], Column] | None = None, stash: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(name, choice, score) of the distinct names whose best choice of master (choice, choice_order) scores the
    threshold or more: the rows of best_fuzzy() from there on, the first choice on ties. Where check is given, only pairs
    of normalised texts that pass it count, and the best is taken among these.

    Where stash is given, it writes the tables that several steps read, and names are first held against choices that
    score NEAR or more, which few pairs may: a name that has one has its best there, and only the others are held against
    all that score the threshold. The rows are the same without it."""
    if check is not None and threshold < LEAST:
        raise ValueError(f"a check needs a threshold of {LEAST} or more")
    if check is None and (threshold < LEAST or (few and names.count() * master.count() <= few)):
        return best_fuzzy(names, master, normalize, rounded=rounded).where(F.col("score") >= threshold)
    q = names.select("name").distinct().withColumn("norm", normalize(col("name"))).where("norm <> ''")
    m = keep_first(master.withColumn("norm", normalize(col("choice"))).where("norm <> ''"), "norm", "choice_order").select("norm", "choice", "choice_order")
    write = stash or (lambda df: df)
    a, b = index(q.select("norm").distinct(), m.select("norm"), write)

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            shares = [100 * token_set(x, y) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([round(s) if rounded else int(s) for s in shares], pa.int32())], names=["x", "y", "score"])

    def best(a: DataFrame, least: int) -> DataFrame:
        pairs = near(a, b, (least - (0.5 if rounded else 0)) / 100)
        scored = pairs.mapInArrow(score, "x string, y string, score int").where(F.col("score") >= least)
        if check is not None:  # behind the scores: it costs more than the bounds, and would be moved before them
            scored = scored.where(check(F.col("x"), F.col("y")))
        first = F.max(F.struct("score", (-F.col("choice_order")).alias("o"), "choice")).alias("b")
        return write(scored.join(m.withColumnRenamed("norm", "y"), "y").groupBy("x").agg(first))

    found = best(a, max(threshold, NEAR) if stash else threshold)
    if stash and threshold < NEAR:
        found = found.union(best(a.join(found, F.col("norm") == F.col("x"), "left_anti"), threshold))
    return q.join(found, q["norm"] == found["x"]).select("name", F.col("b.choice").alias("choice"), F.col("b.score").alias("score"))
