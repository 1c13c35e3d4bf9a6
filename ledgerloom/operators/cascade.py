"""Which ledger rows settle a message: by date, words, amounts.

The outcome depends on a message's date, words and amount only, so it is found once for each such triple, and
messages take it from there; ids may repeat or be null. No pair is made that the result doesn't need. The words
decide by a row's detail, so counts, sums and last forms of a (date, detail) are aggregated before names meet details.
Names that begin alike ask for the same details but for those that have one of their rare words, and what they ask is
summed once (tokens.peel). Amounts are looked up by bins, and details are listed for sums that fit alone, so nothing
grows with messages x rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import ledger_date
from ledgerloom.functions.ids import form_text, usable
from ledgerloom.functions.money import TOLERANCE, amount_close, parse_money
from ledgerloom.functions.text import clean_detail, clean_file_name, drop_noise, text_key, tokens
from ledgerloom.operators.tokens import OVERLAP, RATIO, among, has_all, peel, tokens_match
from ledgerloom.schema import require_columns

RULES = ("no_day", "none", "amount_fallback", "single", "multi_exact", "multi_sum", "multi_blank", "multi_fail")


def filter_ledger(df: DataFrame, kind: str, since: str = "2025-04-01") -> DataFrame:
    """Rows of a kind from a date on; the parsed date is added as fecha."""
    out = df.withColumn("fecha", ledger_date("FECHA"))
    return out.where((F.col("fecha") >= F.lit(since).cast("date")) & (F.lower(F.trim("INDICA")) == kind))


def drop_commissions(df: DataFrame, detail: str = "DETALLE") -> DataFrame:
    """Null details stay."""
    return df.where(~F.coalesce(F.lower(detail).contains("comisi"), F.lit(False)))


def ledger_keys(df: DataFrame, amount_col: str, order_col: str = "row_order") -> DataFrame:
    """D4. Header names may differ in case."""
    names = {c.upper().strip(): c for c in df.columns}
    require_columns(df.toDF(*[c.upper().strip() for c in df.columns]), ["FORMULARIO", "FECHA", "DETALLE", amount_col.upper()], "ledger")
    at = lambda n: F.col(f"`{names[n]}`")
    return df.select(
        ledger_date(at("FECHA")).alias("fecha_key"), clean_detail(at("DETALLE")).alias("detalle_clean"),
        parse_money(at(amount_col.upper())).alias("monto"), form_text(at("FORMULARIO")).alias("formulario"), F.col(order_col).cast("long").alias("row_order"),
    )


def message_keys(df: DataFrame, by: str = "Nombre archivo", keep: Sequence[str] = ()) -> DataFrame:
    """Incoming messages are named by their file, others by their counterparty."""
    name = clean_file_name(F.col(f"`{by}`")) if by == "Nombre archivo" else text_key(F.col(f"`{by}`"))
    return df.select("id", *keep, ledger_date("Date").alias("fecha_key"), name.alias("nombre_clean"), parse_money("Amount").alias("amount"))


def detail_sums(names: DataFrame, details: DataFrame, ratio: float = RATIO, overlap: int = OVERLAP, stash: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """E13 as a join: (fecha_key, src, n, total, one, lead) of the names (fecha_key, src) that match a detail: the rows of
    all details that they match counted, summed, and the last form of these. details have fecha_key, words, n, total
    and one; lead is the rarer of a name's first two words.

    The details that match are told apart by the rarest word of the name, besides the first two, that they have: those
    behind which a name has just as many words as it needs are the ones that it matches by this word and not by those
    after it. So its sums are those of a few questions, which names share. Where stash is given, it writes the questions, and details that none of them asks for are left out."""
    index = details.withColumn("word", F.explode("words"))
    asked = peel(names, index, ["fecha_key"], ratio, overlap)
    # where the two words are enough, others change nothing
    asked = asked.where((F.size("tail") == 0) | (F.col("c") < F.col("need")))
    if stash is not None:
        asked = stash(asked)
        index = among(index, asked, ["fecha_key", "word"], asked.count())
    found = detail_candidates(asked, index)
    per = found.groupBy("fecha_key", "q").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("one").alias("one"))
    back = asked.select("fecha_key", "src", "q", "lead").join(per, ["fecha_key", "q"])
    sums = [F.sum("n").alias("n"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"), F.max("one").alias("one"), F.first("lead").alias("lead")]
    return back.groupBy("fecha_key", "src").agg(*sums)


def detail_candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct questions and the details that answer them."""
    q = asked.select("fecha_key", "q", "two", "c", "need", "tail", "word").distinct()
    both = F.col("c") + F.size(F.filter("tail", lambda t: F.array_contains("words", t)))
    exact = F.array_contains("words", F.try_element_at("tail", F.lit(1))) & (both == F.col("need"))
    return q.join(index, ["fecha_key", "word"]).where(has_all(F.col("words"), F.col("two")) & ((F.size("tail") == 0) | exact))


def reconcile(
    msgs: DataFrame, ledger: DataFrame, loose_single: bool = False, tolerance: float = TOLERANCE, ratio: float = RATIO, overlap: int = OVERLAP,
    keep: Sequence[str] = (), held: list[DataFrame] | None = None, stash: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, keep, rule, formulario) of every message: msgs have id, fecha_key, nombre_clean, amount; ledger rows have
    fecha_key, detalle_clean, monto, formulario, row_order. formulario is null where the message stays as it was.

    Null dates match nothing. multi_blank: the sum fits, but no row has a form. A tolerance of 0 takes equal amounts
    alone. Three narrow tables that several steps read are persisted, in memory or on disk, where held is given: it takes
    them, for unpersist() when the result has been written. Where stash is given instead, it writes these tables and
    returns them as they are read again, and rows that no message asks for are left out by among() before rows move to
    amounts and lists; without either the tables are computed by each step."""

    def hold(df: DataFrame) -> DataFrame:
        if stash is not None:
            return stash(df)
        if held is not None:
            held.append(df.persist())
        return df

    m = hold(msgs.select("id", *keep, "fecha_key", "amount", drop_noise(tokens("nombre_clean")).alias("src")))
    rows = hold(ledger.where("fecha_key IS NOT NULL").select("fecha_key", "detalle_clean", "monto", "formulario", "row_order", F.array_distinct(tokens("detalle_clean")).alias("words")))
    size = F.lit(max(2 * tolerance, 0.01))
    bins = F.array(*[F.floor(F.col("amount") / size) + k for k in (-1, 0, 1)])
    close = amount_close(F.col("monto"), F.col("amount"), tolerance)
    form = F.struct("row_order", "formulario")
    asked = m.where("fecha_key IS NOT NULL").select("fecha_key", "src", "amount").distinct()
    # rows by words
    details = hold(rows.groupBy("fecha_key", "detalle_clean", "words").agg(F.count("*").alias("n"), F.sum("monto").alias("total"), F.max(form).alias("one")))
    sums = detail_sums(asked.select("fecha_key", "src").distinct(), details, ratio, overlap, stash)
    settled = hold(asked.join(sums, ["fecha_key", "src"], "left"))
    many, no_words, total_fits = F.expr("n > 1 AND amount IS NOT NULL"), F.expr("n IS NULL AND amount IS NOT NULL"), amount_close(F.col("total"), F.col("amount"), tolerance)
    sizes = settled.agg(*[F.count_if(x) for x in (many, no_words, many & total_fits)]).first() if stash is not None else None

    def wanted(df: DataFrame, keys: DataFrame, kind: int, bins: int = 1) -> DataFrame:
        on = [c for c in ("fecha_key", "bin", "word") if c in keys.columns]
        return df if sizes is None else among(df, keys.select(*on), on, bins * sizes[kind])

    alike = tokens_match(F.col("src"), F.col("words"), ratio, overlap)
    near = settled.where(many).select("fecha_key", "src", "amount", F.col("lead").alias("word"), F.explode(bins).alias("bin"))
    by_bin = rows.withColumn("bin", F.floor(F.col("monto") / size)).withColumn("word", F.explode("words"))
    near = near.join(wanted(by_bin, near, 0, 3), ["fecha_key", "bin", "word"]).where(close & alike)
    exact = near.groupBy("fecha_key", "src", "amount").agg(F.count("*").alias("n_fit"), F.max(form).alias("fit"))
    # rows by amount, where there are none by words
    alone = settled.where(no_words).select("fecha_key", "amount", F.explode(bins).alias("bin"))
    alone = alone.distinct().join(wanted(rows.withColumn("bin", F.floor(F.col("monto") / size)), alone, 1, 3), ["fecha_key", "bin"]).where(close)
    by_amount = alone.groupBy("fecha_key", "amount").agg(F.count("*").alias("n_amt"), F.max(form).alias("amt"))
    days = rows.select("fecha_key").distinct().withColumn("day", F.lit(True))
    out = settled.join(exact, ["fecha_key", "src", "amount"], "left").join(by_amount, ["fecha_key", "amount"], "left").join(days, "fecha_key", "left")
    rule = (
        F.when(F.col("day").isNull(), "no_day")
        .when(F.col("n").isNull(), F.when((F.col("n_amt") == 1) & usable("amt.formulario"), "amount_fallback").otherwise("none"))
        .when(F.col("n") == 1, F.when(usable("one.formulario", loose_single), "single").otherwise("none"))
        .when((F.col("n_fit") == 1) & usable("fit.formulario"), "multi_exact")
        .when(total_fits, "multi_sum")
        .otherwise("multi_fail")
    )
    value = (
        F.when(F.col("rule") == "amount_fallback", F.col("amt.formulario"))
        .when(F.col("rule") == "single", F.col("one.formulario"))
        .when(F.col("rule") == "multi_exact", F.col("fit.formulario"))
    )
    out = out.withColumn("rule", rule).select("fecha_key", "src", "amount", "lead", "rule", value.alias("value"))
    # lists of forms, for the sums that fit
    summed = out.where("rule = 'multi_sum'").select("fecha_key", "src", F.col("lead").alias("word")).distinct()
    by_word = rows.where(~F.trim("formulario").isin("", "none", "nan", "nat")).select("fecha_key", "words", "row_order", "formulario", F.explode("words").alias("word"))
    sums_fit = settled.where(many & total_fits).select("fecha_key", F.col("lead").alias("word"))
    listed = summed.join(wanted(by_word, sums_fit, 2), ["fecha_key", "word"]).where(alike).groupBy("fecha_key", "src")
    listed = listed.agg(F.array_join(F.transform(F.array_sort(F.collect_list(form)), lambda x: x["formulario"]), "-").alias("forms"))
    out = out.join(listed.withColumn("rule", F.lit("multi_sum")), ["fecha_key", "src", "rule"], "left")
    out = out.withColumn("rule", F.when((F.col("rule") == "multi_sum") & F.col("forms").isNull(), "multi_blank").otherwise(F.col("rule")))
    r = out.select(F.col("fecha_key").alias("_f"), F.col("src").alias("_s"), F.col("amount").alias("_a"), "rule", F.coalesce("value", "forms").alias("formulario"))
    back = m.join(r, (F.col("fecha_key") == F.col("_f")) & (F.col("src") == F.col("_s")) & F.col("amount").eqNullSafe(F.col("_a")), "left")
    return back.select("id", *keep, F.coalesce("rule", F.lit("no_day")).alias("rule"), "formulario")


def last_wins(df: DataFrame, found: DataFrame, order: str) -> DataFrame:
    """df with Formulario updated from (id, formulario) of its rows: equal ids all take the last row's; null ids none."""
    last = found.where("formulario IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max_by("formulario", order).alias("_new"))
    return df.join(last, "id", "left").withColumn("Formulario", F.coalesce("_new", "Formulario")).drop("_new")


def match_counts(found: DataFrame) -> DataFrame:
    """F4."""
    is_ = lambda *r: F.count_if(F.col("rule").isin(*r))
    return found.agg(
        F.count_if(F.col("formulario").isNotNull()).alias("updated"), is_("multi_exact", "multi_sum", "multi_blank", "multi_fail").alias("multi_matched"),
        is_("multi_exact", "multi_sum").alias("multi_ok"), is_("multi_fail").alias("multi_fail"),
    )

