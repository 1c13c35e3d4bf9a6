"""Peak concurrency: how many intervals of a group are open at each moment, what they weigh, and the peaks so far.

Every interval adds to its group at its start and takes the same away at its end. These deltas are summed for each
group and moment, and moments that change nothing go. What is open is the running sum of the deltas that are left.

The running sums, leads and running maxima are windows over time, but no window holds a whole group, since one group
may hold all rows. Time is cut into stretches of 2^12 seconds, these into stretches of 2^24, and these of 2^36; a group has
2^12 moments in a stretch at most, a stretch as many of the next smaller ones, and the range of a timestamp some 300 of
the largest. So each window holds no more than 4,096 rows of one group, whatever the input. What a stretch sums up to,
its maxima and its first moment make one row in the windows of the next level, and what has happened before a stretch is
joined back to it, level by level. Nothing is broadcast.

Defined cases: an interval without a start, or whose end isn't after its start, takes no part; one without an end stays
open. A null value counts as 0, and so does one that isn't a finite number. Intervals repeat freely. Empty tables give
an empty table. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import join_heavy, table

#: A stretch of a level is 2^BITS of the level below; stretches of the last level make one window a group.
BITS, LEVELS = 12, 3
DAY = 86_400
#: The group of all sales, and the one of sales whose client or nation isn't known.
ALL, UNKNOWN = -2, -1


def seconds(df: DataFrame, name: str) -> Column:
    """Seconds since 1970, rounded down; times without a zone count as UTC, whatever the session's zone."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        return days * DAY + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_seconds(c)


def deltas(intervals: DataFrame, grain: int = 1) -> DataFrame:
    """(grp, at, dn, dv) of intervals (grp, start_s, end_s, value): what a group's starts and ends at a moment add."""
    down = lambda c: F.floor(F.col(c) / F.lit(grain)).cast("long") * grain if grain > 1 else F.col(c)
    live = intervals.select("grp", down("start_s").alias("a"), down("end_s").alias("b"), F.coalesce("value", F.lit(0)).cast("long").alias("v"))
    live = live.where("a IS NOT NULL AND (b IS NULL OR b > a)")
    one = F.lit(1).cast("long")
    ends = F.array(F.struct(F.col("a").alias("at"), one.alias("dn"), F.col("v").alias("dv")), F.struct(F.col("b").alias("at"), (-one).alias("dn"), (-F.col("v")).alias("dv")))
    each = live.select("grp", F.inline(ends)).where("at IS NOT NULL")
    return each.groupBy("grp", "at").agg(F.sum("dn").alias("dn"), F.sum("dv").alias("dv")).where("dn <> 0 OR dv <> 0")


def _before(name: str, keys: list[str], order: str, how=F.sum) -> Column:
    return how(name).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))


def sweep(changes: DataFrame, bits: int = BITS, levels: int = LEVELS) -> DataFrame:
    """(grp, at, next, n, v, high_n, peak_v) of every moment of deltas(): the group's next moment, what is open from
    this one on, the most that was open so far, and the largest v of the whole group."""
    up = lambda c: F.expr(f"shiftright({c}, {bits})")
    w = W.partitionBy("grp", "s1").orderBy("at")
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    moments = changes.withColumn("s1", up("at"))
    moments = moments.withColumns({"n": F.sum("dn").over(upto), "v": F.sum("dv").over(upto), "next": F.lead("at").over(w)}).withColumn("high", F.max("n").over(upto))
    # level 1 to levels: a row a stretch, with its place among the stretches of the next larger one
    sums = moments.groupBy("grp", "s1").agg(F.sum("dn").alias("dn"), F.sum("dv").alias("dv"), F.max("n").alias("top_n"), F.max("v").alias("top_v"), F.min("at").alias("first"))
    stretches = []
    for k in range(1, levels + 1):
        own, keys = f"s{k}", ["grp", f"s{k + 1}"] if k < levels else ["grp"]
        if k < levels:
            sums = sums.withColumn(f"s{k + 1}", up(own))
        zero = F.lit(0).cast("long")
        sums = sums.withColumns({"n": F.coalesce(_before("dn", keys, own), zero), "v": F.coalesce(_before("dv", keys, own), zero), "next": F.lead("first").over(W.partitionBy(*keys).orderBy(own))})
        sums = sums.withColumns({"top_n": F.col("n") + F.col("top_n"), "top_v": F.col("v") + F.col("top_v")}).withColumn("high", _before("top_n", keys, own, F.max))
        stretches.append(sums)
        if k < levels:
            sums = sums.groupBy(*keys).agg(F.sum("dn").alias("dn"), F.sum("dv").alias("dv"), F.max("top_n").alias("top_n"), F.max("top_v").alias("top_v"), F.min("first").alias("first"))
    # back again: what was before the larger stretch comes before all in it
    last = stretches.pop().withColumn("peak", F.max("top_v").over(W.partitionBy("grp")))
    carried = last.select("grp", f"s{levels}", "n", "v", "high", "next", "peak")
    for k in range(levels - 1, 0, -1):
        carried = _under(stretches.pop(), carried, f"s{k + 1}").select("grp", f"s{k}", "n", "v", "high", "next", "peak")
    done = _under(moments, carried, "s1")
    return done.select("grp", "at", "next", "n", "v", F.col("high").alias("high_n"), F.col("peak").alias("peak_v"))


def _under(rows: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    c = carried.select(F.col("grp").alias("_g"), F.col(key).alias("_s"), *[F.col(x).alias(f"_{x}") for x in ("n", "v", "high", "next", "peak")])
    both = rows.join(c.hint("merge"), (F.col("grp") == F.col("_g")) & (F.col(key) == F.col("_s")))
    added = {"high": F.greatest("_high", F.col("_n") + F.col("high")), "n": F.col("n") + F.col("_n"), "v": F.col("v") + F.col("_v"), "next": F.coalesce("next", "_next"), "peak": F.col("_peak")}
    return both.withColumns(added)


def sale_intervals(sales: DataFrame, lines: DataFrame, clients: DataFrame, days: int = 1) -> DataFrame:
    """(grp, start_s, end_s, value) of every sale, once for its client's nation and once for ALL: open from its time
    until some days after its first line was shipped; value is its total in cents.

    Every row of sales is a sale, also where ids repeat; of clients that repeat, the smallest nation counts."""
    shipped = lines.select("sale_id", seconds(lines, "shipped_at").alias("shipped")).where("shipped IS NOT NULL AND sale_id IS NOT NULL").groupBy("sale_id").agg(F.min("shipped").alias("shipped"))
    nations = clients.where("client_id IS NOT NULL").groupBy("client_id").agg(F.min("nation_id").cast("int").alias("nation"))
    total = F.col("total").cast("double")
    cents = F.when(F.abs(total) < 9e15, F.floor(total * 100 + 0.5)).otherwise(0)
    s = sales.select("sale_id", "client_id", seconds(sales, "sold_at").alias("start_s"), cents.alias("value")).where("start_s IS NOT NULL")
    s = join_heavy(s, shipped, "sale_id", ["start_s", "client_id", "value"])
    s = s.select("sale_id", "client_id", "start_s", (F.col("shipped") + days * DAY).alias("end_s"), "value").where("end_s IS NULL OR end_s > start_s")
    s = join_heavy(s, nations, "client_id", ["sale_id", "start_s"])
    return s.select(F.explode(F.array(F.coalesce("nation", F.lit(UNKNOWN)), F.lit(ALL))).alias("grp"), "start_s", "end_s", "value")


def op11_peak_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = sale_intervals(*(table(spark, sf_dir, n) for n in ("sales", "sale_lines", "clients")))
    out = sweep(deltas(intervals))
    return out.select(
        F.col("grp").alias("nation_id"), F.col("at").alias("from_s"), F.col("next").alias("to_s"), F.col("n").alias("n_open"),
        F.col("v").alias("open_cents"), F.col("high_n").alias("high_open"), (F.col("v") == F.col("peak_v")).alias("is_peak"),
    )


OP11_SQL = """
WITH shipped AS (SELECT sale_id, CAST(floor(epoch(min(shipped_at))) AS BIGINT) AS shipped FROM sale_lines GROUP BY sale_id),
nations AS (SELECT client_id, min(nation_id) AS nation FROM clients GROUP BY client_id),
live AS (
  SELECT coalesce(nation, -1) AS nation, CAST(floor(epoch(sold_at)) AS BIGINT) AS a, shipped + 86400 AS b,
    CAST(coalesce(floor(100 * total + 0.5), 0) AS BIGINT) AS cents
  FROM sales LEFT JOIN shipped USING (sale_id) LEFT JOIN nations USING (client_id)
  WHERE sold_at IS NOT NULL),
each AS (SELECT * FROM live WHERE b IS NULL OR b > a),
twice AS (SELECT * FROM each UNION ALL SELECT -2, a, b, cents FROM each),
ends AS (
  SELECT nation, a AS from_s, 1 AS dn, cents AS dc FROM twice
  UNION ALL SELECT nation, b, -1, -cents FROM twice WHERE b IS NOT NULL),
nets AS (SELECT nation, from_s, sum(dn) AS dn, sum(dc) AS dc FROM ends GROUP BY nation, from_s HAVING sum(dn) <> 0 OR sum(dc) <> 0),
running AS (
  SELECT nation, from_s, lead(from_s) OVER w AS to_s, sum(dn) OVER w AS n_open, sum(dc) OVER w AS open_cents
  FROM nets WINDOW w AS (PARTITION BY nation ORDER BY from_s))
SELECT CAST(nation AS INTEGER) AS nation_id, from_s, to_s, CAST(n_open AS BIGINT) AS n_open, CAST(open_cents AS BIGINT) AS open_cents,
  CAST(max(n_open) OVER (PARTITION BY nation ORDER BY from_s) AS BIGINT) AS high_open,
  open_cents = max(open_cents) OVER (PARTITION BY nation) AS is_peak
FROM running
"""
