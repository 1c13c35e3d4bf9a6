"""Mixing sources to target weights: how often a mix takes each document, so that every source comes to its target.

Targets. Sources, in order, weigh 3, 1, 2 and so on, and share a budget, a share of all words. No target is above LIMIT
times its source; what is over is shared again by weight among the others, until none is above. That is a level, a
number of words for a unit of weight, that rises from round to round; a round is one aggregation over the sources.

Copies. A document of a source with the target r times its size is to be taken r times: the whole part of r for sure, and
once more with the probability p that is left. Independent draws would miss the target by their variance, so copies are
drawn by pivotal rounding: two documents with fractional probabilities meet, and words of probability move from one to
the other, in a random direction, until one of them is 0 or 1. The direction's odds keep each one's expectation, and the
sum of words times probability never changes, so a source misses its target by less than one document.

It runs as a reduction tree. Documents of a source are dealt to leaves of some LEAF documents; a task reads its leaves
in order and holds one document with a fraction, which meets the next; what a leaf can't decide is one document, and these
are dealt to leaves again, until a source has one leaf, whose last document is drawn by its own probability. Leaves read
large documents first, so that the last one tends to be small. So a source of any size is dealt to many tasks, no task
holds more than a batch, and each level reads a LEAF-th of the one before. Draws hang on ids and leaves only, so reruns
agree, whatever the number of tasks.

Defined cases: a null text has no words; documents without words are taken 0 times; a null source is a source of its
own, the last. Rows of one id, source and size count as copies that are told apart by nothing: they are drawn in groups of
CHUNK at most, in which all but one are whole by arithmetic. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import claim, join_heavy, ranked, stash, table

WEIGHTS, SHARE, LIMIT, SEED = (3, 1, 2), 1.5, 2, "mix"
#: Documents of a leaf, and equal rows that one row stands for.
LEAF, CHUNK = 4096, 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that is never null and sorts as sources do, null last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(key, source_size, n_rows, target) of the sources of rows (key, size, times)."""
    sums = sized.groupBy("key").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n_rows"))
    every = ranked(sums, [F.col("key").asc()], "place")
    every = every.withColumn("weight", F.try_element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
    level, full = 0.0, None
    while True:
        over = F.lit(level) * F.col("weight") > F.col("source_size") * F.lit(limit)
        got = every.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("source_size"))).alias("held"), F.sum(F.when(~over, F.col("weight"))).alias("w"), F.count_if(over).alias("n")
        ).first()
        if not got["all"] or not got["w"] or got["n"] == full:
            break
        level, full = (share * got["all"] - limit * (got["held"] or 0)) / got["w"], got["n"]
    return every.select("key", "source_size", "n_rows", F.least(F.lit(level) * F.col("weight"), F.col("source_size") * F.lit(float(limit))).alias("target"))


def pivot(w: float, p: float, v: float, q: float, u: float) -> tuple[float, float]:
    """New probabilities of two documents of w and v words with probabilities p and q, by a draw u from [0, 1): one at least
    becomes 0 or 1, w * p + v * q stays, and both keep their expectations."""
    a, b = w * (1 - p), v * q  # words that may move to the first, and from the second
    c, d = w * p, v * (1 - q)
    to_first, to_second = min(a, b), min(c, d)
    if u * (to_first + to_second) < to_second:  # to the first, by the other way's words
        return (1.0 if a <= b else p + to_first / w, 0.0 if b <= a else q - to_first / v)
    return (0.0 if c <= d else p - to_second / w, 1.0 if d <= c else q + to_second / v)


#: A row is a document, or `times` equal ones; once is whether they are taken once more than `base`, null if undecided.
_ROWS = "key string, leaf long, leaves long, base int, p double, doc_id {id}, size long, chunk long, times long, source_size long, target double, once int"
_EPS = 1e-12


def fold_leaves(seed: str, level: int, last: bool):
    """A function on sorted batches: rows of each leaf meet one after another; what is undecided at a leaf's end is told
    apart by a null in once, or is drawn if it is the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("mixing")
        leaf, held, draw = None, None, random.Random()

        def close() -> list[dict]:
            if held is None:
                return []
            return [held | {"once": int(draw.random() < held["p"]) if last else None}]

        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                if (row["key"], row["leaf"]) != leaf:
                    out += close()
                    leaf, held = (row["key"], row["leaf"]), None
                    draw.seed(f"{seed}|{level}|{row['key']}|{row['leaf']}")
                p, n = row["p"], row["times"]
                whole = int(n * p + _EPS)
                rest = n * p - whole
                if rest < _EPS:
                    rest = 0.0
                for once, times in ((1, whole), (0, n - whole - (rest > 0))):
                    if times:
                        out.append(row | {"times": times, "once": once})
                if not rest:
                    continue
                row |= {"times": 1, "p": rest}
                if held is None:
                    held = row
                    continue
                one, two = pivot(held["size"], held["p"], row["size"], rest, draw.random())
                open_ = [r | {"p": x} for r, x in ((held, one), (row, two)) if _EPS < x < 1 - _EPS]
                out += [r | {"once": round(x)} for r, x in ((held, one), (row, two)) if not _EPS < x < 1 - _EPS]
                held = open_[0] if open_ else None
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
        if leaf is not None:
            yield pa.RecordBatch.from_pylist(close(), schema=batch.schema)

    return run


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: str = SEED, leaf: int = LEAF, chunk: int = CHUNK,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row: taken is copies times size."""
    kind = docs.schema[id_col].dataType.simpleString()
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), source_key(F.col(f"`{source_col}`")).alias("key"), n_words(F.col(f"`{text_col}`")).alias("size"))
    equal = sized.groupBy("doc_id", "key", "size").agg(F.count("*").alias("n"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / chunk)))
    sized = equal.select("doc_id", "key", "size", "n", chunks.alias("chunk")).withColumn("times", F.least(F.lit(chunk).cast("long"), F.col("n") - F.col("chunk") * chunk)).drop("n")
    sized = stash(sized, "sized")
    sources = stash(targets(sized, weights, share, limit), "sources")
    most = sources.agg(F.max("n_rows")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = join_heavy(sized, sources.withColumn("rate", rate).withColumn("leaves", F.ceil(F.col("n_rows") / leaf)), "key", ["doc_id", "chunk"])
    rows = rows.withColumns({"base": F.floor("rate").cast("int"), "p": F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(0.0), "once": F.lit(None).cast("int")})
    decided, level, leaves = [], 0, -(-most // leaf)
    while True:
        last = leaves <= 1
        dealt = rows.withColumn("leaf", F.pmod(F.xxhash64(F.lit(f"{seed}|{level}"), "doc_id", "size", "chunk"), F.col("leaves"))).select(*_names())
        dealt = dealt.repartition("key", "leaf").sortWithinPartitions("key", "leaf", F.col("size").desc(), F.col("doc_id").asc_nulls_first(), "chunk")
        done = stash(dealt.mapInArrow(fold_leaves(seed, level, last), _ROWS.format(id=kind)), "level")
        decided.append(done.where("once IS NOT NULL"))
        if last:
            break
        # a source with one leaf goes on with its last row alone, as do sources that are done
        rows, level, leaves = done.where("once IS NULL").withColumn("leaves", F.ceil(F.col("leaves") / leaf)), level + 1, -(-leaves // leaf)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("once")).otherwise(0).cast("long")
    every = out.withColumn("copies", copies).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return every.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _names() -> list[str]:
    return [c.split(" ")[0] for c in _ROWS.split(", ")]


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")
