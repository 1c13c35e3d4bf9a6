"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a run of documents of a bounded number of words. Its words become symbols (the benchmark's words; each
run of other words is one gap symbol, which no phrase holds), its suffixes are sorted, and the Burrows-Wheeler
transform goes into a wavelet tree. All benchmark windows are searched backwards at once by its ranks; the rows that
are left are located by walking to sampled suffix positions, and the places are merged into spans of words.

Nothing is shuffled, so a hot key can't gather. The benchmark is applied in blocks of about BLOCK_BYTES of text: a
table of any size is read a block at a time, with a pass over the documents for each, whose result is written before
the next block is read. So driver and tasks hold one block, whatever the size of the table.

Defined cases: null and empty texts have no words and are never contaminated; an item without words has no windows,
and one with fewer than WINDOW words is one window; a null item_id counts as the empty string; equal items each
count; repeated documents get a row each; empty tables give no hits. Other columns are kept or not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import FOLD_ALNUM, bounded_batches, claim, merge_spans, stash, table, text_bytes

WINDOW = 13
SHARD_SYMBOLS = 1 << 19
SAMPLE = 16
BLOCK_BYTES = 2 << 20
#: Bytes of a text that become words at a time.
SLICE = 4 << 20
_END, _GAP, _FIRST = 0, 1, 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Of a sequence that ends in its only 0: sorted by 4 symbols (2 of a large alphabet), then ties by doubling."""
    n = len(s)
    bits, h = (16, 4) if s.max(initial=0) < 1 << 16 else (32, 2)
    key = np.zeros(n, np.uint64)
    for k in range(min(h, n)):
        key[: n - k] |= s[k:].astype(np.uint64) << np.uint64(bits * (h - 1 - k))
    sa = np.argsort(key)
    key = key[sa]
    starts = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[sa], rank[n] = group, -1
    ends = np.append(starts[1:], True)
    tied = np.nonzero(~(starts & ends))[0]  # places in sa whose group has two or more
    while len(tied):
        at = sa[tied]
        key = (rank[at] << 32) | (rank[np.minimum(at + h, n)] + 1)
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[tied] = at
        starts = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = tied[np.maximum.accumulate(np.where(starts, np.arange(len(tied)), 0))]
        ends = np.append(starts[1:], True)
        tied = tied[~(starts & ends)]
        h *= 2
    return sa


class WaveletTree:
    """Levels of bits of a sequence, with counts of ones; each level is split stably by its bit."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        n = len(seq)
        start = np.zeros(n_symbols, np.int64)
        symbols = np.arange(n_symbols)
        for shift in reversed(range(max(1, int(n_symbols - 1).bit_length()))):
            ones = ((seq >> shift) & 1).astype(bool)
            count = np.zeros(n + 1, np.int32)
            np.cumsum(ones, out=count[1:])
            zeros = n - int(count[n])
            self.levels.append((shift, count, zeros))
            seq = np.concatenate((seq[~ones], seq[ones]))
            up = count[start]
            start = np.where((symbols >> shift) & 1, zeros + up, start - up)
        self.start = start

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for shift, count, zeros in self.levels:
            up = count[i]
            i = np.where((symbol >> shift) & 1, zeros + up, i - up)
        return i - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for shift, count, zeros in self.levels:
            up, after = count[i], count[i + 1]
            one = after > up
            symbol |= one.astype(np.int64) << shift
            i = np.where(one, zeros + up, i - up)
        return symbol, i - self.start[symbol]


class FmIndex:
    def __init__(self, seq: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        sa = suffix_array(seq)
        self.n = len(seq)
        self.tree = WaveletTree(seq[sa - 1], n_symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=n_symbols))))
        marked = sa % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(marked, dtype=np.int32)))
        self.samples = sa[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of phrases that occur, and their ranges; phrases are aligned to the right."""
        alive = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for k in range(width):
            todo = lengths[alive] > k
            c = phrases[alive, width - 1 - k]
            lo = np.where(todo, self.before[c] + self.tree.rank(c, lo), lo)
            hi = np.where(todo, self.before[c] + self.tree.rank(c, hi), hi)
            left = lo < hi
            alive, lo, hi = alive[left], lo[left], hi[left]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            found = self.marks[rows + 1] > self.marks[rows]
            out[todo[found]] = self.samples[self.marks[rows[found]]] + steps
            todo, rows = todo[~found], rows[~found]
            c, r = self.tree.access(rows)
            rows, steps = self.before[c] + r, steps + 1
        return out


def words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a slice at a time."""
    at = 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            while end < len(data) and FOLD_ALNUM[data[end]] != 0x20:
                end += 1
        yield data[at:end].translate(FOLD_ALNUM).split()
        at = end


class Phrases:
    """The windows of a block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        by: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            own = [self.ids.setdefault(w, len(self.ids) + _FIRST) for some in words(text) for w in some]
            for i in range(max(1, len(own) - window + 1) if own else 0):
                by[tuple(own[i : i + window])].add(name)
        self.names = [sorted(x) for x in by.values()]
        self.lengths = np.array([len(x) for x in by], np.int64)
        self.rows = np.zeros((len(by), window), np.int64)
        for row, x in zip(self.rows, by):
            row[window - len(x) :] = x
        self.window, self.n_symbols = window, len(self.ids) + _FIRST


def find(texts: list[bytes], p: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: its number of words, disjoint spans of words that windows cover, and the items of the windows."""
    seqs, places, docs, size = [], [], [], 0
    n_words, spans, names = [0] * len(texts), defaultdict(list), defaultdict(set)

    def flush() -> None:
        nonlocal seqs, places, docs, size
        if not seqs or not len(p.rows):
            seqs, places, docs, size = [], [], [], 0
            return
        index = FmIndex(np.concatenate([*seqs, np.array([_END], np.int32)]), p.n_symbols)
        at, doc = np.concatenate(places), np.repeat([d for d, _ in docs], [n for _, n in docs])
        hit, lo, hi = index.search(p.rows, p.lengths)
        which = np.repeat(hit, hi - lo)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(hit) else np.zeros(0, np.int64)
        found = index.locate(rows)
        for d, start, w in zip(doc[found].tolist(), at[found].tolist(), which.tolist()):
            spans[d].append((start, start + int(p.lengths[w])))
            names[d].update(p.names[w])
        seqs, places, docs, size = [], [], [], 0

    def add(d: int, ids: np.ndarray, first: int) -> None:
        nonlocal size
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != _GAP) | (ids[:-1] != _GAP)
        (at,) = np.nonzero(keep)
        seqs.append(np.append(ids[at], np.int32(_GAP)))
        places.append(np.append(at + first, first + len(ids)))
        docs.append((d, len(at) + 1))
        size += len(at) + 1
        if size >= SHARD_SYMBOLS:
            flush()

    for d, data in enumerate(texts):
        tail = np.zeros(0, np.int32)  # the last words of the slice before, for windows across the border
        for some in words(data):
            ids = np.fromiter(map(p.ids.get, some, repeat(_GAP)), np.int32, len(some))
            for i in range(0, len(ids), SHARD_SYMBOLS):
                part = np.concatenate((tail, ids[i : i + SHARD_SYMBOLS]))
                add(d, part, n_words[d] - len(tail))
                n_words[d] += len(part) - len(tail)
                tail = part[max(0, len(part) - p.window + 1) :]
    flush()
    for d in range(len(texts)):
        yield n_words[d], merge_spans(spans[d]) if d in spans else [], names[d] if d in names else set()


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_TEXT, _OLD, _ITEMS = "\x00text", "\x00spans", "\x00items"


def _passes(docs: DataFrame, benchmark: DataFrame, text_col: str, block_bytes: int) -> DataFrame:
    """docs with n_words, spans and items of each row under names that start with a zero byte."""
    bounded_batches(docs.sparkSession)
    names = docs.columns
    item = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), text_bytes("text").alias("text"))
    total = item.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    df = docs.select(
        "*",
        F.lit(0).cast("long").alias("\x00n_words"),
        F.array().cast("array<struct<start:long,stop:long>>").alias(_OLD),
        F.array().cast("array<string>").alias(_ITEMS),
    )
    schema = df.schema
    for k in range(blocks):
        part = item.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k) if blocks > 1 else item
        phrases = Phrases([(r["name"], bytes(r["text"])) for r in part.collect()])

        def run(batches: Iterator[pa.RecordBatch], p: Phrases = phrases) -> Iterator[pa.RecordBatch]:
            claim("fm_index")
            for b in batches:
                n = len(names)
                got = list(find(b.column(n + 3).to_pylist(), p))
                old = zip(b.column(n + 1).to_pylist(), b.column(n + 2).to_pylist())
                both = [
                    (w, merge_spans(s + [(x["start"], x["stop"]) for x in s0]), sorted(i | set(i0)))
                    for (w, s, i), (s0, i0) in zip(got, old)
                ]
                made = [
                    pa.array([w for w, _, _ in both], pa.int64()),
                    pa.array([[{"start": a, "stop": z} for a, z in s] for _, s, _ in both], _SPAN),
                    pa.array([i for _, _, i in both], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*b.columns[:n], *made], names=[*names, "\x00n_words", _OLD, _ITEMS])

        df = df.withColumn(_TEXT, text_bytes(text_col)).mapInArrow(run, schema)
        if k < blocks - 1:
            df = stash(df, "pass")
    return df


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans of words to remove, items) of every row."""
    out = _passes(docs.select("doc_id", "text"), benchmark, "text", block_bytes)
    return out.select("doc_id", F.col("\x00n_words").alias("n_words"), F.col(_OLD).alias("spans"), F.col(_ITEMS).alias("items"))


def _hit(spans: str):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of which windows cover less than a twentieth of the words; columns as they were. Documents
    without words stay, as do all if the benchmark has no words."""
    out = _passes(docs, benchmark, "text", BLOCK_BYTES)
    hit = _hit(_OLD)
    return out.where(~((hit > 0) & (20 * hit >= F.col("\x00n_words")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        _hit("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).select("*", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dl AS (SELECT * FROM d, lens WHERE len(w) >= n),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM dl, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, x)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN items USING (doc_id)
"""
