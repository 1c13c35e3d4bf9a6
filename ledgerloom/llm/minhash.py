"""Near-duplicate documents: MinHash with banding, signature and full verification, connected components.

Words are runs of anything but ASCII white space, A-Z folded; a document's set holds its distinct five-word shingles
(all words as one, where there are fewer). Equal sets are one class from the start, so copies never meet as pairs.
Classes get minima of universal hashes. A band of some minima is a bucket; layout() chooses their numbers by the
threshold t, so that a pair at it misses all bands with a probability of (1 - t ** rows) ** n_bands, under one in two
million.

A bucket of any size is first joined to its smallest member only. What the verified links don't connect is then
compared across components: every bucket that holds more than one component brings its minority members together
with the rest, in cells of bounded numbers. So no link between different components is lost, and nobody pairs off a
group that is one component already. Verification moves the two sets of a pair to a cell of (some documents) x (some
documents), whose memory is bounded whatever the degree of a document.

Defined cases: null and empty texts, and texts of white space, have an empty set and are linked with nothing; rows
with a null doc_id are linked with nothing; a doc_id that repeats is one document, so its texts' components are one;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import FOLD, bounded_batches, claim, join_hot, long_id, only_ids, stash, table, text_bytes, without_ids
from ledgerloom.llm.components import connected_components

WORDS = 5
#: Most minima of a document.
MOST_HASHES = 128
#: Most chances that a pair at the threshold misses all bands, or that its signatures agree less often than the least.
MISS, MISS_AGREE = 4.5e-7, 1e-8
#: Documents of either side of a cell of verification, and members of a bucket that are compared at a time.
CELL, CHUNK = 256, 512
_RNG = np.random.Generator(np.random.PCG64(20240229))
_A, _BAND, _BAND_NO = (_RNG.integers(0, 2**63, MOST_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(3))
_P = np.uint64(0x9E3779B97F4A7C15)


class Layout(NamedTuple):
    """Bands, minima of each, and how many of all minima two signatures have to share."""

    rows: int
    n_bands: int
    least: int

    @property
    def n_hashes(self) -> int:
        return self.rows * self.n_bands


@lru_cache
def layout(percent: int) -> Layout:
    """The most selective bands of MOST_HASHES minima at most that miss a pair at the threshold with MISS at most."""
    t = min(percent, 99) / 100
    bands = lambda rows: math.ceil(math.log(MISS) / math.log1p(-(t**rows)))
    rows = max((r for r in range(1, MOST_HASHES + 1) if r * bands(r) <= MOST_HASHES), default=0)
    if not rows:
        raise ValueError(f"a threshold of {percent} needs more than {MOST_HASHES} minima")
    n, least, below = rows * bands(rows), 0, 0.0
    while (below := below + math.comb(n, least) * t**least * (1 - t) ** (n - least)) <= MISS_AGREE:
        least += 1
    return Layout(rows, bands(rows), least)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash = _WordHash()


def shingles(data: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct n-word shingles."""
    words = data.translate(FOLD).split()
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    if not words:
        return h
    width = min(n, len(words))
    s = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        s = s * _P + h[k : len(h) - width + 1 + k]
    s = (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(width)
    return np.unique(s ^ (s >> np.uint64(32)))


def signature(s: np.ndarray, n_hashes: int) -> np.ndarray:
    """Minima of multiply-shift hashes."""
    low, by = None, _A[:n_hashes]
    for at in range(0, len(s), 512):
        m = (s[at : at + 512, None] * by).min(axis=0)
        low = m if low is None else np.minimum(low, m)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, lay: Layout) -> np.ndarray:
    k = (sig.reshape(lay.n_bands, lay.rows).astype(np.uint64) * _BAND[: lay.rows]).sum(axis=1) + _BAND_NO[: lay.n_bands]
    k = (k ^ (k >> np.uint64(31))) * _P
    return (k ^ (k >> np.uint64(29))).view(np.int64)


def _features(lay: Layout):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash", _hash.clear)
        for b in batches:
            n, digest, sig, bands = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text)
                n.append(len(s))
                if not len(s):
                    digest.append(None), sig.append(None), bands.append(None)
                    continue
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                g = signature(s, lay.n_hashes)
                sig.append(g.tobytes())
                bands.append(band_keys(g, lay))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sig", "bands"],
            )

    return rows


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("minhash", _hash.clear)
    for b in batches:
        s = [shingles(t).tobytes() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.binary())], names=["doc", "shingles"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], names=["x", "y"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def _slot(c: str, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n))


def same_counts(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each x with each y, by products of incidence matrices."""
    every, n = np.unique(np.concatenate([*xs, *ys]), return_counts=True)
    shared = every[n > 1]
    out = np.zeros((len(xs), len(ys)), np.float32)
    for at in range(0, len(shared), 8192):
        part = shared[at : at + 8192]
        m = []
        for side in (xs, ys):
            inc = np.zeros((len(side), len(part)), np.float32)
            for row, s in zip(inc, side):
                i = np.minimum(np.searchsorted(part, s), len(part) - 1)
                row[i[part[i] == s]] = 1
            m.append(inc)
        out += m[0] @ m[1].T
    return np.rint(out).astype(np.int64)


def _links_in_cell(have: dict[int, list[np.ndarray]], asked: list[tuple[int, int]], percent: int) -> list[tuple[int, int]]:
    if not asked:
        return []
    if len(asked) < 8 * len(have):
        return [(x, y) for x, y in asked if any(linked(a, b, percent) for a in have[x] for b in have[y])]
    left = [(x, a) for x in dict.fromkeys(x for x, _ in asked) for a in have[x]]
    right = [(y, b) for y in dict.fromkeys(y for _, y in asked) for b in have[y]]
    same = same_counts([a for _, a in left], [b for _, b in right])
    sizes = [np.array([len(s) for _, s in side]) for side in (left, right)]
    good = 100 * same >= percent * (sizes[0][:, None] + sizes[1] - same)
    wanted = set(asked)
    i, j = np.nonzero(good)
    return list({p: None for k, m in zip(i.tolist(), j.tolist()) if (p := (left[k][0], right[m][0])) in wanted})


def _needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of a cell once; rows come cell by cell."""
    cell, seen, out = None, set(), []
    for c, xs, ys in _rows(batches):
        if c != cell:
            out += [(cell, d) for d in seen]
            cell, seen = c, set()
        if len(out) > 50_000:
            yield _out(out)
            out = []
        seen.update(xs, ys)
    yield _out(out + [(cell, d) for d in seen])


def verify(packed: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs of (cell, xs, ys) whose full sets meet the threshold; a pair comes in one cell, and once."""
    packed = stash(packed.repartition("cell").sortWithinPartitions("cell"), "packed")
    need = stash(packed.repartition("cell").sortWithinPartitions("cell").mapInArrow(_needs, "x long, y long").toDF("cell", "doc"), "need")
    often = need.groupBy("doc").agg(F.count("*").alias("n"))
    involved = only_ids(docs.select(F.col("doc_id").alias("doc"), text_bytes("text").alias("text")), often.select("doc"), "doc").join(often, "doc", "left_semi")
    sets = involved.mapInArrow(_sets, "doc long, shingles binary")
    none = F.lit(None)
    rows = join_hot(need, sets, ["doc"], "cell", sizes=often).select("cell", F.lit(0).alias("kind"), "doc", "shingles", none.cast("array<long>").alias("xs"), none.cast("array<long>").alias("ys"))
    asked = packed.select("cell", F.lit(1).alias("kind"), none.cast("long").alias("doc"), none.cast("binary").alias("shingles"), "xs", "ys")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, have, pairs, out = None, {}, [], []
        for c, kind, doc, data, xs, ys in _rows(batches):
            if c != cell:
                out += _links_in_cell(have, pairs, percent)
                cell, have, pairs = c, {}, []
            if kind == 0:
                have.setdefault(doc, []).append(np.frombuffer(data, np.uint64))
            else:
                pairs += zip(xs, ys)
            if len(out) > 50_000:
                yield _out(out)
                out = []
        yield _out(out + _links_in_cell(have, pairs, percent))

    return rows.union(asked).repartition("cell").sortWithinPartitions("cell", "kind").mapInArrow(check, "x long, y long")


def sides(docs: DataFrame) -> int:
    """Rows and columns of cells so that each has about CELL of the documents."""
    return max(1, -(-docs.distinct().count() // CELL))


def agree(pairs: DataFrame, sigs: DataFrame, lay: Layout) -> DataFrame:
    """The pairs whose signatures agree often enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint32).reshape(-1, lay.n_hashes) for k in (2, 3))
            keep = (a == c).sum(axis=1) >= lay.least
            yield pa.RecordBatch.from_arrays(list(b.columns[:2]), names=["x", "y"]).filter(pa.array(keep))

    n = pairs.groupBy("x").agg(F.count("*").alias("n"))  # the centre of a large bucket is in a pair with each member
    both = join_hot(pairs, sigs.toDF("x", "sx"), ["x"], "y", sizes=n).join(sigs.toDF("y", "sy"), "y")
    return both.select("x", "y", "sx", "sy").mapInArrow(check, "x long, y long")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("x"), F.greatest(a, b).alias("y")]


def _across(members: DataFrame, roots: DataFrame, reps: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Packed candidate pairs (cell, xs, ys) of different components in one bucket whose signatures agree often enough.

    A pair is found in the bucket of its first common band only. A bucket's pairs leave it as a row for each cell of
    verification, so the rows don't grow with the square of a group."""
    lay = layout(percent)
    m = members.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select("key", "band", "doc", F.coalesce("root", "doc").alias("comp"))
    per = m.groupBy("key", "comp").agg(F.count("*").alias("n"))
    opened = per.groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main")).where("k > 1")
    opened = opened.select("key", F.col("main.comp").alias("main"), F.ceil(F.col("n") / CHUNK).alias("chunks"))
    rows = join_hot(m, opened, ["key"], "doc", sizes=sizes)
    rows = stash(rows.join(reps.select(F.col("doc_id").alias("doc"), "sig", F.col("n_shingles").alias("size")), "doc"), "open")
    side = sides(rows.select("doc"))
    rows = rows.withColumn("slot", _slot("doc", side))
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    rest = ["band", "doc", "comp", "main", "size", "slot", "sig"]
    # each minority member meets each chunk of its bucket; minority members are in chunks of their own
    few = rows.where("comp <> main").select("key", F.explode(every).alias("c1"), chunk.alias("c2"), F.lit(0).alias("kind"), *rest)
    lots = rows.where("comp <> main").select("key", chunk.alias("c2")).distinct()
    many = join_hot(rows.withColumn("c1", chunk), lots, ["key"], "doc", sizes=sizes).select("key", "c1", "c2", F.lit(1).alias("kind"), *rest)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, grid, found, out = None, [], None, [], []

        def pack() -> None:
            """The bucket's pairs as rows of out, by cell of verification."""
            if found:
                at, xs, ys = (np.concatenate(c) for c in zip(*found))
                order = np.argsort(at, kind="stable")
                at, xs, ys = at[order], xs[order], ys[order]
                ends = np.append(np.nonzero(np.diff(at))[0] + 1, len(at)).tolist()
                for a, z in zip([0, *ends[:-1]], ends):
                    out.append((int(at[a]), xs[a:z], ys[a:z]))
                found.clear()

        def made() -> pa.RecordBatch:
            cols = zip(*out) if out else ((), (), ())
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["cell", "xs", "ys"])

        for key, c1, c2, kind, band, doc, comp, main, size, slot, sig in _rows(batches):
            if (key, c1, c2) != cell:
                pack()
                cell, held, grid = (key, c1, c2), [], None
                if len(out) >= 1000:
                    yield made()
                    out.clear()
            g = np.frombuffer(sig, np.uint32)
            if kind == 0:
                held.append((doc, comp, size, slot, g))
                continue
            if grid is None:
                if not held:
                    continue
                grid = np.array([h[4] for h in held])
                ids, comps, lens, slots = (np.array([h[k] for h in held], np.int64) for k in range(4))
            same = grid == g
            near = (same.sum(axis=1) >= lay.least) & (comps != comp)
            near &= 100 * np.minimum(lens, size) >= percent * np.maximum(lens, size)
            if comp != main:
                near &= ids < doc  # both are minority members: once is enough
            (near,) = np.nonzero(near)
            near = near[same[near].reshape(-1, lay.n_bands, lay.rows).all(axis=2).argmax(axis=1) == band]
            if len(near):
                found.append((slot * side + slots[near], np.full(len(near), doc), ids[near]))
        pack()
        yield made()

    cells = few.union(many).repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "kind")
    return cells.mapInArrow(check, "cell long, xs array<long>, ys array<long>")


def _same_id(some: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of documents whose id repeats with other texts."""
    again = some.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    of = some.select("doc_id", "digest").join(again, "doc_id", "left_semi").join(classes.select("digest", "rep"), "digest")
    return of.select(*_ordered("doc_id", "rep")).where("x < y").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    lay = layout(percent)
    docs = docs.select(long_id(docs), "text")
    feats = stash(docs.select("doc_id", text_bytes("text").alias("text")).mapInArrow(_features(lay), "doc_id long, n_shingles long, digest binary, sig binary, bands array<long>"), "features")
    able = "doc_id IS NOT NULL AND n_shingles > 0"
    some = feats.where(able)
    classes = stash(some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    sigs = reps.select("doc_id", "sig")
    buckets = reps.select(F.col("doc_id").alias("doc"), F.posexplode("bands").alias("band", "key"))
    shared = stash(buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("centre")).where("n > 1"), "shared")
    members = stash(join_hot(buckets, shared, ["key"], "doc"), "members")
    pairs = members.where("doc <> centre").select(*_ordered("doc", "centre")).distinct()
    texts = docs.where("doc_id IS NOT NULL")
    pairs = stash(agree(stash(pairs, "stars"), sigs, lay), "pairs")
    side = sides(pairs.select("x").union(pairs.select("y")))
    # a centre's pairs are gathered for each cell, in which there are about CELL documents
    packed = pairs.groupBy((_slot("x", side) * side + _slot("y", side)).alias("cell"), "x").agg(F.collect_list("y").alias("ys"))
    packed = packed.select("cell", F.array_repeat("x", F.size("ys")).alias("xs"), "ys")
    links = stash(verify(packed, texts, percent).union(_same_id(some, classes)), "links")
    roots = connected_components(links, "x", "y")
    # what the stars left apart
    packed = stash(_across(members.select("key", "band", "doc"), roots, reps, shared, percent), "across")
    if packed.head(1):
        links = links.union(stash(verify(packed, texts, percent), "links"))
        roots = connected_components(links, "x", "y")
    # a class has one root, so only the classes look for theirs, and copies take it from their class
    of = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "n", F.coalesce("root", "rep").alias("component_id"))
    linked_rows = join_hot(some.select("doc_id", "n_shingles", "digest"), of, ["digest"], "doc_id").select("doc_id", "n_shingles", "component_id")
    return linked_rows.union(feats.where(f"NOT ({able})").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def drop_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each group stays, the one of the smallest doc_id; columns as they were. Rows with a null
    doc_id stay, and of rows that repeat a doc_id all stay or none."""
    return without_ids(docs, near_duplicates(docs, percent).where("doc_id <> component_id").select("doc_id"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
