"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text; where chosen bits of it are zero, a chunk ends (in long stretches without
such a place, where the hash is the smallest around). The hash only depends on the last few bytes, so a passage is cut
alike wherever it stands, but for its ends. One chunk is too short to tell a copy from chance, so what is compared by
digest are the shortest runs of chunks of MIN_RUN bytes or more, one from each boundary on. The first place of each
run, by document and then by where it stands, keeps it; all later places are removed, in other documents or in the
same one. So every byte that goes is in a stretch of MIN_RUN bytes or more that one earlier place has as a whole, and
nothing else depends on which documents those are.

Digests are written once, packed, a row a document; first places are aggregated before they move, and digests of
which many documents have one are dealt to several tasks. Only texts that lose something move.

Defined cases: null and empty texts, and those shorter than MIN_RUN, lose nothing; a text without a boundary is one
chunk; a null doc_id is left out; rows that repeat a doc_id count as one document, but places are compared within a
row only; a place that overlaps the first one in the same text loses what is beyond it; runs of a period
of half their length or less are no passage within a text, so stretches of one short period stay; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, claim, join_hot, long_id, only_ids, stash, table, text_bytes

#: A chunk has 2 ** BITS bytes on average.
BITS = 5
#: Bits of the hash that decide; the highest depends on LOW + BITS bytes.
LOW = 11
#: No boundary this close behind another one.
LEAST = 8
#: A stretch of more bytes without a boundary gets others.
LONG = 160
#: Least bytes of a run of chunks that is compared; a passage of 50 words has more than twice as many.
MIN_RUN = 100
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 2**16, 256, dtype=np.uint16)
#: Bytes that are hashed at a time; each slice sees the bytes before it that its first hashes depend on.
SLICE = 1 << 22


def boundaries(data: bytes) -> np.ndarray:
    """Ends of chunks, the end of the text included."""
    found = []
    for at in range(0, len(data), SLICE):
        before = min(at, 15 + LEAST)
        h = _GEAR[np.frombuffer(data, np.uint8, min(SLICE, len(data) - at) + before, at - before)]
        for k in (1, 2, 4, 8):  # h[i] = sum of gear[i - j] << j, of 2k bytes after each step
            if len(h) > k:
                h = np.concatenate((h[:k], h[k:] + (h[:-k] << np.uint16(k))))
        cut = np.nonzero((h >> np.uint16(LOW)) == 0)[0] + at - before + 1
        cut = cut[np.diff(cut, prepend=-LEAST) >= LEAST]  # only looks at the bytes just before, so copies agree
        cut = cut[cut > at]
        for a, b in zip([at, *cut.tolist()], [*cut.tolist(), min(at + SLICE, len(data))]):
            if b - a > LONG:
                cut = np.append(cut, a + _smallest(h[a - at + before : b - at + before]))
        found.append(np.sort(cut))
    out = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.append(out, len(data)) if len(data) and (not len(out) or out[-1] != len(data)) else out


def _smallest(h: np.ndarray) -> np.ndarray:
    """Boundaries where a long stretch has none: behind hashes that are the smallest around, such as once a period."""
    low = np.lib.stride_tricks.sliding_window_view(np.pad(h, 32, constant_values=65535), 65).min(axis=1)
    out, last = [], 0
    for i in (np.nonzero(h == low)[0] + 1).tolist():
        if i - last >= LEAST:
            out.append(i)
            last = i
    return np.array(out, np.int64)


class Runs(NamedTuple):
    """The shortest runs of chunks of enough bytes: where they begin and end, and their digests."""

    start: np.ndarray
    stop: np.ndarray
    digest: np.ndarray


def chunk_runs(data: bytes, min_run: int = MIN_RUN) -> Runs:
    ends = boundaries(data)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1])) if len(ends) else ends
    last = np.searchsorted(ends, starts + min_run)
    n = int(np.searchsorted(last, len(ends)))  # the last starts have too little behind them
    starts, stops = starts[:n], ends[last[:n]]
    digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
    got = np.fromiter((digest(view[a:z]) for a, z in zip(starts.tolist(), stops.tolist())), np.uint64, n).view(np.int64)
    return Runs(starts, stops, got)


def periodic(x: bytes) -> bool:
    """Whether a stretch repeats what its first half or less holds."""
    k = x.find(x[: len(x) // 2], 1)
    return k > 0 and x[k:] == x[:-k]


def _digests(min_run: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for b in batches:
            runs = [chunk_runs(t, min_run) for t in b.column(1).to_pylist()]
            d = [np.unique(r.digest) for r in runs]
            again = [len(x) < len(r.digest) for x, r in zip(d, runs)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(d, pa.list_(pa.int64())), pa.array(again)], names=["doc_id", "digests", "again"])

    return rows


def later_spans(data: bytes, known: dict[int, int], doc: int, min_run: int) -> list[tuple[int, int, list[int]]]:
    """(start, stop, documents that have it first) of what other documents (known) or the text itself have earlier."""
    found: list[tuple[int, int, int]] = []
    first: dict[int, int] = {}
    runs = chunk_runs(data, min_run)
    for a, z, d in zip(runs.start.tolist(), runs.stop.tolist(), runs.digest.tolist()):
        source = known.get(d)
        if source is not None:
            found.append((a, z, source))
        elif first.setdefault(d, z) != z and max(a, first[d]) < z and not periodic(data[a:z]):
            found.append((max(a, first[d]), z, doc))
    found.sort()
    spans: list[tuple[int, int, set[int]]] = []
    for a, z, source in found:
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(z, spans[-1][1]), spans[-1][2] | {source})
        else:
            spans.append((a, z, {source}))
    return [(a, z, sorted(s)) for a, z, s in spans]


def _candidates(docs: DataFrame, min_run: int) -> DataFrame:
    """(doc_id, text, known) of the texts that may lose something: known are digests that another document has first."""
    bounded_batches(docs.sparkSession)
    text = docs.where("doc_id IS NOT NULL").select(long_id(docs), text_bytes("text").alias("text"))
    packed = stash(text.mapInArrow(_digests(min_run), "doc_id long, digests array<long>, again boolean").where("again OR size(digests) > 0"), "digests")
    digests = packed.select("doc_id", F.explode("digests").alias("digest"))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    first = stash(first.where("first < last").select("digest", "first", "n"), "first")
    found = join_hot(digests, first, ["digest"], "doc_id").where("doc_id <> first")
    per = stash(found.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "first")).alias("known")), "known")
    hit = only_ids(text, per.select("doc_id").union(packed.where("again").select("doc_id")))
    return hit.join(per, "doc_id", "left").select("doc_id", "text", "known")


def _found(batches: Iterator[pa.RecordBatch], min_run: int) -> Iterator[list[tuple[int, bytes, list]]]:
    """(doc_id, text, spans) of the rows of a batch that lose something."""
    claim("substring_dedup")
    for b in batches:
        out = []
        known = b.column(2)
        for row, (doc, data) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            own = known[row].values
            source = dict(zip(own.field(0).to_pylist(), own.field(1).to_pylist())) if own is not None else {}
            if spans := later_spans(data, source, doc, min_run):
                out.append((doc, data, spans))
        yield out


def repeated_spans(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, text, spans): bytes to remove of the documents that lose some, with the documents that have them first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _found(batches, min_run):
            spans = [[{"start": a, "stop": z, "first_doc_ids": s} for a, z, s in x[2]] for x in out]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array(spans, _SPANS)], names=["doc_id", "text", "spans"])

    return _candidates(docs, min_run).mapInArrow(rows, "doc_id long, text binary, spans array<struct<start:long,stop:long,first_doc_ids:array<long>>>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("first_doc_ids", pa.list_(pa.int64()))]))


def without_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, text, n_removed, first_doc_ids) of the documents that lose passages, without those."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _found(batches, min_run):
            texts, first = [], []
            for _, data, spans in out:
                edges = [0, *(x for a, z, _ in spans for x in (a, z)), len(data)]
                texts.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])))
                first.append(sorted({i for _, _, s in spans for i in s}))
            n = [len(x[1]) - len(t) for x, t in zip(out, texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array(texts, pa.binary()), pa.array(n, pa.int64()), pa.array(first, pa.list_(pa.int64()))],
                names=["doc_id", "text", "n_removed", "first_doc_ids"],
            )

    return _candidates(docs, min_run).mapInArrow(rows, "doc_id long, text binary, n_removed long, first_doc_ids array<long>")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose passages: how many bytes, the documents that have them first, and a digest of the rest."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_removed", "first_doc_ids", F.sha2("text", 256).alias("text_sha256"))
