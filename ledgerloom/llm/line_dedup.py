"""Line deduplication by winnowing.

A document is the sequence of the hashes of its lines (texts cut at newlines, blank lines left out). Every window of
RUN consecutive lines selects the rightmost of its smallest hashes; the selected places are fingerprints, and any two
equal runs of RUN lines select the same place in both. Fingerprints that only one place holds are done with. For the
others the windows around them are compared with the first place of the same window, which extends a match both ways
as far as whole windows agree. Runs of fewer lines count if they have MIN_WORDS words together; there are no more of
them than lines for each length, so each is a fingerprint of its own. A run of RUN lines or of MIN_WORDS words or more
that stands earlier, in a document of a smaller doc_id or earlier in the same one, is deleted as far as it goes. A
later place that overlaps the first one in the same text only loses the lines beyond it, so the first place isn't
touched by its own repeats (a b a b a b a keeps a b a).

Counts and first places are aggregated before they move, and what many documents share is dealt to several tasks.
Only texts that lose lines move.

Defined cases: null and empty texts have no lines; documents of fewer than RUN lines and MIN_WORDS words lose
nothing; words are runs of anything but ASCII white space, so a line of a script without spaces is one word; rows that
repeat a doc_id are ordered by a hash of their text, and equal rows of equal ids count as one; a null doc_id sorts
first; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import bitmap, bits_for, bounded_batches, claim, join_hot, long_id, stash, table, tag, text_bytes

#: Lines of a run that counts whatever its length, and words of one that counts whatever its lines.
RUN, MIN_WORDS = 3, 50
_P = np.uint64(0x9E3779B97F4A7C15)


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that aren't blank, and their numbers of words."""
    lines = [x for line in text.split(b"\n") if (x := line.strip())]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines)), np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))


def windows(h: np.ndarray, run: int) -> np.ndarray:
    out = h[: len(h) - run + 1].copy()
    for k in range(1, run):
        out = out * _P + h[k : len(h) - run + 1 + k]
    return (out ^ (out >> np.uint64(32))) * _P


def fingerprints(h: np.ndarray, run: int) -> np.ndarray:
    """Places that a window selects."""
    if len(h) < run:
        return np.zeros(0, np.int64)
    w = np.lib.stride_tricks.sliding_window_view(h, run)[:, ::-1]
    return np.unique(np.arange(run - 1, len(h)) - w.argmin(axis=1))


def long_windows(h: np.ndarray, words: np.ndarray, lines: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of so many lines with enough words begin, and their hashes."""
    if len(h) < lines:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    (at,) = np.nonzero(np.convolve(words, np.ones(lines, np.int64), "valid") >= min_words)
    return at, windows(h, lines)[at]


def _selected(run: int, min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("line_dedup")
        for b in batches:
            ids, marks, places, lines, around = [], [], [], [], []
            for row, text in enumerate(b.column(1).to_pylist()):
                h, words = line_hashes(text)
                for n in range(1, run):
                    at, w = long_windows(h, words, n, min_words)
                    ids.append(np.full(len(at), row))
                    marks.append(w.view(np.int64))
                    places.append(at + run - 1)
                    lines.append(np.full(len(at), n))
                    around += marks[-1][:, None].tolist()
                at = fingerprints(h, run)
                if not len(at):
                    continue
                w = windows(h, run).view(np.int64)
                ids.append(np.full(len(at), row))
                marks.append(h[at].view(np.int64))
                places.append(at)
                lines.append(np.full(len(at), run))
                # windows that hold the fingerprint, by where they begin; those outside the text are null
                around += [[int(w[s]) if 0 <= s < len(w) else None for s in range(p - run + 1, p + 1)] for p in at.tolist()]
            take = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take), b.column(2).take(take),
                    pa.array(np.concatenate(marks) if marks else np.zeros(0, np.int64)),
                    pa.array(np.concatenate(places) if places else np.zeros(0, np.int64)),
                    pa.array(np.concatenate(lines) if lines else np.zeros(0, np.int64)),
                    pa.array(around, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_no", "mark", "place", "lines", "around"],
            )

    return rows


def repeated_runs(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_no, start, stop, first_doc_id): runs of lines to delete, as places among lines that aren't blank."""
    bounded_batches(docs.sparkSession)
    text = docs.select(long_id(docs), text_bytes("text").alias("text"), F.xxhash64("text").alias("text_no"))
    marks = stash(text.mapInArrow(_selected(run, min_words), "doc_id long, text_no long, mark long, place long, lines long, around array<long>"), "marks")
    often = stash(marks.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1"), "often")
    some = join_hot(marks, often, ["mark"], ["doc_id", "place"]).select("doc_id", "text_no", "mark", F.posexplode("around").alias("k", "window"), "place", "lines")
    some = stash(some.where("window IS NOT NULL").select("doc_id", "text_no", "window", (F.col("place") - (run - 1) + F.col("k")).alias("start"), "lines").distinct(), "windows")
    first = some.groupBy("window").agg(F.min(F.struct("doc_id", "text_no", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stash(first, "first")
    stop = F.col("start") + F.col("lines")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_no") == F.col("first.text_no"))
    begin = F.when(same, F.greatest("start", F.col("first.start") + F.col("lines"))).otherwise(F.col("start"))
    later = join_hot(some, first, ["window"], ["doc_id", "start"]).where(~(same & (F.col("start") == F.col("first.start"))))
    places = later.groupBy("doc_id", "text_no").agg(F.array_sort(F.collect_set(F.struct(begin.alias("start"), stop.alias("stop"), F.col("first.doc_id").alias("first_doc_id")))).alias("s"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, no, s in zip(*(c.to_pylist() for c in b.columns)):
                open_ = None
                for x in s:
                    if open_ and x["start"] <= open_[3]:
                        open_[3] = max(open_[3], x["stop"])
                        continue
                    if open_:
                        out.append(tuple(open_))
                    open_ = [doc, no, x["start"], x["stop"], x["first_doc_id"]]
                out.append(tuple(open_))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "text_no", "start", "stop", "first_doc_id"])

    return places.mapInArrow(spans, "doc_id long, text_no long, start long, stop long, first_doc_id long")


def delete_lines(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the lines at those places among its lines that aren't blank."""
    lines = text.split(b"\n")
    at = [i for i, x in enumerate(lines) if x.strip()]
    gone = {at[k] for a, b in spans for k in range(a, b)}
    return b"\n".join(x for i, x in enumerate(lines) if i not in gone)


def without_repeats(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, first_doc_ids, n_deleted) of the documents that lose lines."""
    runs = repeated_runs(docs, run, min_words).groupBy("doc_id", "text_no").agg(F.collect_list(F.struct("start", "stop")).alias("runs"), F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"))
    runs = stash(runs, "runs")
    own = docs.select(F.col("doc_id").cast("long").alias("d"), text_bytes("text").alias("text"), F.xxhash64("text").alias("t"))
    own = tag(own, bitmap(runs, ["doc_id", "text_no"], bits_for(runs)), ["d", "t"], "hit").where("hit").drop("hit")
    hit = own.join(runs, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_no"))).select("doc_id", "text", "runs", "first_doc_ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("line_dedup")
        for b in batches:
            runs = [[(x["start"], x["stop"]) for x in r] for r in b.column(2).to_pylist()]
            texts = [delete_lines(t, r).decode("utf-8", "replace") for t, r in zip(b.column(1).to_pylist(), runs)]
            n = [sum(z - a for a, z in r) for r in runs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), b.column(3), pa.array(n, pa.int64())], names=["doc_id", "text", "first_doc_ids", "n_deleted"])

    return hit.mapInArrow(cut, "doc_id long, text string, first_doc_ids array<long>, n_deleted long")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose lines: how many, the documents that have them first, and a digest of what is left."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_deleted", "first_doc_ids", F.octet_length("text").cast("long").alias("n_bytes_left"), F.sha2("text", 256).alias("text_sha256"))
