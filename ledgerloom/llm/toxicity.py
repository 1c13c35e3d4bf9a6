"""Toxicity: a linear classifier on character n-grams, its features scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (A-Z folded) of a whole text, hashed. Training has two passes over a bounded
sample of labelled rows: counts of documents with each n-gram by label (summed on the executors) give the log-count
ratios r and the n-grams that tell the labels apart best; then the presence of those is gathered, a short row a
document, and a logistic regression is fitted on r-scaled presence. Scoring reads every row and whole text once.

Bounds, all parameters: MAX_ROWS labelled rows, N_FEATURES kept n-grams. Nothing else is capped.
Defined cases: a null or empty text has no features and gets the score of the intercept. Labels that repeat count
once, as toxic if any says so; null labels don't count. Without rows of both labels nothing can be learnt: every score
is the smoothed share of toxic rows, and drop_toxic() keeps all documents. A null id is held out. Bytes that aren't
UTF-8 count as U+FFFD. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import FOLD, bounded_batches, claim, stash, table, text_bytes

ORDERS = (4, 6, 8)
BITS = 20
#: Most labelled rows that are used, those of the smallest hash of their id.
MAX_ROWS = 20_000
#: Files of the sample; each yields a row for each n-gram that it has.
SAMPLE_PARTS = 8
#: N-grams with weights.
N_FEATURES = 6_000
#: Least documents of a kept n-gram, and the smoothing of counts.
MIN_DOCS, SMOOTH = 5, 1.0
STEPS, L2 = 200, 1e-4


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def gram_ids(data: bytes) -> np.ndarray:
    """Hashed n-grams of characters of all orders at each place, with repeats."""
    c = np.frombuffer(data.translate(FOLD).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    out, h = [], c
    for n in range(1, max(ORDERS) + 1):
        if len(c) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :] + np.uint32(n) if n > 1 else h
        if n in ORDERS:
            x = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
            out.append(x >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    bias: float
    grams: np.ndarray
    weights: np.ndarray
    #: whether there were rows of both labels
    learnt: bool = True

    def table(self) -> np.ndarray:
        at = np.full(1 << BITS, -1, np.int16)
        at[self.grams] = np.arange(len(self.grams))
        return at


def present(data: bytes, at: np.ndarray) -> np.ndarray:
    """Indexes of the kept n-grams in a text."""
    got = at[gram_ids(data)]
    return np.unique(got[got >= 0])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("toxicity")
    n = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n[toxic, np.unique(gram_ids(text))] += 1
    (seen,) = np.nonzero(n.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[0, seen]), pa.array(n[1, seen])], names=["gram", "n0", "n1"])


def _fit(y: np.ndarray, ends: np.ndarray, cols: np.ndarray, ratio: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression by accelerated gradient steps on rows of columns (those of row i stand before ends[i]), each
    with the value ratio. Rows are taken some at a time, so that only cols has the size of all."""
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
    cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) + 1, 1 << 20)).tolist() + [len(y)])
    parts = [(a, z) for a, z in zip(cuts, cuts[1:]) if z > a]
    if cuts[0] > 0:
        parts.insert(0, (0, cuts[0]))

    def rows(a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        return cols[starts[a] : ends[z - 1]], np.repeat(np.arange(z - a), ends[a:z] - starts[a:z])

    def forward(w: np.ndarray, b: float) -> np.ndarray:
        by = ratio * w
        return np.concatenate([np.bincount(r, by[c], z - a) for a, z in parts for c, r in [rows(a, z)]]) + b

    def back(g: np.ndarray) -> np.ndarray:
        return ratio * sum(np.bincount(c, g[a:z][r], len(ratio)) for a, z in parts for c, r in [rows(a, z)])

    w, b = np.ones(len(ratio)), 1.0
    for _ in range(20):  # the largest curvature, by power iteration
        size = np.sqrt(w @ w + b * b)
        z = forward(w / size, b / size)
        w, b = back(z), z.sum()
    step = 1 / (0.3 * np.sqrt(w @ w + b * b) / len(y) + L2)
    w, b, t = np.zeros(len(ratio)), 0.0, 1.0
    w_ahead, b_ahead = w, b
    for _ in range(STEPS):
        g = (1 / (1 + np.exp(-np.clip(forward(w_ahead, b_ahead), -30, 30))) - y) / len(y)
        w_next, b_next = w_ahead - step * (back(g) + L2 * w_ahead), b_ahead - step * g.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_ahead, b_ahead = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return float(b), w * ratio


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, n_features: int = N_FEATURES) -> Model:
    bounded_batches(docs.sparkSession)
    rows = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # at most max_rows narrow rows are broadcast, so the documents are read once, and the sample is written once
    text = docs.select("doc_id", text_bytes("text").alias("text")).join(F.broadcast(rows), "doc_id").select("toxic", "text")
    text = stash(text.repartition(SAMPLE_PARTS), "labelled")
    n = {r["toxic"]: r["count"] for r in text.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        share = (pos + SMOOTH) / (pos + neg + 2 * SMOOTH)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0), False)
    count = text.mapInArrow(_counts, "gram long, n0 long, n1 long").groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p, q = (F.col("n1") + SMOOTH) / (pos + 2 * SMOOTH), (F.col("n0") + SMOOTH) / (neg + 2 * SMOOTH)
    best = (
        count.where(F.col("n0") + F.col("n1") >= MIN_DOCS)
        .withColumn("r", F.log(p / q))
        # how far the two shares are apart, in standard deviations
        .withColumn("z", F.abs(p - q) / F.sqrt(p * (1 - p) / pos + q * (1 - q) / neg + 1e-12))
        .orderBy(F.desc("z"), "gram")
        .limit(n_features)
        .select("gram", "r")
        .collect()
    )
    grams, ratio = np.array([r["gram"] for r in best], np.int64), np.array([r["r"] for r in best])
    at = Model(0.0, grams, ratio).table()

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [present(t, at).astype(np.int16) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int16()))], names=["toxic", "ids"])

    got = text.mapInArrow(presence, "toxic int, ids array<short>").toArrow()
    ids = got["ids"].combine_chunks()
    ends = ids.offsets.to_numpy()[1:].astype(np.int64) - ids.offsets[0].as_py()
    bias, w = _fit(got["toxic"].to_numpy().astype(float), ends, ids.flatten().to_numpy(), ratio)
    return Model(bias, grams, w)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    bounded_batches(docs.sparkSession)
    at, bias, w = model.table(), model.bias, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for b in batches:
            z = np.array([bias + w[present(t, at)].sum() for t in b.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes("text").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't call toxic, all of them if there was nothing to learn from; columns as
    they were. Null and empty texts have the score of the intercept; equal rows fare alike."""
    model = train(docs, labels)
    if not model.learnt:
        return docs
    at, bias, w = model.table(), model.bias, model.weights
    names = docs.columns
    docs_in = docs.withColumn("\x00text", text_bytes("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for b in batches:
            keep = [bias + w[present(t, at)].sum() < 0 for t in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(list(b.columns[: len(names)]), names=names).filter(pa.array(keep, pa.bool_()))

    return docs_in.mapInArrow(run, docs.schema)
