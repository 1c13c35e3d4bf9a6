"""A corpus pipeline of this repository's training-data operators; see run().

Every stage takes documents with nulls in any column, empty and very long texts, rows that repeat, more columns than
it knows, and no rows at all; all but the last return the columns that they got."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.bpe import token_digests
from ledgerloom.llm.common import delete, scratch, stash_at, table
from ledgerloom.llm.exact_dedup import drop_exact_copies
from ledgerloom.llm.fm_index import drop_contaminated
from ledgerloom.llm.minhash import drop_near_copies
from ledgerloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. All stay if labels has not both labels; null and empty texts are judged
    by the intercept alone, which keeps them unless most labelled documents are toxic; equal rows fare alike."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id stays; null equals empty, a null id is the smallest, and of rows
    that repeat id and text one stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (a similarity of 0.8 or more) stays, the one of the smallest
    doc_id. Texts without words and rows without an id are linked with nothing and stay; rows of one id stay or go
    together."""
    return drop_near_copies(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which benchmark windows cover a twentieth of the words or more. Those without words stay, and
    all do if benchmark is empty; null items have no windows; equal rows fare alike."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts that are left, as digests of token ids and of the bytes that they decode to, a row for each document;
    null counts as empty, and other columns are left out.

    The executors' memory has grown with the stages before, so the workers' caches are smaller than in a query alone."""
    import public_tokenizers

    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, scale=0.15)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL can't express training, MinHash and BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each one's rows are written to the shared folder and read again by the next. What a
    stage itself has written there, and its input, are deleted when its rows are."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs, path = stash_at(stage(spark, docs, sf_dir), name, keep=True)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
