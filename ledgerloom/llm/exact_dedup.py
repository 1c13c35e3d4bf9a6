"""Exact deduplication by progressive refinement, with DataFrame functions only.

Rows are narrowed by byte length, then by a hash of a prefix, then by a SHA-256 of the whole text; each level only
looks at what the level before left in a group of two or more, and the counts are aggregated before they move. The
groups that the first two levels leave travel to the scan that reads whole texts as a bitmap (sized by their number, up to a bound): a row
that it doesn't hold has no equal; the few others that it holds by chance are hashed in vain, and change nothing.
Texts never move, but for those that drop_exact_copies() has to look at again. Groups of any size are split.

Defined cases: a null text equals the empty text. A null id sorts below every other id. Equal rows that repeat with
the id that stays are all marked kept (they are the same row; `n_same` counts them). An empty table gives an empty
table. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bitmap, bits_for, join_hot, stash, tag

#: Characters of a text that the second level hashes.
PREFIX_CHARS = 256
_LEVELS = ("len", "prefix_hash")


def surviving_groups(docs: DataFrame, text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """(len, prefix_hash) of the groups that still have two rows after the levels by length and by prefix."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(
        F.octet_length(text).alias("len"), F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix_hash")
    )
    # a group of two rows by both is one by length as well, so one partial aggregation serves both levels
    return keys.groupBy(*_LEVELS).agg(F.count("*").alias("n")).where("n > 1").select(*_LEVELS)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_all: bool = False,
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, n_same, kept, text_sha256.

    text_sha256 is null for rows that no other row equals, unless digest_all asks for all digests."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    levels = docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).alias("len"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix_hash"),
        text.alias("whole"),
    )
    groups = stash(surviving_groups(docs, text_col, prefix_chars), "groups")
    tagged = tag(levels, bitmap(groups, _LEVELS, bits_for(groups)), _LEVELS, "hit")
    sha = F.sha2(F.col("whole"), 256)
    rows = stash(tagged.select("id", "len", "hit", (sha if digest_all else F.when(F.col("hit"), sha)).alias("sha")), "digests")
    equal = (
        rows.where("hit")
        .groupBy("len", "sha", "id")
        .agg(F.count("*").alias("n"))
        .groupBy("len", "sha")
        .agg(F.sum("n").alias("n"), F.max(F.struct("id", "n")).alias("top"))
        .where("n > 1")
    )
    equal = stash(equal.withColumn("size", F.col("n")), "equal")
    # rows that can't have an equal pass by the join
    alone = rows.where("NOT hit").select("len", "sha", "id", F.lit(None).cast(equal.schema["top"].dataType).alias("top"), F.lit(None).cast("long").alias("size"))
    out = join_hot(rows.where("hit").select("len", "sha", "id"), equal, ["len", "sha"], "id", "left").select("len", "sha", "id", "top", "size").union(alone)
    grouped = F.col("size").isNotNull()
    keep = F.when(grouped, F.col("top.id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped & F.col("id").eqNullSafe(F.col("top.id")), F.col("top.n")).otherwise(F.lit(1)).cast("long").alias("n_same"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        (F.col("sha") if digest_all else F.when(grouped, F.col("sha"))).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the rows that have an equal text and a smaller id; one row of each group stays.

    A bitmap of the ids that go, or that repeat with one text, is broadcast, and only rows that it holds move."""
    groups = exact_groups(docs, id_col, text_col)
    gone = stash(
        groups.where(~F.col("kept") | (F.col("n_same") > 1))
        .select(F.col(id_col).alias("\x00id"), F.col("text_sha256").alias("\x00sha"), F.col("kept").alias("\x00again"))
        .distinct(),
        "gone",
    )
    bits = bitmap(gone.withColumnRenamed("\x00id", id_col), [id_col], bits_for(gone))
    tagged = tag(docs, bits, [id_col], "\x00hit")
    some = tagged.where(F.col("\x00hit")).drop("\x00hit")
    same = F.col(id_col).eqNullSafe(F.col("\x00id")) & (F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256) == F.col("\x00sha"))
    clean = some.join(gone, same, "left_anti")
    again = some.join(gone.where(F.col("\x00again")), same, "left_semi").withColumn("\x00text", F.coalesce(F.col(text_col), F.lit("")))
    again = again.dropDuplicates([id_col, "\x00text"]).drop("\x00text")
    return tagged.where(~F.col("\x00hit")).drop("\x00hit").unionByName(clean).unionByName(again)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    out = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_all=True)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
