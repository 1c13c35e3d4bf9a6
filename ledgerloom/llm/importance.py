"""Importance resampling: documents are drawn by how much more their words belong to a target than to the corpus.

Features are runs of consecutive words, hashed into buckets. A bucket's gain is the logarithm of its smoothed share of
the target's features over that of the corpus'; a document's weight is the sum of its features' gains, and the draw
is without replacement, by the weight and Gumbel noise from a hash of the id, so that it doesn't depend on how rows are
dealt. Counts cover all rows of both tables.

All of it is DataFrame functions: features are exploded and counted by bucket, partly before the shuffle; the gains,
one row a bucket, are a table of a fixed size, which is broadcast; a document's gains are summed where its features were
exploded, so one narrow row a document is shuffled; ranks come from a distributed sort (common.ranked).

Defined cases: a null or empty text has no features and the weight 0. Empty tables give an empty table; with an empty
target, gains are those of a uniform one. Rows repeat freely, each is drawn by itself, and rows of one score and id
take ranks in any order. A null id is hashed as no text, and comes before others on ties. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ranked, stash, table

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, "2024", 20, 10
#: Words of a text before A-Z are lowered.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold(text: Column) -> Column:
    """A-Z lower-cased; texts of ASCII only by lower(), which is faster and does the same to them."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _AZ, _az))


def runs(words: Column, longest: int) -> Column:
    """All runs of 1 to longest consecutive words, joined by one space."""
    if longest == 1:
        return words
    of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.flatten(F.array(*[F.when(F.size(words) >= n, of(n)).otherwise(F.array().cast("array<string>")) for n in range(1, longest + 1)]))


def features(docs: DataFrame, text_col: str, longest: int, buckets: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row (keep, n_words, bucket) for each feature; bucket is null in the only row of a text that has none."""
    own = [F.col(c) for c in keep]
    words = docs.select(*own, F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD), F.lit(0)).alias("\x00words"))
    runs_ = words.select(*own, F.size("\x00words").cast("long").alias("n_words"), runs(F.col("\x00words"), longest).alias("\x00runs"))
    each = runs_.select(*own, "n_words", F.explode_outer("\x00runs").alias("\x00run"))
    return each.select(*own, "n_words", F.pmod(F.crc32(fold(F.col("\x00run")).cast("binary")), F.lit(buckets)).cast("int").alias("bucket"))


def bucket_counts(docs: DataFrame, name: str, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, name): how many features of docs each bucket has; a row a bucket that has any."""
    return features(docs, text_col, longest, buckets).where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias(name))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of all buckets, in thousandths of a natural logarithm, rounded down."""
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counted = every.join(bucket_counts(docs, "s", text_col, longest, buckets), "bucket", "left").join(bucket_counts(target, "t", text_col, longest, buckets), "bucket", "left").fillna(0, ["s", "t"])
    counted = stash(counted, "buckets")  # so that texts are counted once
    s, t = (F.col(c).cast("double") for c in ("s", "t"))
    all_s, all_t = (counted.agg(F.sum(c)).scalar().cast("double") for c in ("s", "t"))
    ratio = (t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))
    return counted.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def noise(id_: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, by the first 32 bits of a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, gain: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("\x00text"), F.monotonically_increasing_id().alias("row"))
    each = features(rows, "\x00text", longest, buckets, ("row", "id")).join(F.broadcast(gain), "bucket", "left")
    zero = F.lit(0).cast("long")
    of = each.groupBy("row", "id").agg(F.max("n_words").alias("n_words"), F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), zero).alias("weight"))
    return of.withColumn("score", F.col("weight") + noise(F.col("id"), seed))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = 1, buckets: int = BUCKETS, seed: str = SEED,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of docs; rank is null for those not drawn. Of the rows
    with least_words words or more, percent are drawn, rounded down."""
    rows = stash(scored(docs, gains(docs, target, text_col, longest, buckets), id_col, text_col, longest, buckets, seed), "scored")
    fit = ranked(rows.where(F.col("n_words") >= least_words), [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("row").asc()], "rank")
    drawn = F.floor(rows.where(F.col("n_words") >= least_words).agg(F.count("*")).scalar() * percent / 100)
    fit = fit.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return fit.unionByName(rest).drop("row").withColumnRenamed("id", id_col)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


#: The checksum is computed once a distinct word, by its table of 256 remainders.
OP13_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i::BIGINT AS v, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
remainders AS (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
words AS (
  SELECT 0 AS side, rowid_ AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
  UNION ALL SELECT 1, 0, 0, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
each AS (SELECT side, row, doc_id, unnest(ws) AS w FROM words),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM each)),
sums AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, remainders),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM each JOIN sums USING (w) GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM counts),
gains AS (SELECT bucket, floor(1000.0 * ln((t + 1.0) * (all_s + 10000.0) / ((s + 1.0) * (all_t + 10000.0))))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT row, count(*) AS n, sum(gain) AS weight FROM each JOIN sums USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scores AS (
  SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000.0 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (row) WHERE side = 0),
ranks AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS r, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranks
"""
