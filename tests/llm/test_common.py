"""Helpers that the operators share: bitmaps, joins of hot keys, tables in the shared folder."""

import collections
import os
import types

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common


@pytest.mark.parametrize("hot, bits", [(500, 1 << 18), (3, 64), (1, 128)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_hot(spark, monkeypatch, hot, bits, how):
    """The same rows as a plain join, whatever is hot, with null keys and repeats."""
    monkeypatch.setattr(common, "HOT", hot)
    monkeypatch.setattr(common, "HOT_BITS", bits)
    rows = spark.range(300).select(F.when(F.col("id") % 9 > 0, F.floor(F.sqrt("id"))).alias("k"), (F.col("id") % 50).alias("x"))
    groups = rows.where("k % 3 > 0").groupBy("k").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
    want = collections.Counter(tuple(r) for r in rows.join(groups.drop("n"), "k", how).select("k", "x", "s").collect())
    assert collections.Counter(tuple(r) for r in common.join_hot(rows, groups, ["k"], "x", how).select("k", "x", "s").collect()) == want
    several = groups.drop("n").union(groups.select("k", F.lit(-1).cast("long")))  # more rows than one for a key
    want = collections.Counter(tuple(r) for r in rows.join(several, "k").select("k", "x", "s").collect())
    got = common.join_hot(rows, several, ["k"], "x", sizes=groups)
    assert collections.Counter(tuple(r) for r in got.select("k", "x", "s").collect()) == want


@pytest.mark.parametrize("bits", [1 << 22, 64])
def test_ids(spark, monkeypatch, bits):
    """Rows go or stay by id, of any integer width; null ids stay."""
    monkeypatch.setattr(common, "BITS", bits)
    monkeypatch.setattr(common, "MOST_BITS", bits)
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (40, "e")], "doc_id int, `hit` string")
    gone = spark.createDataFrame([(1,), (40,), (41,), (None,)], "x long")
    assert sorted((r.doc_id or 0, r.hit) for r in common.without_ids(docs, gone).collect()) == [(0, "d"), (2, "c")]
    assert {r.doc_id for r in common.only_ids(docs, gone).collect()} >= {1, 40}
    assert common.without_ids(docs, gone.limit(0)).count() == 5 and common.without_ids(docs.limit(0), gone).columns == docs.columns


def test_bits_grow_with_the_ids(spark):
    """A table of more ids has a larger bitmap, up to the bound, so that it holds few rows that it needn't."""
    assert [common.bits_for(spark.range(n)) for n in (0, 10, 1 << 20)] == [common.BITS, common.BITS, 1 << 25]
    assert common.bits_for(spark.range(1 << 24)) == common.MOST_BITS
    some = common.tag(spark.range(2_000_000, 2_100_000).toDF("x"), common.bitmap(spark.range(1 << 19).toDF("x"), ["x"], common.bits_for(spark.range(1 << 19))), ["x"], "hit")
    assert some.where("hit").count() < 100_000 * 0.07


def test_scratch(spark):
    """Tables inside go with the scope around them, but those that it is to keep."""
    df = spark.range(3)
    with common.scratch(spark):
        kept, path = common.stash_at(df, "kept", keep=True)
        _, gone = common.stash_at(df, "gone")
        assert os.path.exists(gone)
    assert not os.path.exists(gone) and kept.count() == 3
    common.delete(spark, path)
    assert not os.path.exists(path)


def test_shared_folder():
    """On a cluster it must be named."""
    session = lambda master, folder: types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda k, d=None: folder), sparkContext=types.SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    )
    assert common.shared_dir(session("spark://x", "/shared/")) == "/shared"
    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(session("spark://x", None))


def test_batches(spark):
    """Sizes of batches are lowered, never raised."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        common.bounded_batches(spark)
        assert spark.conf.get(key) == "4m"
        for before, after in (("64m", "4m"), ("1m", "1m"), ("67108864", "4m"), ("2097152b", "2097152b"), ("4m", "4m")):
            spark.conf.set(key, before)
            common.bounded_batches(spark)
            assert spark.conf.get(key) == after
    finally:
        spark.conf.set(key, old)
