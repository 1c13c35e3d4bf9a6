"""Sweeps, mixing and resampling against brute force, and the distributed helpers that they share."""

import collections
import datetime
import hashlib
import math
import random
import re
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import common, importance, mixing, sweep


@pytest.mark.parametrize("heavy", [1 / 1000, 1 / 3, 0.0])
def test_join_heavy(spark, monkeypatch, heavy):
    """As a plain left join, whatever is heavy, with null keys and repeats."""
    monkeypatch.setattr(common, "HEAVY", heavy)
    rows = spark.range(300).select(F.when(F.col("id") % 9 > 0, F.floor(F.col("id") * F.col("id") / 9000)).alias("k"), (F.col("id") % 50).alias("x"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c"), (None, "d")], "k long, v string")
    want = collections.Counter(tuple(r) for r in rows.join(lookup, "k", "left").collect())
    assert collections.Counter(tuple(r) for r in common.join_heavy(rows, lookup, "k", "x").collect()) == want
    assert common.join_heavy(rows.limit(0), lookup, "k", "x").collect() == []


def test_ranked(spark):
    """Places in the total order, nulls where the order puts them; equal rows take places next to each other."""
    values = [random.Random(k).choice([None, k % 7, k]) for k in range(400)] + [5] * 200
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v int, `n` int").repartition(7)
    got = common.ranked(df, [F.col("v").desc_nulls_first(), F.col("n").asc()], "place").collect()
    want = sorted(enumerate(values), key=lambda x: (x[1] is not None, -(x[1] or 0), x[0]))
    assert {r.n: r.place for r in got} == {n: k + 1 for k, (n, _) in enumerate(want)}
    assert common.ranked(df.limit(0), [F.col("v").asc()], "place").collect() == []


def swept(intervals):
    """By the definition, moment by moment."""
    out = []
    for g in {i[0] for i in intervals}:
        own = [(a, b, v or 0) for h, a, b, v in intervals if h == g and a is not None and (b is None or b > a)]
        before, rows = (0, 0), []
        for t in sorted({x for a, b, _ in own for x in (a, b) if x is not None}):
            open_ = [v for a, b, v in own if a <= t and (b is None or b > t)]
            now = (len(open_), sum(open_))
            if now != before:
                rows.append([g, t, None, *now])
            before = now
        for k, r in enumerate(rows):
            r[2] = rows[k + 1][1] if k + 1 < len(rows) else None
            r += [max(x[3] for x in rows[: k + 1]), max(x[4] for x in rows)]
        out += map(tuple, rows)
    return sorted(out)


@pytest.mark.parametrize("bits, levels, span", [(12, 3, 10**6), (2, 3, 3000), (2, 2, 60), (1, 5, 500), (3, 1, 200)])
def test_sweep(spark, bits, levels, span):
    rng = random.Random(bits * 10 + levels)
    rows = []
    for k in range(300):
        a = rng.choice([None, rng.randrange(-span, span), rng.randrange(-9, 9)])
        b = rng.choice([None, (a or 0) + rng.randrange(-3, span // 5), (a or 0) + 4])
        rows.append((rng.choice([-2, -1, 7, 7, 7]), a, b, rng.choice([None, 0, rng.randrange(-50, 5000)])))
    rows += rows[:40]
    rows += [(8, 5, 9, 3), (8, 9, 12, 3)]  # at 9 nothing changes
    df = spark.createDataFrame(rows, "grp int, start_s long, end_s long, value long")
    got = sweep.sweep(sweep.deltas(df), bits, levels).select("grp", "at", "next", "n", "v", "high_n", "peak_v").collect()
    assert sorted(map(tuple, got)) == swept(rows)
    assert [r[1] for r in swept(rows) if r[0] == 8] == [5, 12]


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20), st.none() | st.integers(-20, 40), st.integers(-3, 3)), max_size=25))
def test_swept_is_the_rule(intervals):
    """The brute force itself: moments in order, each one's next is the following one, and nothing is open before."""
    rows = swept(intervals)
    for a, b in zip(rows, rows[1:]):
        assert a[0] != b[0] or (a[2] == b[1] and (a[3], a[4]) != (b[3], b[4]) and a[5] <= b[5])


def test_windows_are_bounded(spark):
    """No window is over a whole group but that of the last level, a row for each of its stretches."""
    df = spark.range(20_000).select(F.lit(1).alias("grp"), (F.col("id") * 10).alias("start_s"), (F.col("id") * 10 + 25).alias("end_s"), F.lit(1).cast("long").alias("value"))
    changes = sweep.deltas(df)
    most = changes.groupBy("grp", F.expr(f"shiftright(at, {sweep.BITS})")).count().agg(F.max("count")).first()[0]
    assert changes.count() > 20_000 and most <= 1 << sweep.BITS
    assert (1 << 63) // 10**6 >> sweep.BITS * sweep.LEVELS < 300  # stretches of the last level in the range of a timestamp


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sales(spark, zone):
    """Nations of clients, ends of lines, cents, and odd rows; seconds don't depend on the session's zone."""
    at = lambda s: datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=s)
    sales = [
        (1, 10, 1.005, at(1000.9)), (2, 11, None, at(-0.5)), (3, None, 2.0, at(50)), (4, 99, 2.344, at(60)), (5, 10, 3.0, None), (6, 12, 1.0, at(200_000)),
        (7, 10, float("nan"), at(300)), (7, 10, 1.0, at(300)), (None, 13, 5.0, at(400)),
    ]
    lines = [(1, at(5000.2)), (1, at(4000.7)), (1, None), (2, None), (6, at(200_000 - 86_400)), (None, at(1)), (7, at(301)), (3, at(50 - 86_400 + 1))]
    clients = [(10, 4), (11, None), (12, 5), (13, 3), (13, 2), (None, 9)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        made = [spark.createDataFrame(r, s).withColumn("grp", F.lit("clash")) for r, s in ((sales, "sale_id long, client_id long, total double, sold_at timestamp_ntz"), (lines, "sale_id long, shipped_at timestamp_ntz"), (clients, "client_id long, nation_id int"))]
        got = collections.Counter(tuple(r) for r in sweep.sale_intervals(*made).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = 86_400
    want = [(4, 1000, 4000 + day, 100), (-1, -1, None, 0), (-1, 50, 51, 200), (-1, 60, None, 234), (4, 300, 301 + day, 0), (4, 300, 301 + day, 100), (2, 400, None, 500)]
    assert got == collections.Counter([*want, *[(-2, *w[1:]) for w in want]])


def level_of(sizes, weights=mixing.WEIGHTS, share=1.5, limit=2):
    """Targets by sharing the excess again, in sources' order."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        unit = left / sum(w[k] for k in free)
        over = {k for k in free if unit * w[k] > limit * sizes[k]}
        for k in free if not over else over:
            target[k] = unit * w[k] if not over else float(limit * sizes[k])
        if not over:
            break
        left -= sum(limit * sizes[k] for k in over)
        free -= over
    return target


def corpus(spark, seed, n=3000, odd=True):
    rng = random.Random(seed)
    names = ["a", "Z", "é", "", "😀", "￿", None, "b", "tiny", "none"]
    rows = [(k, " ".join(["w"] * int(math.exp(rng.uniform(0, 5)))), rng.choice(["hot", "hot", *names[:8]])) for k in range(n)]
    rows += [(n, "x y", "tiny"), (n + 1, None, "none"), (n + 2, "  \t\n", "none"), (n + 3, "w " * 9000, "hot")]
    if odd:
        rows += [(n + 5, "one two three", "b")] * 500 + [(None, "q", "a"), (None, "q", "a"), (n + 4, "", "a")]
    return rows, spark.createDataFrame([(*r, 1.5, "x") for r in rows], "doc_id long, text string, source string, p double, key string")


@pytest.mark.parametrize("leaf, chunk", [(4096, 1024), (16, 5), (2, 1)])
def test_mix(spark, leaf, chunk):
    """Targets by the rule; whole copies up to the limit; each source within a document of its target; reruns agree."""
    rows, docs = corpus(spark, leaf)
    got = mixing.mix(docs, leaf=leaf, chunk=chunk).collect()
    size = lambda t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w])
    of = {r[0]: r[2] for r in rows}
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, size(t)) for i, t, _ in rows)
    sources = sorted({s for _, _, s in rows if s is not None}, key=lambda s: [ord(c) for c in s]) + [None]
    sums = [sum(size(t) for _, t, s in rows if s == name) for name in sources]
    want = dict(zip(sources, zip(sums, level_of(sums))))
    assert any(t == 2 * n and n for n, t in want.values()) and any(0 < t < 2 * n for n, t in want.values())
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        name = "a" if r.doc_id is None else of[r.doc_id]
        assert (r.source_size, pytest.approx(r.target)) == want[name]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[name] += r.taken
        largest[name] = max(largest[name], r["size"])
    for name, (_, target) in want.items():
        assert abs(taken[name] - target) <= largest[name] + 1e-6
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = mixing.mix(docs.repartition(5), leaf=leaf, chunk=chunk).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))


def test_mix_is_fair(spark):
    """Over many seeds a document is taken about as often as its source's rate says, small and large ones alike."""
    docs = spark.createDataFrame([(k, "w " * (1 + 40 * (k % 2)), "a" if k < 200 else "b") for k in range(400)], "doc_id int, text string, source string")
    n, seeds = collections.Counter(), 4
    for seed in range(seeds):
        for r in mixing.mix(docs, seed=str(seed), leaf=4).collect():
            n[r.doc_id % 2, r.source_size, r.target] += r.copies
    for (_, size, target), copies in n.items():
        mean = copies / seeds / 100
        assert abs(mean - target / size) < 0.12


@given(st.integers(1, 9999), st.floats(0.001, 0.999), st.integers(1, 9999), st.floats(0.001, 0.999))
def test_pivot(w, p, v, q):
    """One is whole afterwards, words of probability stay, expectations stay."""
    (a1, b1), (a2, b2) = (mixing.pivot(w, p, v, q, u) for u in (0.0, 1 - 1e-16))
    for a, b in ((a1, b1), (a2, b2)):
        assert a in (0.0, 1.0) or b in (0.0, 1.0)
        assert -1e-9 <= a <= 1 + 1e-9 and -1e-9 <= b <= 1 + 1e-9
        assert a * w + b * v == pytest.approx(p * w + q * v)
    if a1 != a2:  # the odds of the two ways
        odds = (p - a2) / (a1 - a2)
        assert odds * b1 + (1 - odds) * b2 == pytest.approx(q, abs=1e-6)


def test_mix_odd(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).collect() == []
    blank = spark.createDataFrame([("1", None, None), ("2", "", 3)], "doc_id string, text string, source int")
    assert sorted(map(tuple, mixing.mix(blank).collect())) == [("1", 0, 0, 0.0, 0, 0), ("2", 0, 0, 0.0, 0, 0)]


def drawn(docs, target, longest, buckets, percent=10, least=20):
    """By the contract, in plain Python."""

    def feats(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return len(ws), [zlib.crc32(" ".join(ws[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]

    s, t = (collections.Counter(b for x in side for b in feats(x)[1]) for side in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, x in docs:
        n, fs = feats(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(map(gain, fs))
        rows.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    ranks = collections.defaultdict(list)
    for k, r in enumerate(fit):
        ranks[r[0]].append(k + 1 if k < percent * len(fit) // 100 else None)
    return collections.Counter((*r[:4], ranks[r[0]].pop(0) if r[4] >= least else None) for r in rows)


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (1, 7), (3, 500)])
def test_resample(spark, longest, buckets):
    rng = random.Random(buckets)
    words = ["Alpha", "beta", "ÉTÉ", "été", "日本", "x1", "it's", "naïve", "ZZ"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(300)]
    docs += [(301, None), (302, ""), (303, "..."), (None, "word " * 30), (5, docs[5][1]), (304, "long É, " * 5000), (305, "\u0000a\u007fb " * 20)]
    target = ["alpha BETA beta", None, "", "日本 " * 50]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, bucket int, row string")
    t = spark.createDataFrame([(x, k) for k, x in enumerate(target)], "text string, item_id int")
    got = importance.resample(d, t, longest=longest, buckets=buckets).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert collections.Counter(map(tuple, got)) == drawn(docs, target, longest, buckets)
    assert importance.resample(d.limit(0), t).collect() == []
    assert len(importance.resample(d, t.limit(0)).collect()) == len(docs)


def test_gains_are_bounded(spark):
    """A row a bucket, whatever the input; the sums of a document need no shuffle of its features."""
    d = spark.createDataFrame([(k, f"w{k} w{k + 1}") for k in range(500)], "doc_id long, text string")
    g = importance.gains(d, d.limit(3), buckets=50)
    assert sorted(r.bucket for r in g.collect()) == list(range(50))
