"""Operators that compare documents: exact, near, line and substring deduplication, and revisits."""

import collections
import datetime
import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, exact_dedup, line_dedup, minhash, substring_dedup, warc
from ledgerloom.llm.components import connected_components

CLASH = "doc_id long, text string, keep_id long, len int, sha string, hit string, key string"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 0, 0, "x", "x", "x") for i, t in rows], CLASH).repartition(parts)


@pytest.mark.parametrize("bits, hot", [(1 << 22, 500), (64, 3)])
def test_exact(spark, monkeypatch, bits, hot):
    """Whether or not the bitmaps are crowded and groups are split."""
    monkeypatch.setattr(common, "BITS", bits)
    monkeypatch.setattr(common, "MOST_BITS", bits)
    monkeypatch.setattr(common, "HOT", hot)
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "x" * 300 + "1"), (7, "x" * 300 + "2"), (8, "x" * 300 + "1"), (None, "n"), (None, "n"), (9, "t"), (9, "t"), (10, "long " * 50_000)]
    rows += [(100 + k, "hot") for k in range(50)]
    out = exact_dedup.exact_groups(docs_of(spark, rows), digest_all=True).collect()
    by = collections.defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    want = collections.Counter()
    for own in by.values():
        keep = max(own, key=lambda i: -1 if i is None else i)
        want.update((i, keep, len(own), i == keep) for i in own)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == want
    assert {r.text_sha256 for r in out} == {hashlib.sha256(t.encode()).hexdigest() for t in by}
    some = exact_dedup.exact_groups(docs_of(spark, rows)).collect()
    assert {(r.doc_id, r.text_sha256 is None) for r in some} == {(i, len(own) == 1) for own in by.values() for i in own}
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in some) == want
    kept = exact_dedup.drop_exact_copies(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted(by)
    assert exact_dedup.exact_groups(docs_of(spark, rows).limit(0)).count() == 0


def brute_components(rows):
    sets, root = {}, {}
    for i, t in rows:
        w = (t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 85 * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE two"), (6, "a b c d e"), (7, "A b  c\nd e")]
    i = 10
    for n in (20, 60, 150, 300):
        base = [word() for _ in range(n)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(n)] = word()
            rows.append((i, " ".join(own)))
            i += 1
    rows += [(i + k, " ".join(word() for _ in range(rng.randrange(4, 80)))) for k in range(40)]
    rng.shuffle(rows)
    return rows


def test_minhash(spark):
    rows = near_rows()
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == want
    kept = minhash.drop_near_copies(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_layout():
    """Chances of a loss at the threshold, and the layout of op3_minhash."""
    assert minhash.layout(85) == (5, 25, 81)
    for percent in (50, 70, 80, 85, 90, 99):
        lay, t = minhash.layout(percent), percent / 100
        assert lay.n_hashes <= minhash.MOST_HASHES and (1 - t**lay.rows) ** lay.n_bands < 5e-7
        assert sum(math.comb(lay.n_hashes, k) * t**k * (1 - t) ** (lay.n_hashes - k) for k in range(lay.least)) <= 1e-8


def test_minhash_odd(spark):
    assert minhash.near_duplicates(docs_of(spark, []).limit(0)).count() == 0
    long = " ".join(str(k) for k in range(20_000))
    rows = [(None, long), (None, None), (5, "a b c d e f"), (5, "x y z u v w"), (9, "x y z u v w"), (2, "a b c d e f"), (30, long), (31, long + " end"), (None, "a b c d e f"), (40, ""), (None, "")]
    got = collections.Counter((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs_of(spark, rows)).collect())
    assert got == {(None, None): 4, (40, 40): 1, (5, 2): 2, (9, 2): 1, (2, 2): 1, (30, 30): 1, (31, 30): 1}


def test_dense_cells(monkeypatch, spark):
    monkeypatch.setattr(minhash, "CELL", 8)
    monkeypatch.setattr(minhash, "CHUNK", 4)
    monkeypatch.setattr(common, "HOT", 3)
    monkeypatch.setattr(common, "BITS", 128)
    monkeypatch.setattr(common, "MOST_BITS", 128)
    monkeypatch.setattr(common, "HOT_BITS", 128)
    rows = near_rows(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [500, 3])
def test_lines(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    rng = random.Random(3)
    rows = [(k, "\n".join(rng.choice("abcdef") for _ in range(rng.randrange(12)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "q\n\n r\ns"), (104, "q\nr\n\ns \nt"), (105, "z\n" * 30_000), (106, "solo"), (103, "q\n\n r\ns")]
    rows += [(110, "A\nB\nA\nB\nA\nB\nA")]
    seen, want = {}, {}
    for i, t in sorted(dict(rows).items()):
        lines = [x.strip() for x in (t or "").split("\n") if x.strip()]
        gone = set()
        for k in range(len(lines) - 2):
            at = seen.setdefault(tuple(lines[k : k + 3]), (i, k))
            if at != (i, k):
                gone.update(range(max(k, at[1] + 3) if at[0] == i else k, k + 3))
        if gone:
            want[i] = len(gone)
    got = {r.doc_id: r for r in line_dedup.without_repeats(docs_of(spark, rows)).collect()}
    assert {i: r.n_deleted for i, r in got.items()} == want
    assert got[104].text == "t" or got[104].text.strip() == "t"
    assert got[104].first_doc_ids == [103] and got[110].text == "A\nB\nA" and got[105].text.strip() == "z\nz\nz"
    assert line_dedup.without_repeats(docs_of(spark, rows).limit(0)).count() == 0


def test_long_lines(spark):
    """One or two lines count if they have 50 words together; shorter ones don't."""
    prose = lambda seed, n: " ".join(f"w{seed}x{k}" for k in range(n))
    one, a, b, short, tail = prose(1, 60), prose(2, 30), prose(3, 25), prose(4, 49), prose(5, 5)
    rows = [(1, f"{one}\n{tail}\nx1"), (2, f"x2\n{a}\n{b}"), (3, short), (4, one), (5, f"x5\n\n {a}\n{b} \nx6"), (6, f"{short}\nx7"), (7, f"x8\n{one}\n{tail}"), (8, f"{a}\nx9\n{b}"), (9, f"{prose(9, 50)}\nx10\n{prose(9, 50)}")]
    got = {r.doc_id: r for r in line_dedup.without_repeats(docs_of(spark, rows)).collect()}
    assert {i: (r.n_deleted, r.first_doc_ids) for i, r in got.items()} == {4: (1, [1]), 5: (2, [2]), 7: (2, [1]), 9: (1, [9])}
    assert got[4].text == "" and got[5].text.split() == ["x5", "x6"] and got[7].text == "x8" and got[9].text == f"{prose(9, 50)}\nx10"


def test_substrings(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passages = [prose(60) for _ in range(30)]
    rows = [(k, prose(80)) for k in range(40)]
    rows += [(100 + k, prose(rng.randrange(1, 30)) + " " + p + " " + prose(20)) for k, p in enumerate(passages)]
    rows += [(200 + k, prose(rng.randrange(1, 30)) + "; " + p + "." + prose(9)) for k, p in enumerate(passages)]
    rows += [(300, None), (301, ""), (302, "x"), (303, "ab " * 40_000), (304, "q ab " + "ab " * 30_000), (None, passages[0]), (200, "again")]
    got = {r.doc_id: r for r in substring_dedup.without_repeats(docs_of(spark, rows)).collect()}
    assert set(got) == {200 + k for k in range(30)} | {304}
    for k, p in enumerate(passages):
        assert got[200 + k].first_doc_ids == [100 + k] and got[200 + k].n_removed > len(p) / 3
    assert substring_dedup.repeated_spans(docs_of(spark, rows).limit(0)).count() == 0
    data = prose(500).encode()
    ends = substring_dedup.boundaries(data)
    assert ends[-1] == len(data) and (ends[1:] > ends[:-1]).all()


def test_substrings_within_a_document(spark):
    """A passage that only its own document repeats loses its later places, and the first one stays."""
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    p, q = prose(60), prose(60)
    rows = [(1, f"{prose(20)} {p} {prose(20)} {p} {prose(20)}"), (2, f"{q} {prose(9)} {q} {q}"), (3, prose(100)), (4, f"{p} {prose(20)} {q} {prose(20)}"), (5, "ab " * 9000), (6, None)]
    got = {r.doc_id: r for r in substring_dedup.without_repeats(docs_of(spark, rows)).collect()}
    assert {i: r.first_doc_ids for i, r in got.items()} == {1: [1], 2: [2], 4: [1, 2]}
    text = dict(rows)
    assert got[1].text.count(p.encode()) == 1 and got[1].text.startswith(text[1][: text[1].index(p) + len(p)].encode())
    assert got[2].text.startswith(q.encode()) and got[2].n_removed > len(q) and got[1].n_removed > len(p) / 2


def test_substrings_by_brute_force(spark, monkeypatch):
    """Bytes that go stand in MIN_RUN bytes that an earlier place has; passages of over 50 words that repeat are caught."""
    monkeypatch.setattr(common, "HOT", 4)
    rng = random.Random(11)
    syllables = ["th", "er", "ing", "an", "ou", "re", "st", "ed", "ión", "que", "de", "la"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, planted = [(k, prose(rng.randrange(5, 120))) for k in range(60)], []
    for k in range(40):
        p = prose(rng.randrange(51, 70))
        for i in (100 + k, 200 + k, 300 + k):
            rows.append((i, f"{prose(rng.randrange(20))} {p} {prose(rng.randrange(20))}"))
        planted += [200 + k, 300 + k]
    p = prose(55)
    rows += [(400, f"{p} {prose(9)} {p} {prose(3)} {p}"), (401, None), (402, "")]
    # a passage whose parts other documents have first, each in another one, then as a whole in two documents
    parts = [prose(9) for _ in range(7)]
    rows += [(500 + k, f"{prose(12)} {x} {prose(12)}") for k, x in enumerate(parts)] + [(600 + k, " ".join(parts)) for k in range(2)]
    text = {i: (t or "").encode() for i, t in rows}
    spans = {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in substring_dedup.repeated_spans(docs_of(spark, rows)).collect()}
    n = substring_dedup.MIN_RUN
    for i, own in spans.items():
        for a, z in own:
            held = [k for k in range(max(0, a - n), z - n + 1) if any(text[i][k : k + n] in text[j] for j in text if j < i) or text[i].find(text[i][k : k + n]) < k]
            covered = {x for k in held for x in range(k, k + n)}
            assert covered >= set(range(a, z)), (i, a, z)
    caught = [i for i in planted if sum(z - a for a, z in spans.get(i, [])) >= 100]
    assert len(caught) >= 0.95 * len(planted)
    assert len(spans[400]) == 2 and sum(z - a for a, z in spans[601]) > len(text[601]) / 2
    clean = {k for k in range(60)} | {100 + k for k in range(40)}
    assert not clean & set(spans)


def test_boundaries_in_slices(monkeypatch):
    rng = random.Random(8)
    data = bytes(rng.randrange(97, 123) for _ in range(5000))
    whole = substring_dedup.boundaries(data)
    monkeypatch.setattr(substring_dedup, "SLICE", 700)
    monkeypatch.setattr(substring_dedup, "LONG", 10_000)
    parts = substring_dedup.boundaries(data)
    monkeypatch.setattr(substring_dedup, "SLICE", 1 << 22)
    assert parts.tolist() == substring_dedup.boundaries(data).tolist()
    assert len(whole) > 50


def test_revisits(spark):
    t = lambda d, h=0: datetime.datetime(2025, 1, d, h)
    rows = [
        (1, "response", "http://www.A.org/x/?b=2&a=1#f", t(1), {"etag": '"1"', "content-length": "9", "date": "d1"}),
        (2, "response", "https://a.org:443/x?a=1&b=2", t(3), {"etag": '"2"', "content-length": "8", "date": "d2"}),
        (3, "revisit", "http://a.org/x?a=1&b=2&utm_source=q", t(2), {"etag": 'W/"1"', "date": "d3", "content-length": "0", "server": "s"}),
        (4, "revisit", "http://a.org/x?a=1&b=2", t(9), {"etag": '"1"'}),
        (5, "revisit", "http://a.org/x?a=1&b=2", t(3), {"etag": '"1"', "date": "d5"}),
        (6, "revisit", "http://b.org/", t(1), {"etag": '"1"'}),
        (7, "revisit", None, t(1), None), (8, "revisit", "http://a.org/x?a=1&b=2", None, {"etag": '"2"'}),
        (9, "revisit", "http://a.org/x?a=1&b=2", t(8), None),
        (10, "response", "http://c.org", t(1, 5), {"last-modified": "m"}), (11, "response", "http://c.org", t(1, 5), {"last-modified": "n"}),
        (12, "revisit", "http://c.org/", t(1, 6), {"last-modified": "n"}), (12, "revisit", "http://c.org/", t(1, 6), {"last-modified": "n"}),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "record_id long, kind string, url string, ts timestamp, headers map<string,string>, status string, day int")
    got = collections.Counter((r.record_id, r.response_id, r.status) for r in warc.resolve_revisits(df).collect())
    assert got == {
        (3, 1, "resolved"): 1, (4, 2, "changed"): 1, (5, 1, "resolved"): 1, (6, None, "no-response"): 1, (7, None, "no-response"): 1,
        (8, None, "no-response"): 1, (9, 2, "no-validator"): 1, (12, 11, "resolved"): 2,
    }
    h = {r.record_id: r.headers for r in warc.resolve_revisits(df).collect()}
    assert h[3] == {"etag": 'W/"1"', "date": "d3", "content-length": "9"} and h[4] is None
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_equal_responses(spark):
    """Responses that share id and time: the headers that sort last count, on the same day and later."""
    t = lambda d, h=0: datetime.datetime(2025, 1, d, h)
    rows = [(1, "response", "http://a.org", t(1), {"etag": x}) for x in ("b", "c", "a")] + [(2, "revisit", "http://a.org", t(1, 1), {"etag": "c"}), (3, "revisit", "http://a.org", t(2), {"etag": "c"})]
    rows += [(4, "response", "http://b.org", t(1), None), (5, "revisit", "http://b.org", t(2), {"etag": None})]
    df = spark.createDataFrame(rows * 2, "record_id long, kind string, url string, ts timestamp, headers map<string,string>")
    got = collections.Counter((r.record_id, r.response_id, r.status) for r in warc.resolve_revisits(df).collect())
    assert got == {(2, 1, "resolved"): 2, (3, 1, "resolved"): 2, (5, 4, "no-validator"): 2}


def test_header_case(spark):
    """Names of headers have no case; of names that are equal then, the last one counts."""
    rows = [
        (1, "response", "http://a.org", datetime.datetime(2025, 1, 1), {"ETag": '"1"', "Content-Length": "9", "Date": "d1", "Server": "s"}),
        (2, "revisit", "http://a.org", datetime.datetime(2025, 1, 2), {"ETAG": '"0"', "Date": "d2", "etag": 'W/"1"', "Vary": "x", "X-Own": "y"}),
        (3, "revisit", "http://a.org", datetime.datetime(2025, 1, 3), {"LAST-MODIFIED": "m"}),
    ]
    made = spark.createDataFrame([(*r[:4], json.dumps(r[4])) for r in rows], "record_id long, kind string, url string, ts timestamp, h string")
    df = made.withColumn("headers", F.from_json("h", "map<string,string>"))  # in order
    got = {r.record_id: (r.status, r.headers) for r in warc.resolve_revisits(df).collect()}
    assert got[2] == ("resolved", {"etag": 'W/"1"', "content-length": "9", "date": "d2", "server": "s", "vary": "x"})
    assert got[3] == ("no-validator", None)


def test_canonical_urls(spark):
    urls = {
        "http://www.A.org/x/?b=2&a=1#f": "a.org/x?a=1&b=2", "/A%7Eb": "/A~b", "h.org/%41%2f%zz%e9%": "h.org/A%2F%zz%E9%", "http://h.org/a/./b/../c": "h.org/a/c",
        "http://h.org/../../a": "h.org/a", "http://h.org/a/..": "h.org", "http://h.org/a%2E%2e/b": "h.org/a../b", "http://h.org/x/%2e%2E/b": "h.org/b", "http://h.org/..a/.b": "h.org/..a/.b",
        "http://h.org/?q=%61%26": "h.org?q=a%26", "": "", None: None,
    }
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "k int, u string")
    assert [r.c for r in df.select("k", warc.canonical_url("u").alias("c")).orderBy("k").collect()] == list(urls.values())


@pytest.mark.parametrize("hot", [500, 60, 20, 2])
def test_hot_minute(spark, monkeypatch, hot):
    """Days, minutes and seconds that hold many records of one url, against a plain as-of search."""
    monkeypatch.setattr(common, "HOT", hot)
    rng, start = random.Random(hot), datetime.datetime(2025, 1, 1, 23, 58)
    at = [start + datetime.timedelta(seconds=rng.choice([rng.randrange(40), 20, 61, rng.randrange(200_000)]), microseconds=rng.randrange(3)) for _ in range(600)]
    rows = [(k, rng.choice(["response", "revisit", "revisit"]), rng.choice(["http://h.org/", "http://h.org/", "http://k.org/"]), t, {"etag": "e"}) for k, t in enumerate(at)]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts timestamp, headers map<string,string>")
    want = {r[0]: max(((o[3], o[0]) for o in rows if o[1] == "response" and o[2] == r[2] and o[3] < r[3]), default=(None, None))[1] for r in rows if r[1] == "revisit"}
    assert {r.record_id: r.response_id for r in warc.resolve_revisits(df).collect()} == want


@pytest.mark.parametrize("hot", [500, 2])
def test_hot_url(spark, monkeypatch, hot):
    """One url with most records, over many days."""
    monkeypatch.setattr(common, "HOT", hot)
    base = spark.range(3000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 == 0, "response").otherwise("revisit").alias("kind"), F.lit("http://h.org/").alias("url"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 9000).alias("ts"))
    df = base.withColumn("headers", F.create_map(F.lit("etag"), F.lit("e")))
    assert {(r.record_id - r.response_id, r.status) for r in warc.resolve_revisits(df).collect()} == {(1, "resolved"), (2, "resolved")}


@pytest.mark.parametrize("kind", ["int", "short", "long"])
def test_ids_of_any_width(spark, kind):
    """Near, line and substring deduplication take integers of any width, and say so where ids are none."""
    text = "\n".join(f"line {k} of words that say {k * k} things about {k % 7} others" for k in range(12))
    docs = spark.createDataFrame([(1, text), (2, text + "\nmore"), (3, None), (None, text)], f"doc_id {kind}, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}[2] == 1
    assert [r.doc_id for r in line_dedup.without_repeats(docs).collect() if r.doc_id] and [r.doc_id for r in substring_dedup.without_repeats(docs).collect()] == [2]
    assert sorted(r.doc_id or 0 for r in minhash.drop_near_copies(docs).collect()) == [0, 1, 3]
    names = docs.select(F.col("doc_id").cast("string"), "text")
    for f in (minhash.near_duplicates, line_dedup.without_repeats, substring_dedup.without_repeats):
        with pytest.raises(TypeError, match="doc_id must be an integer"):
            f(names)
