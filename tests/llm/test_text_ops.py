"""Operators without joins of documents: url filters, BPE, licences, decontamination, toxicity."""

import base64
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, common, fm_index, license_scan, toxicity, url_filter

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH, SPLIT = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: Nulls, blanks, a long text, repeats, and columns whose names clash with those that the operators make.
CLASH = "doc_id long, text string, ids string, score double, spans string, items string, key string"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1.0, "x", "x", "x") for i, t in rows], CLASH)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "word"), (5, "word"), (None, "null id"), (7, "long " * 30_000), (8, "日本 ñandú   x y")]


def test_urls(spark):
    urls = {
        "http://a.ORG/x": ("a.org", "/x", "org/", "allow"),
        "http://example.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "https://m.example.org/en/123?q#f": ("m.example.org", "/en/123", "example.org/en/1", "block"),
        "http://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"),
        "http://xcom/fr/": ("xcom", "/fr/", None, "allow"),
        "http://x.com/de/a": ("x.com", "/de/a", "com/de/", "block"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://adult-x.net/": ("adult-x.net", "/", None, "block"),
        "http://a.net/b/casino": ("a.net", "/b/casino", None, "block"),
        "http://archive.net/web/http://example.org/es/a": ("archive.net", "/web/http://example.org/es/a", None, "allow"),
        "http://a.net/x://org/": ("a.net", "/x://org/", None, "allow"),
        "https://t.net/go/https://foo.com/de/x": ("t.net", "/go/https://foo.com/de/x", None, "allow"),
        "http://r.net/?u=http://example.org/es/": ("r.net", "/", None, "allow"),
        "http://org/x://b.com/de/": ("org", "/x://b.com/de/", "org/", "allow"),
        "://://org/": (":", "//org/", None, "allow"),
        "http://a.net/b/casino\n": ("a.net", "/b/casino\n", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://x.com/" + "a" * 100_000: ("x.com", "/" + "a" * 100_000, None, "allow"),
    }
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    out = url_filter.judge_urls(df, url_filter.RULES)
    got = {r.page_id: (r.host, r.path, r.rule if r.base else None, r.verdict) for r in out.collect()}
    assert [got[k] for k in range(len(urls))] == list(urls.values())
    assert url_filter.judge_urls(df.limit(0), url_filter.RULES).count() == 0
    again = url_filter.judge_urls(df.union(df), url_filter.RULES, block_bytes=100)  # many blocks, and rows that repeat
    both = [(r.page_id, r.host, r.path, r.rule if r.base else None, r.verdict) for r in again.collect()]
    assert sorted(both, key=str) == sorted([(k, *v) for k, v in got.items()] * 2, key=str)
    index = url_filter.RuleIndex(url_filter.RULES, {"example": 100, "org": 5, "es": 50, "en": 1})
    assert {t for t, rules in index.by_token.items() for r, _ in rules if r.name.startswith("example.org/e")} == {"org", "en"}


def judged(url):
    """The contract in plain Python: host, path, and the rule of the base rules."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [("org", "/"), ("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/fr/"), ("com", "/de/")]
    fits = [h + p for h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_random_urls():
    """Urls of parts that may stand anywhere, other urls among them."""
    rng = random.Random(1)
    parts = ["http", "://", ":", "/", "/", "//", "?", "#", ".", "org", "example.org", "EXAMPLE.ORG", "com", "example", "/es/", "/en/1", "/fr/", "/de/", "es", "x", "-", "@", "é", "İ", "%2F", "\n", " ", "u=", ":80"]
    index = url_filter.RuleIndex(url_filter.BASE_RULES, {})
    held = 0
    for k in range(10_000):
        url = rng.choice(["http://", "", "http://example.org", "s://a.com"]) + "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        host, path, rule = index.best(url)
        assert (host, path, rule and rule.name) == judged(url), url
        held += rule is not None
    assert held > 500


def tiktoken_encoding():
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library():
    e, rng = tiktoken_encoding(), random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\xa0", "a", "'s", "'ll", "1", "²", "ñ", ".", "!!", " ", "日本", "  \n", " the", "don't", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(15)))
        ids = e.encode_ordinary(text)
        packed = bpe.encode_text(text, PATH, SPLIT)
        assert packed == struct.pack(f"<{len(ids)}I", *ids), repr(text)
        assert bpe.decode_ids(packed, PATH) == text.encode()


@pytest.mark.parametrize("units, pairs, block, long", [(300_000, 1 << 19, 1 << 21, 1000), (3, 16, 40, 6)])
def test_bpe_of_many(monkeypatch, units, pairs, block, long):
    """Whatever the sizes of caches and blocks, in whatever order texts come."""
    for name, value in (("CACHE_UNITS", units), ("CACHE_PAIRS", pairs), ("BLOCK_CHARS", block), ("LONG", long)):
        monkeypatch.setattr(bpe, name, value)
    bpe._forget()
    e, rng = tiktoken_encoding(), random.Random(4)
    syllables = ["th", "er", "ing", "ción", "ß", "ou", "ä", "x", "e", "tion", "日", "st"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", "", ".", ",", ".\n", "?", "\n\n", "3"])
    texts = [" ".join(word() for _ in range(rng.randrange(60))) for _ in range(300)] + ["", " ", "\n", " a", "a ", "q" * 500, "ab" * 400 + " x\ny", "x\n y"]
    for _ in range(2):
        want = [struct.pack(f"<{len(ids)}I", *ids) for ids in map(e.encode_ordinary, texts)]
        assert bpe.encode_texts(texts, PATH, SPLIT) == want
        rng.shuffle(texts)
    bpe._forget()


def test_prefix_table():
    v, rng = bpe.vocabulary(PATH), random.Random(5)
    for _ in range(150):
        data = "".join(rng.choice(["th", "er", "ing", "é", " ", "x", "1"]) for _ in range(90)).encode()
        t = bpe.PrefixTable(v, data[:40])
        t.append(data[40:])
        assert t.ids() == v.encode(data)
        a = rng.randrange(len(data))
        b, new = rng.randrange(a, len(data)), b"tion"
        t.replace(a, b, new)
        assert t.ids() == v.encode(data[:a] + new + data[b:]) and len(t.last) == len(t.data)
    assert all(v.encode(v.tokens[k]) == [k] for k in range(0, len(v.tokens), 37))


def test_bpe_frames(spark):
    e = tiktoken_encoding()
    df = docs_of(spark, ODD)
    out = bpe.decode(bpe.encode(df, PATH, SPLIT), PATH)
    assert out.columns == [*[c for c in df.columns if c != "ids"], "ids", "decoded"]
    for r in out.collect():
        ids = e.encode_ordinary(r["text"] or "")
        assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.token_digests(df.limit(0), PATH, SPLIT).count() == 0


def phrases(words):
    base = [(p.encode().split(), label) for p, label in license_scan.BASE]
    return [(i, label) for p, label in base for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def test_licences(spark):
    rng = random.Random(1)
    vocab = "mit license apache general public gnu the under licensed x".split()
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["Released under the MIT License.", "licensed under CC-BY-NC 4.0", "MIT\nLICENSE mit license", "xmit license", license_scan.TEMPLATES[0][0] + " the end"]
    s = license_scan.scanner()
    for t in texts:
        words = WORD.findall(t.encode().translate(common.FOLD))
        n, base, _ = s.scan(t.encode())
        assert n == len(words) and sorted((i, s.labels[k]) for k, i in base) == sorted(phrases(words))
    got = s.scan(("the mit " + license_scan.TEMPLATES[0][0].replace("restriction", "limits") + " x").encode())[2]
    assert any(s.labels[t] == "mit" and c > 0.9 for t, _, _, c in got)
    rows = license_scan.scan_licenses(docs_of(spark, ODD)).collect()
    assert sorted(r.n_words for r in rows)[:3] == [0, 0, 0] and all(not r.base for r in rows)
    assert license_scan.scan_licenses(docs_of(spark, ODD).limit(0)).count() == 0


def naive_pieces(words, s, templates):
    """Longest runs of template words that end at each word, where the next word doesn't make them longer."""
    own = [license_scan.split_words(t) for t, _ in templates]
    held = {}
    for t, w in enumerate(own):
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                held.setdefault(tuple(w[i:j]), []).append((t, i))
    longest = [0]
    for i in range(1, len(words) + 1):
        longest.append(next(n for n in range(longest[-1] + 1, -1, -1) if not n or tuple(words[i - n : i]) in held))
    longest.append(-1)
    out = set()
    for i, n in enumerate(longest[:-1]):
        if n >= license_scan.LEAST_WORDS and longest[i + 1] != n + 1:
            out |= {(i - n, i, t + s.n_base, at) for t, at in held[tuple(words[i - n : i])]}
    return out


def naive_chain(pieces, sizes):
    """Each piece follows, of all chains of its template that end just before it in text and template, the one with most
    words, the first begun on ties; all chains are looked at for each piece."""
    chains = []
    for a, b, t, at in sorted(set(pieces), key=lambda p: (p[2], p[0], p[1], p[3])):
        before = [c for c in chains if c[-1][2] == t and 0 <= a - c[-1][1] <= license_scan.MOST_GAP and 0 <= at - c[-1][3] - (c[-1][1] - c[-1][0]) <= license_scan.MOST_GAP]
        size = lambda c: sum(x[1] - x[0] for x in c)
        if before:
            max(before, key=size).append((a, b, t, at))
        else:
            chains.append([(a, b, t, at)])
    return sorted((c[0][2], c[0][0], c[-1][1], sum(x[1] - x[0] for x in c) / sizes[c[0][2]]) for c in chains)


@pytest.mark.parametrize("seed", range(20))
def test_licence_chains_by_brute_force(seed):
    """Pieces anywhere, that overlap, repeat, touch, and are just too far apart."""
    rng = random.Random(seed)
    s = license_scan.Scanner((("x y", "x"),), (("a b c d e f g h i j k l", "p"), ("a b c q r s t u v w", "q")))
    for _ in range(60):
        pieces = []
        for _ in range(rng.randrange(25)):
            a, n = rng.randrange(40 + 3 * seed), rng.randrange(3, 7)
            pieces.append((a, a + n, 1 + rng.randrange(2), rng.choice([rng.randrange(9), max(0, a - 20), a % 12])))
        assert s.chain(pieces) == naive_chain(pieces, s.sizes)


def test_licence_pieces_by_brute_force():
    base, rng = (("a b", "ab"), ("c", "c")), random.Random(2)
    templates = [(" ".join(rng.choice("abcde") for _ in range(rng.randrange(3, 25))), f"t{k}") for k in range(6)]
    s = license_scan.Scanner(base, templates)
    for _ in range(200):
        words = [rng.choice("abcdefg") for _ in range(rng.randrange(40))]
        if rng.random() < 0.7:
            t = rng.choice(templates)[0].split()
            i = rng.randrange(len(t))
            words += t[i : i + rng.randrange(20)] + [rng.choice("xab")]
        n, _, pieces = s.match(" ".join(words).encode())
        assert n == len(words) and set(pieces) == naive_pieces([w.encode() for w in words], s, [*base, *templates][len(base) :]), words
        for t, a, z, cover in s.scan(" ".join(words).encode())[2]:
            assert 0 <= a < z <= n and round(cover * s.sizes[t]) <= z - a


def test_licence_parts():
    """Whole paragraphs and statements have their labels, whatever stands around them."""
    s = license_scan.scanner()
    for k, (text, label) in enumerate(license_scan.TEMPLATES):
        n, _, spans = s.scan(f"x y {text.upper()} z".encode())
        assert any(s.labels[t] == label and c == 1 and a >= 2 for t, a, _, c in spans), text
    warranty = license_scan.TEMPLATES[2][0]
    assert "mit" in {s.labels[t] for t, _, _, c in s.scan(warranty.encode())[2] if c >= license_scan.LEAST_COVER}


def test_long_licence_text(monkeypatch):
    monkeypatch.setattr(fm_index, "SLICE", 7)
    assert license_scan.scanner().scan(b"a mit license, a mit x apache license")[:2] == (8, [(0, 1), (1, 6)])


def brute_hits(text, items):
    words = WORD.findall((text or "").encode().translate(common.FOLD))
    hit, found = set(), set()
    for name, item in items:
        own = WORD.findall((item or "").encode().translate(common.FOLD))
        for k in range(max(1, len(own) - 12) if own else 0):
            w = own[k : k + 13]
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(name or "")
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard, piece, block", [(1 << 19, 4 << 20, 1 << 20), (40, 50, 200)])
def test_decontamination(spark, monkeypatch, shard, piece, block):
    monkeypatch.setattr(fm_index, "SHARD_SYMBOLS", shard)
    monkeypatch.setattr(fm_index, "SLICE", piece)
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(6)]
    items = [(str(k), " ".join(rng.choice(vocab) for _ in range(n))) for k, n in enumerate([20, 13, 14, 5, 30])] + [("7", None), (None, "w0 W1"), ("8", ""), ("9", "w1 w1 w1")]
    texts = ["x " * rng.randrange(9) + " ".join(rng.choice([*vocab, "zz"]) for _ in range(rng.randrange(80))) for _ in range(25)]
    texts += [f"Zz, {items[0][1].upper()} - {items[4][1]}", None, "", items[3][1]]
    found = list(fm_index.find([(t or "").encode() for t in texts], fm_index.Phrases([(n or "", (t or "").encode()) for n, t in items])))
    for t, (n, spans, names) in zip(texts, found):
        assert (n, sum(b - a for a, b in spans), sorted(names)) == brute_hits(t, items)
    if block < 1000:
        return
    df = docs_of(spark, list(enumerate(texts)))
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id string, text string, doc_id string")
    for size in (block, 60):
        for r in fm_index.contamination(df, bench, size).collect():
            assert (r.n_words, sum(s.stop - s.start for s in r.spans), r["items"]) == brute_hits(texts[r.doc_id], items)
    kept = {r.doc_id for r in fm_index.drop_contaminated(df, bench).collect()}
    want = {k for k, t in enumerate(texts) if not (lambda n, h, _: h and 20 * h >= n)(*brute_hits(t, items))}
    assert kept == want and fm_index.drop_contaminated(df, bench).columns == df.columns
    assert fm_index.contamination(df.limit(0), bench).count() == 0
    assert all(not r.spans for r in fm_index.contamination(df, bench.limit(0)).collect())


def test_fm_index():
    rng = np.random.default_rng(1)
    for n, sigma in ((1, 3), (50, 3), (400, 5), (300, 70_000)):
        s = np.append(rng.integers(1, sigma, n), 0).astype(np.int32)
        sa = fm_index.suffix_array(s)
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())
        index = fm_index.FmIndex(s, sigma, 4)
        assert index.locate(np.arange(n + 1)).tolist() == sa.tolist()


def test_toxicity(spark):
    rng = random.Random(4)
    clean = "the sun over green hills and quiet rivers runs slowly to sea".split()
    bad = ["idiot", "moron", "scum"]
    rows = []
    for k in range(600):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 60))]
        if k % 4 == 0:
            words += [rng.choice(bad) for _ in range(3)]
            rng.shuffle(words)
        rows.append((k, " ".join(words)))
    df = docs_of(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0), "l") for k in range(600)] + [(0, None, "l"), (None, 1, "l"), (4, 1, "l")], "doc_id long, toxic int, text string")
    model = toxicity.train(df, labels)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    held = {r.doc_id for r in df.where(toxicity.held_out()).select("doc_id").collect()}
    assert len(held) > 60 and all((got[k] >= 0.5) == (k % 4 == 0) for k in held)
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and {r.doc_id % 4 for r in kept.select("doc_id").collect()} == {1, 2, 3}
    odd = toxicity.score(docs_of(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    none = toxicity.train(df, labels.limit(0))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.5}
    for some in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        assert toxicity.drop_toxic(df, some).count() == df.count()  # nothing to learn from
    assert toxicity.score(df.limit(0), model).count() == 0


def naive_grams(text):
    """Hashed n-grams of characters, one at a time."""
    chars = [ord(c) + 32 if "A" <= c <= "Z" else ord(c) for c in text]
    out = []
    for n in toxicity.ORDERS:
        for i in range(len(chars) - n + 1):
            h = chars[i]
            for k in range(1, n):
                h = (h * 0x01000193 + chars[i + k] + k + 1) % 2**32
            out.append((((h ^ (h >> 15)) * 0x9E3779B1) % 2**32) >> (32 - toxicity.BITS))
    return out


def test_toxicity_by_plain_numpy(spark):
    """Features, ratios, selection and weights against a dense version with plain gradient steps."""
    rng = random.Random(9)
    words = "el sol über ñandú 日本 hills Rivers slowly the sea moron scum".split()
    rows = [(k, " ".join(rng.choice(words[: 12 if k % 3 == 0 else 10]) for _ in range(rng.randrange(4, 25)))) for k in range(200)]
    for _, t in rows[:20]:
        assert toxicity.gram_ids(t.encode()).tolist() == naive_grams(t)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs_of(spark, rows), labels, n_features=300)
    held = {r.doc_id for r in docs_of(spark, rows).where(toxicity.held_out()).select("doc_id").collect()}
    own = [(set(naive_grams(t)), k % 3 == 0) for k, t in rows if k not in held]
    pos, neg = sum(y for _, y in own), sum(not y for _, y in own)
    n = {g: [0, 0] for s, _ in own for g in s}
    for s, y in own:
        for g in s:
            n[g][y] += 1
    z, ratio = {}, {}
    for g, (a, b) in n.items():
        if a + b >= toxicity.MIN_DOCS:
            p, q = (b + 1) / (pos + 2), (a + 1) / (neg + 2)
            ratio[g], z[g] = np.log(p / q), abs(p - q) / np.sqrt(p * (1 - p) / pos + q * (1 - q) / neg + 1e-12)
    best = sorted(z, key=lambda g: (-round(z[g], 9), g))[:300]
    assert len(set(best) & set(model.grams.tolist())) >= 0.98 * len(best)  # equal scores at the end may be cut either way
    grams = model.grams.tolist()
    x = np.array([[ratio[g] if g in s else 0.0 for g in grams] for s, _ in own])
    y, w, b = np.array([y for _, y in own], float), np.zeros(len(grams)), 0.0
    step = 4 * len(y) / np.linalg.norm(np.c_[x, np.ones(len(y))], 2) ** 2

    def loss(w, b):
        v = x @ w + b
        return np.mean(np.logaddexp(0, v) - y * v) + toxicity.L2 / 2 * (w @ w)

    for _ in range(4000):
        g = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w, b = w - step * (x.T @ g + toxicity.L2 * w), b - step * g.sum()
    fitted = model.weights / np.array([ratio[g] for g in grams])
    assert loss(fitted, model.bias) < loss(w, b) + 0.02 < loss(0 * w, 0.0) / 2


def test_fit_in_parts():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 30, 200)
    cols, ratio, y = rng.integers(0, 40, sizes.sum()).astype(np.int16), rng.normal(size=40), rng.integers(0, 2, 200).astype(float)
    bias, w = toxicity._fit(y, np.cumsum(sizes), cols, ratio)
    assert np.isfinite(bias) and np.isfinite(w).all()
