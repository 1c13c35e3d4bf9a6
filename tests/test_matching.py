import datetime
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.text import meaningful_tokens, text_key, tokens
from ledgerloom.operators import argmax, cascade, records
from ledgerloom.operators.tokens import match_pairs, peel, positional_match, positional_pairs, tokens_match

PAIRS = [
    ("acme textiles", "pago acme textiles", True), ("textiles acme", "acme textiles", True), ("acme textiles norte", "acme textiles", True),
    ("acme textiles sa de cv", "acme textiles", False), ("acme acme", "acme", True), ("acme sa", "acme textiles", True),
    ("co ltd", "co ltd x", True), ("comisión", "comisi x", False), ("", "anything", False),
]


def test_tokens_match(spark):
    df = spark.createDataFrame(PAIRS, "s string, d string, y boolean")
    rows = df.select("s", "y", tokens_match(meaningful_tokens("s"), F.array_distinct(tokens("d"))).alias("x")).collect()
    assert [(r.s, r.x) for r in rows] == [(r.s, r.y) for r in rows]


CASES = [
    ([(1, "acme textiles #1", 40.0, "101")], "101", "single"),
    ([(1, "acme textiles", 40.0, "101"), (2, "acme textiles", 100.03, "102")], "102", "multi_exact"),
    ([(1, "acme textiles", 40.0, "101"), (2, "acme textiles", 60.0, "102")], "101-102", "multi_sum"),
    ([(1, "acme textiles", 40.0, "101"), (2, "acme textiles", 50.0, "102")], None, "multi_fail"),
    ([(1, "other firm", 100.0, "103")], "103", "amount_fallback"),
    ([(1, "other firm", 100.0, "103"), (2, "other firm", 100.0, "104")], None, "none"),
    ([(1, "acme textiles", 100.0, "101"), (2, "acme textiles", 100.0, "102")], None, "multi_fail"),
    ([(1, "acme textiles", 40.0, "")], None, "none"),
    ([(1, "acme textiles", 40.0, "None"), (2, "acme textiles", 60.0, "102")], "None-102", "multi_sum"),
    ([], None, "no_day"),
    ([(1, "acme textiles", 100.0, ""), (2, "acme textiles", 100.0, "102")], None, "multi_fail"),
    ([(1, "acme textiles", 100.0, ""), (2, "acme textiles", 0.0, "102")], "102", "multi_sum"),
    ([(1, "acme textiles", 40.0, ""), (2, "acme textiles", 60.0, "nan")], None, "multi_blank"),
    ([(1, "other firm", 100.0, "")], None, "none"),
]


@pytest.mark.parametrize("shuffled", [False, True])
def test_cascade(spark, shuffled):
    """Each case on a day of its own; unrelated days and the order of the ledger change nothing."""
    msgs = [(k, f"2025-05-{k + 1:02d}", "acme textiles", 100.0) for k in range(len(CASES))] + [(99, None, "acme textiles", 100.0)]
    msgs += [(0, "2025-05-01", "acme textiles", 100.0), (None, "2025-05-03", "acme textiles", 100.0), (98, "2025-05-03", "acme textiles", None)]
    rows = [(f"2025-05-{k + 1:02d}", d, m, f, o) for k, (own, _, _) in enumerate(CASES) for o, d, m, f in own]
    rows += [("2024-01-01", "acme textiles", 100.0, "9", 9), (None, "acme textiles", 100.0, "9", 9)]
    m = spark.createDataFrame(msgs, "id int, day string, nombre_clean string, amount double").withColumn("fecha_key", F.to_date("day"))
    led = spark.createDataFrame(rows[::-1] if shuffled else rows, "day string, det string, monto double, formulario string, row_order long")
    led = led.withColumn("fecha_key", F.to_date("day")).withColumn("detalle_clean", text_key(F.split_part("det", F.lit("#"), F.lit(1))))
    got = {r.id: (r.formulario, r.rule) for r in cascade.reconcile(m, led).collect()}
    assert [got[k] for k in range(len(CASES))] == [(f, r) for _, f, r in CASES]
    assert got[99] == (None, "no_day") and got[None] == got[2] and got[98] == (None, "multi_fail")
    assert cascade.reconcile(m, led).where("id = 0 AND rule = 'single'").count() == 2  # ids may repeat


def plain_best(names, registry, ratio=0.6):
    """E7 by its definition: every name against every registry row."""
    split, out = lambda t: re.findall("[a-z0-9]+", t.lower()), {}
    for name in names:
        st, best = split(name), None
        for nombre, llave, order in registry:
            od = split(nombre)
            both = sum(t in od for t in st)
            share = both / max(len(st), len(od), 1)
            if len(st) >= 2 and st[0] in od and st[1] in od and both >= 2 and share >= ratio and (best is None or (share, -order) > best[:2]):
                best = (share, -order, llave)
        if best:
            out[name] = (best[0], best[2])
    return out


def plain_sums(names, details):
    """E13 by its definition: rows, sum and last form of the details that a name matches, on its day."""
    out = {}
    for day, src in names:
        hit = []
        for d, words, n, total, one in details:
            both = sum(t in words for t in src)
            enough = len(src) == 1 or (src[1] in words and both >= 2 and both / len(src) >= 0.6)
            if d == day and src[0] in words and enough:
                hit.append((n, total, one))
        if hit:
            out[day, tuple(src)] = (sum(h[0] for h in hit), sum(h[1] or 0 for h in hit), max(h[2] for h in hit))
    return out


def phrase(rng, words, most=7):
    return [rng.choice(words) for _ in range(rng.randrange(1, most))]


@pytest.mark.parametrize("seed", range(4))
def test_best_and_sums_by_definition(spark, seed):
    """Few words, so that names repeat them, share them and miss them."""
    rng = random.Random(seed)
    words = ["banco", "banco", "de", "la", "sur", "norte", *[f"c{k}" for k in range(4 + 20 * seed)]]
    reg = [(" ".join(phrase(rng, words)), f"K{k}", k) for k in range(150)]
    names = [" ".join(phrase(rng, [*words, "lost"])) for _ in range(150)] + ["", "Banco  de BANCO"]
    r = spark.createDataFrame(reg, "nombre string, llave string, od_order int")
    got = argmax.best_by_tokens(spark.createDataFrame([(n,) for n in names + names[:9]], "name string"), r)
    assert {x.name: (x.ratio, x.llave) for x in got.collect()} == plain_best(names, reg)
    days = [datetime.date(2025, 1, 1), datetime.date(2025, 1, 2)]
    asked = sorted({(rng.choice(days), tuple(phrase(rng, words))) for _ in range(150)})
    details = [(rng.choice(days), sorted(set(phrase(rng, words, 9))), rng.randrange(1, 4), rng.choice([None, k / 4]), (k, f"F{k}")) for k in range(150)]
    d = spark.createDataFrame(details, "fecha_key date, words array<string>, n long, total double, one struct<row_order:int,formulario:string>")
    sums = cascade.detail_sums(spark.createDataFrame([(a, list(b)) for a, b in asked], "fecha_key date, src array<string>"), d)
    assert {(x.fecha_key, tuple(x.src)): (x.n, x.total, tuple(x.one)) for x in sums.collect()} == plain_sums(asked, details)


@pytest.mark.parametrize("shape", ["firm n{} bank", "banco de c{}", "banco de la republica c{}", "c{} banco de la", "banco c{} de"])
def test_few_candidates(spark, shape):
    """Words that all names share make no pairs, first words or others: as many rows are looked at as there are names."""
    n = 400
    text = [shape.format(k) for k in range(n)]
    reg = [(t, f"K{k}", k) for k, t in enumerate(text)]
    names, r = spark.createDataFrame([(t,) for t in text], "name string"), spark.createDataFrame(reg, "nombre string, llave string, od_order int")
    index = r.withColumn("od", tokens("nombre")).select("llave", "od_order", "od", F.explode("od").alias("word"))
    asked = peel(names.select(tokens("name").alias("src")), index)
    assert argmax.token_candidates(asked, index).count() + argmax.pair_candidates(asked, index).count() <= 4 * n
    assert {x.name: (x.ratio, x.llave) for x in argmax.best_by_tokens(names, r).collect()} == plain_best(text, reg)
    words = names.select(F.lit(datetime.date(2025, 1, 1)).alias("fecha_key"), tokens("name").alias("src"))
    details = words.select("fecha_key", F.col("src").alias("words"), F.lit(1).alias("n"), F.lit(2.0).alias("total"), F.struct(F.lit(1).alias("o"), F.lit("F").alias("f")).alias("one"))
    index = details.withColumn("word", F.explode("words"))
    assert cascade.detail_candidates(peel(words, index, ["fecha_key"]).where((F.size("tail") == 0) | (F.col("c") < F.col("need"))), index).count() <= 4 * n
    got = {tuple(x.src): x.n for x in cascade.detail_sums(words, details).collect()}
    split = [t.split() for t in text]
    assert got == {tuple(a): sum(a[0] in b and a[1] in b and sum(t in b for t in a) >= max(2, 0.6 * len(a)) for b in split) for a in split}


@pytest.mark.parametrize("n, least", [(2, 2), (1, 1), (3, 2), (2, 1)])
def test_pairs_by_definition(spark, n, least):
    """The joins against the predicates on all pairs."""
    rng = random.Random(n * 7 + least)
    words = ["banco", "banco", "de", "la", "sur", *[f"c{k}" for k in range(9)]]
    some = lambda p: spark.createDataFrame([(f"{p}{k}", phrase(rng, words, 5)) for k in range(80)] + [(f"{p}x", [])], "k string, w array<string>")
    a, b = some("a").toDF("source", "st"), some("b").toDF("detail", "dt")
    every, st, dt = a.hint("broadcast").join(b, F.lit(True)), F.col("st"), F.col("dt")
    rows = lambda df: sorted((r.source, r.detail) for r in df.collect())
    assert rows(match_pairs(a, b, least=least)) == rows(every.where(tokens_match(st, dt, least=least)))
    assert rows(positional_pairs(a, b, n, least)) == rows(every.where(positional_match(st, dt, n, least)))


def test_no_tolerance(spark):
    """A tolerance of 0 takes equal amounts alone."""
    day = datetime.date(2025, 5, 1)
    msgs = spark.createDataFrame([("a", day, "otro", 5.0), ("b", day, "otro", 5.01), ("c", day, "acme sur", 7.0)], "id string, fecha_key date, nombre_clean string, amount double")
    rows = [(day, "acme sur", 7.0, "F1", 1), (day, "acme sur", 7.01, "F2", 2), (day, "x", 5.0, "F3", 3)]
    ledger = spark.createDataFrame(rows, "fecha_key date, detalle_clean string, monto double, formulario string, row_order long")
    got = {r.id: (r.rule, r.formulario) for r in cascade.reconcile(msgs, ledger, tolerance=0).collect()}
    assert got == {"a": ("amount_fallback", "F3"), "b": ("none", None), "c": ("multi_exact", "F1")}


def test_nothing_stays_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    msgs = spark.createDataFrame([("a", None, "x", 1.0)], "id string, fecha_key date, nombre_clean string, amount double")
    ledger = spark.createDataFrame([], "fecha_key date, detalle_clean string, monto double, formulario string, row_order long")
    assert cascade.reconcile(msgs, ledger).count() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_last_wins(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "id string, Formulario string")
    found = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "z", 3)], "id string, formulario string, o int")
    assert sorted(r.Formulario for r in cascade.last_wins(df, found, "o").collect()) == ["3", "y", "y"]


def test_token_argmax(spark):
    reg = spark.createDataFrame([("acme textiles testus33xxx", "A", 1), ("acme textiles sur testus33xxx", "B", 2), ("beta uno norte sur", "C", 3)], "nombre string, llave string, od_order int")
    names = spark.createDataFrame([("acme textiles norte testus33xxx",), ("acme",), ("beta uno",)], "name string")
    best = argmax.best_by_tokens(names, reg)
    assert {r.name: (r.ratio, r.llave) for r in best.collect()} == {"acme textiles norte testus33xxx": (0.75, "A")}
    df = spark.createDataFrame([("acme textiles norte testus33xxx", ""), ("acme textiles norte testus33xxx", "OLD"), ("q", None)], "`Nombre personalizado` string, Llave string")
    assert sorted(str(r.Llave) for r in argmax.fill_keys(df, best).collect()) == ["A", "None", "OLD"]


def test_unmatched_names(spark):
    """Names without a key that match nothing, once each; neither those that match nor those that have a key."""
    reg = spark.createDataFrame([("acme textiles testus33xxx", "A", 1)], "nombre string, llave string, od_order int")
    rows = [(9, "Otra  Firma", None), (3, "otra firma", " "), (1, "acme textiles testus33xxx", None), (2, "Nadie Mas", "OLD"), (7, "acme", ""), (8, None, "")]
    df = spark.createDataFrame(rows, "id int, `Nombre personalizado` string, Llave string")
    best = argmax.best_by_tokens(df.select(F.col("Nombre personalizado").alias("name")), reg)
    assert {(r.name, r.first) for r in argmax.unmatched_names(df, best, "id").collect()} == {("otra firma", 3), ("acme", 7), ("", 8)}


def test_fuzzy(spark):
    assert argmax.token_set_ratio("acme textiles", "textiles acme norte") == 100
    assert argmax.token_set_ratio("abc", "xyz") == 0
    assert argmax._common("kitten", "sitting") == 4
    master = spark.createDataFrame([("ACME TEXTILES", 1), ("ACME TEXTILE", 2), ("OTRA", 3)], "choice string, choice_order long")
    names = spark.createDataFrame([("Acme Textiles Ltd",), ("Otraa",), (" ",), (None,)], "name string")
    for size in (1 << 20, 10):  # one block, many blocks
        got = {r.name: (r.choice, r.score) for r in argmax.best_fuzzy(names, master, block_bytes=size, names_per_cell=1).collect()}
        assert got == {"Acme Textiles Ltd": ("ACME TEXTILES", 100), "Otraa": ("OTRA", 88)}
    df = spark.createDataFrame([("Otraa",), ("zzz",)], "Proveedor string")
    assert sorted(r[0] for r in argmax.enrich_names(df, argmax.best_fuzzy(names, master)).collect()) == ["OTRA", "zzz"]


def reference_ratio(a, b):
    """The definition, by plain edit distances of insertions and deletions on the three joined texts."""

    def ratio(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, last = [i], row
            for j, d in enumerate(y, 1):
                row.append(last[j - 1] if c == d else 1 + min(last[j], row[j - 1]))
        return 1 - row[-1] / (len(x) + len(y)) if x or y else 1.0

    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0
    i = " ".join(sorted(x & y))
    p, q = (" ".join(filter(None, [i, " ".join(sorted(s))])) for s in (x - y, y - x))
    if i and (p == i or q == i):
        return 1.0
    return max([ratio(p, q)] + ([ratio(i, p), ratio(i, q)] if i else []))


WORDS = st.lists(st.sampled_from(["acme", "acm", "textil", "textiles", "sa", "norte", "n", "xyz"]), max_size=5).map(" ".join)


@given(WORDS, WORDS)
def test_token_set_by_definition(a, b):
    assert abs(argmax.token_set(a, b) - reference_ratio(a, b)) < 1e-9


@given(WORDS, st.lists(WORDS, max_size=8), st.booleans())
def test_bounds_lose_nothing(name, norms, rounded):
    norms = [n for n in dict.fromkeys(norms) if n]
    score = lambda n: round(100 * argmax.token_set(name, n)) if rounded else argmax.token_set_ratio(name, n)
    want = max(((score(n), -k) for k, n in enumerate(norms)), default=None)
    if name:
        assert argmax.Choices(norms, rounded).best(name) == (want and (want[0], -want[1]))


def test_match_names(spark):
    master = spark.createDataFrame([("Ácme Textiles", 1), ("ACME", 2), ("xyz", 3)], "choice string, choice_order long")
    names = spark.createDataFrame([("acme  textiles",), ("qqqq",), ("acmee",), (None,)], "name string")
    assert {tuple(r) for r in argmax.match_names(names, master).collect()} == {("acme  textiles", "Ácme Textiles", 100), ("acmee", "ACME", 89)}
    assert argmax.match_names(names, master.limit(0)).count() == 0


@given(st.text("abcd", max_size=12), st.text("abcd", max_size=12))
def test_common_subsequence(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert argmax._common(a, b) == rows[-1][-1]


def test_registry_update(spark):
    msgs = spark.createDataFrame([(1, "101-None-102", "K1"), (2, "102", "K2"), (3, "104", " ")], "row_order int, Formulario string, Llave string")
    rows = spark.createDataFrame([("101", None), ("102", "OLD"), ("103", ""), ("00101", ""), ("101.0", "K1")], "Consecutivo string, `Llave Origen Destino` string")
    got = {r.Consecutivo: (r[1], r.cambio) for r in records.update_registry(rows, records.number_keys(msgs)).select("Consecutivo", "`Llave Origen Destino`", "cambio").collect()}
    assert got == {"101": ("K1", "nuevo"), "102": ("K1", "actualizado"), "103": ("", "sin_match"), "00101": ("K1", "nuevo"), "101.0": ("K1", "igual")}


def test_merge_and_history(spark):
    old = spark.createDataFrame([("a", "Completo"), (None, "Completo")], "id string, Estado string")
    new = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x"), (None, "x")], "id string, Estado string")
    merged = records.merge_new(old, new)
    assert sorted(str(r.id) for r in merged.collect()) == ["None", "a", "b", "b"]
    assert records.merge_new(merged, new).count() == 4
    h = records.accumulate(old, new, "V1")
    assert records.accumulate(h, new, "V1").count() == h.count() == 4


def test_template(spark):
    rows = [("p", "ACME TESTUS33XXX", "Completo"), ("p", "acme testus33xxx", "Completo"), ("p", "acme testus33xxx", "Completo"), ("p", "x", "Incompleto")]
    df = spark.createDataFrame(rows, "Proveedor string, `Nombre personalizado` string, Estado string")
    known = spark.createDataFrame([(" ACME TESTUS33XXX ",), ("",)], "n string")
    assert [r[1] for r in records.template_rows(df, known).collect()] == ["acme testus33xxx"]


def test_completeness(spark):
    df = spark.createDataFrame([("r", None, "1", "p"), ("r", "d", "1", "nan")], "Receiver string, Date string, Amount string, Proveedor string")
    got = [tuple(r) for r in df.select(*[records.is_complete(p) for p in ("truthy", "filled", "exact", "no_date", "lower")]).collect()]
    assert got == [(False, False, False, True, False), (True, True, False, False, False)]


def test_manifest(spark):
    m = spark.createDataFrame([("1", "Completo"), ("2", "Error"), ("3", None)], "content_md5 string, estado string")
    files = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "content_md5 string")
    assert sorted(r[0] for r in records.pending(files, m).collect()) == ["2", "3", "4"]
    marked = records.mark(m, spark.createDataFrame([("2", "Completo")], "content_md5 string, estado string"))
    assert sorted(r[0] for r in records.pending(files, marked).collect()) == ["3", "4"]
    assert records.unmark(marked, "1").count() == 2


def test_words_that_many_rows_have(spark, monkeypatch):
    """Words that many rows have and no name asks for don't meet names in one task; the rows are the same."""
    registry = spark.createDataFrame([(f"Firm Customer {k} BANK", f"K{k}", k) for k in range(12)], "nombre string, llave string, od_order long")
    names = spark.createDataFrame([(f"Customer {k} Firm BANK",) for k in range(6)], "name string")
    want = sorted(map(tuple, argmax.best_by_tokens(names, registry).collect()))
    monkeypatch.setattr("ledgerloom.operators.tokens.HOT", 5)
    assert sorted(map(tuple, argmax.best_by_tokens(names, registry).collect())) == want and len(want) == 6
    index = spark.createDataFrame([("firm",)] * 6 + [("customer",)] * 6 + [("1",)], "word string")
    asked = spark.createDataFrame([("1",), ("customer",)], "word string")
    assert {r.word for r in argmax.asked_words(asked, index).collect()} == {"customer", "1"}


def test_rows_that_nobody_asks_for_do_not_move(spark, tmp_path, monkeypatch):
    """Where tables are written, rows meet amounts and lists only if a message may ask for them; the rules are the same."""
    from ledgerloom.plans.views import stash

    rng = random.Random(5)
    day = lambda k: datetime.date(2025, 5, 1 + k % 20)
    firms = [f"firma {w} c{k}" for k, w in enumerate(["sur", "norte", "este", "oeste"] * 10)]
    rows = [(day(k), rng.choice([*firms, "quite another"]), float(rng.randrange(100, 100_000)), rng.choice(["", f"F{k}", f"F{k}", None]), k) for k in range(6000)]
    mine = {}
    for d, n, amount, _, _ in rows:
        mine.setdefault((d, n), []).append(amount)
    some = [(k, d, n, rng.choice([sum(a), a[0], a[-1] + 0.03, 5.0])) for k, ((d, n), a) in enumerate(sorted(mine.items())) if k % 9 == 0]
    some += [(1000, day(1), "unknown firm", rows[1][2]), (1001, day(1), "unknown firm", None), (1002, None, "firma sur c0", 5.0)]
    m = spark.createDataFrame(some, "id int, fecha_key date, nombre_clean string, amount double")
    led = spark.createDataFrame(rows, "fecha_key date, detalle_clean string, monto double, formulario string, row_order long")
    moved, among = [], cascade.among

    def counted(df, keys, on, n):
        out = among(df, keys, on, n)
        assert df.join(keys.select(*on).distinct(), on, "left_semi").select(*out.columns).exceptAll(out).count() == 0
        moved.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(cascade, "among", counted)
    got = sorted(map(str, cascade.reconcile(m, led, stash=stash(spark)).collect()))
    assert got == sorted(map(str, cascade.reconcile(m, led).collect())) and len({r.split("rule=")[1].split(",")[0] for r in got}) > 3
    assert len(moved) == 4 and all(after < before / 2 for before, after in moved), moved


def test_among_loses_nothing_when_bits_are_few(spark, monkeypatch):
    """More keys than bits: other rows stay, but none that is asked for is lost, and empty keys leave no row."""
    from ledgerloom.operators import tokens

    df = spark.range(3000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("w"))
    keys = df.where("k % 3 = 0")
    assert keys.exceptAll(tokens.among(df, keys, ["k", "w"], 1000)).count() == 0
    assert tokens.among(df, keys, ["k", "w"], 1000).count() < 1300 and tokens.among(df, keys.limit(0), ["k", "w"], 0).count() == 0
    monkeypatch.setattr(tokens, "LEAST_BITS", 1 << 8)
    monkeypatch.setattr(tokens, "MOST_BITS", 1 << 8)
    assert keys.exceptAll(tokens.among(df, keys, ["k", "w"], 1000)).count() == 0
