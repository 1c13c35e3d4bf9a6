"""The similarity join against every pair."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import normalize_text
from ledgerloom.operators import argmax, fuzzy

SYLLABLES = ["ac", "me", "tex", "ti", "les", "ban", "co", "de", "la", "re", "pu", "bli", "ca", "sur", "nor", "te", "ña", "é", "x", "an"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))


def changed(rng, text):
    """A text with a few letters, blanks or words changed, or its words in another order."""
    for _ in range(rng.randrange(4)):
        k = rng.randrange(len(text) + 1)
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + rng.choice("abcx ") + text[k:], text[:k] + "q" + text[k + 1 :], " ".join(rng.sample(text.split(), len(text.split()))), text + " " + word(rng)])
    return text


def corpus(seed, n):
    rng = random.Random(seed)
    words = [word(rng) for _ in range(60)]
    choices = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(n)]
    names = [changed(rng, rng.choice(choices)) for _ in range(n)] + [" ".join(rng.choice(words) for _ in range(3)) for _ in range(n // 4)]
    return [*names, "", " ", "a", "ab", "x" * 300], [*choices, "a", "abc", "", "x" * 290 + "y", "x" * 50]


@pytest.mark.parametrize("seed, threshold, rounded", [(1, 85, False), (2, 90, True), (3, 82, False), (4, 100, False), (5, 60, False)])
def test_same_rows(spark, seed, threshold, rounded):
    names, choices = corpus(seed, 150)
    n = spark.createDataFrame([(x,) for x in [*names, None, names[0]]], "name string")
    m = spark.createDataFrame([(x, k) for k, x in enumerate([*choices, choices[3], None])], "choice string, choice_order long")
    want = argmax.best_fuzzy(n, m, normalize_text, rounded=rounded).where(F.col("score") >= threshold)
    got = fuzzy.fuzzy_matches(n, m, threshold, normalize_text, rounded, few=0)
    assert got.columns == ["name", "choice", "score"]
    want = sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20
    assert fuzzy.fuzzy_matches(n.limit(0), m, threshold, few=0).count() == 0 and fuzzy.fuzzy_matches(n, m.limit(0), threshold, few=0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_no_pair_is_lost(spark, seed):
    """Every pair of normalised texts that reaches the threshold is a candidate."""
    names, choices = corpus(10 + seed, 120)
    clean = lambda xs: sorted({" ".join(x.split()) for x in xs if x.strip()})
    x, y = clean(names), clean(choices)
    table = lambda t: spark.createDataFrame([(v,) for v in t], "norm string")
    found = {tuple(r) for r in fuzzy.candidates(table(x), table(y), 0.85).collect()}
    want = {(a, b) for a in x for b in y if argmax.token_set(a, b) >= 0.85}
    assert want <= found and want


def test_pairs_grow_with_matches(spark):
    """Five times the names and choices make about five times the pairs that are scored, where names x choices is 25."""
    n = {}
    for size in (100, 500):
        rng = random.Random(size)
        choices = [" ".join("".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.randrange(4, 9))) for _ in range(3)) for _ in range(size)]
        names = [changed(rng, c) for c in choices]
        table = lambda t: spark.createDataFrame([(" ".join(v.split()),) for v in set(t)], "norm string")
        n[size] = fuzzy.candidates(table(names), table(choices), 0.85).count()
    assert n[100] < 300 and n[500] < 8 * n[100]


def test_join_query_equals_its_sql(spark, tmp_path):
    """Letters of several bytes that are left out: SQL's levenshtein() counts bytes, so these pairs don't count."""
    import duckdb

    from ledgerloom.plans import queries

    names = ["Vini Nilokoor", "Ornihamren Méma", "Méma Ornihamren", "Anna Strömberg", "Jola Strxmberg", "Jola Méma", "Jola Mima", "Jola Ström", "Ström Jolas", "Maanni Guhamguham"]
    spark.createDataFrame(list(enumerate(names)), "client_id long, name string").write.parquet(str(tmp_path / "clients.parquet"))
    got = queries.QUERIES["e_fuzzy_join"](spark, str(tmp_path)).collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW clients AS SELECT * FROM '{tmp_path}/clients.parquet/*.parquet'")
        want = db.execute(queries.ORACLE_SQL["e_fuzzy_join"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and "ornihamren mma" not in {r["name"] for r in got}


@pytest.mark.parametrize("seed, threshold, rounded", [(6, 85, False), (7, 97, True)])
def test_names_with_a_near_choice_are_held_against_near_ones_alone(spark, tmp_path, monkeypatch, seed, threshold, rounded):
    """The rows are those of all pairs; names whose best choice is near don't take part in the search for less alike ones."""
    from ledgerloom.plans.views import stash

    names, choices = corpus(seed, 80)
    n, m = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x, k) for k, x in enumerate(choices)], "choice string, choice_order long")
    want = argmax.best_fuzzy(n, m, normalize_text, rounded=rounded).where(F.col("score") >= threshold).collect()
    asked, near = [], fuzzy.near
    monkeypatch.setattr(fuzzy, "near", lambda a, b, least: asked.append((a.count(), least)) or near(a, b, least))
    got = fuzzy.fuzzy_matches(n, m, threshold, normalize_text, rounded, few=0, stash=stash(spark))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    far = {" ".join(x.upper().split()) for x in names if x.strip()}
    assert [k for k, _ in asked][0] <= len(far) and len(asked) == (1 if threshold >= fuzzy.NEAR else 2)
    if len(asked) == 2:
        done = {r["name"] for r in want if r["score"] >= fuzzy.NEAR}
        assert len(done) > 20 and asked[1][0] <= asked[0][0] - len({r["choice"] for r in want if r["score"] >= fuzzy.NEAR}) // 2
