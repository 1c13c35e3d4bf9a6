import collections

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from ledgerloom.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from tests.llm.test_dedup_ops import brute_components  # noqa: E402
from tests.llm.test_text_ops import brute_hits  # noqa: E402


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(ORACLE_SQL) == {"op1_url_filters", "op2_warc_revisits", "op8_decontamination", "op9_exact_dedup", "op11_peak_concurrency", "op13_importance"}


def test_stages(spark, tmp_path):
    """Each stage against brute force on its own input, over a small folder of tables."""
    item = " ".join(f"b{k}" for k in range(20))
    prose = lambda seed, n: " ".join(f"v{(seed * 7919 + k * k * 31 + k) % 997}" for k in range(n))
    rows = [(k, prose(k, 40 + k % 30), "en", "s", 1) for k in range(120)]
    rows += [(200 + k, prose(k, 40 + k % 30), "en", "s", 1) for k in range(10)]
    rows += [(300 + k, prose(k, 40 + k % 30) + " end", "en", "s", 1) for k in range(20, 30)]
    rows += [(400 + k, prose(k + 500, 30) + " idiot moron scum trash", "en", "s", 1) for k in range(60)]
    rows += [(500, prose(900, 30) + " " + item, "en", "s", 1), (501, None, None, None, None), (502, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(400 <= r[0] < 460)) for r in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id for r in docs.collect()}
        if name == "toxicity":
            want = {r[0] for r in before if not 400 <= r[0] < 460}
        elif name == "exact_dedup":
            last = collections.defaultdict(int)
            for r in before:
                last[r[1] or ""] = max(last[r[1] or ""], r[0])
            want = set(last.values())
        elif name == "near_dedup":
            want = {i for i, (_, c) in brute_components([r[:2] for r in before]).items() if i == c}
        else:
            hit = {r[0]: brute_hits(r[1], [("1", item)]) for r in before}
            want = {i for i, (n, h, _) in hit.items() if not (h and 20 * h >= n)}
        assert after == want, name
        kept[name] = after
    assert 500 in kept["near_dedup"] and 500 not in kept["decontamination"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept["decontamination"]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents(spark, tmp_path, empty):
    """Nulls in any column, repeated rows, clashing names, no rows: stages keep columns, and nothing clean is lost."""
    prose = lambda seed, n: " ".join(f"v{(seed * 7919 + k * k * 31 + k) % 997}" for k in range(n))
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, "x", 1), (None, prose(1, 40), "en", "s", 1, None, 1), (None, None, None, None, None, None, None)]
    rows += [(5, prose(2, 50), "en", "s", 1, "x", 1)] * 3 + [(6, prose(2, 50), "en", "s", 1, "x", 1), (7, prose(3, 30_000), "en", "s", 1, "x", 1), (8, prose(4, 50), None, None, None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, hit int")
    df = df.limit(0) if empty else df
    for name, schema in (("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert [i for i, _ in left] == ([] if empty else sorted([2, None, 6, 7, 8], key=str))
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(str(i) for i, _ in left)


def test_near_stage_at_80(spark, tmp_path):
    """The stage drops copies with a similarity from 0.8 on: 38 of 46 shingles are 0.826, 38 of 48 are 0.79."""
    words = [f"w{k}" for k in range(46)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:42], *"abcd"])), (3, " ".join(f"x{k}" for k in range(47))), (4, " ".join([*(f"x{k}" for k in range(42)), *"abcde"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()} == {1, 3, 4}
