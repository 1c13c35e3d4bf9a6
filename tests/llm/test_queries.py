"""The queries end to end on small odd tables: columns, types, one row a document or page, nothing on empty ones."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from ledgerloom.llm.queries import QUERIES  # noqa: E402

PROSE = " ".join(f"word{k}" for k in range(60))
LINES = "\n".join(f"line {k} of {k * 7}" for k in range(9))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, PROSE), (5, PROSE), (5, PROSE), (6, PROSE + " end"), (7, LINES), (8, "x\n" + LINES), (None, PROSE), (None, None),
    (9, "long text, " * 20_000), (10, "日本 ñandú MIT License"), (11, "b0 " + " ".join(f"b{k}" for k in range(15))), (12, "\u0000 zero \uffff"),
]
PAGES = [(1, "http://a.ORG/x", "<p>"), (2, None, None), (3, "no scheme", ""), (4, "http://example.org/es/1", "q" * 50_000), (4, "http://example.org/es/1", "q"), (None, "http://x.com/de/", "r")]
#: Columns of each query that the contract names, or the operator.
COLUMNS = {
    "op1_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op2_warc_revisits": {"record_id": "bigint", "canonical_url": "string", "response_id": "bigint", "status": "string"},
    "op3_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op4_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op6_line_dedup": {"doc_id": "bigint", "n_deleted": "bigint"},
    "op7_substring_dedup": {"doc_id": "bigint", "n_removed": "bigint"},
    "op8_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op9_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_peak_concurrency": {"nation_id": "int", "from_s": "bigint", "to_s": "bigint", "n_open": "bigint", "open_cents": "bigint", "high_open": "bigint", "is_peak": "boolean"},
    "op12_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op13_importance": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


def tables(spark, folder, empty):
    cut = lambda df: df.limit(0) if empty else df
    clash = "text_sha256 string, key string, digest string, score string, n long, hit boolean"
    more = ("x", "x", "x", "x", 7, True)
    cut(spark.createDataFrame([(i, t, "en", "s", 1, *more) for i, t in TEXTS], f"doc_id long, text string, lang string, source string, n_chars long, {clash}")).write.parquet(f"{folder}/documents.parquet")
    cut(spark.createDataFrame([(*r, *more) for r in PAGES], f"page_id long, url string, html string, {clash}")).write.parquet(f"{folder}/pages.parquet")
    cut(spark.createDataFrame([("a", " ".join(f"B{k}" for k in range(14)), 0), (None, None, 1), ("c", "", 2)], "item_id string, text string, doc_id long")).write.parquet(f"{folder}/benchmark.parquet")
    sales = [(1, 1, 5.0, "2024-01-01 00:00:00.5"), (1, 1, 5.0, "2024-01-01 00:00:00.5"), (2, None, None, None), (None, 7, None, "2024-01-03 00:00:00"), (3, 2, 1e300, "1969-12-31 23:59:59")]
    lines = [(1, "2024-01-02 00:00:00"), (1, None), (3, "1960-01-01 00:00:00"), (None, None)]
    for name, rows, kinds, at in (("sales", sales, "sale_id long, client_id long, total double, at string", "sold_at"), ("sale_lines", lines, "sale_id long, at string", "shipped_at")):
        df = spark.createDataFrame([(*r, *more) for r in rows], f"{kinds}, {clash}").withColumn(at, F.col("at").cast("timestamp_ntz"))
        cut(df).write.parquet(f"{folder}/{name}.parquet")
    cut(spark.createDataFrame([(1, None, *more), (1, 4, *more), (2, 5, *more), (None, 6, *more)], f"client_id long, nation_id int, {clash}")).write.parquet(f"{folder}/clients.parquet")
    cut(spark.createDataFrame([(i, k % 2, "x") for k, (i, _) in enumerate(TEXTS)] + [(4, None, "x")], "doc_id long, toxic int, text string")).write.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module", params=[False, True], ids=["odd", "empty"])
def folder(spark, tmp_path_factory, request):
    path = str(tmp_path_factory.mktemp("tables"))
    tables(spark, path, request.param)
    return path, request.param


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, name):
    path, empty = folder
    df = QUERIES[name](spark, path)
    types = dict(df.dtypes)
    assert {c: types[c] for c in COLUMNS[name]} == COLUMNS[name]
    rows = df.collect()
    if empty:
        assert rows == []
    elif name in ("op6_line_dedup", "op7_substring_dedup", "op11_peak_concurrency"):
        assert rows
    else:
        assert len(rows) == (len(PAGES) if name in ("op1_url_filters", "op2_warc_revisits") else len(TEXTS))
        assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows if types.get("score") == "double")


def test_values(spark, folder):
    path, empty = folder
    if empty:
        return
    by = lambda name, key: {r[key]: r for r in QUERIES[name](spark, path).collect() if r[key] is not None}
    near = by("op3_minhash", "doc_id")
    assert {i: near[i].component_id for i in (1, 2, 4, 5, 6, 7, 8)} == {1: 1, 2: 2, 4: 4, 5: 4, 6: 4, 7: 7, 8: 7}
    exact = by("op9_exact_dedup", "doc_id")
    assert (exact[4].keep_id, exact[4].group_size, exact[4].kept, exact[5].kept) == (5, 4, False, True)
    assert (exact[1].keep_id, exact[1].group_size) == (2, 3)
    hit = by("op8_decontamination", "doc_id")
    assert (hit[11].n_hit, hit[11].n_items, hit[11].contaminated) == (14, 1, True) and not hit[4].contaminated
    scan = by("op5_license_scan", "doc_id")
    assert (scan[10].base_labels, scan[10].first_word, scan[1].first_word, scan[1].labels) == ("mit", 2, None, "")
    sales = sorted(tuple(r) for r in QUERIES["op11_peak_concurrency"](spark, path).collect() if r.nation_id in (4, -1))
    at, day = 1704067200, 86400
    assert sales == [(-1, at + 2 * day, None, 1, 0, 1, True), (4, at, at + 2 * day, 2, 1000, 2, True), (4, at + 2 * day, None, 0, 0, 2, False)]
    assert set(by("op6_line_dedup", "doc_id")) >= {8} and set(by("op7_substring_dedup", "doc_id")) >= {5, 6}
