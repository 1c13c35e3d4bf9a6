import datetime
import time
import unicodedata
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import dates, ids, money, text
from ledgerloom.schema import conform, require_columns, sentinel_to_null
from tests.conftest import one

D = datetime.date


@pytest.mark.parametrize(
    "f, cases",
    [
        (money.clean_amount, {"1,234.56": "1234.56", "1.234,56": "1234.56", "1234": "1234.00", "USD 1 234,56": "1234.56", "1.234.567": "1234567.00", "1,234,567": "1234567.00", "1,234,567.89": "1234567.89", "1.234.567,89": "1234567.89", "1.234": "1.23", "1,234": "1.23", "-50.00": "50.00", "1.2,3,4": None, ".": None, None: None}),
        (money.parse_money, {"1.234,56": 1234.56, "1234.56": 1234.56, "1,234.56": 1.23456, "1,234,567": None, "1.234.567": None, "-50,5": -50.5, "12.": 12.0, "-": None}),
        (money.mail_amount, {"#8.800,#": "8800.00", "#6.752,99#": "6752.99", "21687.04": "21687.04", "1.234.567,89": "1234567.89", "1,234.56": "123456.00"}),
        (money.fix_open_decimals, {"26.550,": "26.550,00", "30.449,84": "30.449,84"}),
        (money.fix_decimals, {"7297.3": "7297.30", "7297.": "7297.00", "7297": "7297.00", "7,297.35": "7,297.35"}),
        (ids.bank_code, {"testus33": "TESTUS33XXX", "TESTUS33XXX": "TESTUS33XXX", "ABC": None}),
        (ids.shorten_name, {"ALPHA BETA GAMMA DELTA EPSILON ZETA ETA THETA TESTUS33XXX": "ALPHA BETA GAMMA DELTA EPSILON ZETA TESTUS33XXX", "X" * 60: "X" * 60}),
        (ids.form_text, {"12030.0": "12030", "007": "7", "": "0", None: "", "None": "None"}),
        (ids.form_numbers, {"12030-None-12028": ["12030", "12028"], "A012-": ["12"], "000": ["0"], None: []}),
        (dates.ledger_date, {"45748": D(2025, 4, 1), "13/02/2025": D(2025, 2, 13), "": None}),
        (dates.scanned_date, {"10 APR 2O25": D(2025, 4, 10), "5 PEB 2025": D(2025, 2, 5), "3-SEPT-2025": D(2025, 9, 3), "31 FEB 2025": None, "1O APR 2025": None}),
        (dates.mail_date, {"08 Oct 2025": "2025-10-08", "08/10/2025": "2025-10-08", "soon": "soon", "nan": None}),
        (dates.file_date, {"05112025 2.pdf": D(2025, 11, 5), "5112025 2.pdf": None}),
        (dates.folder_month, {"11 noviembre": 11, "SETIEMBRE": 9, "x": None}),
        (lambda c: dates.folder_day(c, F.lit(2025)), {"26 NOVIEMBRE": D(2025, 11, 26), "31 FEBRERO": None}),
        (dates.is_date, {"20250410": True, "10APR2025": True, "04/13/2025": True, "13/13/2025": False, "x": False}),
        (text.tokens, {"Comisión ACME-Co 12": ["comisi", "n", "acme", "co", "12"], None: []}),
        (text.meaningful_tokens, {"Comisión ACME-Co 12": ["comisi", "n", "acme", "12"], "Co Ltd": ["co", "ltd"]}),
        (text.clean_detail, {"ACME Textiles #123": "acme textiles"}),
        (text.clean_file_name, {"11487 11453 ACME Textiles.PDF": "acme textiles", "05112025 2.pdf": "2"}),
        (text.normalize_name, {"Ácme Textiles Ltd. China": "ACME TEXTILES", "ACME S.A.S.": "ACME S A S", "CHINA": "CHINA"}),
        (text.company_forms, {"ACME SAS": "ACME S.A.S.", "ACME S.A.S.TESTUS33XXX": "ACME S.A.S. TESTUS33XXX", "ACME S A": "ACME S.A.", "SABLE": "SABLE"}),
        (text.normalize_text, {" \u00a0Ñandú\t x ": "NANDU X", None: ""}),
        (text.text_key, {"Groß  \u00a0Comisión ": "gross comisión"}),
        (sentinel_to_null, {" nan ": None, "NaT": None, "x ": "x"}),
    ],
)
def test_cases(spark, f, cases):
    assert one(spark, f, list(cases)) == list(cases.values())


def test_display_name(spark):
    assert one(spark, lambda c: ids.display_name(c, F.lit("TESTUS33")), ["ACME", "nan", None]) == ["ACME TESTUS33", "TESTUS33", "TESTUS33"]


def test_amount_close(spark):
    df = spark.createDataFrame([(100.0, 100.03), (8.05, 8.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(money.amount_close(F.col("a"), F.col("b"))).collect()] == [True, False, False]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), min_size=1, max_size=20))
def test_properties(spark, xs):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x string")
    got = df.select("k", "x", ids.uuid5("x").alias("u"), text.text_key("x").alias("a"), text.text_key(text.text_key("x")).alias("b"), ids.shorten_name("x").alias("s")).orderBy("k").collect()
    for x, r in zip(xs, got):
        assert r["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, x))
        assert r["a"] == r["b"]
        assert len(r["s"]) <= max(50, len(x))


def test_schema(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert conform(df, ["b", "a"]).columns == ["b", "a", "z"]
    with pytest.raises(ValueError):
        require_columns(df, ["q"])


def test_folding(spark):
    """B1 and B3, on every character that is assigned, by the definitions in the standard library."""
    texts = ["Ñandú Ǟ ệ Ά Й", "e\u0301\u0327", "ﬁ ½", "日本 가각", None, ""]
    assert one(spark, text.fold, texts) == ["Nandu A e Α И", "e", "fi 1⁄2", "日本 \u1100\u1161\u1100\u1161\u11a8", None, ""]
    assert one(spark, text.text_key, ["Straße ΣΑΣ ŉ ﬃ İ", None, "  "]) == ["strasse σασ ʼn ffi i̇", "", ""]
    assert one(spark, text.normalize_text, [" ﬁ  x", None]) == ["FI X", ""]
    # letters of a later Unicode than the standard library's are lower-cased by Spark
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    blocks = ["".join(every[k : k + 256]) for k in range(0, len(every), 256)]
    bare = ["".join(k for k in unicodedata.normalize("NFKD", x) if not unicodedata.combining(k)) for x in blocks]
    assert one(spark, text.fold, blocks) == bare and one(spark, text.case_fold, blocks) == [x.casefold() for x in blocks]
    plan = spark.range(1).select(text.fold(F.lit("x")), text.text_key(F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_folding_of_joined_letters_anywhere(spark):
    """Joined letters beside ASCII, accents, Hangul and letters that stay, at both ends and by themselves, in long texts."""
    some = [*text._JOINED[::7], *text._CASED_JOINED, "가", "힣", "é", "日", "a", "ab c", "\x7f", "\x80", "𝒜", "🄐", "\ue000"]
    texts = [x + y + x for x in some for y in ("", "a", "é", "日", "각ﬁ", " long " * 900)]
    assert one(spark, text.fold, texts) == [text._bare(x) for x in texts]
    assert one(spark, text.case_fold, texts) == [x.casefold() for x in texts]


def test_folding_takes_as_long_for_all_letters(spark):
    """Ligatures, which are late in the table of joined letters, take no longer than fractions, which are early in it."""

    def seconds(letter):
        df = spark.range(40, numPartitions=1).select(F.repeat(F.lit(letter), 5000 + F.col("id").cast("int")).alias("x")).localCheckpoint()
        took = []
        for _ in range(4):
            began = time.perf_counter()
            df.select(F.sum(F.length(text.fold("x")))).collect()
            took.append(time.perf_counter() - began)
        return min(took[1:])

    assert seconds("ﬁ") < 3 * seconds("½")


def test_unicode_forms_equal_their_sql(spark, tmp_path):
    """Blank texts keep the blank before what stands behind them, also where only marks are left, and null ones are null."""
    import duckdb

    from ledgerloom.plans import queries

    texts = ["", " ", "\n", "\t \r\n", " ", "　", None, "́", "a", " a ", "a\n", "ss", "fi", "ssfi km", " Straße\t", "ẍ", "Office  km ß", "sss ffi fl fi"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["b_unicode_forms"](spark, str(tmp_path)).collect()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = db.execute(queries.ORACLE_SQL["b_unicode_forms"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
