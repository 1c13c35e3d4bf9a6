"""The format `sheets`: what is read, which parts of files are, and that failed writes leave the workbook as it was."""

import datetime
import io
import os
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import sheets
from ledgerloom.sources.workbook import Workbook
from tests.test_workbook import LEDGER, WANT, xlsb, xlsx

SCHEMA = "row_order bigint, FORMULARIO string, FECHA string, INDICA string, DETALLE string, DEBITO string"


@pytest.fixture(scope="module")
def sheet_spark(spark):
    sheets.register(spark)
    return spark


def whole(tables, **more):
    """With the list of types that all workbooks have, and other members."""
    out = io.BytesIO(xlsx(tables))
    with zipfile.ZipFile(out, "a") as z:
        z.writestr("[Content_Types].xml", '<x:Types xmlns:x="t"><x:Override PartName="/xl/calcChain.xml" ContentType="c"/></x:Types>'.replace("<x:Override", "<Override"))
        for name, text in more.items():
            z.writestr(f"xl/{name}.xml", text)
    return out.getvalue()


def cells(path, name):
    return list(Workbook(path.read_bytes()).rows(name))


@pytest.mark.parametrize("end, write", [("xlsx", xlsx), ("xlsb", xlsb)])
def test_read(sheet_spark, tmp_path, end, write):
    path = tmp_path / f"ledger.{end}"
    read = lambda **o: sheet_spark.read.format("sheets").options(headerRow=4, **o)
    assert read(sheet="COM").schema(SCHEMA).load(str(path)).count() == 0  # no file
    path.write_bytes(write({"note": [["FECHA"], ["x"], None, ["DETALLE"], ["y"]], "COM": LEDGER, "empty": []}))
    for options in ({"sheet": "COM"}, {}):  # by name, and by the columns that it has
        got = read(**options).schema(SCHEMA).load(str(path)).orderBy("row_order").collect()
        assert [r[0] for r in got] == [5, 7, 8] and got[0][4] == WANT[0][4] and got[2][1] is None
    assert read(sheet="gone").schema(SCHEMA).load(str(path)).count() == 0
    probed = read(sheet="COM").load(str(path))
    assert probed.columns == ["row_order", "FORMULARIO", "FECHA", "INDICA", "DETALLE", "DEBITO", "ignored"] and probed.where("ignored = 'y'").count() == 1
    with pytest.raises(Exception, match="read as strings"):
        read().schema("DEBITO double").load(str(path)).count()
    with pytest.raises(Exception, match="no header"):
        read(sheet="empty").load(str(path))


def test_sheets_are_chosen(sheet_spark, tmp_path):
    """A partition a sheet; those that aren't chosen aren't read, even one that can't be."""
    for k in (1, 2):
        path = tmp_path / f"b{k}.xlsx"
        path.write_bytes(xlsx({n: [["a", "b"], [f"{n}{k}", k]] for n in ("x", "y", "broken")}))
        with zipfile.ZipFile(path) as z:
            members = {i: z.read(i) for i in z.namelist()}
        members["xl/worksheets/s2.xml"] = b"<broken"
        with zipfile.ZipFile(path, "w") as z:
            for name, data in members.items():
                z.writestr(name, data)
    read = lambda name: sheet_spark.read.format("sheets").option("sheet", name).schema("a string, _sheet string, _file string").load(str(tmp_path))
    some = read("?")
    assert some.rdd.getNumPartitions() == 4 and sorted(r["a"] for r in some.collect()) == ["x1", "x2", "y1", "y2"]
    one = some.where((F.col("_sheet") == "y") & F.col("_file").endswith("b2.xlsx"))
    assert [tuple(r) for r in one.select("a", "_sheet").collect()] == [("y2", "y")]
    assert some.count() == 4  # also after the filtered one
    assert read("*").rdd.getNumPartitions() == 6
    with pytest.raises(Exception, match="ParseError"):
        read("*").count()


ROWS = [("p", 1, 1.5, Decimal("2.50"), True, "a<&\" b", datetime.date(2024, 1, 2)), ("p", 2, None, None, None, "", None), ("q", -3, float("nan"), None, False, "  x\u0001ñ가", None), (None, 10**18, 0.1, None, None, None, None)]
KIND = "version string, k bigint, f double, d decimal(10,2), b boolean, t string, day date"


def test_write(sheet_spark, tmp_path):
    path = tmp_path / "out.xlsx"
    path.write_bytes(whole({"p": [["old"], ["gone"]], "stays": [["s", "n"], ["text", 7]]}, calcChain="<c/>", styles="<s/>"))
    df = sheet_spark.createDataFrame(ROWS, KIND).repartition(3)
    df.write.format("sheets").mode("append").option("by", "version").save(str(path))
    assert list(Workbook(path.read_bytes()).sheets) == ["p", "stays", "none", "q"]
    with zipfile.ZipFile(path) as z:
        assert "xl/styles.xml" in z.namelist() and "xl/calcChain.xml" not in z.namelist() and len(z.namelist()) == len(set(z.namelist()))
        types = z.read("[Content_Types].xml").decode()
        assert "calcChain" not in types and types.count("<x:Override") == 2
    assert cells(path, "stays") == [(1, ["s", "n"]), (2, ["text", "7"])]
    assert cells(path, "p")[0] == (1, ["k", "f", "d", "b", "t", "day"]) and sorted(r[0] for _, r in cells(path, "p")[1:]) == ["1", "2"]
    assert cells(path, "q")[1][1] == ["-3", "nan", None, "False", "  x_x0001_ñ가", None]
    back = sheet_spark.read.format("sheets").option("sheet", "*").schema("k string, t string, _sheet string").load(str(path))
    assert {tuple(r) for r in back.where("_sheet IN ('p', 'q', 'none')").collect()} == {("1", "a<&\" b", "p"), ("2", "", "p"), ("-3", "  x_x0001_ñ가", "q"), (str(10**18), None, "none")}
    df.orderBy("k").write.format("sheets").mode("overwrite").option("sheet", "all").save(str(path))
    assert list(Workbook(path.read_bytes()).sheets) == ["all"] and [r[1] for _, r in cells(path, "all")[1:]] == ["-3", "1", "2", str(10**18)]
    df.limit(0).write.format("sheets").mode("append").option("sheet", "none yet").save(str(path))
    assert cells(path, "none yet") == [(1, ["version", "k", "f", "d", "b", "t", "day"])] and len(cells(path, "all")) == 5
    assert os.listdir(tmp_path) == ["out.xlsx"]


def test_failed_writes(sheet_spark, tmp_path, monkeypatch):
    """A task that fails, a lock, a bad name and too many rows: the old workbook stays, and nothing lies beside it."""
    path = tmp_path / "out.xlsx"
    path.write_bytes(old := whole({"p": [["old"], ["row"]]}))
    df = sheet_spark.range(100).repartition(4)
    write = lambda x, **o: x.write.format("sheets").mode("append").options(**{"sheet": "p", **o}).save(str(path))
    with pytest.raises(Exception, match="stop here"):
        write(df.select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop here"))).otherwise(F.col("id")).alias("id")))
    with pytest.raises(Exception, match="no name of a sheet"):
        write(df.withColumn("v", F.lit("a/b")), by="v")
    with pytest.raises(Exception, match="end in .xlsx"):
        df.write.format("sheets").mode("append").save(f"{tmp_path}/x.csv")
    (tmp_path / "~$out.xlsx").write_bytes(b"")
    with pytest.raises(Exception, match="open in another program"):
        write(df)
    os.rename(tmp_path / "~$out.xlsx", tmp_path / "free")
    with pytest.raises(Exception, match="would have 1048577 rows"):
        write(sheet_spark.range(sheets.MAX_ROWS).coalesce(4))
    assert path.read_bytes() == old
    path.write_bytes(b"no workbook")
    with pytest.raises(Exception, match="zip"):
        write(df)
    assert path.read_bytes() == b"no workbook"
    path.write_bytes(old)
    assert sorted(os.listdir(tmp_path)) == ["free", "out.xlsx"]
    write(df)
    assert len(cells(path, "p")) == 101
