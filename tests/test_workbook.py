"""Workbooks written here byte by byte, read from files by Spark and in memory."""

import io
import struct
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import types as T

from ledgerloom.sources import tabular
from ledgerloom.sources.workbook import Workbook, table_rows


def name_of(k):
    return chr(65 + k)


def xlsx(sheets):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        texts = []

        def cell(r, k, v):
            at = f'r="{name_of(k)}{r}"'
            if isinstance(v, bool):
                return f'<c {at} t="b"><v>{int(v)}</v></c>'
            if isinstance(v, (int, float)):
                return f"<c {at}><v>{v}</v></c>"
            if k % 2:
                return f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>'
            texts.append(v)
            return f'<c {at} t="s"><v>{len(texts) - 1}</v></c>'

        for k, rows in enumerate(sheets.values()):
            body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1) if row)
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{escape(t)}</t></si>" if len(t) % 2 else f"<si><r><t>{escape(t[:1])}</t></r><r><t>{escape(t[1:])}</t></r></si>" for t in texts) + "</sst>")
    return out.getvalue()


def record(kind, data):
    head = bytes([kind]) if kind < 128 else bytes([kind & 0x7F | 0x80, kind >> 7])
    n, size = len(data), b""
    while True:
        size += bytes([n & 0x7F | (0x80 if n > 127 else 0)])
        n >>= 7
        if not n:
            return head + size + data


def wide(t):
    return struct.pack("<I", len(t.encode("utf-16-le")) // 2) + t.encode("utf-16-le")


def xlsb(sheets):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.bin", b"".join(record(156, struct.pack("<II", 0, k) + wide(f"r{k}") + wide(n)) for k, n in enumerate(sheets)))
        z.writestr("xl/_rels/workbook.bin.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="/xl/worksheets/s{k}.bin"/>' for k in range(len(sheets))) + "</Relationships>")
        texts = []

        def cell(k, v):
            head = struct.pack("<II", k, 0)
            if isinstance(v, bool):
                return record(4, head + bytes([v]))
            if isinstance(v, int):
                return record(2, head + struct.pack("<i", v << 2 | 2))
            if isinstance(v, float) and round(v * 100) == v * 100 and k % 2:
                return record(2, head + struct.pack("<i", int(v * 100) << 2 | 3))
            if isinstance(v, float):
                return record(5, head + struct.pack("<d", v))
            if k % 2:
                return record(6, head + wide(v))
            texts.append(v)
            return record(7, head + struct.pack("<I", len(texts) - 1))

        for k, rows in enumerate(sheets.values()):
            body = b"".join(record(0, struct.pack("<I", r) + b"\0" * 13) + b"".join(cell(c, v) for c, v in enumerate(row) if v is not None) for r, row in enumerate(rows) if row)
            z.writestr(f"xl/worksheets/s{k}.bin", record(129, b"") + body + record(130, b""))
        z.writestr("xl/sharedStrings.bin", b"".join(record(19, b"\0" + wide(t)) for t in texts))
    return out.getvalue()


LEDGER = [["title"], None, ["x"], ["FORMULARIO", " FECHA ", "INDICA", "DETALLE", "DEBITO", "ignored"], [101, 45757, "IMP", "ACME TEXTILES SA # ñ & 1", 30449.84], [None, " ", None, None], ["102", 45988.0, "imp", "x" * 300, -7.5, "y"], [None, None, None, None, 1.25]]
WANT = [(5, "101", "45757", "IMP", "ACME TEXTILES SA # ñ & 1", "30449.84"), (7, "102", "45988", "imp", "x" * 300, "-7.5"), (8, None, None, None, None, "1.25")]
NAMES = ["row_order", "FORMULARIO", "FECHA", "INDICA", "DETALLE", "DEBITO"]


@pytest.mark.parametrize("write", [xlsx, xlsb])
def test_rows(write):
    data = write({"other": [["a"], [True]], "COM": LEDGER})
    assert [tuple(x if not isinstance(x, str) or k != 2 else x.removesuffix(".0") for k, x in enumerate(r)) for r in table_rows(data, NAMES, "COM", 4)] == WANT
    assert list(table_rows(data, ["a"])) == [("True",)] and list(table_rows(data, ["a"], "none")) == []
    assert list(table_rows(data, ["DEBITO"], "COM", 4, max_cols=2))[0] == (None,)
    assert list(Workbook(data).sheets) == ["other", "COM"]


def test_small_numbers():
    """Numbers of 30 bits: integers, hundredths, and the upper half of a double."""
    for value, want in ((struct.pack("<i", -5 << 2 | 2), "-5"), (struct.pack("<i", 1234 << 2 | 3), "12.34"), (struct.pack("<d", 1.5)[4:], "1.5"), (struct.pack("<d", -2.0)[4:], "-2")):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr("xl/workbook.bin", record(156, struct.pack("<II", 0, 0) + wide("r") + wide("s")))
            z.writestr("xl/_rels/workbook.bin.rels", '<Relationships><Relationship Id="r" Target="worksheets/s.bin"/></Relationships>')
            z.writestr("xl/worksheets/s.bin", record(0, struct.pack("<I", 0)) + record(2, struct.pack("<II", 0, 0) + value))
        assert list(Workbook(data.getvalue()).rows()) == [(1, [want])]


@pytest.mark.parametrize("end, write", [("xlsx", xlsx), ("xlsb", xlsb)])
def test_sheets(spark, tmp_path, end, write):
    schema = T.StructType([T.StructField("row_order", T.LongType()), *(T.StructField(n, T.StringType()) for n in NAMES[1:])])
    path = f"{tmp_path}/ledger.{end}"
    assert tabular.read_sheet(spark, path, schema, "COM", 4).count() == 0  # no file
    (tmp_path / f"ledger.{end}").write_bytes(write({"COM": LEDGER}))
    assert tabular.read_sheet(spark, path, schema, "COM", 4).orderBy("row_order").first()[4] == WANT[0][4]
    assert tabular.read_sheet(spark, path, schema, "gone", 4).count() == 0  # no sheet
    (tmp_path / f"broken.{end}").write_bytes(b"no workbook")
    with pytest.raises(Exception, match="zip"):
        tabular.read_sheet(spark, f"{tmp_path}/broken.{end}", schema).count()
