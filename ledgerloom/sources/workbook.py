"""Workbooks as rows of text: .xlsx (XML) and .xlsb (binary records), both zip files, read with the standard library.

Numbers, dates among them, come as the text of their stored value; empty cells are None. A workbook is one file of a
bounded size (its format has 1,048,576 rows a sheet at most), so it is read in one task; many are read by many.
"""

from __future__ import annotations

import io
import posixpath
import struct
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

Row = list[str | None]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


class Workbook:
    """Sheets by name, in order; rows(name) yields (number of the row from 1, its cells)."""

    def __init__(self, data: bytes | IO[bytes]):
        self.zip = zipfile.ZipFile(io.BytesIO(data) if isinstance(data, bytes) else data)
        self.binary = "xl/workbook.bin" in self.zip.namelist()
        end = "bin" if self.binary else "xml"
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(self.zip.read(f"xl/_rels/workbook.{end}.rels"))}
        listed = self._listed_binary() if self.binary else self._listed_xml()
        place = lambda t: t.lstrip("/") if t.startswith("/") else posixpath.normpath(f"xl/{t}")
        self.sheets = {name: place(targets[rel]) for name, rel in listed if rel in targets}
        part = f"xl/sharedStrings.{end}"
        self.texts = [] if part not in self.zip.namelist() else self._texts_binary(part) if self.binary else self._texts_xml(part)

    def rows(self, name: str | None = None) -> Iterator[tuple[int, Row]]:
        """Of the named sheet, else of the first; of no sheet if there is none of that name."""
        part = self.sheets.get(name or next(iter(self.sheets), ""))
        if part:
            yield from self._rows_binary(part) if self.binary else self._rows_xml(part)

    # --- XML ----------------------------------------------------------------------------------------------------

    def _listed_xml(self) -> Iterator[tuple[str, str]]:
        for e in ElementTree.fromstring(self.zip.read("xl/workbook.xml")).iter():
            if _local(e.tag) == "sheet":
                yield e.get("name", ""), next(v for k, v in e.attrib.items() if _local(k) == "id")

    def _texts_xml(self, part: str) -> list[str]:
        plain = lambda si: "".join(t.text or "" for r in si for t in ([r] if _local(r.tag) == "t" else r if _local(r.tag) == "r" else []) if _local(t.tag) == "t")
        return [plain(si) for si in ElementTree.fromstring(self.zip.read(part)) if _local(si.tag) == "si"]

    def _rows_xml(self, part: str) -> Iterator[tuple[int, Row]]:
        at = 0
        with self.zip.open(part) as f:
            for _, e in ElementTree.iterparse(f):
                if _local(e.tag) != "row":
                    continue
                at = int(e.get("r", at + 1))
                cells: dict[int, str | None] = {}
                for c in e:
                    cells[_column(c.get("r")) if c.get("r") else len(cells)] = self._cell_xml(c)
                yield at, [cells.get(k) for k in range(max(cells, default=-1) + 1)]
                e.clear()

    def _cell_xml(self, c: ElementTree.Element) -> str | None:
        value = next((x for x in c if _local(x.tag) in ("v", "is")), None)
        if value is None:
            return None
        text = "".join(value.itertext())
        kind = c.get("t", "n")
        return self.texts[int(text)] if kind == "s" else ("True" if text == "1" else "False") if kind == "b" else None if kind == "e" else text

    # --- binary records -----------------------------------------------------------------------------------------

    def _records(self, part: str) -> Iterator[tuple[int, bytes]]:
        data, at = self.zip.read(part), 0
        while at < len(data):
            kind, size = data[at] & 0x7F, 0
            at += 1
            if data[at - 1] & 0x80:
                kind |= (data[at] & 0x7F) << 7
                at += 1
            for k in range(4):
                size |= (data[at] & 0x7F) << (7 * k)
                at += 1
                if not data[at - 1] & 0x80:
                    break
            yield kind, data[at : at + size]
            at += size

    def _listed_binary(self) -> Iterator[tuple[str, str]]:
        for kind, x in self._records("xl/workbook.bin"):
            if kind == _SHEET:
                rel, at = _wide(x, 8)
                yield _wide(x, at)[0], rel

    def _texts_binary(self, part: str) -> list[str]:
        return [_wide(x, 1)[0] for kind, x in self._records(part) if kind == _SHARED]

    def _rows_binary(self, part: str) -> Iterator[tuple[int, Row]]:
        at, cells = None, {}
        for kind, x in self._records(part):
            if kind == _ROW:
                if at is not None:
                    yield at, [cells.get(k) for k in range(max(cells, default=-1) + 1)]
                at, cells = struct.unpack_from("<I", x)[0] + 1, {}
            elif at is not None and kind in _CELLS:
                cells[struct.unpack_from("<I", x)[0]] = self._cell_binary(_CELLS[kind], x)
        if at is not None:
            yield at, [cells.get(k) for k in range(max(cells, default=-1) + 1)]

    def _cell_binary(self, kind: str, x: bytes) -> str | None:
        if kind == "text":
            return _wide(x, 8)[0]
        if kind == "shared":
            return self.texts[struct.unpack_from("<I", x, 8)[0]]
        if kind == "real":
            return _number(struct.unpack_from("<d", x, 8)[0])
        if kind == "bool":
            return "True" if x[8] else "False"
        if kind == "short":  # 30 bits, of an integer or of a double; the lowest bit stands for a hundredth
            raw = struct.unpack_from("<i", x, 8)[0]
            value = float(raw >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<q", (raw & ~3) << 32))[0]
            return _number(value / 100 if raw & 1 else value)
        return None


#: Kinds of records of the binary format.
_ROW, _SHARED, _SHEET = 0, 19, 156
_CELLS = {1: "blank", 2: "short", 3: "error", 4: "bool", 5: "real", 6: "text", 7: "shared", 8: "text", 9: "real", 10: "bool", 11: "error"}


def _wide(x: bytes, at: int) -> tuple[str, int]:
    n = struct.unpack_from("<I", x, at)[0]
    return x[at + 4 : at + 4 + 2 * n].decode("utf-16-le"), at + 4 + 2 * n


def _column(place: str) -> int:
    n = 0
    for c in place:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def table_rows(data: bytes | IO[bytes], names: list[str], sheet: str | None = None, header_row: int = 1, max_cols: int = 0, order: str = "row_order", strict: bool = False) -> Iterator[tuple]:
    """The named columns of a sheet below its header row, blank rows left out; the column order is the row's number.

    A5: without a name of a sheet, the first one whose header has all columns; if none has, there are no rows, or, if it
    is strict, that is an error."""
    book, wanted = Workbook(data), set(names) - {order}
    for name in book.sheets if sheet is None else [sheet]:
        rows = book.rows(name) if name in book.sheets else iter(())
        at: dict[str, int] | None = None
        for number, cells in rows:
            cells = cells[:max_cols] if max_cols else cells
            if number < header_row:
                continue
            if at is None:
                if number > header_row:
                    break
                at = {}
                for k, c in enumerate(cells):
                    at.setdefault((c or "").replace("\u00a0", " ").strip(), k)
                if sheet is None and not wanted <= set(at):
                    at = None
                    break
            elif any(c and c.strip() for c in cells):
                yield tuple(number if n == order else cells[at[n]] if n in at and at[n] < len(cells) else None for n in names)
        if at is not None:
            return
    if sheet is None and strict:
        raise ValueError(f"no sheet has the columns {', '.join(sorted(wanted))}; there are {', '.join(book.sheets)}")
