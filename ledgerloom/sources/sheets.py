"""Workbooks as a source and a sink of Spark: the format `sheets`, once register() has been called.

Read: a task for each sheet, which takes that sheet's part of the file and no other. Options: path (of a workbook or of a
folder of them), sheet (a name, or a pattern with * and ?, which no name may hold; else the first sheet that has all columns
of the schema, A5), headerRow, maxCols. Without a schema the columns are those of the sheet's header, as text, and
row_order; `_sheet` and `_file` are columns that may be asked for. A schema names the columns that are wanted, and cells
of others are not kept. No file, no sheet of that name and an empty sheet give no rows.

Filters aren't pushed to the source: Spark 4.1 keeps what a DataFrame's first query has pushed for all its later ones, and
an unfiltered count after a filtered one would miss rows. Choose sheets by the option.

Write (A16, A21, .xlsx): rows go to the sheet that the column `by` names (`none` for null), or to the option sheet. Each
task writes its rows as parts beside the workbook, and the commit joins them, in the order of partitions, into a new file
that takes the workbook's place in one step. Mode append replaces the sheets that it names and leaves the others as they
are; overwrite replaces the workbook. A write that fails deletes its parts and leaves the workbook as it was; so does one on
a workbook that a program holds open (its lock file is there), and one of more rows than a sheet may have."""

from __future__ import annotations

import datetime
import math
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fnmatch import fnmatchcase
from xml.sax.saxutils import escape, quoteattr

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ledgerloom.sources.workbook import Workbook, table_rows

FORMAT = "sheets"
#: The most rows of a sheet, what no name of a sheet may hold, and names of the file format.
MAX_ROWS, MAX_NAME, BAD_NAME = 1_048_576, 31, re.compile(r"[\[\]:*?/\\]")
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
ORDERS = ("row_order", "src_order")
_ENDS = (".xlsx", ".xlsm", ".xltx", ".xlsb")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def register(spark: SparkSession) -> None:
    """The format for this session."""
    spark.dataSource.register(SheetSource)


def _place(path: str):
    """(file system, path on it): local, or what the uri's scheme says."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _books(path: str) -> list[str]:
    """The workbook, or those of the folder, by name."""
    from pyarrow import fs

    system, at = _place(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(at))
        return sorted(f"{path.rstrip('/')}/{x.base_name}" for x in found if x.is_file and x.base_name.endswith(_ENDS) and not x.base_name.startswith("~$"))
    return [] if info.type == fs.FileType.NotFound else [path]


def _open(path: str):
    system, at = _place(path)
    return system.open_input_file(at)


def _header(book: Workbook, name: str, row: int, most: int) -> list[str]:
    for number, cells in book.rows(name):
        if number >= row:
            return [(c or "").replace(" ", " ").strip() for c in (cells[:most] if most else cells)] if number == row else []
    return []


@dataclass
class Sheet(InputPartition):
    path: str
    name: str


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        """The header's columns of the chosen sheet of the first workbook; of columns that repeat, the first."""
        sheets = _Options(self.options)
        for path in _books(sheets.path):
            with _open(path) as f:
                book = Workbook(f)
                for name in (n for n in book.sheets if sheets.sheet is None or fnmatchcase(n, sheets.sheet)):
                    header = [n for n in dict.fromkeys(_header(book, name, sheets.header, sheets.most)) if n]
                    if header:
                        order = [] if ORDERS[0] in header else [T.StructField(ORDERS[0], T.LongType())]
                        return T.StructType([*order, *(T.StructField(n, T.StringType()) for n in header)])
        raise ValueError(f"no header in row {sheets.header} of {sheets.path}")

    def reader(self, schema: T.StructType) -> SheetReader:
        return SheetReader(_Options(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> SheetWriter:
        return SheetWriter(_Options(self.options), schema, overwrite)


class _Options:
    def __init__(self, options: dict[str, str]):
        get = {k.lower(): v for k, v in options.items()}.get
        self.path, self.sheet, self.by = get("path", ""), get("sheet"), get("by")
        self.header, self.most = int(get("headerrow", "1")), int(get("maxcols", "0"))


class SheetReader(DataSourceReader):
    def __init__(self, options: _Options, schema: T.StructType):
        self.options, self.names = options, schema.names
        self.order = next((n for n in schema.names if n in ORDERS), "")
        for x in schema.fields:
            if not isinstance(x.dataType, T.LongType if x.name == self.order else T.StringType):
                raise ValueError(f"column {x.name}: cells are read as strings, numbers of rows as bigint")

    def partitions(self) -> list[Sheet]:
        o, out = self.options, []
        columns = {n for n in self.names if n not in ("_sheet", "_file", self.order)}
        for path in _books(o.path):
            with _open(path) as f:
                book = Workbook(f)
                if o.sheet is None:
                    names = [next((n for n in book.sheets if columns <= set(_header(book, n, o.header, o.most))), None)]
                else:
                    names = [n for n in book.sheets if fnmatchcase(n, o.sheet)]
            out += [Sheet(path, n) for n in names if n is not None]
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Sheet):  # there is none
            return
        fixed = {"_sheet": partition.name, "_file": partition.path}
        at = [(k, fixed[n]) for k, n in enumerate(self.names) if n in fixed]
        with _open(partition.path) as f:
            for row in table_rows(f, self.names, partition.name, self.options.header, self.options.most, self.order):
                row = list(row)
                for k, x in at:
                    row[k] = x
                yield tuple(row)


@dataclass
class Parts(WriterCommitMessage):
    partition: int
    files: dict[str, tuple[str, int]]  # of a sheet: file, rows


def _cell(x) -> str:
    if x is None:
        return "<c/>"
    if isinstance(x, bool):
        return f'<c t="b"><v>{int(x)}</v></c>'
    if isinstance(x, (int, Decimal)) or isinstance(x, float) and math.isfinite(x):
        return f"<c><v>{x!r}</v></c>" if not isinstance(x, Decimal) else f"<c><v>{x:f}</v></c>"
    text = x.isoformat(" ") if isinstance(x, datetime.datetime) else str(x)
    # what XML can't hold is written as the file format does
    text = _CONTROL.sub(lambda m: f"_x{ord(m[0]):04X}_", text)
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


class SheetWriter(DataSourceWriter):
    def __init__(self, options: _Options, schema: T.StructType, overwrite: bool):
        if not options.path.endswith((".xlsx", ".xlsm")):
            raise ValueError(f"not written: {options.path}; workbooks end in .xlsx or .xlsm")
        if options.by and options.by not in schema.names:
            raise ValueError(f"no column {options.by}")
        self.path, self.by, self.overwrite = options.path, options.by, overwrite
        self.sheet = options.sheet or "Sheet1"
        self.names = [n for n in schema.names if n != options.by]
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"
        # not made by tasks: one that still runs when a write is given up must not bring it back
        system, at = _place(self.parts)
        system.create_dir(at, recursive=True)

    def _row(self, values: Iterable) -> bytes:
        return f"<row>{''.join(map(_cell, values))}</row>".encode("utf-8", "replace")

    def write(self, iterator: Iterator) -> Parts:
        task = TaskContext.get()
        system, at = _place(self.parts)
        open_, counts, files = {}, {}, {}
        try:
            for r in iterator:
                name = self.sheet if not self.by else "none" if r[self.by] is None else str(r[self.by])
                if name not in open_:
                    if not name or len(name) > MAX_NAME or BAD_NAME.search(name):
                        raise ValueError(f"no name of a sheet: {name!r}")
                    files[name] = f"{at}/{task.partitionId()}-{task.taskAttemptId()}-{len(files)}"
                    open_[name], counts[name] = system.open_output_stream(files[name]), 0
                open_[name].write(self._row(r[n] for n in self.names))
                counts[name] += 1
        finally:
            for f in open_.values():
                f.close()
        return Parts(task.partitionId(), {n: (files[n], counts[n]) for n in files})

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, at = _place(self.parts)
        if system.get_file_info(at).type == fs.FileType.Directory:
            system.delete_dir(at)

    def commit(self, messages: list) -> None:
        try:
            self._put([m for m in messages if m is not None])
        finally:
            self.abort(messages)

    def _put(self, messages: list[Parts]) -> None:
        sheets: dict[str, list[str]] = {} if self.by else {self.sheet: []}
        rows: dict[str, int] = {}
        for m in sorted(messages, key=lambda m: m.partition):
            for name, (file, n) in m.files.items():
                sheets.setdefault(name, []).append(file)
                rows[name] = rows.get(name, 0) + n
        sheets = {n: sheets[n] for n in sorted(sheets)}
        for name, n in rows.items():
            if n + 1 > MAX_ROWS:
                raise ValueError(f"sheet {name} would have {n + 1} rows; a sheet has {MAX_ROWS} at most")
        system, at = _place(self.path)
        folder, _, base = at.rpartition("/")
        if system.get_file_info(f"{folder}/~${base}").is_file:
            raise PermissionError(f"{self.path} is open in another program")
        old = not self.overwrite and system.get_file_info(at).is_file
        if not sheets and (old or not self.overwrite):
            return
        new = f"{at}.new-{uuid.uuid4().hex}"
        try:
            with system.open_output_stream(new) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                if old:
                    with system.open_input_file(at) as f, zipfile.ZipFile(f) as before:
                        self._add(z, before, Workbook(f).sheets, sheets, system)
                else:
                    self._create(z, sheets or {self.sheet: []}, system)
            system.move(new, at)
        except Exception:
            if system.get_file_info(new).is_file:
                system.delete_file(new)
            raise

    def _fill(self, z: zipfile.ZipFile, part: str, files: list[str], system) -> None:
        with z.open(part, "w", force_zip64=True) as out:
            out.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            out.write(self._row(self.names))
            for file in files:
                with system.open_input_stream(file) as f:
                    shutil.copyfileobj(f, out, 1 << 20)
            out.write(b"</sheetData></worksheet>")

    def _create(self, z: zipfile.ZipFile, sheets: dict[str, list[str]], system) -> None:
        z.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_RELATION}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self._list(z, f'<workbook xmlns="{_MAIN}"><sheets></sheets></workbook>', f'<Relationships xmlns="{_PACKAGE}/relationships"></Relationships>', _content_types(), sheets, system)

    def _add(self, z: zipfile.ZipFile, before: zipfile.ZipFile, known: dict[str, str], sheets: dict[str, list[str]], system) -> None:
        """The old file's members as they are, but for the sheets that are replaced, and lists of the new ones. The
        order in which formulas were computed goes, as those of replaced sheets do."""
        lists = ("xl/workbook.xml", "xl/_rels/workbook.xml.rels", "[Content_Types].xml")
        book, relations, types = (before.read(n).decode("utf-8") for n in lists)
        relations = re.sub(r'<Relationship [^>]*calcChain[^>]*/>', "", relations)
        types = re.sub(r'<Override [^>]*calcChain[^>]*/>', "", types)
        replaced = {known[n]: n for n in sheets if n in known}
        for item in before.infolist():
            if item.filename in replaced:
                self._fill(z, item.filename, sheets[replaced[item.filename]], system)
            elif item.filename not in lists and not item.filename.endswith("calcChain.xml"):
                with before.open(item) as f, z.open(item.filename, "w", force_zip64=True) as out:
                    shutil.copyfileobj(f, out, 1 << 20)
        self._list(z, book, relations, types, {n: x for n, x in sheets.items() if n not in known}, system)

    def _list(self, z: zipfile.ZipFile, book: str, relations: str, types: str, sheets: dict[str, list[str]], system) -> None:
        top = max(map(int, re.findall(r'sheetId="(\d+)"', book)), default=0)
        rows, links, kinds, mark = [], [], [], uuid.uuid4().hex[:8]
        for k, (name, files) in enumerate(sheets.items(), 1):
            part = f"worksheets/part-{mark}-{k}.xml"
            self._fill(z, f"xl/{part}", files, system)
            rows.append(f'<{{0}}sheet xmlns:r="{_RELATION}" name={quoteattr(name)} sheetId="{top + k}" r:id="n{mark}-{k}"/>')
            links.append(f'<{{0}}Relationship Id="n{mark}-{k}" Type="{_RELATION}/worksheet" Target="{part}"/>')
            kinds.append(f'<{{0}}Override PartName="/xl/{part}" ContentType="{_TYPE}.worksheet+xml"/>')
        z.writestr("xl/workbook.xml", _before_end(book, "sheets", rows))
        z.writestr("xl/_rels/workbook.xml.rels", _before_end(relations, "Relationships", links))
        z.writestr("[Content_Types].xml", _before_end(types, "Types", kinds))


def _content_types() -> str:
    plain = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
    return f'<Types xmlns="{_PACKAGE}/content-types">{plain}<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/></Types>'


def _before_end(xml: str, tag: str, new: list[str]) -> str:
    """With the new elements at the end of the list, under its own prefix."""
    end = re.search(rf"</((?:\w+:)?){tag}>", xml)
    if end is None:
        raise ValueError(f"no list of {tag}")
    return xml[: end.start()] + "".join(x.replace("{0}", end[1]) for x in new) + xml[end.start() :]
