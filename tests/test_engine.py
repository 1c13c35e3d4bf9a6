import json
import os
import pathlib
import shutil
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.cli import config_of, main, parser
from ledgerloom.config import Config
from ledgerloom.plans.engine import Engine
from ledgerloom.plans.queries import ORACLE_SQL, QUERIES
from ledgerloom.schema import MANIFEST
from ledgerloom.sources import files, pages, sinks, tabular
from ledgerloom.operators import extract, records
from ledgerloom.sources.workbook import Workbook
from ledgerloom.streaming.incremental import append_new, event_windows, ingest
from tests.test_extract import V1, V2
from tests.test_workbook import xlsb, xlsx


def test_run_twice(spark, tmp_path):
    root = str(tmp_path)
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{root}/imp/{name}")
    put([("m1", "1 ACME TEXTILES SA.pdf", 1, V1, "V1"), ("m2", "b.pdf", 1, V2, "V2"), ("m3", "c.pdf", 1, "Receiver: TESTUS33\nAmount", "V2")], "content_md5 string, file_name string, page_no int, text string, version string", "pages")
    put([("101", "10/04/2025", "IMP", "ACME TEXTILES SA # 1", "30449.84", 1), ("102", "2025-11-27", " imp ", "x", "7297.30", 2), ("103", "01/01/2020", "imp", "x", "1", 3)], "FORMULARIO string, FECHA string, INDICA string, DETALLE string, DEBITO string, row_order int", "ledger")
    put([("testus33", "estados unidos", "ny", 1)], "`CODIGO DE LOS SWIFT` string, PAIS string, CIUDAD string, src_order int", "directory")
    put([("ACME TEXTILES", 1)], "name string, src_order long", "master")
    put([("acme textiles testus33xxx", "K9", 1)], "`Nombre personalizado` string, `Llave carga masiva` string, src_order int", "registry_names")
    put([("101", None), ("7", "OLD")], "Consecutivo string, `Llave Origen Destino` string", "registry_rows")
    engine = Engine(spark, Config(account="000", root=root))
    first = engine.run("completo", "imp")
    assert not first.warnings
    assert {k: first.counts[k] for k in ("complete", "manual", "manifest", "with_form", "with_key", "registry_nuevo", "registry_sin_match")} == {"complete": 2, "manual": 1, "manifest": 3, "with_form": 2, "with_key": 1, "registry_nuevo": 1, "registry_sin_match": 1}
    rows = {r["Version"]: r for r in engine.table("complete", "imp").collect()}
    assert rows["V1"]["Formulario"] == "101" and rows["V2"]["Formulario"] == "102" and rows["V1"]["Ciudad"] == "NY"
    again = engine.run("completo", "imp")
    assert (again.counts["history"], again.counts["moved"], again.counts["complete"]) == (first.counts["history"], 0, 2)
    assert "completo imp" in again.summary()
    assert engine.run("ocr", "gto").warnings
    with pytest.raises(ValueError):
        engine.run("x", "imp")
    assert parser().parse_args(["post", "gto", "--account", "1"]).mode == "post"


def flaky():
    """A recogniser that fails at some files and pages."""

    def read(data):
        text = data.decode()
        if text.startswith("broken"):
            raise ValueError("broken")
        return [lambda t=t: t if t != "bad" else 1 / 0 for t in text.split("\f")]

    return read


def test_files_to_records(spark, tmp_path):
    """Folder, routing, reading, records; errors are read again, whole and partial files only if forced."""
    day = lambda d: (tmp_path / "imp" / "files" / "NOVIEMBRE" / f"{d} NOVIEMBRE")
    for d in (10, 27):
        day(d).mkdir(parents=True)
    (day(10) / "1 ACME.pdf").write_text("bad\f" + V1)
    (day(10) / "same.pdf").write_text("Receiver : TESTUS33XXX")
    (day(27) / "b.pdf").write_text(V2)
    (day(27) / "c.pdf").write_text("broken")
    (tmp_path / "imp" / "ledger.xlsb").write_bytes(xlsb({"COM": [None, None, None, ["FORMULARIO", "FECHA", "INDICA", "DETALLE", "DEBITO"], [101, "10/04/2025", "imp", "ACME", 30449.84]]}))
    (tmp_path / "imp" / "registry_names.xlsx").write_bytes(xlsx({"Origen y destino": [["Nombre personalizado", "Llave carga masiva"], ["acme textiles sa testus33xxx", "K9"]]}))
    engine = Engine(spark, Config(account="0", root=str(tmp_path), recogniser="tests.test_engine:flaky"))
    assert engine.missing_inputs("completo", "imp") == [] and engine.missing_inputs("cruces", "exp") == ["complete", "ledger"]
    first = engine.run("completo", "imp")
    assert {k: first.counts[k] for k in ("complete", "manual", "manifest", "errors", "updated", "with_key")} == {"complete": 2, "manual": 2, "manifest": 4, "errors": 1, "updated": 1, "with_key": 2}
    state = lambda: {r.file: r.estado for r in engine.table("manifest", "imp").collect()}
    assert state() == {"1 ACME.pdf": "Completo", "same.pdf": "Incompleto", "b.pdf": "Completo", "c.pdf": "Error"}
    (day(27) / "c.pdf").write_text("broken, too")
    (day(27) / "d.pdf").write_text(V2 + " ")
    again = engine.run("ocr", "imp")
    assert (again.counts["complete"], again.counts["manual"], again.counts["errors"], state()["d.pdf"]) == (3, 2, 1, "Completo")
    (day(27) / "c.pdf").write_text(V2 + "  ")
    assert engine.run("ocr", "imp").counts == {"complete": 4, "manual": 1, "manifest": 7, "errors": 0}
    forced = engine.run("ocr", "imp", force=True)
    assert forced.counts == {"complete": 4, "manual": 1, "manifest": 5, "errors": 0}
    assert parser().parse_args(["ocr", "imp", "--account", "1", "--forzar"]).forzar
    assert engine.table("nothing", "imp") is None
    (tmp_path / "imp" / "odd").mkdir()
    with pytest.raises(Exception, match="(?i)schema"):  # an error, not a missing table
        engine.table("odd", "imp")


#: Where counting() notes pages; workers don't see what a test sets in its environment.
COUNTED = pathlib.Path(tempfile.gettempdir()) / f"counted-{os.getuid()}"


@pytest.fixture
def counted():
    shutil.rmtree(COUNTED, ignore_errors=True)
    COUNTED.mkdir()
    yield COUNTED
    shutil.rmtree(COUNTED)


def counting():
    """A recogniser that notes each page that it recognises."""

    def read(data):
        def page(k, text):
            def run():
                with open(COUNTED / uuid.uuid4().hex, "w") as f:
                    f.write(f"{text[:2]} {k}")
                return text

            return run

        return [page(k + 1, t) for k, t in enumerate(data.decode().split("\f"))]

    return read


def noted(folder):
    got = sorted(p.read_text() for p in folder.iterdir())
    for p in folder.iterdir():
        p.unlink()
    return got


def test_pages_until_complete(spark, tmp_path, counted):
    """Of incoming files, pages are recognised until all fields are known; of outgoing ones all."""
    day = tmp_path / "imp" / "files" / "NOVIEMBRE" / "10 NOVIEMBRE"
    day.mkdir(parents=True)
    half = V1.index("59:")
    (day / "a.pdf").write_text("A1\n" + V1 + "\fA2\fA3")
    (day / "b [1].pdf").write_text("B1\fB2\n" + V1[:half] + "\fB3\n" + V1[half:] + "\fB4")
    (day / "c.pdf").write_text("C1\fC2\fC3")
    (day / "a copy.pdf").write_text("A1\n" + V1 + "\fA2\fA3")
    engine = Engine(spark, Config(account="0", root=str(tmp_path), recogniser="tests.test_engine:counting"))
    out = engine.run("ocr", "imp")
    assert noted(counted) == ["A1 1", "A1 1", "B1 1", "B2 2", "B3 3", "C1 1", "C2 2", "C3 3"]
    assert (out.counts["complete"], out.counts["manual"]) == (3, 1)
    whole = extract.extract(spark.createDataFrame([("b", "b", k + 1, t, None) for k, t in enumerate((day / "b [1].pdf").read_text().split("\f"))], "file_path string, file_name string, page_no int, text string, error string"), "imp", "V1").first()
    assert whole.pages_scanned == 3


def test_nothing_is_read_again(spark, tmp_path, monkeypatch, counted):
    """A second run over an unchanged folder reads no file; a copy is read but not recognised; a file that is touched is."""
    day = tmp_path / "imp" / "files" / "NOVIEMBRE" / "27 NOVIEMBRE"
    day.mkdir(parents=True)
    (day / "b.pdf").write_text("B " + V2)
    engine = Engine(spark, Config(account="0", root=str(tmp_path), recogniser="tests.test_engine:counting"))
    assert engine.run("ocr", "imp").counts["complete"] == 1 and len(noted(counted)) == 1
    read, contents = [], engine._contents
    monkeypatch.setattr(engine, "_contents", lambda paths: read.extend(paths) or contents(paths))
    assert engine.run("ocr", "imp").counts["complete"] == 1
    assert read == [] and noted(counted) == []
    (day / "copy.pdf").write_text("B " + V2)
    engine.run("ocr", "imp")
    assert [p.rpartition("/")[2] for p in read] == ["copy.pdf"] and noted(counted) == []
    read.clear()
    engine.run("ocr", "imp")
    assert read == []
    (day / "b.pdf").write_text("B " + V2 + " changed")
    engine.run("ocr", "imp")
    assert {p.rpartition("/")[2] for p in read} == {"b.pdf"} and len(noted(counted)) == 1


def test_scans_are_errors(spark, tmp_path):
    """Bytes that aren't text are an error until there is a recogniser for them."""
    day = tmp_path / "imp" / "files" / "NOVIEMBRE" / "27 NOVIEMBRE"
    day.mkdir(parents=True)
    (day / "a.pdf").write_bytes(b"%PDF-1.7\n%\xe2\xe3")
    (day / "b.pdf").write_bytes(b"\xff\xfe\x00")
    (day / "c.pdf").write_text(V2)
    engine = Engine(spark, Config(account="0", root=str(tmp_path)))
    out = engine.run("ocr", "imp")
    assert (out.counts["errors"], out.counts["complete"]) == (2, 1)
    assert {r.file: r.estado for r in engine.table("manifest", "imp").collect()} == {"a.pdf": "Error", "b.pdf": "Error", "c.pdf": "Completo"}
    assert Engine(spark, Config(account="0", root=str(tmp_path), recogniser="tests.test_engine:always")).run("ocr", "imp").counts["complete"] == 3


def always():
    return lambda data: [V2]


def test_sheet_with_a_note_in_front(spark, tmp_path):
    """The directory is the first sheet that has its columns; none is an error, for mail kinds no rows."""
    (tmp_path / "imp").mkdir()
    head = ["CODIGO DE LOS SWIFT", "PAIS", "CIUDAD"]
    (tmp_path / "imp" / "directory.xlsx").write_bytes(xlsx({"note": [["read me"], ["x"]], "some": [head[:2], ["a", "b"]], "codes": [head, ["TESTUS33", "US", "NY"]]}))
    engine = Engine(spark, Config(account="0", root=str(tmp_path)))
    assert [tuple(r)[:3] for r in engine.table("directory", "imp").collect()] == [("TESTUS33", "US", "NY")]
    (tmp_path / "imp" / "master.xlsb").write_bytes(xlsb({"note": [["read me"]]}))
    with pytest.raises(Exception, match="no sheet has the columns"):
        engine.table("master", "imp").collect()
    (tmp_path / "gto").mkdir()
    (tmp_path / "gto" / "directory.xlsx").write_bytes(xlsx({"note": [["read me"]]}))
    assert engine.table("directory", "gto").count() == 0


def test_all_tables_or_none(spark, tmp_path, monkeypatch):
    """A run that fails at any of its writes leaves what the last whole run has left, and no folders."""
    root = f"{tmp_path}/imp"
    page = lambda i, t: spark.createDataFrame([(i, f"{i}.pdf", 1, t, "V2")], "content_md5 string, file_name string, page_no int, text string, version string")
    page("a", V2).write.parquet(f"{root}/pages")
    engine = Engine(spark, Config(account="0", root=str(tmp_path)))
    engine.run("completo", "imp")
    names = ("complete", "manual", "manifest", "history", "template")
    state = lambda: [sorted(map(str, engine.table(n, "imp").collect())) for n in names]
    first, folders = state(), sorted(os.listdir(f"{root}/_data"))
    page("b", V2 + " ").write.mode("append").parquet(f"{root}/pages")
    write = engine.write
    for k in range(1, 6):
        left = iter(range(k))

        def failing(*a, left=left, **b):
            if next(left, None) is None:
                raise OSError("stopped")
            return write(*a, **b)

        monkeypatch.setattr(engine, "write", failing)
        if k < 5:
            with pytest.raises(OSError, match="stopped"):
                engine.run("completo", "imp")
            assert state() == first and sorted(os.listdir(f"{root}/_data")) == folders
    monkeypatch.setattr(engine, "write", write)
    pinned = engine.versions("imp").latest()[0]
    assert engine.run("completo", "imp").counts["history"] == 2
    assert engine.table("complete", "imp").count() == 2 and engine.table("complete", "imp", pinned).count() == 1
    history = engine.versions("imp").latest()[1]["history"]
    assert len(history) == 2 and [engine.versions("imp").table([f]).count() for f in history] == [1, 1]  # new rows only
    of = engine.versions("imp")
    number, tables = of.latest()
    of.commit(number, tables)
    with pytest.raises(RuntimeError, match="another run"):
        of.commit(number, tables)
    engine.put(engine.table("manual", "imp").limit(0), "manual", "imp")
    assert len(of.numbers()) == 2 and engine.table("history", "imp").count() == 2


def test_new_rows_leave_the_old_side_where_it_is(spark, tmp_path):
    """The larger side isn't shuffled; null equals null."""
    old = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("id"))
    old.write.parquet(f"{tmp_path}/old")
    new = spark.createDataFrame([("5",), ("x",), (None,), ("x",)], "id string")
    got = records.new_rows(new, spark.read.parquet(f"{tmp_path}/old"))
    assert [r.id for r in got.collect()] == ["x", "x"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    old_side = plan[plan.rindex("BroadcastHashJoin") if "LeftSemi" in plan else 0 :]
    assert "LeftSemi" in plan and "BroadcastHashJoin" in old_side


def test_options():
    a = parser().parse_args(["ocr", "imp", "--account", "1", "--own-codes", "AAAA, BBBB", "--path-in-id", "--overwrite", "--year", "2026", "--cutover", "2026-01-02", "--recogniser", "m:f"])
    c = config_of(a)
    assert (c.own_codes, c.path_in_id, c.overwrite, c.year, str(c.cutover), c.recogniser) == (("AAAA", "BBBB"), True, True, 2026, "2026-01-02", "m:f")
    assert config_of(parser().parse_args(["ocr", "imp", "--account", "1", "--root", "."])) == Config(account="1")


def test_command_line(spark, tmp_path, capsys):
    """What waits is shown in order and not read; a run exports its tables; a log file is written."""
    for d, name in (("27 NOVIEMBRE", "b.pdf"), ("10 NOVIEMBRE", "z.pdf"), ("10 NOVIEMBRE", "a.pdf")):
        day = tmp_path / "imp" / "files" / "NOVIEMBRE" / d
        day.mkdir(parents=True, exist_ok=True)
        (day / name).write_text(V2 if name == "b.pdf" else V1 + name)
    base = ["completo", "imp", "--account", "77", "--root", str(tmp_path)]
    assert main([*base, "--waiting"]) == 0
    shown = [line.split() for line in capsys.readouterr().out.splitlines()]
    assert [(x[0], x[1], x[-1].rpartition("/")[2]) for x in shown] == [("2025-11-10", "V1", "a.pdf"), ("2025-11-10", "V1", "z.pdf"), ("2025-11-27", "V2", "b.pdf")]
    assert main([*base, "--export", f"{tmp_path}/out", "--workbook", f"{tmp_path}/out.xlsx", "--log", f"{tmp_path}/run.log"]) == 1  # there is no ledger
    assert "complete: 3" in capsys.readouterr().out and (tmp_path / "run.log").exists()
    rows = spark.read.option("header", "true").csv(f"{tmp_path}/out/imp-template").collect()
    assert {r["Cuenta compensación"] for r in rows} == {"77"} and spark.read.option("header", "true").csv(f"{tmp_path}/out/imp-complete").count() == 3
    book = spark.read.format("sheets").option("sheet", "template").load(f"{tmp_path}/out.xlsx")
    assert [tuple(r) for r in book.drop("row_order").orderBy(*book.columns[1:]).collect()] == sorted(tuple(r) for r in spark.read.option("header", "true").csv(f"{tmp_path}/out/imp-template").collect())
    assert list(Workbook((tmp_path / "out.xlsx").read_bytes()).sheets) == ["complete", "template"]
    assert main([*base, "--waiting"]) == 0 and capsys.readouterr().out == ""
    with pytest.raises(ValueError, match="no table"):
        Engine(spark, Config(account="1", root=str(tmp_path))).export("manual", "exp", f"{tmp_path}/x")


def test_confirm(spark, tmp_path):
    root, engine = f"{tmp_path}/imp", Engine(spark, Config(account="0", root=str(tmp_path)))
    cols = "id string, `Nombre archivo` string, Receiver string, Date string, Amount string, Proveedor string, Pais string, Ciudad string, `Nombre personalizado` string, Estado string, Formulario string, Llave string, Version string"
    row = lambda i: (i, "f", "TESTUS33", None, "1.00", "p", None, None, "n", "Incompleto", None, None, "V1")
    spark.createDataFrame([row("a")], cols).write.parquet(f"{root}/complete")
    spark.createDataFrame([row("a"), row("b")], cols).write.parquet(f"{root}/manual")
    asked = []
    out = engine.run("post", "imp", confirm=lambda n: asked.append(n))
    assert asked == [1] and "moved" not in out.counts and out.warnings == ["1 manual records stay"]
    assert engine.run("post", "imp", confirm=lambda n: True).counts["moved"] == 1


def test_manifest_json(spark, tmp_path):
    m = spark.createDataFrame([("k", "f", "V1", "t", "Completo")], MANIFEST)
    tabular.write_manifest(m, f"{tmp_path}/m.json")
    assert tabular.read_manifest(spark, f"{tmp_path}/m.json").collect() == m.collect()
    assert records.cleared(m).count() == 0


def test_append_keeps_errors(spark, tmp_path):
    """Only a missing table counts as none."""
    (tmp_path / "t").mkdir()
    with pytest.raises(Exception, match="(?i)schema"):
        append_new(f"{tmp_path}/t")(spark.createDataFrame([("a",)], "id string"), 0)


def test_gto(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("testus33", "08 Oct 2025", "#8.800,#", "ACME"), (None, "x", None, None)], "Receiver string, DATE string, Amount string, `Beneficiary Customer` string").write.parquet(f"{root}/gto/mail")
    out = Engine(spark, Config(account="000", root=root)).run("ocr", "gto")
    assert out.counts == {"complete": 1, "manual": 1}


def test_sources(spark, tmp_path):
    schema = "a string, b string"
    from pyspark.sql.types import _parse_datatype_string as parse

    assert tabular.read_sheet(spark, f"{tmp_path}/none.csv", parse(schema)).count() == 0
    (tmp_path / "x.csv").write_text("a,b\n1, \n,\n")
    df = tabular.read_sheet(spark, f"{tmp_path}/x.csv", parse(schema))
    assert tabular.drop_blank_rows(df).count() == 1 and tabular.headers(df) == {"a": 1, "b": 2}
    assert tabular.format_of("x.xlsb") == "excel"
    assert tabular.first_with_columns([df.drop("b"), df], ["b"]).columns == ["a", "b"]
    assert tabular.first_with_columns([df], ["q"], strict=False) is None
    (tmp_path / "m.json").write_text(json.dumps({"k": {"file": "f", "version": "V1", "procesado_en": "t", "estado": "Completo"}}))
    assert tabular.read_manifest(spark, f"{tmp_path}/m.json").first().estado == "Completo"
    assert tabular.read_manifest(spark, f"{tmp_path}/q.json").columns == MANIFEST.names
    folder = tmp_path / "NOVIEMBRE" / "26 NOVIEMBRE"
    folder.mkdir(parents=True)
    (folder / "a.pdf").write_text("one\ftwo")
    found = files.route(files.list_files(spark, str(tmp_path)), "path", "imp", F.lit(2025), "2025-11-26", "2025-04-01")
    assert found.first().version == "V2"
    assert [(r.page_no, r.text) for r in pages.read_pages(found).orderBy("page_no").collect()] == [(1, "one"), (2, "two")]
    assert files.missing_targets(found, found).count() == 0
    v = spark.createDataFrame([(1, "V1"), (2, "V2")], "a int, version string")
    sinks.write_sheets(v, f"{tmp_path}/t")
    sinks.write_sheets(v.where("a = 1").withColumn("a", F.lit(5)), f"{tmp_path}/t")
    assert sorted(r.a for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [2, 5]
    up = spark.createDataFrame([(1, "n")], "a int, c string")
    assert sorted(str(r.c) for r in sinks.patch(v, up, "a", "c").collect()) == ["None", "n"]


def test_stream(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "id string, v int")
    for k in range(2):
        df.write.mode("append").parquet(src)
        ingest(spark.readStream.schema(df.schema).parquet(src), out, f"{tmp_path}/c").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b"]
    ev = spark.createDataFrame([("2025-01-01 00:01:00", "x", 1.0), ("2025-01-01 00:04:00", "x", 2.0)], "t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    assert [(r.n, r.total) for r in event_windows(ev).collect()] == [(2, 3.0)]


def test_every_query_has_sql_or_a_test():
    assert set(QUERIES) - set(ORACLE_SQL) == {"e_fuzzy_master", "e_fuzzy_matches"}
