"""K1-K7: runs by mode and kind over the tables and files in one folder. MODES has the steps of each mode.

Below root/kind there are tables, as Parquet folders: pages, mail, ledger, directory, master, registry_names,
registry_rows, and those that runs write: complete, manual, history, template, manifest, seen, registry_out. Instead of
the first seven there may be workbooks (INPUTS), and instead of pages a folder `files` of message files, which are routed
by date, looked up in the manifest and read. V1 and V2 are one table with a Version column. A missing table is empty.

What a run writes is there when it has ended, all tables or none (sources.versions); until then, and after a run that
failed, table() gives what the last whole run has left. Tables that lie there as folders are read until a run writes
them. The history only grows: a run writes its new rows alone.

Files are listed first, and only those that haven't been seen with the same path, size and time are read; their content is
then looked up in the manifest. Pages of incoming files are recognised one after another, of files only that still lack
a field. Files whose reading fails are recorded with the state Error and are read again by the next run; others by their
completeness, and not again unless a run is forced."""

from __future__ import annotations

import contextlib
import itertools
import logging
import os
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import Config
from ledgerloom.functions.ids import display_name, record_id
from ledgerloom.operators import argmax, cascade, extract, fuzzy, records
from ledgerloom.schema import ERROR, FINAL, HISTORY, MANIFEST, conform
from ledgerloom.sources import files, sinks
from ledgerloom.sources.pages import read_pages
from ledgerloom.sources.tabular import exists, mail_rows, read_sheet, registry_map
from ledgerloom.sources.versions import MANY, State, Versions

log = logging.getLogger(__name__)
KINDS = ("imp", "exp", "gto")
MODES = {"ocr": ("extract",), "post": ("curate",), "post_auto": ("curate",), "plantilla": ("curate",), "cruces": ("reconcile",), "completo": ("extract", "curate", "reconcile")}
#: Workbooks that stand in for tables: sheet, number of the header row, columns (fixed values), column of the order.
INPUTS = {
    "ledger": ("COM", 4, ("FORMULARIO", "FECHA", "INDICA", "DETALLE", "DEBITO", "CREDITO"), "row_order"),
    "directory": (None, 1, ("CODIGO DE LOS SWIFT", "PAIS", "CIUDAD"), "src_order"),
    "master": (None, 1, ("DB Nombre o razon social del beneficiario",), "src_order"),
    "registry_names": ("Origen y destino", 1, ("Nombre personalizado", "Llave carga masiva"), "src_order"),
    "registry_rows": ("Datos Origen Destino", 1, ("Consecutivo", "Llave Origen Destino"), "src_order"),
    "mail": (None, 1, ("Receiver", "DATE", "Amount", "Beneficiary Customer"), "src_order"),
}
BOOKS = ("xlsx", "xlsb", "xlsm")
_FILE = "path string, modificationTime timestamp, length long, content binary"


@dataclass
class Result:
    mode: str
    kind: str
    counts: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def summary(self) -> str:
        return "\n".join([f"{self.mode} {self.kind}", *[f"  {k}: {n}" for k, n in self.counts.items()], *[f"  ! {w}" for w in self.warnings]])


class Engine:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        #: What a run that is going on has written, by table.
        self.state: State | None = None
        self.written: list[str] = []
        self.passing: list[str] = []

    def path(self, name: str, kind: str) -> str:
        return f"{self.config.root}/{kind}/{name}"

    def versions(self, kind: str) -> Versions:
        return Versions(self.spark, f"{self.config.root}/{kind}")

    def table(self, name: str, kind: str, version: int | None = None) -> DataFrame | None:
        """The table as of the last commit, or of a named one; else the folder, else the workbook of its name, else none.
        Within a run, as the run has written it so far. Errors other than a missing path are raised."""
        of = self.versions(kind)
        state = self.state if self.state is not None and version is None else of.read(version) if version else of.latest()[1]
        if name in state:
            return of.table(state[name]) if state[name] else None
        path = self.path(name, kind)
        if exists(self.spark, path):
            return self.spark.read.parquet(path)
        if name in INPUTS:
            sheet, header, columns, order = INPUTS[name]
            schema = T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField(order, T.LongType())])
            for end in BOOKS:
                if exists(self.spark, f"{path}.{end}"):
                    return read_sheet(self.spark, f"{path}.{end}", schema, sheet, header, strict=kind != "gto")
        return None

    def write(self, df: DataFrame, name: str, kind: str, add: bool = False) -> int:
        """Replace a table, or add rows to it, when the run ends; the rows written, which are counted on the way."""
        of = self.versions(kind)
        before = self.state.get(name, []) if add else []
        if add and name not in self.state and (old := self.table(name, kind)) is not None:
            df = old.unionByName(df, allowMissingColumns=True)  # a folder from before
        elif len(before) >= MANY:
            df, before = of.table(before).unionByName(df, allowMissingColumns=True), []
        folder, n = of.folder(name), Observation(f"{name}-{uuid.uuid4().hex}")
        self.written.append(folder)
        df.observe(n, F.count(F.lit(1)).alias("n")).write.parquet(f"{of.root}/{folder}")
        self.state[name] = [*before, folder]
        return n.get["n"]

    def put(self, df: DataFrame, name: str, kind: str) -> None:
        """Replace a table by hand, such as manual records that have been reviewed."""
        with self._committed(kind):
            self.write(df, name, kind)

    @contextlib.contextmanager
    def _committed(self, kind: str) -> Iterator[None]:
        """What is written inside is committed at the end, or, if that isn't reached, is gone."""
        of = self.versions(kind)
        base, before = of.latest()
        self.state, self.written = dict(before), []
        try:
            yield
            if self.state != before:
                of.commit(base, self.state)
                self.written = []
        finally:
            for folder in self.written + self.passing:
                of.delete(folder)
            self.state, self.passing = None, []

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def missing_inputs(self, mode: str, kind: str) -> list[str]:
        """Names of tables that the steps of a mode can't do without and that aren't there."""
        need = {"extract": ("mail",) if kind == "gto" else ("pages",), "curate": ("complete",), "reconcile": ("complete", "ledger")}
        made = {"complete"} if "extract" in MODES[mode] else set()
        have = lambda n: self.table(n, kind) is not None or (n == "pages" and exists(self.spark, self.path("files", kind)))
        return [n for step in MODES[mode] for n in need[step] if n not in made and not have(n)]

    def clear(self, kind: str) -> None:
        """K8: forget which files have been read."""
        if self.state is not None:
            self.state |= {"manifest": [], "seen": []}
            return
        with self._committed(kind):
            self.clear(kind)

    def run(self, mode: str, kind: str, force: bool = False, confirm: Callable[[int], bool] | None = None) -> Result:
        """force: read files again that have been read. confirm: asked, in mode `post` and `completo`, whether that many
        manual records may move to the complete ones; they stay where they are if it says no."""
        mode, kind = mode.lower(), kind.lower()
        if mode not in MODES or kind not in KINDS:
            raise ValueError(f"unknown mode {mode} or kind {kind}")
        out = Result(mode, kind)
        self.confirm = confirm if mode in ("post", "completo") else None
        with self._committed(kind):
            if force:
                self.clear(kind)
            for step in MODES[mode]:
                getattr(self, f"_{step}")(kind, out)
        log.info(out.summary())
        return out

    # steps ----------------------------------------------------------------------------------------------------

    def _enrich(self, df: DataFrame, kind: str) -> DataFrame:
        master, places = self.table("master", kind), self.table("directory", kind)
        if master is not None:
            names = df.select(F.col("Proveedor").alias("name")).where("name IS NOT NULL")
            m = master.select(F.col(master.columns[0]).alias("choice"), F.col("src_order").alias("choice_order"))
            df = argmax.enrich_names(df, fuzzy.fuzzy_matches(names, m, self.config.fuzzy_threshold), threshold=self.config.fuzzy_threshold)
        if places is not None:
            df = records.add_places(df, records.directory(places, "CODIGO DE LOS SWIFT", "PAIS", "CIUDAD", "src_order"), upper=kind != "gto")
        return df

    def _pages(self, kind: str, fresh: str) -> DataFrame | None:
        """Pages of messages that haven't been read: of the table, or of the files in the folder; written to fresh."""
        pages, done = self.table("pages", kind), self.table("manifest", kind)
        if pages is not None:
            pages = pages if "error" in pages.columns else pages.withColumn("error", F.lit(None).cast("string"))
            pages = pages if "file_path" in pages.columns else pages.withColumn("file_path", F.col("file_name"))
            (pages if done is None else records.pending(pages, done)).write.parquet(f"{fresh}/pages")
            return self.spark.read.parquet(f"{fresh}/pages")
        return self._read_files(kind, fresh, done) if exists(self.spark, self.path("files", kind)) else None

    def _contents(self, paths: list[str]) -> DataFrame:
        """The named files. Their names pass through the driver, as do those of all files that Spark lists."""
        plain = [re.sub(r"([\[\]{}*?\\\\])", r"\\\1", p) for p in paths]
        return self.spark.read.format("binaryFile").load(plain) if plain else self.spark.createDataFrame([], _FILE)

    def _unread(self, kind: str) -> DataFrame:
        c, seen, done = self.config, self.table("seen", kind), self.table("manifest", kind)
        listing = files.list_files(self.spark, self.path("files", kind)).select("path", "modificationTime", "length")
        found = files.route(listing, "path", kind, F.lit(c.year), c.cutover.isoformat(), c.earliest_file.isoformat())
        return found if done is None or seen is None else records.unread(found, seen, done)

    def waiting(self, kind: str) -> DataFrame:
        """(file_date, file_name, version, path) of the files that the next run will read, in order."""
        return files.in_order(self._unread(kind)).select("file_date", "file_name", "version", "path")

    def export(self, name: str, kind: str, path: str, form: str = "csv") -> None:
        """A table for other programs; a table that isn't there is an error. Form xlsx: the sheet of the table's name
        in the workbook at path, whose other sheets stay."""
        df = self.table(name, kind)
        if df is None:
            raise ValueError(f"no table {name} of {kind}")
        sinks.export(df, path, form, name)

    def _read_files(self, kind: str, fresh: str, done: DataFrame | None) -> DataFrame:
        c, seen = self.config, self.table("seen", kind)
        found = self._unread(kind).select("path", "file_name", "version").collect()
        names = self.spark.createDataFrame([tuple(r) for r in found], "file_path string, file_name string, version string")
        held = records.with_md5(self._contents([r["path"] for r in found])).select(F.col("path").alias("file_path"), "length", "modificationTime", "content_md5")
        names.join(held, "file_path").write.parquet(f"{fresh}/held")
        held = self.spark.read.parquet(f"{fresh}/held")
        now = held.select(F.col("file_path").alias("path"), "length", F.col("modificationTime").alias("modified"), "content_md5")
        if held.head(1):
            self.write(now if seen is None else records.upsert(seen, now, "path"), "seen", kind)
        open_ = held if done is None else records.pending(held, done)
        open_ = open_.select("file_path", "version", "content_md5")
        rounds = [None] if kind != "imp" else itertools.count(1)
        parts, known = [], []
        for k in rounds:
            paths = [r[0] for r in open_.select("file_path").collect()]
            part = f"{fresh}/pages-{k or 0}"
            read = read_pages(self._contents(paths), c.recogniser, k)
            read.join(open_, "file_path").write.parquet(part)
            read, parts = self.spark.read.parquet(part), [*parts, part]
            got = read.where("page_no > 0")
            if k is None or not got.head(1):
                break
            # files that lack a field go on to the next page, if they have had this one
            for v in ("V1", "V2"):
                has = [F.col(n).isNotNull().alias(n) for n in extract.NAMES]
                known.append(extract.read_fields(got.where(F.col("version") == v), kind, v, ["file_path"]).select("file_path", *has))
            every = known[-2].union(known[-1]) if len(known) == 2 else self.spark.read.parquet(f"{fresh}/known-{k - 1}").union(known[-2]).union(known[-1])
            every.groupBy("file_path").agg(*[F.max(n).alias(n) for n in extract.NAMES]).write.parquet(f"{fresh}/known-{k}")
            whole = self.spark.read.parquet(f"{fresh}/known-{k}").where(" AND ".join(extract.NAMES)).select("file_path")
            open_ = open_.join(got.select("file_path").distinct(), "file_path", "left_semi").join(whole, "file_path", "left_anti")
        return self.spark.read.parquet(*parts)

    def _extract(self, kind: str, out: Result) -> None:
        c = self.config
        if kind == "gto":
            mail = self.table("mail", kind)
            if mail is None:
                out.warnings.append("no mail table")
                return
            df = self._enrich(mail_rows(mail), kind).withColumn("Nombre personalizado", display_name("Proveedor", "Receiver"))
            parts = [F.coalesce(F.col(f"`{n}`"), F.lit("nan" if c.legacy_nan_id else "")) for n in ("Receiver", "Date", "Amount", "Nombre personalizado")]
            new = df.withColumns({"Estado": records.estado("lower"), "Version": F.lit("V1"), "id": record_id("gto", *parts)})
        else:
            # files are read and recognised once, also where their pages are needed several times
            fresh = self.versions(kind).folder("run")
            self.passing.append(fresh)
            pages = self._pages(kind, f"{self.config.root}/{kind}/{fresh}")
            if pages is None:
                out.warnings.append("no pages table and no files")
                return
            parts = []
            for v in ("V1", "V2"):
                own = pages.where(F.col("version") == v)
                parts.append(self._enrich(records.shape_records(extract.extract(own, kind, v, c.own_codes), v, limit=c.name_limit, path_in_id=c.path_in_id, keep_path=True).drop("Pais", "Ciudad"), kind))
            new = parts[0].unionByName(parts[1], allowMissingColumns=True)
        states = new.select("file_path", "Estado") if kind != "gto" else None
        new = conform(new.drop("file_path"), (*FINAL, "Version"))
        complete, manual = records.split_by_state(new)
        for name, part in (("complete", complete), ("manual", manual)):
            old = None if c.overwrite else self.table(name, kind)
            if old is not None:
                # a file that is read again leaves the other table
                old = records.anti_by_key(old, new.select("id"))
            out.counts[name] = self.write(part if old is None else old.unionByName(part, allowMissingColumns=True), name, kind)
        if kind != "gto":
            out.counts["manifest"] = self.write(self._marked(kind, pages, states), "manifest", kind)
            out.counts["errors"] = pages.where("page_no = 0 AND error IS NOT NULL").select("file_path").distinct().count()

    def _marked(self, kind: str, pages: DataFrame, states: DataFrame) -> DataFrame:
        """The manifest with the files of a run, by what came of them; files of one content by the first of their paths."""
        state = states.groupBy("file_path").agg(F.min("Estado").alias("state"))
        failed = F.max((F.col("page_no") == 0) & F.col("error").isNotNull())
        of = pages.groupBy("content_md5").agg(F.min(F.struct("file_path", "file_name", "version")).alias("f"), failed.alias("failed")).select("content_md5", "f.*", "failed")
        marks = of.join(state, "file_path", "left").select(
            "content_md5", F.col("file_name").alias("file"), "version", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("procesado_en"),
            F.when(F.col("failed") | F.col("state").isNull(), ERROR).otherwise(F.col("state")).alias("estado"),
        )
        done = self.table("manifest", kind)
        return marks if done is None else records.mark(done.select(*MANIFEST.names), marks)

    def _curate(self, kind: str, out: Result) -> None:
        complete, manual = self.table("complete", kind), self.table("manual", kind)
        if complete is None:
            out.warnings.append("no complete table")
            return
        if manual is not None:
            ready = manual.where(records.is_complete("no_date")).withColumn("Nombre personalizado", display_name("Proveedor", "Receiver"))
            n = records.anti_by_key(ready, complete).count()
            if n and self.confirm is not None and not self.confirm(n):
                out.warnings.append(f"{n} manual records stay")
            else:
                if n:
                    self.write(records.merge_new(complete, ready), "complete", kind)
                    complete = self.table("complete", kind)
                out.counts["moved"] = n
        history = self.table("history", kind)
        if history is None:
            history = conform(complete.limit(0), HISTORY)
        parts = [records.new_history(history, complete.where(F.col("Version") == v), v) for v in ("V1", "V2")]
        if parts[0].head(1) or parts[1].head(1):
            # an id of both versions is added once, as V1
            parts[1] = records.anti_by_key(parts[1], parts[0])
            self.write(conform(parts[0].unionByName(parts[1], allowMissingColumns=True), HISTORY), "history", kind, add=True)
        out.counts["history"] = history.count() if (now := self.table("history", kind)) is None else now.count()
        names = self.table("registry_names", kind)
        known = complete.limit(0).select("Nombre personalizado") if names is None else names.select("Nombre personalizado")
        out.counts["template"] = self.write(records.template_columns(records.template_rows(complete.drop("Version"), known), self.config.account), "template", kind)

    def _reconcile(self, kind: str, out: Result) -> None:
        complete, ledger = self.table("complete", kind), self.table("ledger", kind)
        if complete is None or ledger is None:
            out.warnings.append("no complete or ledger table")
            return
        c = self.config
        rows = cascade.filter_ledger(ledger, kind, c.earliest_ledger.isoformat())
        if kind == "gto":
            rows = cascade.drop_commissions(rows)
        keys = cascade.ledger_keys(rows, "CREDITO" if kind == "exp" else "DEBITO")
        # rows as they would stand in sheets: by version, file and id; equal ids all take the last row's form
        order = F.struct("Version", "`Nombre archivo`", "id")
        ordered = complete.withColumn("row_order", order)
        keys_of = cascade.message_keys(ordered, "Nombre archivo" if kind == "imp" else "Proveedor", ["row_order"])
        found = cascade.reconcile(keys_of, keys, kind == "imp", c.amount_tolerance, c.token_ratio, c.token_overlap, ["row_order"], held := [])
        try:
            out.counts |= cascade.match_counts(found).first().asDict()
            done = cascade.last_wins(complete, found, "row_order")
            names = self.table("registry_names", kind)
            if names is not None:
                known = registry_map(names, "Nombre personalizado", "Llave carga masiva", "src_order")
                best = argmax.best_by_tokens(done.select(F.col("Nombre personalizado").alias("name")), known, c.token_ratio, c.token_overlap)
                missing = argmax.unmatched_names(done.withColumn("row_order", order), best, "row_order").orderBy("first", "name").limit(20).collect()
                if missing:
                    log.warning("names without a key: %s", ", ".join(r["name"] for r in missing))
                done = argmax.fill_keys(done, best)
            self.write(done, "complete", kind)
        finally:
            for df in held:
                df.unpersist()
        done = self.table("complete", kind)
        out.counts |= records.filled_counts(done).first().asDict()
        registry = self.table("registry_rows", kind)
        if registry is not None:
            changed = records.update_registry(registry, records.number_keys(done.withColumn("row_order", order)))
            self.write(changed, "registry_out", kind)
            counts = {r["cambio"]: r["n"] for r in records.change_counts(self.table("registry_out", kind)).collect()}
            out.counts |= {f"registry_{k}": n for k, n in counts.items()}


def default_root() -> str:
    """The folder of the tables, by LEDGERLOOM_ROOT or the current one."""
    return os.environ.get("LEDGERLOOM_ROOT", ".")
