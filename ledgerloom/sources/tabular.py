"""Sheets as tables (A1-A7, A24): a missing file or sheet is an empty table, headers are cleaned, row order is kept."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import text_key
from ledgerloom.operators.argmax import keep_first
from ledgerloom.schema import MANIFEST, clean_headers, sentinel_to_null

#: Spreadsheet extensions; all others are read by Spark's own formats.
EXCEL = ("xlsx", "xlsm", "xltx", "xlsb")
FORMATS = {"csv": "csv", "json": "json", "orc": "orc", "parquet": "parquet", "txt": "text"}


def format_of(path: str) -> str:
    """A2."""
    end = path.rstrip("/").rpartition(".")[2].lower()
    return "excel" if end in EXCEL else FORMATS.get(end, "parquet")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_missing(e: AnalysisException) -> bool:
    """Whether an error says that there is no such path; all others are errors."""
    return e.getCondition() == "PATH_NOT_FOUND"


def read_workbook(spark: SparkSession, path: str, schema: T.StructType, sheet: str | None = None, header_row: int = 1, max_cols: int = 0, strict: bool = False) -> DataFrame:
    """A4, A5: rows of a workbook's sheet as text, with the number of the row in row_order or src_order if the schema
    has it; without a name, of the first sheet that has all columns. Read by Spark, so from any file system; a sheet that
    isn't there has no rows, or is an error if it is strict."""
    names = schema.names
    order = next((n for n in names if n in ("row_order", "src_order")), "")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        from ledgerloom.sources.workbook import table_rows

        for b in batches:
            for data in b["content"]:
                yield pd.DataFrame(table_rows(bytes(data), names, sheet, header_row, max_cols, order, strict), columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def read_sheet(spark: SparkSession, path: str, schema: T.StructType, sheet: str | None = None, header_row: int = 1, max_cols: int = 0, strict: bool = False, **options: str) -> DataFrame:
    """A1: the table, or an empty one with the same columns if there is none. Other errors are raised."""
    kind = format_of(path)
    if kind == "excel":
        found = exists(spark, path)
        return read_workbook(spark, path, schema, sheet, header_row, max_cols, strict) if found else spark.createDataFrame([], schema)
    reader = spark.read.format(kind).schema(schema).options(**options)
    if kind == "csv":
        reader = reader.option("header", "true")
    try:
        return clean_headers(reader.load(path))
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], schema)


def headers(df: DataFrame) -> dict[str, int]:
    """A3: places of columns, from 1."""
    return {c: k + 1 for k, c in enumerate(df.columns)}


def drop_blank_rows(df: DataFrame, keep: Iterable[str] = ("row_order",)) -> DataFrame:
    """A4: rows of blanks only go; the columns of keep don't count."""
    keep = set(keep)
    some = [sentinel_to_null(f"`{c}`").isNotNull() for c in df.columns if c not in keep]
    return df.where(F.exists(F.array(*some), lambda x: x))


def first_with_columns(tables: Iterable[DataFrame], names: Iterable[str], strict: bool = True) -> DataFrame | None:
    """A5: the first table that has all names."""
    wanted = set(names)
    for df in tables:
        if wanted <= set(df.columns):
            return df
    if strict:
        raise ValueError(f"no table has {', '.join(sorted(wanted))}")
    return None


def registry_map(df: DataFrame, name: str, key: str, order: str) -> DataFrame:
    """(nombre, llave, od_order), the first row of each name; a blank key is kept as a key."""
    rows = df.select(text_key(F.col(f"`{name}`")).alias("nombre"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("nan")).alias("llave"), F.col(order).alias("od_order"))
    return keep_first(rows.where("nombre <> '' AND llave <> ''"), "nombre", "od_order")


def mail_rows(df: DataFrame) -> DataFrame:
    """The four fields of a mail sheet; missing values are null, not text."""
    from ledgerloom.functions.dates import mail_date
    from ledgerloom.functions.money import mail_amount
    from ledgerloom.schema import require_columns

    require_columns(df, ("Receiver", "DATE", "Amount", "Beneficiary Customer"), "mail sheet")
    return df.select(
        F.upper(sentinel_to_null("Receiver")).alias("Receiver"), mail_date("DATE").alias("Date"), mail_amount("Amount").alias("Amount"),
        sentinel_to_null("`Beneficiary Customer`").alias("Proveedor"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of entries by digest, or a table; a missing or broken file is empty."""
    if format_of(path) != "json":
        return read_sheet(spark, path, MANIFEST)
    entry = "struct<file:string,version:string,procesado_en:string,estado:string>"
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    whole = spark.read.text(path, wholetext=True)
    found = whole.select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("content_md5", "e"))
    return found.select("content_md5", "e.file", "e.version", "e.procesado_en", "e.estado")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """As a JSON object of entries by digest, which read_manifest() reads. One object is one file, so this is for
    handing a manifest over; the engine keeps its own as a table."""
    entry = F.struct("file", "version", "procesado_en", "estado")
    pairs = F.map_from_entries(F.collect_list(F.struct("content_md5", entry.alias("e"))))
    manifest.agg(F.to_json(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)
