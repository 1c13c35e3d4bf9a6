"""Folders of message files: dates and layouts from paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import file_date, folder_day, folder_month, try_date


def list_files(spark: SparkSession, root: str, glob: str = "*.pdf") -> DataFrame:
    """(path, modificationTime, length, content) of all files below root; columns that aren't used aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)


def route(df: DataFrame, path: str, kind: str, year: Column, cutover: str, since: str) -> DataFrame:
    """df with file_name, file_date and version (V1 before the cut-over) of files not older than since.

    Incoming files are in month/day folders; outgoing ones have the date in their name, else they count for the first
    of their folder's month."""
    parts = F.split(path, "/")
    name, parent = F.element_at(parts, -1), F.element_at(parts, -2)
    if kind == "imp":
        date = folder_day(parent, year)
    else:
        date = F.coalesce(file_date(name), try_date(year.cast("string"), folder_month(parent).cast("string"), F.lit("1")))
    out = df.withColumns({"file_name": name, "file_date": date}).where(F.col("file_date") >= F.lit(since).cast("date"))
    return out.withColumn("version", F.when(F.col("file_date") < F.lit(cutover).cast("date"), "V1").otherwise("V2"))


def in_order(files: DataFrame) -> DataFrame:
    """By date and name, for showing; nothing else depends on an order of rows."""
    return files.orderBy("file_date", "file_name", "path")


def missing_targets(files: DataFrame, target: DataFrame, name: str = "file_name") -> DataFrame:
    """Files that the target folder doesn't have."""
    return files.join(target.select(name).distinct(), name, "left_anti")
