"""Tables that replace only what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources import sheets


def write_sheets(df: DataFrame, path: str, by: str = "version") -> None:
    """Partitions that df has rows of are replaced, the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def patch(df: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """The column's new values by key; null updates change nothing. A missing column is added."""
    u = updates.select(F.col(key).alias("_key"), F.col(column).alias("_new")).where("_key IS NOT NULL")
    old = F.col(f"`{column}`") if column in df.columns else F.lit(None).cast("string")
    return df.join(u, F.col(key) == F.col("_key"), "left").withColumn(column, F.coalesce("_new", old)).drop("_key", "_new")


def export(df: DataFrame, path: str, kind: str = "csv", sheet: str = "Sheet1") -> None:
    """Rows for other programs. Kind xlsx: the named sheet of a workbook, whose other sheets stay (sources.sheets)."""
    if kind == "xlsx":
        sheets.register(df.sparkSession)
        df.write.format(sheets.FORMAT).mode("append").option("sheet", sheet).save(path)
    else:
        df.write.mode("overwrite").format(kind).option("header", "true").save(path)
