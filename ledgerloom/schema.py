"""Column names that are the data contract, and checks on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The order of the final records and of the history.
FINAL = ("id", "Nombre archivo", "Receiver", "Date", "Amount", "Proveedor", "Pais", "Ciudad", "Nombre personalizado", "Estado", "Formulario", "Llave")
HISTORY = (*FINAL, "Versión", "Fecha Control")
TEMPLATE = ("Cuenta compensación", "Nombre / Razón social", "País", "Ciudad", "Nombre personalizado", "Observaciones")
COMPLETE, INCOMPLETE, ERROR = "Completo", "Incompleto", "Error"
#: Texts that stand for a missing value.
SENTINELS = ("", "nan", "none", "nat", "<na>")

PAGES = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_name", T.StringType()), T.StructField("page_no", T.IntegerType()), T.StructField("text", T.StringType())])
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("content_md5", "file", "version", "procesado_en", "estado")])


def sentinel_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(~F.lower(text).isin(*SENTINELS), text)


def require_columns(df: DataFrame, names: Iterable[str], context: str = "") -> DataFrame:
    """Fail early if a column is missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"{context or 'table'}: missing columns {', '.join(missing)}")
    return df


def conform(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """D3: the named columns in order, null where missing; extra columns last."""
    names = list(names)
    have = [F.col(f"`{n}`") if n in df.columns else F.lit(None).cast("string").alias(n) for n in names]
    return df.select(*have, *[F.col(f"`{c}`") for c in df.columns if c not in names])


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("\u00a0", " ").strip() for c in df.columns])
