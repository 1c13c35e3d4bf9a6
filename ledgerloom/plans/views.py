"""Role views: the tables of this domain, made from order tables. Each view also has its SQL, as a CTE."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAMED = ("id", "Receiver", "Date", "Amount", "Proveedor", "Pais", "Ciudad", "Nombre personalizado", "Estado", "Formulario", "Llave")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset, the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def stash(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Writes a table to the shared folder and reads it again, so that several steps don't each compute it."""

    def write(df: DataFrame) -> DataFrame:
        path = f"{shared(spark)}/stash-{uuid.uuid4().hex}.parquet"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write


def msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, fecha_key, proveedor, amount) of every order; amounts that sums, single rows, other or no rows settle."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("total"), F.min("l_extendedprice").alias("least"))
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    kind = F.col("o_orderkey") % 4
    amount = F.when(kind == 0, F.round("total", 2)).when(kind == 1, F.col("least")).when(kind == 2, F.col("o_totalprice"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("k"), "left").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("fecha_key"), F.col("c_name").alias("proveedor"), amount.alias("amount")
    )


MSGS = """lines AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS total, min(l_extendedprice) AS least FROM lineitem GROUP BY 1),
msgs AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS fecha_key, c_name AS proveedor,
  CASE o_orderkey % 4 WHEN 0 THEN round(total, 2) WHEN 1 THEN least WHEN 2 THEN o_totalprice END AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = k)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fecha_key, detalle, monto, formulario, row_order) of every line; some have no form."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("fecha_key"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # customers meet orders, of which there are fewer than lines; lines, whose size is guessed too small, aren't broadcast
    named = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    rows = table(spark, sf_dir, "lineitem").join(named.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    order = F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber") * 100_000 + F.col("l_partkey")
    other = (F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")) % 7 == 0
    detail = F.concat(F.when(other, "other firm").otherwise(F.translate("c_name", "#", " ")), F.lit(" # "), F.col("l_linenumber").cast("string"))
    form = F.when((F.col("l_orderkey") + F.col("l_partkey")) % 13 == 0, "").otherwise(order.cast("string"))
    return rows.select("fecha_key", detail.alias("detalle"), F.col("l_extendedprice").alias("monto"), form.alias("formulario"), order.alias("row_order"))


LEDGER = """ledger AS (SELECT CAST(o_orderdate AS DATE) AS fecha_key,
  CASE WHEN (l_orderkey + l_linenumber + l_partkey) % 7 = 0 THEN 'other firm' ELSE replace(c_name, '#', ' ') END || ' # ' || l_linenumber AS detalle,
  l_extendedprice AS monto, CASE WHEN (l_orderkey + l_partkey) % 13 = 0 THEN '' ELSE CAST(l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS VARCHAR) END AS formulario,
  l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS row_order
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def directory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, country, city, src_order) of suppliers: 8 and 11 characters, some invalid, some twice."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    base = F.concat(F.lit("BK"), F.lpad((key % 60).cast("string"), 6, "0"))
    code = F.when(key % 7 == 0, F.lit("BAD")).when(key % 3 == 0, F.concat(base, F.lit("XXX"))).when(key % 3 == 1, F.lower(base)).otherwise(F.concat(F.lit(" "), base))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(code.alias("code"), F.col("n_name").alias("country"), F.col("s_name").alias("city"), key.alias("src_order"))


DIRECTORY = """directory_rows AS (SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'BAD' WHEN s_suppkey % 3 = 0 THEN 'BK' || lpad(CAST(s_suppkey % 60 AS VARCHAR), 6, '0') || 'XXX'
    WHEN s_suppkey % 3 = 1 THEN lower('BK' || lpad(CAST(s_suppkey % 60 AS VARCHAR), 6, '0')) ELSE ' BK' || lpad(CAST(s_suppkey % 60 AS VARCHAR), 6, '0') END AS code,
  n_name AS country, s_name AS city, s_suppkey AS src_order FROM supplier JOIN nation ON s_nationkey = n_nationkey),
coded AS (SELECT *, upper(trim(code)) AS t FROM directory_rows),
directory AS (SELECT code11, arg_min(country, src_order) AS pais, arg_min(city, src_order) AS ciudad FROM
  (SELECT *, CASE length(t) WHEN 8 THEN t || 'XXX' WHEN 11 THEN t END AS code11 FROM coded) WHERE code11 IS NOT NULL GROUP BY 1)"""


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nombre, llave, od_order) of customers, some names cut short."""
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.lit("Firm "), F.translate("c_name", "#", " "), F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(F.lit(" BANKUS33XXX")))
    return c.select(name.alias("nombre"), F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("llave"), F.col("c_custkey").alias("od_order"))


REGISTRY = """registry AS (SELECT 'Firm ' || replace(c_name, '#', ' ') || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ' BANKUS33XXX' END AS nombre,
  'K' || c_custkey AS llave, c_custkey AS od_order FROM customer)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of every message, with gaps and with texts that stand for gaps."""
    k = F.col("id")
    receiver = F.when(k % 11 == 0, None).when(k % 13 == 0, F.lit("nan")).otherwise(F.concat(F.lit("BK"), F.lpad((k % 97).cast("string"), 6, "0"), F.when(k % 2 == 0, F.lit("XXX")).otherwise(F.lit(""))))
    date = F.when(k % 9 == 0, None).when(k % 17 == 0, F.lit("31/31/2020")).otherwise(F.date_format("fecha_key", "yyyy-MM-dd"))
    amount = F.when(F.col("amount").isNull(), None).when(k % 19 == 0, F.lit("None")).otherwise(F.format_string("%.2f", F.col("amount")))
    supplier = F.when(k % 23 == 0, F.lit("  ")).when(k % 29 == 0, F.lit("nan")).otherwise(F.col("proveedor"))
    return msgs(spark, sf_dir).select(k, receiver.alias("Receiver"), date.alias("Date"), amount.alias("Amount"), supplier.alias("Proveedor"))


RECORDS = f"""{MSGS},
records AS (SELECT id, CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN 'nan' ELSE 'BK' || lpad(CAST(id % 97 AS VARCHAR), 6, '0') || CASE WHEN id % 2 = 0 THEN 'XXX' ELSE '' END END AS Receiver,
  CASE WHEN id % 9 = 0 THEN NULL WHEN id % 17 = 0 THEN '31/31/2020' ELSE strftime(fecha_key, '%Y-%m-%d') END AS Date,
  CASE WHEN amount IS NULL THEN NULL WHEN id % 19 = 0 THEN 'None' ELSE printf('%.2f', amount) END AS Amount,
  CASE WHEN id % 23 = 0 THEN '  ' WHEN id % 29 = 0 THEN 'nan' ELSE proveedor END AS Proveedor FROM msgs)"""


def styled(price: str, key: str) -> Column:
    """An amount with two decimals in one of five spellings."""
    us = F.format_number(F.col(price), 2)
    eu = F.translate(us, ",.", ".,")
    kind = F.col(key) % 5
    return F.when(kind == 0, F.format_string("%.2f", F.col(price))).when(kind == 1, us).when(kind == 2, eu).when(kind == 3, F.concat(F.lit("#"), eu, F.lit("#"))).otherwise(F.concat(F.lit("USD "), F.translate(us, ",.", " ,")))


STYLED = """styled AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN printf('%.2f', o_totalprice) WHEN 1 THEN us WHEN 2 THEN translate(us, ',.', '.,')
    WHEN 3 THEN '#' || translate(us, ',.', '.,') || '#' ELSE 'USD ' || translate(us, ',.', ' ,') END AS txt
  FROM (SELECT *, format('{:,.2f}', o_totalprice) AS us FROM orders))"""
