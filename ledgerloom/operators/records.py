"""Records: directory, completeness, merging, history, template, registry, manifest, quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import is_date
from ledgerloom.functions.ids import bank_code, display_name, form_numbers, form_text, is_bank_code, record_id, shorten_name
from ledgerloom.functions.money import clean_amount
from ledgerloom.functions.text import strip
from ledgerloom.operators.argmax import keep_first
from ledgerloom.schema import COMPLETE, ERROR, FINAL, HISTORY, INCOMPLETE, conform, require_columns, sentinel_to_null

FIELDS = ("Receiver", "Date", "Amount", "Proveedor")


# --- directory ---------------------------------------------------------------------------------------------------


def directory(df: DataFrame, code: str, country: str, city: str, order: str) -> DataFrame:
    """(code11, pais, ciudad), the first row of each valid code."""
    rows = df.select(bank_code(F.col(f"`{code}`")).alias("code11"), F.col(f"`{country}`").alias("pais"), F.col(f"`{city}`").alias("ciudad"), F.col(order).alias("o"))
    return keep_first(rows.where("code11 IS NOT NULL"), "code11", "o").drop("o")


def add_places(df: DataFrame, of: DataFrame, upper: bool = True) -> DataFrame:
    """Pais and Ciudad from the directory; Catalyst broadcasts it if its size allows."""
    up = (lambda c: F.upper(F.trim(c))) if upper else (lambda c: F.col(c))
    out = df.drop("Pais", "Ciudad").withColumn("_code", bank_code("Receiver")).join(of.withColumnRenamed("code11", "_code"), "_code", "left")
    return out.withColumn("Pais", up("pais")).withColumn("Ciudad", up("ciudad")).drop("_code")


# --- completeness ------------------------------------------------------------------------------------------------


def _all(names, ok) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(ok(F.col(n)), F.lit(False)) for n in names])


def is_complete(policy: str) -> Column:
    """`truthy` (a), `filled` (b), `exact` (c, sentinels in their case), `no_date` (d), `lower` (e)."""
    if policy == "truthy":
        return _all(FIELDS, lambda c: c != "")
    if policy == "filled":
        return _all(FIELDS, lambda c: strip(c) != "")
    if policy == "exact":
        return _all(FIELDS, lambda c: ~strip(c).isin("", "nan", "None", "NaT", "NaN"))
    if policy == "no_date":
        return _all(("Receiver", "Proveedor", "Amount"), lambda c: ~F.lower(strip(c)).isin("", "nan", "none", "nat"))
    if policy == "lower":
        return _all(FIELDS, lambda c: ~F.lower(strip(c)).isin("", "nan", "none", "nat"))
    raise ValueError(policy)


def estado(policy: str) -> Column:
    return F.when(is_complete(policy), COMPLETE).otherwise(INCOMPLETE)


# --- shaping -----------------------------------------------------------------------------------------------------


def shape_records(extracted: DataFrame, version: str, prefix: str = "app", limit: int = 50, path_in_id: bool = False, keep_path: bool = False) -> DataFrame:
    """Extracted fields as records with amount, display name, state and id. path_in_id: files of one name in
    several folders have ids of their own. keep_path: with the column file_path."""
    out = extracted.select(
        F.col("file_name").alias("Nombre archivo"), F.col("receiver").alias("Receiver"), F.col("date").alias("Date"),
        clean_amount("amount").alias("Amount"), F.col("beneficiary").alias("Proveedor"), F.col("file_path").alias("_path") if path_in_id else F.col("file_name").alias("_path"),
        *(["file_path"] if keep_path else []),
    )
    out = out.withColumn("Nombre personalizado", shorten_name(display_name("Proveedor", "Receiver"), limit)).withColumn("Estado", estado("filled"))
    return conform(out.withColumn("id", record_id(prefix, F.lit(version), F.col("_path"))).drop("_path"), FINAL).withColumn("Version", F.lit(version))


def split_by_state(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("Estado") == COMPLETE), df.where(F.col("Estado") != COMPLETE)


# --- life cycle --------------------------------------------------------------------------------------------------


def anti_by_key(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """Rows of new whose key old doesn't have; null equals null; repeats within new stay."""
    o = old.select(F.col(f"`{key}`").alias("_key")).distinct()
    return new.join(o, new[key].eqNullSafe(F.col("_key")), "left_anti")


def new_rows(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """As anti_by_key(), where old is the larger one: old is asked for the keys of new, which Catalyst sends to it if
    they are few, so old isn't shuffled; only keys that it has move."""
    keys = new.select(F.col(f"`{key}`").alias("_asked")).distinct()
    known = old.select(key).join(keys, old[key].eqNullSafe(F.col("_asked")), "left_semi").distinct()
    return anti_by_key(new, known, key)


def merge_new(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Old, and new rows of new keys marked complete."""
    require_columns(old, [key]), require_columns(new, [key])
    return old.unionByName(anti_by_key(new, old, key).withColumn("Estado", F.lit(COMPLETE)), allowMissingColumns=True)


def accumulate(history: DataFrame, complete: DataFrame, version: str, control: Column | None = None) -> DataFrame:
    """History, and the complete rows of new ids with version and control time."""
    return history.unionByName(new_history(history, complete, version, control), allowMissingColumns=True)


def new_history(history: DataFrame, complete: DataFrame, version: str, control: Column | None = None) -> DataFrame:
    """The rows alone that accumulate() adds."""
    at = F.date_format(F.current_timestamp() if control is None else control, "yyyy-MM-dd HH:mm")
    return new_rows(conform(complete.withColumns({"Versión": F.lit(version), "Fecha Control": at}), HISTORY), history)


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """X3 fixed: new rows replace old rows of their id, the others stay."""
    return anti_by_key(old, new, key).unionByName(new, allowMissingColumns=True)


def template_rows(complete: DataFrame, registry_names: DataFrame, name: str = "Nombre personalizado", by_name: bool = False) -> DataFrame:
    """Complete rows, distinct, with short names that the registry doesn't have (exact but trimmed)."""
    rows = complete.where(F.col("Estado") == COMPLETE)
    rows = rows.dropDuplicates([name]) if by_name else rows.distinct()
    rows = rows.withColumn(name, shorten_name(F.col(f"`{name}`")))
    known = registry_names.select(strip(F.col(registry_names.columns[0])).alias("_name")).where("_name <> ''").distinct()
    return rows.join(known, strip(F.col(f"`{name}`")) == F.col("_name"), "left_anti")


def template_columns(df: DataFrame, account: str) -> DataFrame:
    """The upload columns, with the account that the caller gives."""
    return df.select(F.lit(account).alias("Cuenta compensación"), F.col("Proveedor").alias("Nombre / Razón social"), F.col("Pais").alias("País"), "Ciudad", "Nombre personalizado")


def lineage(raw: DataFrame, written: DataFrame, excluded_by: DataFrame, name: str = "Nombre personalizado") -> DataFrame:
    """rows of each step of the template in one row."""
    complete = raw.where(F.col("Estado") == COMPLETE)
    step = lambda df, t: df.select(F.lit(t).alias("t"))
    every = step(complete, 0).union(step(complete.distinct(), 1)).union(step(written, 2))
    n = lambda t: F.count_if(F.col("t") == t)
    return every.agg(n(0).alias("n_raw"), (n(0) - n(1)).alias("n_duplicates"), (n(1) - n(2)).alias("n_excluded"), n(2).alias("n_written"))


# --- registry ----------------------------------------------------------------------------------------------------


def number_keys(msgs: DataFrame, forms: str = "Formulario", key: str = "Llave", order: str = "row_order") -> DataFrame:
    """(numero, llave): the key of the first message with each form number."""
    rows = msgs.where(F.trim(key) != "").select(F.col(order).alias("o"), F.col(key).alias("llave"), F.posexplode(form_numbers(forms)).alias("p", "numero"))
    return rows.groupBy("numero").agg(F.min_by("llave", F.struct("o", "p")).alias("llave"))


def update_registry(rows: DataFrame, keys: DataFrame, number: str = "Consecutivo", key: str = "Llave Origen Destino") -> DataFrame:
    """Rows with their new key and cambio: nuevo, actualizado, igual, sin_match."""
    k = keys.select(F.col("numero").alias("_n"), F.col("llave").alias("_new"))
    old = F.coalesce(F.trim(F.col(f"`{key}`")), F.lit(""))
    out = rows.join(k, form_text(F.col(f"`{number}`")) == F.col("_n"), "left")
    change = F.when(F.col("_new").isNull(), "sin_match").when(old == "", "nuevo").when(old != F.col("_new"), "actualizado").otherwise("igual")
    return out.withColumn("cambio", change).withColumn(key, F.coalesce("_new", F.col(f"`{key}`"))).drop("_n", "_new")


def change_counts(rows: DataFrame) -> DataFrame:
    """how many registry rows are new, updated, as before, or without a match."""
    return rows.groupBy("cambio").agg(F.count("*").alias("n"))


# --- manifest ----------------------------------------------------------------------------------------------------


def with_md5(files: DataFrame, content: str = "content") -> DataFrame:
    """B20."""
    return files.withColumn("content_md5", F.md5(F.col(content).cast("binary")))


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest doesn't hold as processed without error."""
    done = manifest.where(F.col("estado").isNotNull() & (F.col("estado") != ERROR)).select("content_md5").distinct()
    return files.join(done, "content_md5", "left_anti")


def unread(listing: DataFrame, seen: DataFrame, manifest: DataFrame) -> DataFrame:
    """E15 without reading files: those of a listing (path, length, modificationTime) that haven't been seen just so, or
    whose content isn't processed without error. seen has path, length, modified and content_md5."""
    ok = manifest.where(F.col("estado").isNotNull() & (F.col("estado") != ERROR)).select("content_md5").distinct()
    done = seen.join(ok, "content_md5", "left_semi").select(F.col("path").alias("_p"), F.col("length").alias("_l"), "modified")
    return listing.join(done, (F.col("path") == F.col("_p")) & (F.col("length") == F.col("_l")) & (F.col("modificationTime") == F.col("modified")), "left_anti")


def mark(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """K8: entries of done replace those of the same content."""
    return upsert(manifest, done, "content_md5")


def cleared(manifest: DataFrame) -> DataFrame:
    """K8: no entries, so that every file is read again."""
    return manifest.limit(0)


def unmark(manifest: DataFrame, content_md5: str) -> DataFrame:
    return manifest.where(F.col("content_md5") != content_md5)


def manifest_stats(manifest: DataFrame) -> DataFrame:
    """F10."""
    return manifest.groupBy(F.coalesce("estado", F.lit("None")).alias("estado")).agg(F.count("*").alias("n"))


# --- counts ------------------------------------------------------------------------------------------------------


def is_amount(c: str | Column) -> Column:
    """The last separator is the decimal one, and a number is left."""
    s = F.regexp_replace(F.col(c) if isinstance(c, str) else c, "[^0-9.,]", "")
    dot_last = F.when(~s.contains("."), False).when(~s.contains(","), True).otherwise(F.locate(".", F.reverse(s)) < F.locate(",", F.reverse(s)))
    plain = F.when(dot_last, F.replace(s, F.lit(","), F.lit(""))).otherwise(F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return F.coalesce(plain.rlike(r"^(\d+\.?\d*|\.\d+)$"), F.lit(False))


def quality_report(df: DataFrame) -> DataFrame:
    """F9 with D7-D9: how many rows have each field, and a valid one."""
    has = lambda c: sentinel_to_null(c).isNotNull()
    return df.agg(
        F.count("*").alias("n"), *[F.count_if(has(c)).alias(f"has_{c.lower()}") for c in FIELDS],
        F.count_if(has("Receiver") & is_bank_code("Receiver")).alias("valid_receiver"), F.count_if(has("Date") & is_date("Date")).alias("valid_date"),
        F.count_if(has("Amount") & is_amount("Amount")).alias("valid_amount"), F.count_if(is_complete("exact")).alias("complete"),
    )


def ready_pending(manual: DataFrame) -> DataFrame:
    """F8."""
    return manual.agg(F.count_if(is_complete("no_date")).alias("ready"), F.count_if(~is_complete("no_date")).alias("pending"))


def status_totals(df: DataFrame) -> DataFrame:
    """F7."""
    return df.groupBy("Estado").agg(F.count("*").alias("n"))


def filled_counts(df: DataFrame) -> DataFrame:
    """F6."""
    return df.agg(F.count_if(F.trim("Formulario") != "").alias("with_form"), F.count_if(F.trim("Llave") != "").alias("with_key"))

