"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z, all other bytes as they are; bytes.split() then cuts at 0x20 and 0x09-0x0D only.
FOLD = bytes.maketrans(_UPPER, _LOWER)
#: As FOLD, and every byte of 00-2F, 3A-60 and 7B-7F (after folding) becomes a space.
FOLD_ALNUM = bytes(
    b if 0x30 <= b <= 0x39 or b >= 0x80 else FOLD[b] if 0x61 <= FOLD[b] <= 0x7A else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In local mode, where both are one process, a
    folder of our own stands in for it if it is unset; on a cluster that is an error."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        got = spark.sparkContext.getCheckpointDir()
    return got.rstrip("/")


_scratch: list[list[str]] = []


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    return stash_at(df, name)[0]


def stash_at(df: DataFrame, name: str, keep: bool = False) -> tuple[DataFrame, str]:
    """The table, and the folder that it is in; kept by the scratch() around it if so wished."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch and not keep:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stashed inside is deleted at the end, when results that depend on it have been written elsewhere."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Fewest and most bits of a bitmap of ids, BITS_PER_ID for each in between, and bits of one of hot keys: a 64th of them in
#: words of 16 bytes is all that is broadcast of any set of keys, 16 MB at most. Above the most, ever more rows that the
#: bitmap needn't hold are held as well and take the exact way behind it, up to all rows: results don't change.
BITS, MOST_BITS, BITS_PER_ID, HOT_BITS = 1 << 22, 1 << 26, 16, 1 << 18
#: Rows of a group from which on they are dealt to SALTS tasks.
HOT, SALTS = 500, 64
_WORD, _BITS, _SALT, _HOT = "\x00word", "\x00bits", "\x00salt", "\x00hot"


class Bitmap(NamedTuple):
    words: DataFrame
    n_bits: int


def _slot(df: DataFrame, keys: Sequence[str], n_bits: int) -> Column:
    """The bit of the keys; integers of any width that are equal have the same one."""
    col = lambda k: F.col(f"`{k}`").cast("long") if isinstance(df.schema[k].dataType, T.IntegralType) else F.col(f"`{k}`")
    return F.pmod(F.xxhash64(*map(col, keys)), F.lit(n_bits))


def bits_for(keys: DataFrame) -> int:
    """Bits of a bitmap of the rows of a table that has been written, so that it holds few others."""
    return max(BITS, min(MOST_BITS, 1 << (BITS_PER_ID * keys.count()).bit_length()))


def bitmap(df: DataFrame, keys: Sequence[str], n_bits: int | None = None) -> Bitmap:
    """The bits of the keys' hashes, as words of a bounded number; there is one at least, so plans don't depend on
    whether there are any keys."""
    n_bits = n_bits or BITS
    bits = df.select(_slot(df, keys, n_bits).alias("s")).selectExpr(f"cast(s div 64 AS int) AS `{_WORD}`", f"shiftleft(1L, cast(s % 64 AS int)) AS `{_BITS}`")
    none = df.sparkSession.range(1).select(F.lit(0).alias(_WORD), F.lit(0).cast("long").alias(_BITS))
    return Bitmap(bits.union(none).groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS)), n_bits)


def tag(df: DataFrame, bits: Bitmap, keys: Sequence[str], name: str) -> DataFrame:
    """df and a boolean: false for keys that the bitmap doesn't hold; true for all that it holds, and a few others."""
    at = _slot(df, keys, bits.n_bits)
    both = df.withColumn(_WORD, F.floor(at / 64).cast("int")).join(F.broadcast(bits.words), _WORD, "left")
    bit = F.col(_BITS).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))) != 0
    return both.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(bit, F.lit(False)).alias(name))


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without the rows whose id is in gone, a table of one column: only rows that its bitmap holds move."""
    gone = stash(gone.toDF("\x00gone").distinct(), "gone")
    tagged = tag(docs, bitmap(gone, ["\x00gone"], bits_for(gone)), [id_col], "\x00hit")
    some = tagged.where(F.col("\x00hit")).join(gone, F.col(f"`{id_col}`") == F.col("\x00gone"), "left_anti")
    return tagged.where(~F.col("\x00hit")).union(some).drop("\x00hit")


def only_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id the bitmap of ids, a table of one column, holds: all that are in it, and few others."""
    ids = stash(ids.toDF("\x00id").distinct(), "ids")
    return tag(docs, bitmap(ids, ["\x00id"], bits_for(ids)), [id_col], "\x00hit").where(F.col("\x00hit")).drop("\x00hit")


def join_hot(rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread: str | Sequence[str], how: str = "inner", sizes: DataFrame | None = None) -> DataFrame:
    """rows joined with groups by keys; sizes (else groups) holds the number of rows of each key in n.

    Rows of keys with HOT rows or more are dealt to SALTS tasks by a hash of the columns spread, and what groups has
    of those keys is repeated for each; which keys these are travels as a bitmap. No row is lost or doubled. Both
    sides are dealt by key whatever their size, so the plan is the same at all sizes."""
    keys = list(keys)
    spread = [spread] if isinstance(spread, str) else spread
    bits = bitmap((groups if sizes is None else sizes).where(F.col("n") >= HOT), keys, HOT_BITS)
    if sizes is None:
        groups = groups.drop("n")
    zero = F.lit(0).cast("long")
    salt = F.pmod(F.xxhash64(F.lit(7), *[F.col(c) for c in spread]), F.lit(SALTS))
    a = tag(rows, bits, keys, _HOT).withColumn(_SALT, F.when(F.col(_HOT), salt).otherwise(zero)).drop(_HOT)
    every = F.when(F.col(_HOT), F.sequence(zero, F.lit(SALTS - 1).cast("long"))).otherwise(F.array(zero))
    b = tag(groups, bits, keys, _HOT).withColumn(_SALT, F.explode(every)).drop(_HOT)
    return a.join(b.hint("merge"), [*keys, _SALT], how).drop(_SALT)


#: A key is heavy from this share of all rows on, so there are no more heavy keys than 1 / HEAVY, whatever the input.
HEAVY = 1 / 1000


def join_heavy(rows: DataFrame, lookup: DataFrame, key: str, spread: str | Sequence[str], salts: int = SALTS) -> DataFrame:
    """rows with the columns of lookup, a row a key at most, null where it has none; a null key has none.

    Rows of heavy keys are dealt to several tasks by a hash of the columns spread, and their rows of lookup repeated
    for each. Only the heavy keys are broadcast, 1,000 at most; all else goes by key, at every size alike."""
    spread = [spread] if isinstance(spread, str) else spread
    sizes = rows.groupBy(F.col(f"`{key}`").alias("\x00key")).agg(F.count("*").alias("\x00n"))
    total = rows.agg(F.count("*")).scalar()
    heavy = F.broadcast(sizes.where(F.col("\x00n") >= total * F.lit(HEAVY)).select("\x00key", F.lit(True).alias(_HOT)))
    zero = F.lit(0).cast("long")
    salt = F.pmod(F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c in spread]), F.lit(salts))
    at = lambda df: df.join(heavy, F.col(f"`{key}`").eqNullSafe(F.col("\x00key")), "left").drop("\x00key")
    a = at(rows).withColumn(_SALT, F.when(F.col(_HOT), salt).otherwise(zero)).drop(_HOT)
    every = F.when(F.col(_HOT), F.sequence(zero, F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
    b = at(lookup).withColumn(_SALT, F.explode(every)).drop(_HOT)
    return a.join(b.hint("merge"), [key, _SALT], "left").drop(_SALT)


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df and each row's place, from 1, in a total order, by a distributed sort: rows are dealt to ranges and sorted in
    them, and a row's place is its place in its range behind the rows of the ranges before.

    The sorted rows are written to the shared folder, so that ranges can't change between the steps. A row a range goes
    through one task; there are no more ranges than shuffle partitions."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("\x00at", F.monotonically_increasing_id())
    sorted_ = stash(sorted_, "sorted").withColumn("\x00range", F.shiftrightunsigned("\x00at", 33))
    sizes = sorted_.groupBy("\x00range").agg(F.count("*").alias("\x00n"))
    before = F.sum("\x00n").over(W.orderBy("\x00range").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("\x00range", F.coalesce(before, F.lit(0)).alias("\x00before"))
    place = F.col("\x00before") + F.col("\x00at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return sorted_.join(F.broadcast(starts), "\x00range").select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name))


def long_id(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The ids as long integers, from integers of any width; ids of other types are an error that says so."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer, not {docs.schema[id_col].dataType.simpleString()}; ranked() numbers rows of any kind")
    return F.col(f"`{id_col}`").cast("long").alias(id_col)


def text_bytes(text: str | Column) -> Column:
    """A text as its UTF-8 bytes; null counts as empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("binary"), F.lit(b""))


def _bytes(size: str) -> float:
    """Of a size as Spark writes it, such as 64m or 67108864b; no limit if it is none."""
    digits, unit = size.rstrip("bB ").rstrip("kmgtKMGT"), size.rstrip("bB ")[-1:].lower()
    n = int(digits or -1) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0)
    return n if n > 0 else float("inf")


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """Keep Arrow batches to a few MB whatever the length of the texts. Plans run later than they are made, so this
    holds for the session; what the caller has set lower stays."""
    size, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    if _bytes(spark.conf.get(size)) > _bytes(most):
        spark.conf.set(size, most)
    if not 0 < int(spark.conf.get(rows)) <= 4096:
        spark.conf.set(rows, "4096")


_held: dict[str, Callable[[], None]] = {}


def claim(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called where an operator starts in a Python worker: what other operators have cached there is dropped and given
    back to the system, since workers live on from stage to stage and their memory adds up."""
    others = [n for n in _held if n != owner]
    for name in others:
        _held.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)
    _held[owner] = clear


def merge_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
