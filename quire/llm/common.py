"""What the operators of this subpackage share: the shared folder, written tables, Arrow helpers."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that goes to a Python worker: rows alone, 10,000 of them, don't bound it when texts are long.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless it has a bound of its own; a single longer row still passes whole."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


@lru_cache(1)
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="quire-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a temporary folder in local
    mode, as in tests; on a cluster it must be set, since executors don't share the driver's disk."""
    bound_batches(spark)
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _local_dir()
    return found.rstrip("/")


#: Paths that the operator which runs now has written, and not its callers.
_made: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("made", default=None)


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append((spark, path))
    return path


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """Has the file system delete what was written there when the driver ends; it forgets paths that don't exist yet."""
    fs, at = _file(spark, path)
    fs.deleteOnExit(at)


def make_folder(spark: SparkSession, path: str) -> str:
    """Makes a folder and gives its name with the scheme, by which other readers than Hadoop's find it, too."""
    fs, at = _file(spark, path)
    fs.mkdirs(at)
    return fs.makeQualified(at).toString()


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a path now."""
    fs, at = _file(spark, path)
    fs.delete(at, True)
    fs.cancelDeleteOnExit(at)


def stash(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again. That cuts the lineage, survives lost executors, and lets Spark
    know the true size before it picks a join."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    keep_until_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def paths_of(df: DataFrame) -> set[str]:
    """The last parts of the folders that a plan reads."""
    return {file.rsplit("/", 2)[-2] for file in df.inputFiles()}


def drop(*frames: DataFrame) -> None:
    """Deletes the written tables that these read."""
    for df in frames:
        for last in paths_of(df):
            discard(df.sparkSession, f"{shared_dir(df.sparkSession)}/{last}")


def tidy(operator: Callable) -> Callable:
    """Deletes the tables that an operator has written, as soon as it returns, but for those that its result reads: they
    go when the driver ends, or when an operator that called this one returns. Bitmaps are small and read in subqueries,
    which a plan doesn't name, so they stay, too."""

    @wraps(operator)
    def run(*args, **kwargs):
        outer, made = _made.get(), []
        token = _made.set(made)
        used: set[str] = set()
        try:
            found = operator(*args, **kwargs)
            frames = [x for x in (found, *vars(found).values()) if isinstance(x, DataFrame)] if not isinstance(found, DataFrame) else [found]
            used = set().union(*map(paths_of, frames)) if frames else set()
            return found
        finally:
            _made.reset(token)
            for spark, path in made:
                last = path.rsplit("/", 1)[-1]
                if last in used or last.startswith(KEPT):
                    if outer is not None:
                        outer.append((spark, path))
                else:
                    discard(spark, path)

    return run


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of text in a column over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.coalesce(F.col(column), F.lit("")))), F.lit(0))).head()[0]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Starts and ends of each string in one bytes object; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), b""
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    base = int(offsets[0])
    body = data.slice(base, int(offsets[-1]) - base).to_pybytes() if data is not None else b""
    return offsets[:-1] - base, offsets[1:] - base, body


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text each (one row at least), to bound the memory of what is computed from them."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = int(total[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Returns free memory to the system: a worker lives on after its task, and what it keeps adds up over stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Names of what plans read without naming it.
KEPT = ("bitmap-", "tokens-")
#: Least and most bits of a bitmap of keys: 8 KB to 8 MB in a plan's subquery, for any input.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26


@dataclass
class Bitmap:
    table: DataFrame | None  # one row, one column, written to the shared folder; none lets every key through
    bits: int = 0


def key_bitmap(keys: DataFrame, *columns: str) -> Bitmap:
    """A bitmap with the hash of each key, of a size that goes with their number: 16 bits a key at least, 8 MB at most. Of
    more than 16 million keys it would hardly keep anything back, so there is none: then every row is shuffled, once, as
    a join does by itself. What uses it must be right for any key that it lets through. It is made and written by
    executors; plans read it as a scalar subquery, since a literal is kept with the text of each plan at the driver."""
    n = keys.count()
    if 4 * n > MOST_BITS:
        return Bitmap(None)
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(n, 1) - 1).bit_length()))
    spot = F.pmod(F.xxhash64(*columns), F.lit(bits))
    words = keys.select(spot.alias("spot")).groupBy((F.col("spot") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("mask"))
    every = keys.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("word"), "left")  # bits / 64 rows
    digits = F.collect_list(F.struct("id", F.lpad(F.hex(F.coalesce("mask", F.lit(0))), 16, "0").alias("hex")))
    joined = every.agg(F.unhex(F.array_join(F.transform(F.array_sort(digits), lambda x: x.hex), "")).alias("bitmap"))
    return Bitmap(stash(joined, "bitmap"), bits)


def may_hold(bitmap: Bitmap, *columns: str) -> Column:
    """Whether a row's key may be in the bitmap."""
    if bitmap.table is None:
        return F.lit(True)
    spot = F.pmod(F.xxhash64(*columns), F.lit(bitmap.bits))
    place = F.shiftright(spot, 6) * 8 + 8 - F.shiftright(F.pmod(spot, F.lit(64)), 3)  # words are big-endian, places count from 1
    byte = F.conv(F.hex(F.substring(bitmap.table.scalar(), place.cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.call_function("getbit", byte, F.pmod(spot, F.lit(8)).cast("int")) == 1


@tidy
def keep_rows(docs: DataFrame, decisions: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of docs that ``decisions(key, th, kept)`` keep; th is ``xxhash64(text)``, a decision stands for each row.

    Only rows that may be among those to go are shuffled with their texts, the others pass. Of rows that are equal in key
    and text, of which some stay, one stays: the smallest by its other columns in their order, as far as they can be
    ordered, else any.
    """
    gone = decisions.groupBy(F.col("key").alias("_quire_k"), F.col("th").alias("_quire_t")).agg(F.max("kept").alias("_quire_any"), F.min("kept").alias("_quire_all"))
    gone = stash(gone.where("not _quire_all"), "gone")
    names, marks = docs.columns, ["_quire_key", "_quire_th"]
    rows = docs.withColumns({marks[0]: F.col(f"`{key}`"), marks[1]: F.xxhash64(F.col(f"`{text}`"))})
    maybe = may_hold(key_bitmap(gone, "_quire_k", "_quire_t"), *marks)
    met = rows.where(maybe).join(gone, F.col(marks[0]).eqNullSafe(F.col("_quire_k")) & (F.col(marks[1]) == F.col("_quire_t")), "left")
    stay = met.where("_quire_any is null").select(*[F.col(f"`{c}`") for c in names])
    one = F.first if re.search("map<|variant", docs.schema.simpleString()) else F.min
    once = met.where("_quire_any").groupBy(*marks).agg(one(F.struct(*[F.col(f"`{c}`") for c in names])).alias("row")).select("row.*")
    return rows.where(~maybe).select(*[F.col(f"`{c}`") for c in names]).unionByName(stay).unionByName(once)
