"""Shared helpers: written intermediate tables, Arrow word columns, 64-bit mixing."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Stand-in for a null doc_id, so that such rows sort first and join like any other.
NULL_ID = -(2**63)
#: UTF-8 bytes of text handled at once inside a task.
SLICE_BYTES = 2 << 20

#: Bytes of an Arrow batch that goes to a Python worker: the JVM holds it beside its heap, and the worker once more.
BATCH_BYTES = 4 << 20

_own_dir: dict[str, str] = {}
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); one of its own only where that is unset on a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="tessella-")
    return _own_dir[app]


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session to BATCH_BYTES, also for results that are written after this call.

    Spark's own bound is 64 MB for each task; a bound that the user has set stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, lost executors cost nothing.

    The files stay until clear_stored(), since results that are not written yet read them.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/tessella-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> int:
    """Delete the intermediate tables of this process; call it once the results that need them are written."""
    count = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, starts): df dealt by ranges of (group, order) and written sorted, and (*group, _part, _rows, _shift) of each part.

    A row's place within its group is `_at` + `_shift` of its group and part. However large a group is, no task has to hold
    or number it: only the counts of its parts are summed. Equal rows are dealt apart as well.
    """
    keys = [*group, *order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), name)
    parts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    return rows, stored(parts.select(*group, "_part", "_rows", shift.alias("_shift")), f"{name}-starts")


def row_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, text): id with nulls replaced, a hash of the text to tell apart rows that share an id, and the text."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"),
        F.xxhash64(F.col(text_col)).alias("th"),
        F.col(text_col).alias("text"),
    )


def real_id(col: str | Column = "did") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NULL_ID, c)


#: Bytes of one input split below which a small table is dealt out again.
SPLIT_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts that has less than a split for each core (often one row group, so one task) is spread over them."""
    small_batches(spark)
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    small = name in ("documents", "pages", "conversations") and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SPLIT_BYTES * cores
    return df.repartition(cores) if small else df


# ---------------------------------------------------------------- inside tasks


def give_back() -> None:
    """Return what this worker has freed to the system: workers outlive their tasks, and the C library keeps freed memory for itself."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `size` bytes of text (or one longer row)."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(sizes) // size
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, b.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield b.slice(int(lo), int(hi - lo))
    give_back()


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), vectorised."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=False) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows, end to end, and the n+1 row offsets; null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = pc.fill_null(text, "")
    wide = pa.types.is_large_string(text.type)
    off = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    buf = text.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


#: The library's white space: U+0020 and U+0009 to U+000D.
IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, off: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words in rows laid end to end, and the n+1 word offsets of the rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    solid = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    ends = solid
    ends = np.r_[solid[:-1] & (~solid[1:] | first[1:-1]), solid[-1]]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


_P = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    if len(_tables.get("up", ())) < n:
        m = max(n, SLICE_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            for name, base in (("up", _P), ("down", pow(_P, -1, 2**64))):
                out = np.full(m, base, np.uint64)
                out[0] = 1
                _tables[name] = np.multiply.accumulate(out)
    return _tables["up"], _tables["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span, by one running polynomial sum over all of them."""
    value = mix(np.arange(256, dtype=np.uint64), 1000 + seed)
    value = value[LOWER] if lower else value
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * up[: len(data)], out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: pa.Array, lower: bool, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word `[^\\x20\\x09-\\x0D]+` of all rows, and the n+1 row offsets."""
    data, off = text_bytes(text)
    starts, ends, rows = word_bounds(data, off, space)
    return span_hashes(data, starts, ends, lower), rows


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of h[i:i+k] for each i (across row borders too: callers mask those), by doubling."""
    with np.errstate(over="ignore"):
        out, done, power, width = None, 0, h, 1
        base = _BASE
        while True:
            if k & width:
                if out is None:
                    out = power
                else:  # append the next `width` words to the `done` words held so far
                    n = len(h) - (done + width) + 1
                    out = out[: max(n, 0)] * base + power[done : done + max(n, 0)]
                done += width
            if done == k:
                return mix(out)
            power = power[: max(len(power) - width, 0)] * base + power[width:]
            base = base * base
            width *= 2


def lookup(vocab: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in h, numbers in the sorted vocab) of the hashes that are in it."""
    if not len(vocab) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(1 << 20, bool)
    seen[(vocab & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(vocab, h[maybe]), len(vocab) - 1)
    hit = vocab[at] == h[maybe]
    return maybe[hit], at[hit]


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())
