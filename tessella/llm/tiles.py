"""Tiles of a stated query set and all vectors: packed shards meet packed blocks of queries by a join on a part number.

Vectors are packed into shards (a row each), and shards are dealt to parts of about PART_SHARDS. Blocks of queries are sent
to every part, which is the search itself; nothing passes through the driver. In a part the blocks are streamed past its
shards, so a task holds a part's shards, one tile and the lists of the block at hand, whatever the number of queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SHARD_ROWS, BLOCK_ROWS, PART_SHARDS, FAN_IN = 8192, 512, 16, 16
#: Components of one pack.
PACK_CELLS = 1 << 20


def narrow(m: np.ndarray) -> np.ndarray:
    """m in the smallest integer type that holds it."""
    lo, hi = int(m.min(initial=0)), int(m.max(initial=0))
    return m.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def packed(rows: DataFrame, limit: int, columns: bool, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, label, v, *more) as packs of at most `limit` vectors of one length: by columns (a dimension end to end) or by rows.

    Longs in `more` are packed too; arrays of longs are packed end to end, all of one length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            off, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            size = np.diff(off)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                for lo in range(0, len(at), step := max(1, min(limit, PACK_CELLS // int(dim)))):
                    on = at[lo : lo + step]
                    m = narrow(flat[off[on][:, None] + np.arange(dim)])
                    m = np.ascontiguousarray(m.T) if columns else m
                    rest = [b.column(c).take(pa.array(on)) for c in ("id", "label", *more)]
                    rest = [(x.flatten() if pa.types.is_list(x.type) else x).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for x in rest]
                    yield pa.RecordBatch.from_arrays([pa.array([int(dim)], pa.int32()), pa.array([m.itemsize], pa.int32()), *[pa.array([x], pa.binary()) for x in (m.tobytes(), *rest)]], names)

    names = ["dim", "width", "cells", "ids", "labels", *more]
    return rows.select("id", "label", "v", *more).mapInArrow(run, "dim int, width int, " + ", ".join(f"{c} binary" for c in names[2:]))


def cells(width: int, data: bytes, shape: tuple[int, int]) -> np.ndarray:
    return np.frombuffer(data, f"i{width}").reshape(shape)


def parts_of(shards: DataFrame) -> tuple[int, int]:
    """(parts, shards): parts of PART_SHARDS shards, or as many as there are cores or shards if that is more."""
    count = shards.count()
    return max(1, -(-count // PART_SHARDS), min(count, shards.sparkSession.sparkContext.defaultParallelism)), count


def tiled(shards: DataFrame, blocks: DataFrame, parts: int, search: Callable[[Iterator[dict]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What `search` yields over the tiles: dicts of a block's columns and, with the prefix s_, a shard's.

    The tiles of a block follow each other where Spark merges sorted parts; `search` must be right in any order.
    """
    right = shards.select(F.pmod(F.xxhash64("ids", "cells"), F.lit(parts)).alias("part"), F.col("dim").alias("s_dim"), *[F.col(c).alias(f"s_{c}") for c in shards.columns if c != "dim"])
    left = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    # dealt by number, so that small tables aren't gathered in one task: the work is in the products, not in the bytes
    right, left = right.repartition(2 * parts, "part", "s_dim"), left.repartition(2 * parts, "part", "dim")
    joined = left.join(right.hint("merge"), (left["part"] == right["part"]) & (left["dim"] == right["s_dim"]))
    names = [*blocks.columns, *[f"s_{c}" for c in shards.columns if c != "dim"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from search({c: b.column(c)[i].as_py() for c in names} for b in batches for i in range(b.num_rows))

    return joined.select(*names).mapInArrow(run, schema)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids, best first; a partial selection precedes the sort."""
    if len(ids) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        on = scores >= bar
        ids, scores = ids[on], scores[on]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _merge(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    """One list per key: a bounded number of lists of k meet in each group."""
    one = F.transform(F.arrays_zip("ids", "scores"), lambda x: F.struct((-x["scores"]).alias("s"), x["ids"].alias("i")))
    top = F.slice(F.array_sort(F.flatten(F.collect_list(one))), 1, k)
    return lists.groupBy(*keys).agg(top.alias("top")).select(*keys, F.transform("top", lambda x: x["i"]).alias("ids"), F.transform("top", lambda x: -x["s"]).alias("scores"))


def merged(lists: DataFrame, keys: list[str], k: int, width: int) -> DataFrame:
    """One list of the k best (ids, scores) per key, as a tree: about FAN_IN of a key's lists meet in each group; `width` is a bound of a key's lists."""
    lists = lists.withColumn("_at", F.monotonically_increasing_id())
    while width > FAN_IN:
        width = -(-width // FAN_IN)
        lists = _merge(lists.withColumn("_at", F.pmod(F.xxhash64("_at"), F.lit(width))), [*keys, "_at"], k)
    return _merge(lists, keys, k)


def rows_of(lists: DataFrame, keys: list[str | Column], id_name: str) -> DataFrame:
    """(*keys, rank, id, score) of the lists, a row for each entry, ranks from 1."""
    x = lists.select(*keys, F.posexplode(F.arrays_zip("ids", "scores")).alias("_pos", "_x"))
    return x.withColumns({"rank": F.col("_pos") + 1, id_name: F.col("_x.ids"), "score": F.col("_x.scores")}).drop("_pos", "_x")


def stored_packs(rows: DataFrame, limit: int, columns: bool, name: str, more: tuple[str, ...] = ()) -> DataFrame:
    return stored(packed(rows, limit, columns, more), name)
