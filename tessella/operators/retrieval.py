"""Chunks, exact cosine search, and what a chat prompt needs of its hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .lifecycle import latest_by_key, upsert

# Separators from coarse to fine.
SEPARATORS = ["\n\n", "\n", ".", " ", ""]


def _cuts(text: str, start: int, end: int, separator: str) -> np.ndarray:
    """Where the parts of text[start:end] begin, and its end: a part begins with the separator before it."""
    if separator == "":
        return np.arange(start, end + 1)
    out, at = [start], text.find(separator, start, end)
    while at >= 0:
        out.append(at)
        at = text.find(separator, at + len(separator), end)
    return np.array([*out, end])


def _merged(cut: np.ndarray, size: int, overlap: int) -> list[tuple[int, int]]:
    """Chunks of consecutive parts, as many as fit; the next chunk begins with the parts at its end that lie within the overlap."""
    out, first, at, last = [], 0, 1, len(cut) - 1
    while True:
        # the first part, after one at least, that no longer fits
        at = max(at, int(np.searchsorted(cut, cut[first] + size, side="right")) - 1)
        if at >= last:
            return [*out, (int(cut[first]), int(cut[last]))]
        out.append((int(cut[first]), int(cut[at])))
        first = min(at, int(max(np.searchsorted(cut, cut[at] - overlap), np.searchsorted(cut, cut[at + 1] - size))))
        at += 1


def chunk_spans(text: str, size: int = 1000, overlap: int = 200, start: int = 0, end: int | None = None, separators: list[str] | None = None) -> list[tuple[int, int]]:
    """(start, end) of the chunks of recursive character splitting: cut at the coarsest separator that occurs, parts merged up to size,
    longer parts cut at the finer ones. Offsets only: a chunk costs two searches among the cuts, however many parts it has."""
    separators, end = SEPARATORS if separators is None else separators, len(text) if end is None else end
    at = next((i for i, s in enumerate(separators) if s == "" or text.find(s, start, end) >= 0), len(separators) - 1)
    cut, finer = _cuts(text, start, end, separators[at]), separators[at + 1 :]
    long = np.flatnonzero(np.diff(cut) > size) if finer else []
    out, done = [], 0
    for i in [*long, len(cut) - 1]:
        if i > done:
            out += _merged(cut[done : i + 1], size, overlap)
        if i < len(cut) - 1:
            out += chunk_spans(text, size, overlap, int(cut[i]), int(cut[i + 1]), finer)
        done = i + 1
    return out


def split_text(text: str, size: int = 1000, overlap: int = 200) -> list[str]:
    """The chunks' texts, stripped; blank ones are left out."""
    return [c for a, b in chunk_spans(text, size, overlap) if (c := text[a:b].strip())]


@F.arrow_udf(T.ArrayType(T.StringType()))
def text_chunks(text: pa.Array) -> pa.Array:
    return pa.array([split_text(t) if t else [] for t in text.to_pylist()], pa.list_(pa.string()))


def chunk_table(docs: DataFrame, id_col: str, text_col: str, *extra: str) -> DataFrame:
    """(id, video_id, chunk_index, document, ...): one row a chunk."""
    cut = docs.select(F.col(id_col).cast("string").alias("video_id"), *extra, F.posexplode(text_chunks(text_col)).alias("chunk_index", "document"))
    return cut.select(F.concat("video_id", F.lit("_chunk_"), "chunk_index").alias("id"), "video_id", "chunk_index", "document", *extra)


def embedded(chunks: DataFrame, embed: Callable[[list[str]], list[list[float]]], batch: int = 50) -> DataFrame:
    """chunks (..., document) with their `embedding`: `embed` gets `batch` texts at a time, and what is left at a task's end."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.RecordBatch) -> pa.RecordBatch:
            return rows.append_column("embedding", pa.array(embed(rows.column("document").to_pylist()), pa.list_(pa.float64())))

        for part in parts:
            held.append(part)
            if sum(h.num_rows for h in held) < batch:
                continue
            rows = pa.concat_batches(held)
            whole = rows.num_rows // batch * batch
            for at in range(0, whole, batch):
                yield flush(rows.slice(at, batch))
            held = [rows.slice(whole)]
        rows = pa.concat_batches(held) if held else None
        if rows is not None and rows.num_rows:
            yield flush(rows)

    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    return chunks.mapInArrow(run, schema)


def upsert_chunks(store: DataFrame, chunks: DataFrame, embed: Callable[[list[str]], list[list[float]]], *order: str, batch: int = 50) -> DataFrame:
    """The store (id, ..., document, embedding) with the last version of each new chunk, which alone is embedded, in its place."""
    return upsert(store, embedded(latest_by_key(chunks, "id", *order), embed, batch), "id", *order)


#: Vectors of a shard, and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 4096, 512
#: Beyond the rounding of a matrix product, so that what may be among the best is scored again.
_SLACK = 1e-9


def _packed(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (id, v) as packs (dim, ids, cells) of vectors of one length; vectors with null or non-finite components are left out."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            off = lists.offsets.to_numpy().astype(np.int64)
            flat, size = lists.values.to_numpy(zero_copy_only=False).astype(np.float64), np.diff(off)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                m = flat[off[at][:, None] + np.arange(dim)]
                good = np.isfinite(m).all(axis=1)
                at, m = at[good], m[good]
                for lo in range(0, len(at), limit):
                    ids = b.column("id").take(pa.array(at[lo : lo + limit]))
                    lengths = pa.array([0, len(ids)], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array([int(dim)], pa.int32()), pa.ListArray.from_arrays(lengths, ids), pa.array([m[lo : lo + limit].tobytes()], pa.binary())], ["dim", "ids", "cells"])

    return rows.filter(F.col("id").isNotNull() & (F.size("v") > 0)).select("id", "v").mapInArrow(run, f"dim int, ids array<{kind}>, cells binary")


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.cumsum(m * m, axis=1)[:, -1])


def _tiles(k: int):
    """The k best of each tile's vectors for each of its queries: one matrix product, a partial selection, exact sums of what is selected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                c, q = (np.frombuffer(b.column(x)[i].as_buffer(), np.float64).reshape(-1, dim) for x in ("cells", "q_cells"))
                ids, queries = b.column("ids")[i].values, b.column("q_ids")[i].values
                c_norm, q_norm = _norms(c), _norms(q)
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = np.where((c_norm > 0) & (q_norm > 0)[:, None], q @ c.T / (q_norm[:, None] * c_norm), -np.inf)
                few = min(k, len(ids))
                row, at = np.nonzero((s >= np.partition(s, len(ids) - few, axis=1)[:, [len(ids) - few]] - _SLACK) & (s > -np.inf))
                # summed in the order of the components, so that equal vectors score equally everywhere
                score = np.cumsum(q[row] * c[at], axis=1)[:, -1] / (q_norm[row] * c_norm[at])
                place = np.empty(len(ids), np.int64)
                place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
                order = np.lexsort((place[at], -score, row))
                row, at, score = row[order], at[order], score[order]
                first = np.searchsorted(row, row)
                on = np.arange(len(row)) - first < k
                yield pa.RecordBatch.from_arrays([queries.take(pa.array(row[on])), ids.take(pa.array(at[on])), pa.array(score[on])], ["query_id", "id", "similarity"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 7) -> DataFrame:
    """(query_id, rank, id, similarity): exact cosine top-k of a stated query set (id, v) over all vectors, ties to smaller ids.

    Vectors are packed into shards, queries into blocks, and a block goes to every part of the shards (as many as there are
    shuffle partitions): neither passes through the driver. Only the best k of each tile, then of each task, are shuffled.
    Vectors without a direction (zero) or with null or non-finite components take no part.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = _packed(vectors, SHARD_ROWS).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)))
    blocks = _packed(queries, BLOCK_ROWS).select("dim", F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    kind = vectors.schema["id"].dataType.simpleString()
    scored = blocks.join(shards.hint("merge"), ["part", "dim"]).select("dim", "ids", "cells", "q_ids", "q_cells").mapInArrow(_tiles(k), f"query_id {queries.schema['id'].dataType.simpleString()}, id {kind}, similarity double")
    # row_number <= k becomes a group limit before the shuffle, so a query's list has k rows a task
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")


def distinct_sources(hits: DataFrame) -> DataFrame:
    """Titles in the order of their first hit, per query."""
    return hits.groupBy("query_id", "title").agg(F.min("rank").alias("first"))


def context(hits: DataFrame) -> DataFrame:
    """Numbered context text per query, in rank order (k rows a query)."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), "document")
    return hits.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "\n\n").alias("context"))
