"""Exact top-k search by tiles.

Candidate vectors are packed into shards and queries into blocks (one row each, a binary matrix of the narrowest integer
type). A join on part numbers brings each block to every part of the shards (`tiles`), so neither side passes through the
driver. In a task, blocks stream past the part's shards; a tile is one matrix product, of which the k best scores of all its
queries are selected at once and merged with what the block has so far. Nothing but these top lists is shuffled; the lists of
a query are then merged as a tree.

Every tile has a bounded size, so memory per task is fixed; the number of tiles is queries x vectors / tile, which is the
search itself. Scores are exact: products run in float32 or float64 while every partial sum is an exact integer there, else
in Python integers.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, neither as query nor as candidate;
ties go to the smaller id; a vector whose length differs from the query's is no candidate of it; repeated rows each
count as a candidate, and a query id given twice gets the list of each of its rows merged; null ids take no part; an empty
table of either side gives an empty result; extra columns are not read; a pack of very long vectors holds fewer of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tiles import cells, merged, narrow, parts_of, rows_of, stored_packs, tiled

SHARD_ROWS, BLOCK_ROWS = 2048, 512
_LISTS = "query_id long, ids array<long>, scores array<long>"
_MIN = np.iinfo(np.int64).min


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of q and c."""
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        kind = np.float32 if top < 2**24 else np.float64
        return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
    return (q.astype(object) @ c.astype(object).T).astype(np.int64)


def select(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row (ids: of the columns, ascending), ties to smaller ids, in no order."""
    if scores.shape[1] <= k:
        return np.broadcast_to(ids, scores.shape), scores
    bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
    over, even = scores > bar, scores == bar
    on = over | even & (np.cumsum(even, axis=1) <= k - over.sum(axis=1, keepdims=True))
    at = np.nonzero(on)[1].reshape(len(scores), k)
    return ids[at], np.take_along_axis(scores, at, axis=1)


def join_lists(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of each row as one of the k best, best first."""
    ids, scores = np.concatenate([a[0], b[0]], axis=1), np.concatenate([a[1], b[1]], axis=1)
    order = np.lexsort((ids, ~scores))[:, :k]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _search(k: int):
    """The k best candidates of each query among the shards that its block meets in a row."""

    def lists(queries: np.ndarray, held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        real = held[1] > _MIN  # a query's own row and places without a candidate have the least number
        flat = lambda x: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(real.sum(axis=1))].astype(np.int32)), pa.array(x[real], pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(queries), flat(held[0]), flat(held[1])], ["query_id", "ids", "scores"])

    def run(tiles: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        block = queries = held = None
        for t in tiles:
            if block != (t["ids"], t["cells"]):
                if held is not None:
                    yield lists(queries, held)
                block, queries, held = (t["ids"], t["cells"]), np.frombuffer(t["ids"], np.int64), None
            ids = np.frombuffer(t["s_ids"], np.int64)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            scores = products(cells(t["width"], t["cells"], (-1, t["dim"])), cells(t["s_width"], t["s_cells"], (-1, t["dim"]))[order])
            lo, hi = np.searchsorted(ids, queries), np.searchsorted(ids, queries, side="right")
            for j in np.flatnonzero(hi > lo):  # the few queries whose own row is in this shard
                scores[j, lo[j] : hi[j]] = _MIN
            found = select(ids, scores, k)
            held = join_lists(found if held is None else held, (found[0][:, :0], found[1][:, :0]) if held is None else found, k)
        if held is not None:
            yield lists(queries, held)

    return run


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * component) as long, of the vectors that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of integer vectors (id, v): the k best inner products of each query over all other rows."""
    label = F.lit(0).cast("long").alias("label")
    shards = stored_packs(vectors.select("id", label, "v"), SHARD_ROWS, False, "shards")
    blocks = stored_packs(queries.select("id", label, "v"), BLOCK_ROWS, False, "blocks")
    parts, width = parts_of(shards)  # a query row has a list for each shard at most
    lists = stored(tiled(shards, blocks, parts, _search(k), _LISTS), "lists")
    return rows_of(merged(lists, ["query_id"], k, width), ["query_id"], "vec_id").select("query_id", "rank", "vec_id", "score")
