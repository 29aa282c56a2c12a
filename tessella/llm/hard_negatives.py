"""Hard negatives by a vertical scan (BOND): the columns of a shard are read in the order of each anchor's largest components.

After each few dimensions a candidate's score lies between its sum so far plus the least, and plus the most, that the
dimensions left can add in its shard (their minima and maxima times the anchor's components). A bitmap holds the candidates
whose bounds still reach a window; it shrinks until the scores are known. The first scan looks for each anchor's best rows
of its own label: its window is what may beat the best so far. The second looks for rows of other labels whose score lies
in the window that each positive's score opens, and above the best found in it so far.

Tiles of anchor blocks and shards are made by a join (tiles.py): the driver holds no anchor, and a hot label or a common
vector changes nothing in how the work is dealt. Both results are exact.

Defined results: rows with a null id, label or vector, an empty one, or a null or non-finite component take no part; ties go
to the smaller id; rows that repeat are candidates each, and an anchor that repeats is one; rows with the anchor's own id are never its
candidates, nor are vectors of another length; a positive of score 0 admits rows of score 0 only, a negative one none; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tiles import BLOCK_ROWS, PART_SHARDS, SHARD_ROWS, best, cells, merged, parts_of, rows_of, stored_packs, tiled

POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Dimensions read between two looks at the bounds.
STEP = 8
_MIN, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Shard:
    """The columns of a shard in floats that keep its sums exact, and the least and the most of each."""

    def __init__(self, dim: int, width: int, data: bytes, ids: bytes, labels: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        whole = cells(width, data, (dim, len(self.ids)))
        self.least, self.most = whole.min(axis=1).astype(np.float64), whole.max(axis=1).astype(np.float64)
        self.top = float(max(np.abs(self.least).max(initial=0), np.abs(self.most).max(initial=0)))
        self.columns = {kind: whole.astype(kind) for kind in ([np.float32] if self.top < 2**24 else [])} | {"whole": whole}

    def as_kind(self, kind: type) -> np.ndarray:
        if kind not in self.columns:
            self.columns[kind] = self.columns["whole"].astype(kind)
        return self.columns[kind]


def scan(q: np.ndarray, shard: Shard, alive: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the alive rows that some window [low, high] can need: all that are among the k best of a window are there.

    A row is dropped once its bounds miss every window, or k rows are sure to be in the window and above it.
    """
    rows = np.flatnonzero(alive)
    peak = float(np.abs(q).max(initial=0)) * shard.top * max(1, len(q))
    if peak >= 2**53:  # beyond exact floats: all dimensions at once, in integers
        return rows, (shard.columns["whole"][:, rows].astype(object) * q.astype(object)[:, None]).sum(axis=0).astype(np.int64)
    kind = np.float32 if peak < 2**24 else np.float64
    columns, order = shard.as_kind(kind), np.argsort(-np.abs(q), kind="stable")
    v = q.astype(np.float64)
    ends = np.sort(np.stack([v * shard.least, v * shard.most])[:, order], axis=0)
    # what the dimensions from each place on add at least and at most
    left = np.concatenate([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1))], axis=1)
    q, score, whole = q.astype(kind), np.zeros(len(rows), kind), len(rows) == len(alive)
    bar = low.astype(np.float64)
    for at in range(0, len(q), STEP):
        read = order[at : at + STEP]
        part = columns[read]
        score = score + q[read] @ (part if whole else part[:, rows])
        down, up = score + left[0, min(at + STEP, len(q))], score + left[1, min(at + STEP, len(q))]
        keep = np.zeros(len(rows), bool)
        for w in range(len(bar)):
            inside = up <= high[w]
            sure = down[inside]
            if len(sure) >= k:  # the k-th best of those that can't be above the window: a bar, if it is in the window
                bar[w] = max(bar[w], np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (up >= bar[w]) & (down <= high[w])
        if 2 * np.count_nonzero(keep) <= len(rows) or at + STEP >= len(q):
            rows, score, whole = rows[keep], score[keep], False
        if not len(rows):
            break
    return rows, score.astype(np.int64)


def _tiles_of(tiles: Iterator[dict]) -> Iterator[tuple[dict, dict, Shard]]:
    """(tile, what is kept of its block, shard); a block's tiles share what is kept while they follow each other."""
    shards: dict[tuple, Shard] = {}
    block, kept = None, {}
    for t in tiles:
        name = (t["s_ids"], t["s_cells"])
        if name not in shards:
            if len(shards) >= PART_SHARDS:
                shards.clear()
            shards[name] = Shard(t["dim"], t["s_width"], t["s_cells"], t["s_ids"], t["s_labels"])
        if block != (t["ids"], t["cells"]):
            block, kept = (t["ids"], t["cells"]), {}
        yield t, kept, shards[name]


def _lists(found: dict, keys: list[str]) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in found], pa.int64()) for i in range(len(keys))]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array([x[i] for x in found.values()], pa.list_(pa.int64())) for i in (0, 1)]], [*keys, "ids", "scores"])


def _positives(k: int):
    def search(tiles: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for t, now, shard in _tiles_of(tiles):
            if now is not kept:
                if kept:
                    yield _lists(kept, ["anchor", "version"])
                kept = now
            q = cells(t["width"], t["cells"], (-1, t["dim"]))
            ids, labels, versions = (np.frombuffer(t[c], np.int64) for c in ("ids", "labels", "version"))
            for j in range(len(ids)):
                key = (int(ids[j]), int(versions[j]))
                old = kept.get(key, (np.zeros(0, np.int64),) * 2)
                bar = old[1][-1] if len(old[0]) == k else _MIN
                rows, scores = scan(q[j], shard, (shard.labels == labels[j]) & (shard.ids != ids[j]), np.array([bar]), np.array([_MAX]), k)
                kept[key] = best(np.r_[old[0], shard.ids[rows]], np.r_[old[1], scores], k)
        if kept:
            yield _lists(kept, ["anchor", "version"])

    return search


def _negatives(k: int, positives: int):
    def search(tiles: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for t, now, shard in _tiles_of(tiles):
            if now is not kept:
                if kept:
                    yield _lists(kept, ["anchor", "version", "place"])
                kept = now
            q = cells(t["width"], t["cells"], (-1, t["dim"]))
            ids, labels, versions = (np.frombuffer(t[c], np.int64) for c in ("ids", "labels", "version"))
            lows, highs = (np.frombuffer(t[c], np.int64).reshape(-1, positives) for c in ("low", "high"))
            for j in range(len(ids)):
                places = np.flatnonzero(lows[j] <= highs[j])
                if not len(places):
                    continue
                old = [kept.get((int(ids[j]), int(versions[j]), int(p)), (np.zeros(0, np.int64),) * 2) for p in places]
                bars = np.array([x[1][-1] if len(x[0]) == k else low for x, low in zip(old, lows[j][places], strict=True)])
                rows, scores = scan(q[j], shard, (shard.labels != labels[j]) & (shard.ids != ids[j]), bars, highs[j][places], k)
                for p, bar, x in zip(places, bars, old, strict=True):
                    on = (scores >= bar) & (scores <= highs[j][p])
                    kept[int(ids[j]), int(versions[j]), int(p)] = best(np.r_[x[0], shard.ids[rows[on]]], np.r_[x[1], scores[on]], k)
        if kept:
            yield _lists(kept, ["anchor", "version", "place"])

    return search


def labelled(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v): floor(scale * component) as long, of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    taken = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector_col) > 0) & F.coalesce(ok, F.lit(False)))
    return taken.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors among vectors (id, label, v).

    A positive's window is low to high percent of its score.
    """
    shards = stored_packs(vectors, SHARD_ROWS, True, "columns")
    parts, width = parts_of(shards)  # an anchor has a list for each shard at most
    # an anchor is a distinct row
    asked = stored(anchors.withColumn("version", F.xxhash64("label", "v")).dropDuplicates(["id", "version"]), "anchors")
    blocks = stored_packs(asked, BLOCK_ROWS, False, "anchor-blocks", ("version",))
    lists = tiled(shards, blocks, parts, _positives(positives), "anchor long, version long, ids array<long>, scores array<long>")
    first = stored(merged(stored(lists, "positive-lists"), ["anchor", "version"], positives, width), "positives")
    # the whole numbers of each window; places without a positive, and negative scores, have an empty one
    pad = lambda f, none: F.slice(F.concat(F.transform("scores", f), F.array_repeat(F.lit(none).cast("long"), positives)), 1, positives)
    windows = asked.join(first.withColumnRenamed("anchor", "id"), ["id", "version"]).select(
        "id", "label", "v", "version",
        pad(lambda s: F.when(s < 0, _MAX).otherwise(F.call_function("div", s * low + 99, F.lit(100))), _MAX).alias("low"),
        pad(lambda s: F.when(s < 0, _MIN).otherwise(F.call_function("div", s * high, F.lit(100))), _MIN).alias("high"),
    )
    blocks = stored_packs(stored(windows, "windows"), BLOCK_ROWS, False, "window-blocks", ("version", "low", "high"))
    lists = tiled(shards, blocks, parts, _negatives(negatives, positives), "anchor long, version long, place long, ids array<long>, scores array<long>")
    found = rows_of(merged(stored(lists, "negative-lists"), ["anchor", "version", "place"], negatives, width), ["anchor", "version", "place"], "negative_id")
    mates = rows_of(first, ["anchor", "version"], "positive_id").select("anchor", "version", (F.col("rank") - 1).cast("long").alias("place"), "positive_id", F.col("score").alias("positive_score"))
    return found.join(mates, ["anchor", "version", "place"]).select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
