"""Line dedup over sharded minimal perfect hashes.

Every distinct eligible line (its normalised key has at least `min_chars` code points) is a 128-bit hash. The hashes are
dealt to shards by their value; each shard gets a minimal perfect hash (levels of bit arrays; a key settles on the first
level where no other key of its shard has its slot; rank by population count) that indexes three compact arrays:
32-bit fingerprint, document count, largest document id. Documents do not join lines: a task packs the distinct hashes
of a batch of documents into one block per shard, the block meets its shard's arrays and probes them with numpy.

Skew: a line that a third of all documents hold is one entry in each block, counted before the shuffle, and the blocks
of heavy shards are spread over salts, each with its own copy of that shard's arrays.

Defined results: null text is one empty line; a null doc_id sorts before all others and its rows count as one document;
rows that share a doc_id count as one document and all of them keep the lines for which that id is the largest; repeated
rows are each returned; columns besides id and text pass through untouched; an empty table gives an empty result; a very
long line is one key, a very long text is split like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, give_back, mix, row_keys, slices, span_hashes, stored, text_bytes

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of one shard, and document references of one salt of a shard.
SHARD_KEYS, SALT_REFS = 1 << 18, 1 << 21
_WS = np.isin(np.arange(256), [32, *range(9, 14)])


# ------------------------------------------------------------- minimal perfect hash


def build_mph(keys: np.ndarray, gamma: float = 1.6) -> list[np.ndarray]:
    """Bit levels (as packed bytes) of a minimal perfect hash over distinct 64-bit keys (it ends only for distinct ones)."""
    levels, left, level = [], keys, 0
    while len(left):
        size = max(64, int(gamma * len(left)) // 8 * 8 + 8)
        slot = (mix(left, 7 + level) % np.uint64(size)).astype(np.int64)
        taken = np.bincount(slot, minlength=size)
        levels.append(np.packbits(taken == 1, bitorder="little"))
        left = left[taken[slot] != 1]
        level += 1
    return levels


def probe_mph(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Index of each key, 0 to n-1; -1 where the key settles on no level."""
    out = np.full(len(keys), -1, np.int64)
    todo, base = np.arange(len(keys)), 0
    for level, packed in enumerate(levels):
        bits = np.unpackbits(packed, bitorder="little")
        rank = np.cumsum(bits, dtype=np.int64)
        slot = (mix(keys[todo], 7 + level) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[slot] == 1
        out[todo[hit]] = base + rank[slot[hit]] - 1
        todo, base = todo[~hit], base + int(rank[-1])
    return out


# ------------------------------------------------------------------ lines of a batch


def eligible_lines(text: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, line number, low hash, high hash) of each line whose key has at least min_chars code points."""
    lines = pc.split_pattern(pc.fill_null(text, ""), "\n")
    first = lines.offsets.to_numpy().astype(np.int64)
    first -= first[0]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    number = np.arange(first[-1]) - first[row]
    data, off = text_bytes(lines.flatten())
    starts, ends = off[:-1], off[1:]
    solid = np.flatnonzero(~_WS[data])
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends)
    full = b > a
    row, number, a, b = row[full], number[full], a[full], b[full]
    lo, hi = solid[a], solid[b - 1] + 1
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    long = points[hi] - points[lo] >= min_chars
    row, number, lo, hi = row[long], number[long], lo[long], hi[long]
    return row, number, span_hashes(data, lo, hi, lower=True), span_hashes(data, lo, hi, lower=True, seed=77)


def _line_refs(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, _, low, high = eligible_lines(b.column("text"), min_chars)
            did = b.column("did").to_numpy()[row]
            order = np.lexsort((did, high, low))
            low, high, did = low[order], high[order], did[order]
            new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (did[1:] != did[:-1])] if len(low) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(x[new].view(np.int64)) for x in (low, high, did)], ["low", "high", "did"])

    return run


# ------------------------------------------------------------------------ index


def line_counts(rows: DataFrame, min_chars: int) -> DataFrame:
    """(low, high, n_docs, top): documents that hold each distinct line, and the largest of their ids."""
    refs = rows.mapInArrow(_line_refs(min_chars), "low long, high long, did long")
    once = refs.groupBy("low", "high", "did").agg(F.lit(1).alias("one"))
    return once.groupBy("low", "high").agg(F.count("one").alias("n_docs"), F.max("did").alias("top"))


def _shard_of(low: np.ndarray, shards: int) -> np.ndarray:
    return (mix(low, 3) % np.uint64(shards)).astype(np.int64)


def _build(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index row per shard from rows sorted by shard."""
    held: list[pa.RecordBatch] = []

    def finish() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        low, high = (t.column(c).to_numpy().view(np.uint64) for c in ("low", "high"))
        seed = next(s for s in range(1, 1000) if len(np.unique(mix(low, s) ^ high)) == len(low))  # 128-bit hashes are distinct
        levels = build_mph(mix(low, seed) ^ high)
        at = probe_mph(levels, mix(low, seed) ^ high)
        mark, count, top = np.zeros(len(low), np.uint32), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        mark[at], count[at], top[at] = (high >> np.uint64(32)).astype(np.uint32), t.column("n_docs").to_numpy(), t.column("top").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array([t.column("shard")[0].as_py()], pa.int64()), pa.array([seed], pa.int32()), pa.array([np.array([len(x) for x in levels], np.int64).tobytes()], pa.binary()), pa.array([b"".join(x.tobytes() for x in levels)], pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in (mark, np.minimum(count, 2**32 - 1).astype(np.uint32), top)), pa.array([int(count.sum())], pa.int64())],
            ["shard", "seed", "sizes", "bits", "mark", "count", "top", "refs"],
        )

    for b in groups:
        shard = b.column("shard").to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            if held and held[0].column("shard")[0].as_py() != shard[lo]:
                yield finish()
                held = []
            held.append(b.slice(int(lo), int(hi - lo)))
    if held:
        yield finish()
    held.clear()
    give_back()


_INDEX = "shard long, seed int, sizes binary, bits binary, mark binary, count binary, top binary, refs long"


def build_index(rows: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The sharded index as a stored table, one row a shard, and the number of shards, which follows the number of lines."""
    counts = stored(line_counts(rows, min_chars), "line-counts")
    shards = max(1, -(-counts.count() // shard_keys))
    # the shard is a function of the line's hash, as in _shard_of; Spark deals whole shards to tasks
    keyed = counts.mapInArrow(
        lambda it: (pa.RecordBatch.from_arrays([pa.array(_shard_of(b.column("low").to_numpy().view(np.uint64), shards)), *b.columns], ["shard", *b.schema.names]) for b in it if b.num_rows),
        "shard long, low long, high long, n_docs long, top long",
    )
    index = keyed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_build, _INDEX)
    return stored(index, "line-index"), shards


# ------------------------------------------------------------------------ probes


def _blocks(min_chars: int, shards: int, salts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, number, low, high = eligible_lines(b.column("text"), min_chars)
            if not len(row):
                continue
            shard = _shard_of(low, shards)
            order = np.lexsort((high, low, shard))
            row, number, low, high, shard = (x[order] for x in (row, number, low, high, shard))
            did, th = b.column("did").to_numpy()[row], b.column("th").to_numpy()[row]
            new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
            seed = int(mix(low[:1])[0] ^ np.uint64(row[0]))
            cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
            out: dict[str, list] = {k: [] for k in ("shard", "salt", "kind", "low", "high", "times", "did", "th", "number")}
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                s = slice(lo, hi)
                firsts = np.flatnonzero(new[s] | (np.arange(hi - lo) == 0)) + lo
                out["shard"].append(int(shard[lo]))
                out["salt"].append(seed % salts.get(int(shard[lo]), 1))
                out["kind"].append(1)
                for name, x in (("low", low[firsts]), ("high", high[firsts]), ("times", np.diff(np.r_[firsts, hi])), ("did", did[s]), ("th", th[s]), ("number", number[s])):
                    out[name].append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[k], pa.int64() if k in ("shard", "salt") else pa.int32() if k == "kind" else pa.binary()) for k in out], list(out))

    return run


def _probe(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted so that a shard's arrays come before its blocks; one shard is held at a time."""
        arrays, levels, held, seed = {}, [], None, 1
        for b in batches:
            for r in range(b.num_rows):
                get = lambda c: b.column(c)[r].as_py()  # noqa: B023, E731
                if get("kind") == 0:
                    held, seed = get("shard"), get("seed")
                    sizes, bits = np.frombuffer(get("sizes"), np.int64), np.frombuffer(get("bits"), np.uint8)
                    levels = np.split(bits, np.cumsum(sizes)[:-1])
                    arrays = {"mark": np.frombuffer(get("mark"), np.uint32), "count": np.frombuffer(get("count"), np.uint32), "top": np.frombuffer(get("top"), np.int64)}
                    continue
                if get("shard") != held:
                    continue
                low, high = (np.frombuffer(get(c), np.uint64) for c in ("low", "high"))
                at = probe_mph(levels, mix(low, seed) ^ high)
                known = (at >= 0) & (arrays["mark"][at] == (high >> np.uint64(32)).astype(np.uint32))
                often = known & (arrays["count"][at] >= min_docs)
                times = np.frombuffer(get("times"), np.int64)
                often, top = np.repeat(often, times), np.repeat(arrays["top"][at], times)
                did, th, number = (np.frombuffer(get(c), np.int64) for c in ("did", "th", "number"))
                drop = often & (did != top)
                did, th, number = did[drop], th[drop], number[drop]
                order = np.lexsort((number, th, did))
                did, th, number = did[order], th[order], number[order]
                firsts = np.flatnonzero(np.r_[True, (did[1:] != did[:-1]) | (th[1:] != th[:-1])]) if len(did) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[firsts, len(did)].astype(np.int32)), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(did[firsts]), pa.array(th[firsts]), lists], ["did", "th", "gone"])

    return run


def dropped_lines(rows: DataFrame, index: DataFrame, shards: int, min_chars: int, min_docs: int, salt_refs: int = SALT_REFS) -> DataFrame:
    """(did, th, gone): numbers of the lines that each document loses; documents that lose none have no row."""
    # only shards above the bound are named here, so the list is shorter than all references / salt_refs
    salts = {r.shard: -(-r.refs // salt_refs) for r in index.filter(F.col("refs") > salt_refs).select("shard", "refs").toLocalIterator()}
    blocks = rows.mapInArrow(_blocks(min_chars, shards, salts), "shard long, salt long, kind int, low binary, high binary, times binary, did binary, th binary, number binary")
    arrays = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.ceil(F.col("refs") / salt_refs)).cast("long") - 1)))
    both = blocks.unionByName(arrays.select("shard", "salt", F.lit(0).alias("kind"), "seed", "sizes", "bits", "mark", "count", "top"), allowMissingColumns=True)
    hits = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(_probe(min_docs), "did long, th long, gone array<int>")
    # equal rows give equal lists, which the set merges; a document's own lines bound what one key gathers
    return hits.groupBy("did", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("gone")))).alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, counts: bool = True) -> DataFrame:
    """docs with text reduced; with counts also `_n_lines`, `_n_dropped` (long; extra columns of those names are replaced).

    A key found in min_docs documents keeps its lines only in the largest id that holds it.
    """
    keys = row_keys(docs, id_col, text_col)
    index, shards = build_index(keys.select("did", "text"), min_chars)
    gone = dropped_lines(keys, index, shards, min_chars, min_docs)
    kept_cols = [c for c in docs.columns if not counts or c not in ("_n_lines", "_n_dropped")]
    tagged = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text_col).alias("th"), F.struct(*kept_cols).alias("doc"))
    joined = tagged.join(gone, ["did", "th"], "left")
    was = F.col("doc").getField(text_col)
    text = F.coalesce(was, F.lit(""))
    # linear in the lines: the numbers that stay by one pass over a set, and each line by its number
    stay = lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone"), lambda i: F.get(lines, i))
    kept = F.array_join(F.get(F.transform(F.array(F.split(text, "\n", -1)), stay), F.lit(0)), "\n")
    tallies = [
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_n_dropped"),
    ]
    return joined.select(*[(F.when(F.col("gone").isNull(), was).otherwise(kept) if c == text_col else F.col("doc").getField(c)).alias(c) for c in kept_cols], *tallies[: 2 * counts])
