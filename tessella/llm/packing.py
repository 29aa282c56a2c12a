"""Packing of tokenised documents into sequences of bounded length, by exact complements and best fit.

Only the lengths decide how pieces are packed, and there are at most `capacity` of them, so the plan is made from the counts of each
length, whatever the size of the corpus. Indexes by sum hold how many single lengths, pairs and triples of available
lengths there are. The longest piece opens a sequence; a single piece, a pair or a triple that fills its gap exactly is
looked up by the gap; without one the longest piece that fits goes in (best fit), and the smaller gap is looked up again. A
pattern found is used as often as its lengths are available, so each pattern uses up a length and a plan has about as many
patterns as there are lengths.

Pieces then find their places by themselves: a piece's number among those of its length (counted in its task, plus a sum
over the tasks before) leads to a pattern, a copy of it and a slot. Texts are tokenised once, in one pass; only
lengths are counted, and pieces meet the counts of their own task, so a hot length is as even as its tasks.

A text is tokenised unit by unit: no token of the vocabulary crosses white space or what its rules split. Distinct units are
encoded once and kept by the worker.

Defined results: null and empty texts are one piece that holds the end mark only; null ids stay null; repeated rows are packed each;
a very long text is cut like any other and is tokenised in one task; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import IS_SPACE, LOWER, slices, stored, text_bytes, word_bounds

CAPACITY, END_ID = 4096, 1
VOCABULARY = "word_bpe_49k.json"
#: Units whose ids a worker remembers, and the longest of them in characters.
WORDS, LONGEST = 1 << 20, 64

# ------------------------------------------------------------------------ tokens


class Words:
    """Ids of units; those met often are kept, end to end, as long as there are less than WORDS.

    A unit is a run of ASCII letters (in lower case), one digit or a run of other visible ASCII characters, which the
    vocabulary's own rules split off alike, so the model takes it as it is; or a whole word with any other character, an
    apostrophe or "<" (contractions and special tokens), which goes through all of the tokenizer's steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.size, self.first, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def numbers(self, units: list[str], odd: np.ndarray) -> np.ndarray:
        """Numbers of distinct units in `size`, `first` and `flat`; numbers given before may be void afterwards."""
        if len(self.number) > WORDS:
            self.clear()
        known = self.number
        out = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(out < 0)
        if len(new):
            whole = iter(self.tokenizer.encode_batch_fast([units[i] for i in new[odd[new]].tolist()], add_special_tokens=False))
            ids = [next(whole).ids if strange else [t.id for t in self.model.tokenize(units[i])] for i, strange in zip(new.tolist(), odd[new].tolist(), strict=True)]
            size = np.array([len(x) for x in ids], np.int64)
            out[new] = len(self.size) + np.arange(len(new))
            known.update((units[i], n) for i, n in zip(new.tolist(), out[new].tolist(), strict=True) if len(units[i]) <= LONGEST)
            self.first = np.r_[self.first, len(self.flat) + np.cumsum(size) - size]
            self.size, self.flat = np.r_[self.size, size], np.r_[self.flat, np.array([x for i in ids for x in i], np.uint32)]
        return out


_loaded: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One for each worker process: units stay known from task to task."""
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Kinds of bytes: 0 white space, 1 letters, 2 digits, 3 other visible ASCII, 4 what the tokenizer has to see as it is.
_KIND = np.full(256, 4, np.int8)
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[ord("'"), ord("<")]] = 4
_KIND[IS_SPACE] = 0


def token_ids(text: pa.Array, words: Words, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, an end mark after each, and the n+1 offsets."""
    data, off = text_bytes(text)
    starts, ends, rows = word_bounds(data, off)
    solid = data[~IS_SPACE[data]]
    kind, size = _KIND[solid], ends - starts
    first = np.cumsum(size) - size
    odd = np.maximum.reduceat(kind, first) == 4 if len(first) else np.zeros(0, bool)
    strange = np.repeat(odd, size)
    begins = np.r_[True, kind[1:] != kind[:-1]] | (kind == 2) if len(kind) else np.zeros(0, bool)
    begins &= ~strange
    begins[first] = True
    at = np.flatnonzero(begins)
    lowered = np.where(strange, solid, LOWER[solid])
    column = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.r_[at, len(solid)].astype(np.int64)), pa.py_buffer(lowered))
    coded = column.dictionary_encode()
    code, units = coded.indices.to_numpy(), coded.dictionary
    seen = np.zeros(len(units), bool)
    seen[code[strange[at]]] = True
    unit = words.numbers(units.to_numpy(zero_copy_only=False).tolist(), seen)[code]
    count = words.size[unit]
    row = np.searchsorted(at, np.r_[first, len(solid)][rows])  # units before each text
    total = np.r_[0, np.cumsum(count)]
    ids = words.flat[np.repeat(words.first[unit] - total[:-1], count) + np.arange(int(total[-1]))]
    bounds = total[row]
    return np.insert(ids, bounds[1:], np.uint32(end)), bounds + np.arange(len(bounds))


def pieces(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, ids, _task, _nth) of each text's pieces; ids are little-endian numbers of 32 bits.

    `_nth` counts the earlier pieces of this length in the task that cut them.
    """
    path = path or vocabulary_path()
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "_task", "_nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, task = words_of(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for b in slices(batches, "text"):
            ids, off = token_ids(b.column("text"), words, end)
            total = np.diff(off)
            count = -(-total // capacity)
            row = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(row)) - (np.cumsum(count) - count)[row]
            start = piece * capacity
            length = np.minimum(capacity, total[row] - start)
            lo = (off[:-1][row] + start) * 4
            raw = memoryview(ids.astype("<u4").tobytes())
            cut = [raw[a:z] for a, z in zip(lo.tolist(), (lo + 4 * length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            same = length[order]
            first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)])) + seen[same]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [b.column("id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in cut], pa.int64())]
            columns += [pa.array([bytes(x) for x in cut], pa.binary())] if keep_ids else []
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(row), task)), pa.array(nth)], names)

    kinds = {"id": docs.schema[id_col].dataType.simpleString(), "piece": "int", "ids": "binary"}
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))
    return out.withColumnRenamed("id", id_col)


# -------------------------------------------------------------------------- plan


class Lengths:
    """Available pieces of each length, and how many lengths, pairs and triples (ordered) of available ones have each sum."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.single = (self.left > 0).astype(np.int64)
        self.pairs = self._sums(self.single)
        self.triples = self._sums(self.pairs)

    def _sums(self, other: np.ndarray) -> np.ndarray:
        """How often each sum up to the capacity arises from an available length and an entry of `other`."""
        out = np.zeros(len(other), np.int64)
        for length in np.flatnonzero(self.single):
            out[length:] += other[: len(other) - length]
        return out

    def take(self, pattern: Counter, copies: int) -> None:
        for length, n in pattern.items():
            self.left[length] -= n * copies
            if not self.left[length]:
                self._used_up(length)

    def _used_up(self, x: int) -> None:
        """Sums without the length x: (s - x)^2 and (s - x)^3, where powers are convolutions."""
        size = len(self.left)
        ahead = lambda a, by: np.r_[np.zeros(min(by, size), np.int64), a[: max(size - by, 0)]]
        one = np.zeros(size, np.int64)
        one[0] = 1
        triples = self.triples - 3 * ahead(self.pairs, x) + 3 * ahead(self.single, 2 * x) - ahead(one, 3 * x)
        pairs = self.pairs - 2 * ahead(self.single, x) + ahead(one, 2 * x)
        self.triples, self.pairs = triples, pairs
        self.single[x] = 0

    def _pair(self, gap: int, free: np.ndarray) -> list[int] | None:
        a = np.arange((gap + 1) // 2, gap)  # the longer of both
        on = (free[a] > 0) & (free[gap - a] > (a == gap - a))
        at = np.flatnonzero(on)
        return [int(a[at[-1]]), gap - int(a[at[-1]])] if len(at) else None

    def exact(self, gap: int, used: Counter) -> list[int] | None:
        """A single length, a pair or a triple that fills the gap, the longest first, beside what is used already."""
        free = self.left.copy()
        for length, n in used.items():
            free[length] -= n
        if free[gap] > 0:
            return [gap]
        if self.pairs[gap] and (found := self._pair(gap, free)):
            return found
        if self.triples[gap]:
            first = np.flatnonzero((free[1:gap] > 0) & (self.pairs[gap - np.arange(1, gap)] > 0)) + 1
            for a in first[::-1].tolist():
                free[a] -= 1
                if found := self._pair(gap - a, free):
                    return [a, *found]
                free[a] += 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Counter]]:
    """(copies, lengths) of the sequences for so many pieces of each length."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths lie between 1 and the capacity")
    have, out = Lengths(counts, capacity), []
    for longest in sorted(counts, reverse=True):
        while have.left[longest]:
            used, gap = Counter({longest: 1}), capacity - longest
            while gap:
                if found := have.exact(gap, used):
                    used.update(found)
                    break
                fits = np.flatnonzero(have.left[1 : gap + 1]) + 1
                fits = next((x for x in fits[::-1].tolist() if have.left[x] > used[x]), 0)
                if not fits:
                    break
                # at once, as long as what is left stays beyond a triple's reach
                n = min(int(have.left[fits]) - used[fits], max(1, (gap - 3 * longest) // fits))
                used[fits] += n
                gap -= n * fits
            copies = min(int(have.left[x]) // n for x, n in used.items())
            have.take(used, copies)
            out.append((copies, used))
    return out


def slots(patterns: list[tuple[int, Counter]], counts: dict[int, int]) -> dict[str, np.ndarray]:
    """Runs of pieces in the order of (length, number): where a run begins, its first sequence, pieces a sequence, and offset there."""
    base, runs = dict(zip(sorted(counts), np.cumsum([0, *[counts[x] for x in sorted(counts)]]).tolist(), strict=False)), []
    first, free = base.copy(), 0
    for copies, used in patterns:
        offset = 0
        for length, n in used.items():
            runs.append((first[length], free, n, offset))
            first[length] += n * copies
            offset += n * length
        free += copies
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    starts = np.zeros(max(counts, default=0) + 1, np.int64)
    starts[list(base)] = list(base.values())
    return {"base": starts, "begin": table[:, 0], "sequence": table[:, 1], "each": table[:, 2], "offset": table[:, 3]}


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, ids, sequence_id, offset): every piece and its place."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, capacity, id_col, text_col, path, end, keep_ids), "pieces")
    tasks = stored(cut.groupBy("_task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    where = spark.sparkContext.broadcast(slots(plan(counts, capacity), counts))

    @F.arrow_udf(T.StructType().add("sequence_id", T.LongType()).add("offset", T.LongType()))
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        p, length = where.value, length.to_numpy()
        at = p["base"][length] + number.to_numpy()
        run = np.searchsorted(p["begin"], at, side="right") - 1
        copy, slot = np.divmod(at - p["begin"][run], p["each"][run])
        return pa.StructArray.from_arrays([pa.array(p["sequence"][run] + copy), pa.array(p["offset"][run] + slot * length)], ["sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("_task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = cut.join(starts, ["_task", "length"]).withColumn("_place", place(F.col("length"), F.col("_nth") + F.col("_before")))
    return placed.select(*[c for c in cut.columns if c not in ("_task", "_nth")], "_place.sequence_id", "_place.offset")
