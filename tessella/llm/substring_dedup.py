"""Substring dedup: suffix automata of reference shards give each document's matching statistics.

A window is `width` consecutive words. Round 1 finds where equal windows can be: every window is named by the least hash
among its word k-grams (equal windows have equal names), runs of windows with one name are one segment, and a name that
several documents hold sends their segments to its leader, the segment in the smallest document. Leaders' segments are
the reference: dealt by document and block into shards of bounded size, each turned into a suffix automaton (states carry
the least document id that ends there). All other segments stream through the automaton of their leader's shard;
wherever the match reaches `width` words in a document with a smaller id, the window repeats. Round 2 does the same for
windows that their leader doesn't hold but other documents do, or the leader's document in its other segments of the name
(names are then the windows' own hashes), so no repeated window is missed and nothing is compared outside its shard.

The reference is the whole corpus, so its automata can't be sent to every task; a document's segments stream to the shards
that can hold them, where the automaton stands ready.

Skew: a name is aggregated, never gathered, and joined as two written tables, whose larger partitions Spark splits; the
segments sent to a heavy shard are spread over salts, each with its own copy of the shard's reference. Automata read 64-bit
word hashes. Segments end at every BLOCK_WORDS words, so a shard holds `SHARD_WORDS` of reference on average whatever the
texts, and a region of REGION_WORDS words is streamed at once.

Defined results: null text has no words; null doc_id sorts before all ids; rows that share a doc_id are one document
(they don't remove each other's words); repeated rows each get the result of their text; words are never changed; a very
long text is cut into blocks as above; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, mix, ngram_hashes, row_keys, slices, stored, text_bytes, word_bounds, word_hashes

WIDTH, GRAM = 50, 20
#: Words of reference in one shard (on average), of a block of one document, and words streamed per salt of a shard.
SHARD_WORDS, BLOCK_WORDS, SALT_WORDS = 8192, 4096, 1 << 15
#: Words of one streamed region, about.
REGION_WORDS = 1 << 16


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for each i."""
    n, have, m = len(x) - w + 1, 1, x
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:n], m[w - have : w - have + n])


class Automaton:
    """Suffix automaton over word hashes; `least` is the smallest document id at which a state's strings end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [2**63 - 1]

    def add(self, words: list[int], doc: int) -> None:
        """Append one reference region; regions don't run into each other."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for w in words:
            at = nxt[last].get(w)
            if at is not None:
                if length[at] == length[last] + 1:
                    last = at
                else:
                    clone = len(nxt)
                    nxt.append(nxt[at].copy())
                    link.append(link[at])
                    length.append(length[last] + 1)
                    least.append(least[at])
                    link[at] = clone
                    p = last
                    while p >= 0 and nxt[p].get(w) == at:
                        nxt[p][w] = clone
                        p = link[p]
                    last = clone
                if doc < least[last]:
                    least[last] = doc
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            least.append(doc)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    link.append(link[q])
                    length.append(length[p] + 1)
                    least.append(least[q])
                    link[q] = link[new] = clone
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
            last = new

    def close(self) -> None:
        """Carry the least ids to the states of shorter strings."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            p = self.link[s]
            if self.least[s] < self.least[p]:
                self.least[p] = self.least[s]

    def held(self, words: list[int], doc: int, width: int) -> np.ndarray:
        """For each window of `words`: does it occur in a document with an id below doc?"""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        out = np.zeros(max(0, len(words) - width + 1), bool)
        s = n = 0
        for i, w in enumerate(words):
            to = nxt[s].get(w)
            while to is None and s:
                s = link[s]
                n = length[s]
                to = nxt[s].get(w)
            if to is None:
                n = 0
                continue
            s = to
            n += 1
            if n >= width:
                while length[link[s]] >= width:  # the state of the last `width` words
                    s = link[s]
                    n = length[s]
                if least[s] < doc:
                    out[i - width + 1] = True
        return out


# --------------------------------------------------------------------- segments


def _segments(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, off = word_hashes(b.column("text"), lower=False)
            if len(h) < width:
                continue
            name = sliding_min(ngram_hashes(h, gram), width - gram + 1)
            row = np.searchsorted(off, np.arange(len(name)), side="right") - 1
            inside = np.arange(len(name)) + width <= off[row + 1]
            name, row, at = name[inside], row[inside], np.flatnonzero(inside)
            if not len(at):
                continue
            block = (at - off[row]) // BLOCK_WORDS
            first = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (row[1:] != row[:-1]) | (block[1:] != block[:-1])])
            n = np.diff(np.r_[first, len(at)])
            r = row[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[first].view(np.int64)), *(pa.array(b.column(c).to_numpy()[r]) for c in ("did", "th")), pa.array((at[first] - off[r]).astype(np.int32)), pa.array(n.astype(np.int32))],
                ["name", "did", "th", "start", "n"],
            )

    return run


_WANT = "array<struct<shard: long, salt: long, ref: boolean, start: int, n: int>>"


def _cut(width: int, of_text: bool):
    """Word regions that the shards ask of a source row: neighbouring requests of one shard are one region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text" if of_text else "words"):
            if of_text:
                h, off = word_hashes(b.column("text"), lower=False)
            out: dict[str, list] = {c: [] for c in ("shard", "salt", "kind", "did", "th", "base", "words", "windows")}
            want = b.column("want")
            lists, flat = want.offsets.to_numpy(), want.values
            cols = {c: flat.field(i).to_numpy(zero_copy_only=False) for i, c in enumerate(("shard", "salt", "ref", "start", "n"))}
            for r in range(b.num_rows):
                w = slice(lists[r], lists[r + 1])
                shard, salt, ref, start, n = (cols[c][w] for c in ("shard", "salt", "ref", "start", "n"))
                words = h[off[r] : off[r + 1]] if of_text else np.frombuffer(b.column("words")[r].as_buffer(), np.uint64)
                base = 0 if of_text else b.column("base")[r].as_py()
                order = np.lexsort((start, ref, salt, shard))
                shard, salt, ref, start, n = (x[order] for x in (shard, salt, ref, start, n))
                reach = 0
                group: list[tuple[int, int]] = []
                did, th = b.column("did")[r].as_py(), b.column("th")[r].as_py()

                def emit(i: int) -> None:
                    lo, hi = group[0][0], max(a + k for a, k in group) + width - 1  # noqa: B023
                    mark = np.zeros(hi - width + 1 - lo, bool)
                    for a, k in group:  # noqa: B023
                        mark[a - lo : a - lo + k] = True
                    for c, v in (("shard", shard[i]), ("salt", salt[i]), ("kind", 0 if ref[i] else 1), ("did", did), ("th", th), ("base", lo), ("words", words[lo - base : hi - base].tobytes()), ("windows", np.packbits(mark).tobytes())):  # noqa: B023
                        out[c].append(v)  # noqa: B023

                for i in range(len(shard)):
                    if group and (shard[i] != shard[i - 1] or salt[i] != salt[i - 1] or ref[i] != ref[i - 1] or start[i] > reach or reach - group[0][0] > REGION_WORDS):
                        emit(i - 1)
                        group = []
                    reach = max(reach, start[i] + n[i]) if group else start[i] + n[i]
                    group.append((int(start[i]), int(n[i])))
                if group:
                    emit(len(shard) - 1)
            types = {"shard": pa.int64(), "salt": pa.int64(), "kind": pa.int32(), "did": pa.int64(), "th": pa.int64(), "base": pa.int32(), "words": pa.binary(), "windows": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[c], types[c]) for c in types], list(types))

    return run


_REGION = "shard long, salt long, kind int, did long, th long, base int, words binary, windows binary"


def _match(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, automaton, closed = None, None, False
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("did", "th", "base", "shard", "start", "n", "found", "name")}
            for r in range(b.num_rows):
                key = (b.column("shard")[r].as_py(), b.column("salt")[r].as_py())
                if key != held:
                    held, automaton, closed = key, Automaton(), False
                h = np.frombuffer(b.column("words")[r].as_buffer(), np.uint64)
                did = b.column("did")[r].as_py()
                if b.column("kind")[r].as_py() == 0:
                    automaton.add(h.tolist(), did)
                    continue
                if not closed:
                    automaton.close()
                    closed = True
                found = automaton.held(h.tolist(), did, width)
                asked = np.unpackbits(np.frombuffer(b.column("windows")[r].as_buffer(), np.uint8), count=len(found)).astype(bool)
                base = b.column("base")[r].as_py()
                edge = np.flatnonzero(np.r_[True, (found[1:] != found[:-1])])
                for lo, hi in zip(edge, np.r_[edge[1:], len(found)], strict=True):
                    if found[lo]:
                        for c, v in zip(out, (did, b.column("th")[r].as_py(), base, key[0], base + int(lo), int(hi - lo), True, None), strict=True):
                            out[c].append(v)
                left = np.flatnonzero(asked & ~found)
                if len(left):
                    names = ngram_hashes(h, width)[left].view(np.int64)
                    for i, v in zip(left.tolist(), names.tolist(), strict=True):
                        for c, x in zip(out, (did, b.column("th")[r].as_py(), base, key[0], base + i, 1, False, v), strict=True):
                            out[c].append(x)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(out, types, strict=True)], list(out))

    return run


_FOUND = "did long, th long, base int, shard long, start int, n int, found boolean, name long"


def _resolve(segments: DataFrame, source: DataFrame, of_text: bool, width: int) -> tuple[DataFrame, DataFrame]:
    """(regions sent to the shards, their windows: found in a smaller document, or left over with their own name).

    segments: (name, did, th, [base, from], start, n); source: rows (did, th, text) or stored regions.
    """
    at = ["did", "th"] if of_text else ["did", "th", "base", "shard"]
    leaders = segments.groupBy("name").agg(F.min(F.struct("did", "start", *[c for c in at if c != "did"], "n")).alias("lead"), F.max("did").alias("top")).filter(F.col("lead.did") < F.col("top"))
    leaders = stored(leaders.select("name", "lead"), "leaders")
    total = leaders.agg(F.sum(F.col("lead.n") + 8)).first()[0] or 0
    shards = max(1, int(total) // SHARD_WORDS)
    home = F.pmod(F.xxhash64("lead.did", "lead.th", F.floor(F.col("lead.start") / BLOCK_WORDS)), F.lit(shards))
    leaders = leaders.withColumn("home", home)
    # in round 1 a name stands for many windows: the leading document's other segments of it may hold some that the leader lacks
    other = (F.col("start") != F.col("lead.start")) | (F.col("th") != F.col("lead.th"))
    sent = segments.join(leaders, "name").filter((F.col("did") > F.col("lead.did")) | (other if of_text else F.lit(False)))
    probes = stored(sent.select("home", *at, "start", "n"), "probes")
    salts = F.coalesce("salts", F.lit(1))
    # shards above the bound, written; Spark broadcasts the table only if it is small
    spread = probes.groupBy("home").agg(F.sum(F.col("n") + 8).alias("words")).filter(F.col("words") > SALT_WORDS).select("home", F.ceil(F.col("words") / SALT_WORDS).alias("salts"))
    spread = stored(spread, "spread")
    asks = probes.join(spread, "home", "left").select(*at, F.struct(F.col("home").alias("shard"), F.pmod(F.xxhash64("did", "th", F.floor(F.col("start") / BLOCK_WORDS)), salts).alias("salt"), F.lit(False).alias("ref"), "start", "n").alias("w"))
    copies = F.transform(
        F.sequence(F.lit(0).cast("long"), salts - 1),
        lambda s: F.struct(F.col("home").alias("shard"), s.alias("salt"), F.lit(True).alias("ref"), F.col("lead.start").alias("start"), F.col("lead.n").alias("n")),
    )
    refs = leaders.join(spread, "home", "left").select(*[F.col(f"lead.{c}").alias(c) for c in at], F.explode(copies).alias("w"))
    # what one document is asked for is bounded by its length; equal rows ask for the same
    want = asks.unionByName(refs).groupBy(*at).agg(F.collect_set("w").alias("want"))
    cut = source.join(want, at)
    regions = (cut.select("did", "th", "text", "want") if of_text else cut.select("did", "th", "base", "words", "want")).mapInArrow(_cut(width, of_text), _REGION)
    regions = stored(regions, "regions")
    dealt = regions.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return regions.filter("kind = 1"), stored(dealt.mapInArrow(_match(width), _FOUND), "windows")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(did, th, start, n): runs of window starts whose windows also start in a document with a smaller id."""
    keyed = row_keys(docs, id_col, text_col)
    segments = stored(keyed.mapInArrow(_segments(width, gram), "name long, did long, th long, start int, n int"), "segments")
    regions, first = _resolve(segments, keyed, True, width)
    left = first.filter("not found").select("name", "did", "th", "base", "shard", "start", "n").dropDuplicates(["name", "did", "th", "start"])
    source = regions.select("did", "th", "base", "shard", "words").dropDuplicates(["did", "th", "base", "shard"])
    _, second = _resolve(left, source, False, width)
    return first.filter("found").unionByName(second.filter("found")).select("did", "th", "start", "n")


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = text_bytes(b.column("text"))
            starts, ends, rows = word_bounds(data, off)
            raw = data.tobytes()
            gone = b.column("gone")
            texts, n_words, n_removed = [], np.diff(rows), np.zeros(b.num_rows, np.int64)
            for r in range(b.num_rows):
                lo, hi = starts[rows[r] : rows[r + 1]], ends[rows[r] : rows[r + 1]]
                if gone[r].is_valid:
                    cover = np.zeros(len(lo) + 1, np.int64)
                    runs = gone[r].values
                    s, n = runs.field(0).to_numpy(), runs.field(1).to_numpy()
                    np.add.at(cover, s, 1)
                    np.add.at(cover, s + n + width - 1, -1)
                    keep = np.cumsum(cover)[:-1] == 0
                    n_removed[r] = len(lo) - int(keep.sum())
                    lo, hi = lo[keep], hi[keep]
                texts.append(b" ".join([raw[a:z] for a, z in zip(lo.tolist(), hi.tolist(), strict=True)]))
            keep_cols = [c for c in b.schema.names if c not in ("text", "gone")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep_cols), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words.astype(np.int64)), pa.array(n_removed)], [*keep_cols, "kept", "n_words", "n_removed"])

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(did, th, kept, n_words, n_removed): the words of each row that no repeated window covers, joined by one space."""
    windows = repeated_windows(docs, id_col, text_col, width, gram)
    gone = windows.groupBy("did", "th").agg(F.collect_set(F.struct("start", "n")).alias("gone"))
    return row_keys(docs, id_col, text_col).join(gone, ["did", "th"], "left").mapInArrow(_remove(width), "did long, th long, kept string, n_words long, n_removed long")
