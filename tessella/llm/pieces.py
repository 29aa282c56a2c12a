"""SentencePiece encoding and decoding, and distinct sampled segmentations by Gumbel top-k.

`encode` and `decode` run the public vocabulary on whole texts. `sample` draws k different segmentations of each text
without replacement. A text is a chain of units, cut wherever no piece holds the two characters side by side, so no piece
crosses them; each distinct unit of a batch has a lattice of pieces with weight -alpha * log(2 + rank), and backward
sums over it give the exact probability of every next piece. The search is a perturbed A*: a subtree is all segmentations
with a common beginning, its key is the largest Gumbel-perturbed log probability in it, drawn top-down. The root's key
belongs to the first sample, a plain ancestral draw; every decision of a sample leaves the subtree of its alternatives,
with a key truncated at the sample's own; the best open subtree gives the next sample. Keys are exact
maxima, so samples come out in order of their perturbed scores, and the key after the k-th gives each one's inclusion
score, 1 - exp(-exp(log p - kappa)).

All draws are hashes of the row key and the place of the draw, so results don't depend on partitions, order or batches.
Work is one pass without a shuffle; numpy handles all texts of a slice together.

Defined results: null text has no pieces and no samples; empty text has the empty segmentation with probability one; if
there are fewer than k segmentations, all are returned, then inclusion is 1.0; characters without a piece are
spelt in byte pieces; a text that holds U+2581 itself doesn't decode to itself (`same` is false); a null key counts as 0;
repeated rows get the same samples; an empty table gives an empty result; extra columns are carried in `doc`; a very long
text is one slice, whose lattice is held whole (some 200 bytes a character, 600 without spaces), in time linear in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, mix, powers, slices, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA, SAMPLES = 1.5, 3
#: UTF-8 bytes of text whose lattices are held at once.
LATTICE_BYTES = 1 << 18
#: Characters of new units whose lattices are made at once.
ADDED_AT_ONCE = 1 << 16
#: Pieces that the lattices of known units may hold; beyond it the units met least often are forgotten.
STORE_EDGES = 1_000_000
#: New units that the vocabulary encodes in one call.
ENCODED_AT_ONCE = 1024
#: Classes that the characters of longer pieces are dealt to; with more characters some share a class, then units are longer than need be.
CLASSES = 2048
#: One in units of the summed probabilities: sums of 64-bit integers are exact in any order.
ONE = 2.0**62
_NONE = np.iinfo(np.int32).min
SPACE, BREAK = 0x2581, 10
_B = np.uint64(0xD1342543DE82EF95)
_loaded: dict[str, Vocabulary] = {}


class Vocabulary:
    """The pieces as a prefix table: each prefix of a piece by its hash, with the piece's id where it is one."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.line_break = sp.encode("\n")[-1]
        self.bytes = np.zeros(256, np.int64)
        known: dict[int, int] = {}
        self.longest = 1
        # what each piece decodes to; none for bytes and the like, whose texts the vocabulary decodes itself
        surface: list[np.ndarray] = [np.zeros(0, np.int64)] * sp.get_piece_size()
        side_by_side: list[np.ndarray] = []
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
                continue
            if sp.is_control(i) or sp.is_unknown(i):
                continue
            codes = np.array([ord(c) for c in sp.id_to_piece(i)], np.uint64)
            side_by_side.append(np.stack([codes[:-1], codes[1:]]).astype(np.int64))
            if not sp.is_unused(i):
                self.longest = max(self.longest, len(codes))
                surface[i] = codes.astype(np.int64)
                h = np.uint64(0)
                with np.errstate(over="ignore"):
                    for n, v in enumerate(mix(codes, 9)):
                        h = h * _B + v
                        known[int(h)] = i if n == len(codes) - 1 else known.get(int(h), _NONE)
        surface[self.line_break] = np.array([BREAK])
        self.surface, self.surface_off = np.concatenate(surface), np.r_[0, np.cumsum([len(x) for x in surface])]
        # which characters stand side by side in a piece, by classes of characters; class 0 never does
        left, right = np.concatenate(side_by_side, axis=1)
        chars = np.setdiff1d(np.r_[left, right], [BREAK])
        self.classes = min(len(chars) + 1, CLASSES)
        self.class_of = np.zeros(0x110000, np.int16)
        self.class_of[chars] = 1 + np.arange(len(chars)) % max(self.classes - 1, 1)
        self.joined = np.zeros((self.classes, self.classes), bool)
        self.joined[self.class_of[left], self.class_of[right]] = True
        self.joined[0] = self.joined[:, 0] = False
        self.keys = np.array(list(known), np.uint64)
        self.ids = np.array(list(known.values()), np.int64)
        self.rank = np.maximum(0, np.array([-sp.get_score(i) for i in range(sp.get_piece_size())]))
        # two hashed tables: what finds its slot of the first taken has one in the second; the few others are searched
        self.tables, left = [], np.arange(len(self.keys))
        for shift in (0, 20):
            slot = (mix(self.keys[left], 4) >> np.uint64(shift) & np.uint64((1 << 20) - 1)).astype(np.int64)
            t = np.full(1 << 20, -1, np.int32)
            t[slot] = left
            self.tables.append((shift, t))
            left = left[t[slot] != left]
        self.rest = {int(self.keys[i]): int(i) for i in left}

    def spells(self, ids: np.ndarray, chars: np.ndarray) -> bool:
        """Are the pieces' own characters, end to end, these (with SPACE for spaces)? False where a piece has none."""
        n = self.surface_off[ids + 1] - self.surface_off[ids]
        return bool(n.all()) and int(n.sum()) == len(chars) and bool((self.surface[_gather(self.surface_off, ids, n)] == chars).all())

    def apart(self, codes: np.ndarray) -> np.ndarray:
        """Is there no piece that could hold a character and the one before it? Neither a piece nor a merge crosses there."""
        kind = self.class_of[codes].astype(np.int64)
        out = np.ones(len(codes), bool)
        out[1:] = ~self.joined.ravel()[kind[:-1] * self.classes + kind[1:]]
        return out

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each prefix hash, -1 if there is none."""
        m = mix(h, 4)
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for shift, t in self.tables:
            at = t[(m[todo] >> np.uint64(shift) & np.uint64((1 << 20) - 1)).astype(np.int64)]
            hit = (at >= 0) & (self.keys[at] == h[todo])
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (at >= 0)]
        if self.rest and len(todo):
            out[todo] = [self.rest.get(int(x), -1) for x in h[todo].tolist()]
        return out


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


_C1, _C2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def placed(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A key for each place under a row key."""
    with np.errstate(over="ignore"):
        return mix(key + place.astype(np.uint64) * _C1, 90)


def uniform(key: np.ndarray, draw: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), hashed from a key and the number of the draw."""
    with np.errstate(over="ignore"):
        n = (draw + 1).astype(np.uint64) if isinstance(draw, np.ndarray) else np.uint64((draw + 1) % 2**64)
        h = mix(key + n * _C2, 91)
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


class Lattice:
    """Units of the texts, and for each distinct unit the pieces that can follow each place, with exact probabilities.

    A lattice can take another slice of texts with read(): units it knows already are kept, the most frequent half of them
    once they hold STORE_EDGES pieces. What is known changes no result, only the time taken.
    """

    #: Stored arrays by what their entries are.
    EDGES = {"piece": np.int32, "target": np.int32, "tokens": np.int8, "fixed": np.int64, "mass": np.int64, "others": np.float64}
    UNITS = {"begin": np.int64, "last": np.int64, "uses": np.int64, "whole": np.bool_}

    def __init__(self, vocab: Vocabulary, alpha: float):
        self.vocab = vocab
        self.per = -alpha * np.log(2 + vocab.rank)  # weight of each piece
        self.per[vocab.bytes] = -alpha * np.log(2 + len(vocab.rank))
        self._buffers: dict[str, np.ndarray] = {}
        for name, kind in (self.EDGES | self.UNITS | {"ids": np.int32}).items():
            setattr(self, name, np.zeros(0, kind))
        self.edges, self.id_off = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.cut = np.zeros(0, np.bool_)  # of each node: every way through its unit passes it
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _append(self, name: str, values: np.ndarray) -> None:
        """Lengthen one of the stored arrays; its buffer doubles, so most calls copy the new values only."""
        old = getattr(self, name)
        n, buffer = len(old) + len(values), self._buffers.get(name)
        if buffer is None or n > len(buffer):
            buffer = self._buffers[name] = np.empty(max(2 * n, STORE_EDGES * 5 // 4 if name in self.EDGES else 0), old.dtype)
            buffer[: len(old)] = old
        buffer[len(old) : n] = values
        setattr(self, name, buffer[:n])

    def _forget(self) -> None:
        """Keep the units met most often, as many as hold half of STORE_EDGES."""
        size = self.edges[self.last + 1] - self.edges[self.begin]
        order = np.argsort(-self.uses, kind="stable")
        keep = np.sort(order[: np.searchsorted(np.cumsum(size[order]), STORE_EDGES // 2, side="right")])
        nodes = self.last[keep] - self.begin[keep] + 1
        at = np.repeat(self.begin[keep] - (np.cumsum(nodes) - nodes), nodes) + np.arange(int(nodes.sum()))
        e = _gather(self.edges[self.begin], keep, size[keep])
        begin = np.cumsum(nodes) - nodes
        words = self.id_off[keep + 1] - self.id_off[keep]
        new = {c: getattr(self, c)[e] for c in self.EDGES} | {c: getattr(self, c)[keep] for c in self.UNITS} | {"ids": self.ids[_gather(self.id_off, keep, words)]}
        new["target"] = (new["target"] + np.repeat(begin - self.begin[keep], size[keep])).astype(np.int32)
        new |= {"begin": begin, "last": begin + nodes - 1, "uses": new["uses"] // 2}
        new |= {"cut": self.cut[at]}
        degree = np.diff(self.edges)[at]
        self._buffers = {}
        for c, v in new.items():
            setattr(self, c, v[:0])
            self._append(c, v)
        self.edges, self.id_off = np.r_[0, np.cumsum(degree)], np.r_[0, np.cumsum(words)]
        number = np.full(int(self.numbers.max()) + 1, -1)
        number[keep] = np.arange(len(keep))
        on = number[self.numbers] >= 0
        self.hashes, self.numbers = self.hashes[on], number[self.numbers[on]]

    def read(self, text: pa.Array) -> None:
        """Take these texts: rows, unit (the number of each unit in order)."""
        data, off = text_bytes(text)
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][off]
        n = np.diff(points)
        # a space before each text, as the encoder has it
        at = np.flatnonzero(n > 0)
        marked = np.r_[0, np.cumsum(codes == SPACE)]
        self.marks = marked[points[1:]] > marked[points[:-1]]  # rows that hold the mark itself
        codes = np.insert(codes, points[:-1][at], 32).astype(np.int64)
        codes[codes == 32] = SPACE
        bounds = points + np.r_[0, np.cumsum(n > 0)]
        first = np.zeros(len(codes), bool)
        first[bounds[:-1][at]] = True
        starts = np.flatnonzero(first | self.vocab.apart(codes))
        self.rows = np.searchsorted(starts, bounds)  # units of each row
        ends = np.r_[starts[1:], len(codes)]
        # distinct units
        size = ends - starts
        up, down = powers(len(codes) + 1)
        with np.errstate(over="ignore"):
            run = np.r_[np.uint64(0), np.cumsum(mix(codes, 9) * up[: len(codes)])]
            h = mix((run[ends] - run[starts]) * down[starts] + size.astype(np.uint64), 5)
        names, index, self.unit = np.unique(h, return_index=True, return_inverse=True)
        if len(self.piece) > STORE_EDGES:
            self._forget()
        at = np.minimum(np.searchsorted(self.hashes, names), max(len(self.hashes) - 1, 0))
        new = self.hashes[at] != names if len(self.hashes) else np.ones(len(names), bool)
        if new.any():
            fresh = len(self.begin) + np.arange(int(new.sum()))
            s, k = starts[index[new]], size[index[new]]
            block = (np.cumsum(k) - k) // ADDED_AT_ONCE
            for part in np.split(np.arange(len(k)), np.flatnonzero(np.diff(block)) + 1):
                self._add(codes, s[part], k[part])
            order = np.argsort(every := np.r_[self.hashes, names[new]], kind="stable")
            self.hashes, self.numbers = every[order], np.r_[self.numbers, fresh][order]
        self.places, self.before = np.flatnonzero(self.cut), np.r_[0, np.cumsum(self.cut)]  # the places, and how many come before each node
        numbers = self.numbers[np.searchsorted(self.hashes, names)]
        self.uses[numbers] += np.bincount(self.unit, minlength=len(names))
        self.unit = numbers[self.unit]

    def _add(self, codes: np.ndarray, s: np.ndarray, k: np.ndarray) -> None:
        """Lattices and encodings of units (starts s, sizes k in codes) that aren't known yet."""
        vocab = self.vocab
        base = np.cumsum(k) - k
        where = np.repeat(s - base, k) + np.arange(int(k.sum()))
        code = codes[where]
        self._encode(code, k)
        value = mix(code.astype(np.uint64), 9)
        left = np.repeat(base + k, k) - np.arange(len(code))  # characters to the end of the unit
        # nodes: one for each character and one for each unit's end
        shift = np.repeat(np.arange(len(k)), k)
        node = np.arange(len(code)) + shift
        begin, nodes, old, known = base + np.arange(len(k)), len(code) + len(k), len(self.edges) - 1, len(self.piece)
        active, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        # the piece of each length at each place, the longest first
        found = np.full((len(code), vocab.longest), _NONE, np.int32)
        with np.errstate(over="ignore"):
            for n in range(1, vocab.longest + 1):
                h = h * _B + value[active + n - 1]
                at = vocab.find(h)
                ok = at >= 0
                active, h = active[ok], h[ok]
                found[active, vocab.longest - n] = vocab.ids[at[ok]]
                more = left[active] > n
                active, h = active[more], h[more]
        single = found[:, -1]
        spelt = np.flatnonzero(single == _NONE)
        single[spelt] = np.where(code[spelt] < 128, vocab.bytes[np.minimum(code[spelt], 127)], -code[spelt] - 1)  # a character in byte pieces
        flat = np.flatnonzero(found.ravel() != _NONE)
        piece = found.ravel()[flat]
        source = flat // vocab.longest
        length = vocab.longest - (flat - source * vocab.longest)
        width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        weight = self.per[np.maximum(piece, 0)]
        rare = np.flatnonzero(piece < 0)
        weight[rare] = self.per[vocab.bytes[0]] * width[source[rare]]
        degree = np.bincount(source, minlength=len(code))
        own = np.repeat(node, degree)
        target = own + length
        edges = np.zeros(nodes, np.int64)
        edges[node] = degree
        edges = np.r_[0, np.cumsum(edges)]
        # places within a unit that no piece covers: every way passes them, so what lies between two is a lattice of its own
        covers = np.zeros(len(code) + 1, np.int64)
        wide = length > 1
        np.add.at(covers, source[wide] + 1, 1)
        np.add.at(covers, (source + length)[wide], -1)
        passed = np.flatnonzero(np.cumsum(covers)[:-1] == 0)
        stop = np.r_[passed, len(code)][np.searchsorted(passed, np.arange(len(code)), side="right")]
        narrow = np.zeros(nodes, bool)
        narrow[node[passed]] = True
        narrow[begin] = False
        # sums over all ways from a node to the next such place, by the distance to it
        beta = np.zeros(nodes + 1)
        far = np.repeat(stop - np.arange(len(code)), degree)
        inner = np.where(source + length == stop[source], nodes, target)  # at the place itself: 0
        by = np.argsort(far.astype(np.int16) if far.max(initial=0) < 2**15 else far, kind="stable")
        cut = np.searchsorted(far[by], np.arange(1, int(far.max(initial=0)) + 2))
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if hi > lo:
                e = by[lo:hi]
                v = weight[e] + beta[inner[e]]
                src = own[e]
                g = np.flatnonzero(np.r_[True, src[1:] != src[:-1]])
                top = np.maximum.reduceat(v, g)
                beta[src[g]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, np.diff(np.r_[g, len(e)]))), g))
        exact = np.minimum(weight + beta[inner] - beta[own], 0.0)
        # sums over a node's earlier pieces and over all its others: in integers, so without cancellation
        share = np.maximum(np.rint(np.exp(exact) * ONE).astype(np.int64), 1)
        ends = np.cumsum(share)  # modulo 2**64: differences within a node are right
        first = np.cumsum(degree) - degree
        before = (ends - share)[first]
        mass = ends - np.repeat(before, degree)
        mass[first + degree - 1] = np.iinfo(np.int64).max  # the last one takes what is left
        whole = np.repeat(ends[first + degree - 1] - before, degree)
        with np.errstate(divide="ignore"):
            others = np.log((whole - share) / ONE)  # log probability of all other pieces there, -inf if there are none
        tokens = np.ones(len(piece), np.int8)
        tokens[rare] = width[source[rare]]
        # in units of 2**-32 the sums of log probabilities are exact, so they don't depend on what else is in the batch
        fixed = np.rint(exact * 2**32).astype(np.int64)
        for name, values in (
            ("begin", begin + old), ("last", begin + k + old), ("uses", np.zeros(len(k), np.int64)), ("cut", narrow), ("edges", edges[1:] + known), ("piece", piece), ("target", target + old),
            ("tokens", tokens), ("fixed", fixed), ("mass", mass), ("others", others),
        ):
            self._append(name, values)

    def _encode(self, code: np.ndarray, k: np.ndarray) -> None:
        """The vocabulary's own encoding of each unit: no merge crosses units, so a text's encoding is theirs end to end.

        Many units are encoded in one call, a line break before each. Does it decode to the unit, too?
        """
        sp = self.vocab.processor
        base = np.cumsum(k) - k
        plain = (k > 1) | (code[base] != BREAK)  # a line break is a unit of its own
        count, good, found = np.ones(len(k), np.int64), np.ones(len(k), bool), []
        chars = np.where(code == SPACE, 32, code)[np.repeat(plain, k)]
        units, at = np.flatnonzero(plain), np.r_[0, np.cumsum(k[plain])]
        for lo in range(0, len(units), ENCODED_AT_ONCE):
            part = units[lo : lo + ENCODED_AT_ONCE]
            x, y = at[lo], at[lo + len(part)]
            text = np.insert(chars[x:y], at[lo : lo + len(part)] - x, BREAK).astype("<u4").tobytes().decode("utf-32-le")
            ids = np.asarray(sp.encode(text, return_type="numpy", num_threads=1), np.int32)[1:]  # without the encoder's own space
            cut = np.flatnonzero(ids == self.vocab.line_break)
            if len(cut) != len(part):
                raise ValueError("the vocabulary must keep line breaks apart")
            count[part] = np.diff(np.r_[cut, len(ids)]) - 1
            found.append(np.delete(ids, cut))
            if not self.vocab.spells(ids, np.insert(np.where(chars[x:y] == 32, SPACE, chars[x:y]), at[lo : lo + len(part)] - x, BREAK)) and sp.decode(ids) != text:
                good[part] = [sp.decode(i) == "\n" + t for i, t in zip(np.split(ids, cut[1:]), text[1:].split("\n"), strict=True)]
        off = np.r_[0, np.cumsum(count)]
        out = np.full(int(off[-1]), self.vocab.line_break, np.int32)
        if found:
            out[np.repeat(plain, count)] = np.concatenate(found)
        self._append("whole", good)
        self._append("ids", out)
        self._append("id_off", self.id_off[-1] + off[1:])

    def encoded(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n+1 offsets by row) of the texts' encodings."""
        n = self.id_off[self.unit + 1] - self.id_off[self.unit]
        return self.ids[_gather(self.id_off, self.unit, n)], np.r_[0, np.cumsum(n)][self.rows]

    def decoded(self) -> np.ndarray:
        """Does the encoding of each row decode to its text?"""
        bad = np.r_[0, np.cumsum(~self.whole[self.unit])]
        return (bad[self.rows[1:]] == bad[self.rows[:-1]]) & ~self.marks

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by its probability."""
        edge = self.edges[node]
        u = (u * ONE).astype(np.int64)
        on = np.flatnonzero(u >= self.mass[edge])
        at, u = edge[on], u[on]
        while len(on):
            at += 1
            edge[on] = at
            more = np.flatnonzero(u >= self.mass[at])
            on, at, u = on[more], at[more], u[more]
        return edge

    def walk(self, node: np.ndarray, last: np.ndarray, key: np.ndarray, number: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Ancestral draws from each node to its unit's end: (edges, n+1 offsets), in order.

        What lies between two places that every way passes is drawn beside the rest, so a long unit takes as many steps as
        its longest such stretch has pieces. A draw is named by its distance to the unit's end.
        """
        places, lo = self.places, self.before[node + 1]
        more = self.before[last] - lo
        more[node >= last] = 0
        size = more + 1
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(node)), size)
        at = np.empty(len(owner), np.int64)
        at[first] = node
        inner = np.ones(len(owner), bool)
        inner[first] = False
        at[inner] = places[np.repeat(lo - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))]
        end, stop = last[owner], np.empty(len(owner), np.int64)
        stop[:-1] = at[1:]
        stop[first + size - 1] = last
        key, name = placed(key, number)[owner], end + (turn << 32)
        step, on, chosen, walker = 0, np.flatnonzero(at < stop), [], []
        while len(on):
            e = self.choose(at[on], uniform(key[on], name[on] - at[on]))
            chosen.append(e)
            walker.append(on)
            at[on] = self.target[e]
            on = on[at[on] < stop[on]]
            step += 1
        count = np.bincount(np.concatenate(walker), minlength=len(owner)) if walker else np.zeros(len(owner), np.int64)
        offsets = np.r_[0, np.cumsum(count)]
        out = np.zeros(int(offsets[-1]), np.int64)
        for j, (e, o) in enumerate(zip(chosen, walker, strict=True)):
            out[offsets[o] + j] = e
        return out, offsets[np.r_[first, len(owner)]]


def _truncated(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Maxima of Gumbels at phi, given that they lie below top."""
    return np.where(np.isneginf(phi), -np.inf, phi - np.log(np.exp(np.clip(phi - top, -700, 700)) - np.log(u)))


def _best(v: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n largest values of each row (rows in order), and of their equals."""
    if not len(v):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size, v, out = np.diff(np.r_[first, len(v)]), v.copy(), []
    for _ in range(n):
        hit = np.flatnonzero((v == np.repeat(np.maximum.reduceat(v, first), size)) & (v > -np.inf))
        v[hit] = -np.inf
        out.append(hit)
    return np.sort(np.concatenate(out))


#: No Gumbel of uniform() is larger; and how far below a row's beginning its subtrees are looked for first.
GUMBEL, SPAN = 37.0, 48.0


@dataclass
class Sample:
    """One segmentation of each of `rows`: decisions (edges) by row, log p and perturbed log p."""

    rows: np.ndarray
    edges: np.ndarray
    off: np.ndarray
    logp: np.ndarray
    key: np.ndarray


def _gather(off: np.ndarray, rows: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions of the first count[i] entries of each row."""
    return np.repeat(off[rows] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _branches(lattice: Lattice, run: np.ndarray, edges: np.ndarray, off: np.ndarray, fresh: np.ndarray, top: np.ndarray, key: np.ndarray, turn: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, key) of the n best subtrees that a sample leaves from place `fresh` on: no more of a row's can still be opened.

    A Gumbel of 53 bits lies less than GUMBEL above its place. So where a beginning's log probability (run) falls below -span,
    keys are below GUMBEL - span: a row whose n-th best key of the places before is higher needs no more of them.
    """
    rows, span = np.flatnonzero(np.diff(off) > fresh), float(SPAN)
    lost = -run
    while len(rows):
        begin, end = off[rows], off[rows + 1]
        stop = np.minimum(np.searchsorted(lost, lost[begin] + int(span * 2**32), side="right"), end) if span < 2**30 else end
        start = begin + fresh[rows]
        size = np.maximum(stop - start, 0)
        on, row = _gather(start, np.arange(len(rows)), size), np.repeat(rows, size)
        others = lattice.others[edges[on]]
        able = np.flatnonzero(others > -np.inf)
        on, row = on[able], row[able]
        place = on - off[row]
        phi = (run[on] - run[off[row]]) / 2**32 + others[able]
        v = _truncated(phi, top[row], uniform(placed(key[row], place), -1000 - turn))
        keep = _best(v, row, n)
        row, place, v = row[keep], place[keep], v[keep]
        enough = np.bincount(row[v > GUMBEL - span], minlength=len(off))[rows] >= n
        done = np.zeros(len(off), bool)
        done[rows] = enough | (stop == end)
        yield row[done[row]], place[done[row]], v[done[row]]
        rows, span = rows[~done[rows]], span * 8


def draw(lattice: Lattice, key: np.ndarray, k: int) -> tuple[list[Sample], np.ndarray]:
    """k samples of each row without replacement, best first, and the key of each row's best open subtree after them.

    Open subtrees are (row, key, sample, place, edge): the beginning of that sample up to the place, then the edge; or
    edge -1 for all edges there but the sample's own.
    """
    n_rows = len(lattice.rows) - 1
    unit_row = np.repeat(np.arange(n_rows), np.diff(lattice.rows))
    number = np.arange(len(unit_row)) - lattice.rows[:-1][unit_row]
    begin, last = lattice.begin[lattice.unit], lattice.last[lattice.unit]
    samples: list[Sample] = []
    open_ = {c: [np.zeros(0, np.float64 if c == "v" else np.int64)] for c in ("row", "v", "sample", "place", "edge")}

    def add(**columns) -> None:
        for c, v in columns.items():
            open_[c].append(np.asarray(v))

    for turn in range(k):
        if not turn:
            rows, top = np.arange(n_rows), -np.log(-np.log(uniform(key, 0)))
            edges, ends = lattice.walk(begin, last, key[unit_row], number, 0)
            off, fresh = ends[lattice.rows], np.zeros(n_rows, np.int64)
        else:
            cat = {c: np.concatenate(v) for c, v in open_.items()}
            order = np.lexsort((cat["v"], cat["row"]))
            pick = order[np.r_[np.diff(cat["row"][order]) > 0, True]] if len(order) else order
            pick = pick[~np.isneginf(cat["v"][pick])]
            rows, best, source, place, edge = (cat[c][pick] for c in ("row", "v", "sample", "place", "edge"))
            cat["v"][pick] = -np.inf
            open_ = {c: [v] for c, v in cat.items()}
            if not len(rows):
                break
            top = np.full(n_rows, -np.inf)
            top[rows] = best
            # beginnings, edge by edge of the parents
            heads, old, old_unit, before = [], np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for s in np.unique(source).tolist():
                on, parent = np.flatnonzero(source == s), samples[s]
                head = parent.edges[_gather(parent.off, rows[on], place[on])]
                heads.append((on, head))
                old[on] = parent.edges[parent.off[rows[on]] + place[on]]
                ends = np.cumsum(place[on])
                sums = np.r_[0, np.cumsum(lattice.fixed[head])]
                before[on] = (sums[ends] - sums[ends - place[on]]) / 2**32
                met = lattice.target[head]
                closed = np.r_[0, np.cumsum(lattice.edges[met + 1] == lattice.edges[met])]  # a unit's end has no edges
                old_unit[on] = lattice.rows[rows[on]] + closed[ends] - closed[ends - place[on]]
            # open the subtrees that still hold several edges: Gumbels of each, given their maximum
            several = np.flatnonzero(edge < 0)
            node = np.searchsorted(lattice.edges, old[several], side="right") - 1
            size = lattice.edges[node + 1] - lattice.edges[node]
            child = _gather(lattice.edges, node, size)
            of = np.repeat(several, size)
            child, of = child[child != old[of]], of[child != old[of]]
            g = before[of] + lattice.fixed[child] / 2**32 - np.log(-np.log(uniform(placed(key[rows[of]], (place[of] << 20) + child - lattice.edges[np.searchsorted(lattice.edges, child, side="right") - 1]), -2 - turn)))
            peak = np.full(len(rows), -np.inf)
            np.maximum.at(peak, of, g)
            won = np.flatnonzero(g == peak[of])
            edge[of[won]] = child[won]
            lost = g != peak[of]
            c, o = child[lost], of[lost]
            # exp(-v) = exp(-best) - exp(-peak) + exp(-g), from the largest term
            add(row=rows[o], v=-np.logaddexp(-best[o], -g[lost] + np.log1p(-np.exp(np.minimum(g[lost] - peak[o], -1e-12)))), sample=source[o], place=place[o], edge=c)
            rest = lattice.rows[rows + 1] - old_unit - 1
            tail = _gather(old_unit + 1, np.arange(len(rows)), rest)
            e1, o1 = lattice.walk(lattice.target[edge], last[old_unit], key[rows], number[old_unit], 2 * turn)
            e2, o2 = lattice.walk(begin[tail], last[tail], np.repeat(key[rows], rest), number[tail], 2 * turn + 1)
            n1, n2 = np.diff(o1), np.diff(o2[np.r_[0, np.cumsum(rest)]])
            size = np.zeros(n_rows, np.int64)
            size[rows] = place + 1 + n1 + n2
            off = np.r_[0, np.cumsum(size)]
            edges, every = np.empty(int(off[-1]), np.int64), np.arange(len(rows))
            for on, head in heads:
                edges[_gather(off, rows[on], place[on])] = head
            edges[off[rows] + place] = edge
            edges[_gather(off[rows] + place + 1, every, n1)] = e1
            edges[_gather(off[rows + 1] - n2, every, n2)] = e2
            fresh = np.zeros(n_rows, np.int64)
            fresh[rows] = place + 1  # what branches off before is open already
        run = np.r_[0, np.cumsum(lattice.fixed[edges])]
        logp = (run[off[1:]] - run[off[:-1]]) / 2**32
        samples.append(Sample(rows, edges, off, logp, top))
        for row, place, v in _branches(lattice, run, edges, off, fresh, top, key, turn, k - turn):
            add(row=row, v=v, sample=np.full(len(row), turn), place=place, edge=np.full(len(row), -1))
    kappa = np.full(n_rows, -np.inf)
    for r, v in zip(open_["row"], open_["v"], strict=True):
        np.maximum.at(kappa, r, v)
    return samples, kappa


def token_ids(lattice: Lattice, vocab: Vocabulary, sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """(ids, n+1 offsets by row) of a sample; characters without a piece are spelt in bytes."""
    piece, tokens = lattice.piece[sample.edges], lattice.tokens[sample.edges]
    if not (piece < 0).any():
        return piece, sample.off
    ends = np.cumsum(tokens)
    ids = np.repeat(piece, tokens)
    for i in np.flatnonzero(piece < 0).tolist():
        ids[ends[i] - tokens[i] : ends[i]] = vocab.bytes[list(chr(-int(piece[i]) - 1).encode())]
    return ids, np.r_[0, ends][sample.off]


def _lists(values: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of these rows end to end, and their n+1 offsets."""
    if len(rows) == len(off) - 1 and (rows[1:] > rows[:-1]).all():
        return values, off.astype(np.int32)
    n = off[rows + 1] - off[rows]
    return values[_gather(off, rows, n)], np.r_[0, np.cumsum(n)].astype(np.int32)


def id_type(pieces: int) -> str:
    """Packed ids: little-endian numbers of 16 bits, of 32 for larger vocabularies."""
    return "<u2" if pieces <= 1 << 16 else "<i4"


def _column(ids: np.ndarray, off: np.ndarray, null: np.ndarray, packed: str | None) -> pa.Array:
    """Rows of ids as lists, or packed: one binary value a row, which Spark passes on as it is."""
    if packed is None:
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32), mask=np.r_[null, False]), pa.array(ids, pa.int32()))
    data = ids.astype(packed)
    ends = (off * data.itemsize).astype(np.int32)
    valid = np.packbits(~null, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(null), [pa.py_buffer(valid.tobytes()), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _segment(path: str, alpha: float, k: int, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        lattice = Lattice(vocab, alpha)  # of this task: its memory is given back at the end
        kind = id_type(len(vocab.rank)) if packed else None
        for b in slices(batches, size=LATTICE_BYTES):
            text = b.column("text")
            key = mix(b.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), 12)
            lattice.read(text)
            samples, kappa = draw(lattice, key, k)
            known = text.is_valid().to_numpy(zero_copy_only=False)
            got: dict[str, list[np.ndarray]] = {c: [] for c in ("row", "rank", "n", "logp", "key", "inclusion", "ids")}
            hashes: list[str] = []
            for rank, sample in enumerate(samples):
                rows = sample.rows[known[sample.rows]]
                ids, off = _lists(*token_ids(lattice, vocab, sample), rows)
                raw = memoryview(ids.astype("<i4").tobytes())
                hashes += [hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                inclusion = -np.expm1(-np.exp(np.clip(sample.logp[rows] - kappa[rows], -700, 700)))
                for c, v in (("row", rows), ("rank", np.full(len(rows), rank + 1, np.int32)), ("n", np.diff(off)), ("logp", sample.logp[rows]), ("key", sample.key[rows]), ("inclusion", inclusion), ("ids", ids)):
                    got[c].append(v)
            flat = {c: np.concatenate(v) for c, v in got.items()}
            order = np.argsort(flat["row"], kind="stable")
            at = np.r_[0, np.cumsum(flat["n"])]
            ids, off = _lists(flat["ids"], at, order)
            one = pa.StructArray.from_arrays(
                [pa.array(flat["rank"][order]), pa.array(flat["n"][order].astype(np.int64)), pa.array(hashes, pa.string()).take(pa.array(order)), *(pa.array(flat[c][order]) for c in ("logp", "key", "inclusion")), _column(ids, off, np.zeros(len(order), bool), kind)],
                ["rank", "n_ids", "ids_sha256", "logp", "perturbed", "inclusion", "ids"],
            )
            out = pa.ListArray.from_arrays(pa.array(np.searchsorted(flat["row"][order], np.arange(b.num_rows + 1)).astype(np.int32)), one)
            ids, off = lattice.encoded()
            raw = memoryview(ids.astype("<i4").tobytes())
            hashes = [hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            lists = _column(ids, off, ~known, kind)
            names = [c for c in b.schema.names if c not in ("text", "key")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(np.diff(off)), pa.array(hashes, pa.string()), pa.array(lattice.decoded(), mask=~known), lists, out],
                [*names, "n_ids", "ids_sha256", "same", "ids", "samples"],
            )
        del lattice
        give_back()

    return run


_OUT = "n_ids long, ids_sha256 string, same boolean, ids {0}, samples array<struct<rank: int, n_ids: long, ids_sha256: string, logp: double, perturbed: double, inclusion: double, ids: {0}>>"


def segment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, alpha: float = ALPHA, k: int = SAMPLES, packed: bool = False) -> DataFrame:
    """(doc, n_ids, ids_sha256, same, ids, samples): the encoding of each text, whether it decodes to it, and k samples.

    packed: ids are binary (see id_type) instead of arrays, as training data stores them; decode reads both.
    """
    sent = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(0))).alias("key"), F.col(text_col).alias("text"))
    schema = T.StructType([sent.schema["doc"], *T.StructType.fromDDL(_OUT.format("binary" if packed else "array<int>")).fields])
    return sent.mapInArrow(_segment(path, alpha, k, packed), schema)


def decode(ids: DataFrame, ids_col: str = "ids", path: str = MODEL) -> DataFrame:
    """ids with a column `text`: the decoded ids (null for null)."""

    @F.pandas_udf("string")
    def text(x: pd.Series) -> pd.Series:
        vocab = vocabulary(path)
        read = lambda v: np.frombuffer(v, id_type(len(vocab.rank))) if isinstance(v, bytes) else v
        return pd.Series([None if v is None else vocab.processor.decode([int(i) for i in read(v)]) for v in x], dtype=object)

    return ids.withColumn("text", text(ids_col))
