"""Benchmark decontamination by latent semantic retrieval, then word-order and answer checks.

1. Document frequencies of the benchmark's terms, counted over the passages (blocks of STEP words) of all documents.
2. TF-IDF vectors of the benchmark's passages (at most SPAN words each), and their randomised SVD: tasks hold the rows
   and return partial sums of A'(A O) for a random O, which are added up as a tree; an orthonormal basis of the sum and
   a small eigenproblem give the right singular vectors, up to RANK of them.
3. Every window of SPAN words of every document (a new one each STEP words) is projected and compared with all reference
   passages by matrix products. Candidates have a cosine (less by the square root of the share of the window that a
   shorter reference can fill) and a coverage (their share of the reference's own length along it) over the thresholds.
4. For a candidate, the longest common subsequence of words with the reference decides: over `exact`, it is a leak; over
   `loose`, it is one if the window also holds the answer, the reference's rarest terms.

The reference is handled in blocks of BLOCK passages, so at most BLOCK x SPAN terms and twice as many kilobytes are sent to
the tasks however long the benchmark is. Documents are read once for the counts and once for each block; nothing of them is shuffled but term counts and matches.

Defined results: null or empty texts match nothing, on either side; ids may be null or repeated, equal rows (one id, one
text) are returned once; a document shorter than SPAN is one window; equal benchmark items each match; of windows that
share as many words the one with the higher cosine is returned, then the first; a very long text is a row of windows like
any other; empty tables give no matches; extra columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, row_keys, slices, stored
from .toxicity import tokens

SPAN, STEP, RANK, BLOCK = 48, 16, 192, 512
COSINE, COVERAGE = 0.5, 0.35
#: Shares of the reference's words in the common subsequence.
EXACT, LOOSE, ANSWER = 0.75, 0.5, 0.8
#: Terms in more than this share of passages carry little; the ANSWER_TERMS rarest of a reference always count.
COMMON, ANSWER_TERMS = 0.02, 6


def reference_passages(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(item, nth, words): items cut into equal parts of at most span words, as word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, _, _, rows, _ = tokens(b.column("text"))
            item, nth, words = [], [], []
            for r, i in enumerate(b.column("item").to_pylist()):
                w = h[rows[r] : rows[r + 1]]
                for n, part in enumerate(np.array_split(w, max(1, -(-len(w) // span)))):
                    if len(part):
                        item.append(i)
                        nth.append(n)
                        words.append(part.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(nth, pa.int32()), pa.array(words, pa.list_(pa.int64()))], ["item", "nth", "words"])

    return benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).mapInArrow(run, "item long, nth int, words array<long>")


def _frequencies(vocab: np.ndarray, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = np.zeros(len(vocab), np.int64), 0
        for b in slices(batches):
            h, _, _, rows, _ = tokens(b.column("text"))
            pos, num = lookup(vocab, h)
            row = np.searchsorted(rows, pos, side="right") - 1
            first = np.cumsum(-(-np.diff(rows) // step))
            blocks += int(first[-1])
            block = first[row] - (rows[row + 1] - pos + step - 1) // step  # any numbering of the blocks does
            pairs = np.unique(num * (1 << 32) + block)
            total += np.bincount(pairs >> 32, minlength=len(vocab))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[hit, -1]), pa.array(np.r_[total[hit], blocks])], ["term", "n"])

    return run


def tree_sum(parts: DataFrame, fan_in: int = 16) -> np.ndarray:
    """Sum of float64 arrays held as binary rows (`part`), added up in rounds of fan_in."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column("part"):
                v = np.frombuffer(x.as_buffer(), np.float64)
                total = v.copy() if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    left = parts = stored(parts, "sums")
    n = parts.count()
    while n > 1:
        n = -(-n // fan_in)
        left = stored(left.repartition(n).mapInArrow(add, "part binary"), "sums")
        if n > 1:
            n = left.count()
    return np.frombuffer(left.first()["part"], np.float64)


def _vector(words: np.ndarray, vocab: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A passage's terms, their shares of its unit TF-IDF vector, and the length it had before."""
    terms, count = np.unique(lookup(vocab, words)[1], return_counts=True)
    v = np.log1p(count) * weight[terms]
    length = float(np.sqrt((v * v).sum()))
    return terms, v / max(length, 1e-12), length


def _project_sum(vocab: np.ndarray, weight: np.ndarray, basis: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for words in b.column("words"):
                terms, v, _ = _vector(words.values.to_numpy().view(np.uint64), vocab, weight)
                total = np.zeros(basis.shape) if total is None else total
                total[terms] += np.outer(v, v @ basis[terms])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return run


def singular_vectors(passages: DataFrame, vocab: np.ndarray, weight: np.ndarray, rank: int, n: int) -> np.ndarray:
    """Right singular vectors (terms x rank) of the TF-IDF rows, by two distributed passes of a randomised range finder."""
    k = min(rank + 16, n, len(vocab))
    basis = np.random.default_rng(11).normal(size=(len(vocab), k))
    for _ in range(2):
        y = tree_sum(passages.mapInArrow(_project_sum(vocab, weight, basis), "part binary")).reshape(len(vocab), k)
        basis, _ = np.linalg.qr(y)
    y = tree_sum(passages.mapInArrow(_project_sum(vocab, weight, basis), "part binary")).reshape(len(vocab), k)
    values, inner = np.linalg.eigh(basis.T @ y)
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-12)]
    return basis @ inner[:, order]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit vector for each word of a."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for w in b.tolist():
        m = where.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _search(vocab, weight, vectors, refs, items, answers, span, step, cosine, coverage, exact, loose, answer):
    """vectors: terms x rank; refs: the references' word hashes; answers: the hashes of each one's rarest terms."""
    sparse = [_vector(w, vocab, weight) for w in refs]
    own = np.array([v @ vectors[t] for t, v, _ in sparse]).reshape(len(refs), vectors.shape[1])
    length = np.linalg.norm(own, axis=1)
    unit = (own / np.maximum(length, 1e-12)[:, None]).astype(np.float32)
    # a reference's unscaled length, which windows are measured against
    need = (coverage * np.array([n for _, _, n in sparse]) * length).astype(np.float32)
    # a window of `span` words that holds a shorter reference has other words besides
    bar = (cosine * np.sqrt([min(1.0, len(w) / span) for w in refs])).astype(np.float32)
    terms = weight > 0
    blocks = span // step
    scaled = (vectors * (weight * np.log(2))[:, None]).astype(np.float32)
    del vectors, own  # the tasks get `scaled` alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, _, _, rows, _ = tokens(b.column("text"))
            pos, num = lookup(vocab, h)
            on = terms[num]
            pos, num = pos[on], num[on]
            out: dict[str, list] = {c: [] for c in ("did", "th", "item", "start", "cosine", "common")}
            if len(pos):
                row = np.searchsorted(rows, pos, side="right") - 1
                per_row = -(-np.diff(rows) // step)
                base = np.cumsum(per_row) - per_row + np.arange(len(per_row)) * blocks  # rows of zero blocks keep documents apart
                block = base[row] + (pos - rows[row]) // step
                live, inverse = np.unique(block, return_inverse=True)
                first = np.flatnonzero(np.r_[True, np.diff(inverse) > 0])
                count = np.diff(np.r_[first, len(num)])
                sums = scaled[num[first]]
                for j in range(1, int(count.max())):  # a block's terms, one after another for all blocks
                    on = np.flatnonzero(count > j)
                    sums[on] += scaled[num[first[on] + j]]
                block_row = row[first]
                # windows that start at a block that holds a term, or up to span words before it
                begin = np.unique((live[:, None] - np.arange(blocks)).ravel())
                begin = begin[begin >= 0]
                owner = np.searchsorted(base, begin, side="right") - 1
                ok = begin - base[owner] < per_row[owner]
                begin, owner = begin[ok], owner[ok]
                for lo in range(0, len(begin), 8192):
                    w, r = begin[lo : lo + 8192], owner[lo : lo + 8192]
                    x = np.zeros((len(w), scaled.shape[1]), np.float32)
                    for j in range(blocks):
                        at = np.minimum(np.searchsorted(live, w + j), len(live) - 1)
                        hit = (live[at] == w + j) & (block_row[at] == r)
                        x[hit] += sums[at[hit]]
                    dots = x @ unit.T
                    size = np.maximum(np.linalg.norm(x, axis=1), 1e-12)
                    i, q = np.nonzero((dots >= need) & (dots >= bar * size[:, None]))
                    for i, q in zip(i.tolist(), q.tolist(), strict=True):
                        d = int(r[i])
                        start = int(rows[d] + (w[i] - base[d]) * step)
                        lo_w, hi_w = max(int(rows[d]), start - step), min(int(rows[d + 1]), start + span + step)
                        words = h[lo_w:hi_w]
                        share = common_subsequence(refs[q], words) / len(refs[q])
                        if share >= exact or share >= loose and np.isin(answers[q], words).mean() >= answer:
                            for c, v in zip(out, (b.column("did")[d].as_py(), b.column("th")[d].as_py(), items[q], start - int(rows[d]), float(dots[i, q] / size[i]), share), strict=True):
                                out[c].append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(out, types, strict=True)], list(out))

    return run


_MATCH = "did long, th long, item long, start long, cosine double, common double"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rank: int = RANK, cosine: float = COSINE, coverage: float = COVERAGE, exact: float = EXACT, loose: float = LOOSE, answer: float = ANSWER, block: int = BLOCK) -> DataFrame:
    """(did, th, item, start, cosine, common): for each distinct row and benchmark item it holds, the best window."""
    keyed = row_keys(docs, id_col, text_col)
    passages = stored(reference_passages(benchmark, item_col, item_text), "references")
    total = passages.count()
    numbered = passages.withColumn("block", F.pmod(F.xxhash64("item", "nth"), F.lit(max(1, -(-total // block)))))
    found = None
    for k in range(max(1, -(-total // block))):
        part = numbered.filter(F.col("block") == k)
        rows = sorted(part.collect(), key=lambda r: (r.item if r.item is not None else -1, r.nth))
        refs = [np.array(r.words, np.int64).view(np.uint64) for r in rows]
        vocab = np.unique(np.concatenate([np.zeros(0, np.uint64), *refs]))
        counts = {r.term: r.n for r in keyed.select("text").mapInArrow(_frequencies(vocab, STEP), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
        blocks = max(counts.get(-1, 0), 1)
        df = np.array([counts.get(t, 0) for t in range(len(vocab))], float)
        idf = np.log((1 + blocks) / (1 + df))
        rare = [np.unique(lookup(vocab, w)[1]) for w in refs]
        rare = [x[np.argsort(-idf[x], kind="stable")[:ANSWER_TERMS]] for x in rare]
        counted = df <= COMMON * blocks
        if rare:
            counted[np.concatenate(rare)] = True
        weight = np.where(counted, np.maximum(idf, 1e-3), 0.0)
        if not refs:
            continue
        vectors = singular_vectors(part, vocab, weight, rank, len(refs))
        search = _search(vocab, weight, vectors, refs, [r.item for r in rows], [vocab[x] for x in rare], SPAN, STEP, cosine, coverage, exact, loose, answer)
        matches = keyed.mapInArrow(search, _MATCH)
        found = matches if found is None else found.unionByName(matches)
    if found is None:
        return keyed.sparkSession.createDataFrame([], _MATCH)
    best = found.groupBy("did", "th", "item").agg(F.max(F.struct("common", "cosine", (-F.col("start")).alias("back"))).alias("m"))
    return best.select("did", "th", "item", (-F.col("m.back")).alias("start"), F.col("m.cosine").alias("cosine"), F.col("m.common").alias("common"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of docs that hold no benchmark item."""
    hit = leaks(docs, benchmark, id_col, text_col, **parameters).select("did", "th").distinct()
    plain = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("did"), F.xxhash64(text_col).alias("th"))
    return plain.join(hit, ["did", "th"], "left_anti").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
