"""Toxic spans by a linear-chain conditional random field, learnt from document labels.

Training reads a bounded sample: at most `max_toxic` and `max_clean` labelled rows, the least by a hash of their id, and of
each at most `max_chains` chains of WINDOW tokens, evenly spaced over the whole text. Tasks send the tokens' hashes; one task
fits the model in numpy and returns its few arrays, so the driver holds no text. Near copies in the sample count once (one document per least shingle hash). A token of a
toxic document is labelled toxic if its word is much more frequent among toxic than among clean documents (`toxic_words`);
all other tokens are clean. The chain has two states, an emission weight per word and four transitions, fitted by gradient ascent
on the conditional likelihood (forward-backward). A document's score is a logistic function of the sum of its squared
toxic marginals (squares keep many tiny ones of a long text from adding up), fitted to the document labels and corrected for
the sample's share of toxic rows; runs of tokens with a marginal of one half or more are its offending spans.

Scoring is one pass over whole texts without a shuffle; chains are cut every WINDOW tokens, so memory is bounded.

Defined results: extra columns are carried in `doc` and never read; a very long text is scored whole, chain by chain; an empty
table gives an empty result; null, empty or wordless text has no toxic token and gets the score of such documents; ids and
labels may be null (such labels are left out) or repeated (a document is toxic if any of its labels is); without
labelled rows of both kinds every score is the share of toxic ones among the labelled (0.0 if there are none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, mix, ngram_hashes, slices, span_hashes, text_bytes, word_bounds

WINDOW = 128
MAX_TOXIC, MAX_CLEAN, MAX_CHAINS = 800, 1200, 64
#: A word of toxic documents: in LEAST of them, ODDS times as frequent as in clean ones, and SURE bits beyond chance.
LEAST, ODDS, SURE = 4, 20, 3
#: Bytes between words: all ASCII but letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray  # toxic-state emission of each
    other: float  # emission of any other word
    trans: np.ndarray  # 2 x 2 log potentials
    start: np.ndarray  # 2
    a: float  # score = sigmoid(a + b * log1p(sum of squared marginals))
    b: float


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose crc32(id as text) mod folds is 0 are never learnt from; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, row offsets, bytes) of the words of each row; A-Z count as a-z."""
    data, off = text_bytes(text)
    starts, ends, rows = word_bounds(data, off, BETWEEN)
    return span_hashes(data, starts, ends, lower=True), starts, ends, rows, data


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers as a matrix of chains (-1 pads), chains never crossing rows; and the chain's row."""
    n = np.diff(rows)
    chains = -(-n // WINDOW)
    row = np.repeat(np.arange(len(n)), chains)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(chains) - chains, chains)
    at = (rows[:-1][row] + nth * WINDOW)[:, None] + np.arange(WINDOW)
    return np.where(at < rows[1:][row][:, None], at, -1), row


def marginals(em: np.ndarray, on: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Toxic marginals of chains (chains x steps emissions of state 1, state 0 emits 0), expected transitions, log Z."""
    c, t = em.shape
    e1 = np.exp(em)
    m = np.exp(trans)
    f = np.empty((t, 2, c))
    scale = np.ones((t, c))
    for i in range(t):
        if i == 0:
            x0, x1 = np.full(c, np.exp(start[0])), np.exp(start[1]) * e1[:, 0]
        else:
            p0, p1 = f[i - 1]
            x0, x1 = p0 * m[0, 0] + p1 * m[1, 0], (p0 * m[0, 1] + p1 * m[1, 1]) * e1[:, i]
            x0, x1 = np.where(on[:, i], x0, p0), np.where(on[:, i], x1, p1)
        s = x0 + x1
        f[i, 0], f[i, 1] = x0 / s, x1 / s
        scale[i] = s
    out = np.zeros((c, t))
    pair = np.zeros((2, 2))
    b0 = b1 = np.ones(c)
    for i in range(t - 1, -1, -1):
        z = f[i, 0] * b0 + f[i, 1] * b1
        out[:, i] = np.where(on[:, i], f[i, 1] * b1 / z, 0)
        if i:
            w = on[:, i]
            g0, g1 = b0, b1 * e1[:, i]
            p0, p1 = f[i - 1]
            q = np.array([[p0 * m[0, 0] * g0, p0 * m[0, 1] * g1], [p1 * m[1, 0] * g0, p1 * m[1, 1] * g1]])
            q = np.where(w, q / np.maximum(q.sum((0, 1)), 1e-300), 0)
            pair += q.sum(2)
            n0, n1 = m[0, 0] * g0 + m[0, 1] * g1, m[1, 0] * g0 + m[1, 1] * g1
            s = n0 + n1
            b0, b1 = np.where(w, n0 / s, b0), np.where(w, n1 / s, b1)
    return out, pair, float(np.log(scale).sum())


def emissions(model: Model, h: np.ndarray) -> np.ndarray:
    out = np.full(len(h), model.other)
    if len(model.words):
        # a bit map by 20 bits of the hash lets few other words through to the exact search
        seen = np.zeros(1 << 20, bool)
        seen[(model.words & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.words, h[maybe]), len(model.words) - 1)
        hit = model.words[at] == h[maybe]
        out[maybe[hit]] = model.weights[at[hit]]
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def toxic_words(word: np.ndarray, doc: np.ndarray, left: np.ndarray, toxic: np.ndarray, n_clean: int, size: int) -> np.ndarray:
    """Which of `size` words mark toxic documents, from the distinct pairs (word, doc).

    A word is marked if it is ODDS times as frequent in toxic documents as in clean ones, and if that is no chance of so
    many words. In each further round only the toxic documents without a marked word count, so that the words of a rare
    language are not held against the toxic documents of all others. left: the toxic documents; it is changed.
    """
    clean = np.bincount(word[~toxic[doc]], minlength=size)
    marked = np.zeros(size, bool)
    while left.any() and n_clean:
        hits, n = np.bincount(word[left[doc]], minlength=size), int(left.sum())
        able = hits + clean >= LEAST
        rate, share = hits / np.maximum(hits + clean, 1), n / (n + n_clean)
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = hits * np.log2(rate / share) + np.where(clean > 0, clean * np.log2((1 - rate) / (1 - share)), 0.0)
        odds = (hits + 0.5) / (n + 1) * (n_clean + 1) / (clean + 0.5)
        new = (hits >= LEAST) & (odds >= ODDS) & (bits >= SURE + np.log2(max(1, able.sum()))) & ~marked
        if not new.any():
            break
        marked |= new
        left[doc[new[word]]] = False
    return marked


def fit(texts: list[str], toxic: np.ndarray, steps: int = 40) -> Model:
    """Train on texts in memory (bounded by the caller)."""
    h, _, _, rows, _ = tokens(pa.array(texts, pa.large_string()))
    return fit_tokens(h, rows, toxic, steps)


def fit_tokens(h: np.ndarray, rows: np.ndarray, toxic: np.ndarray, steps: int = 40) -> Model:
    """Train on documents as token hashes h with row offsets (bounded by the caller)."""
    count = len(rows) - 1
    toxic = np.asarray(toxic, bool)
    share = float(toxic.mean()) if len(toxic) else 0.0
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -8.0, np.zeros((2, 2)), np.zeros(2), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))), 0.0)
    if not 0 < share < 1:
        return none
    # near copies count once: the first document of each least shingle hash
    grams = ngram_hashes(h, 5)
    least = np.array([grams[a : max(a + 1, b - 4)].min(initial=2**64 - 1) if b - a >= 5 else mix(np.array([i], np.uint64))[0] for i, (a, b) in enumerate(zip(rows[:-1], rows[1:], strict=True))], np.uint64)
    keep = np.sort(np.unique(least, return_index=True)[1])
    row = np.repeat(np.arange(count), np.diff(rows))
    on = np.isin(row, keep)
    vocab, word = np.unique(h[on], return_inverse=True)
    pairs = np.unique(word.astype(np.int64) * count + row[on])
    uses = np.bincount(pairs // count, minlength=len(vocab))
    left = np.zeros(count, bool)
    left[keep] = toxic[keep]
    marked = toxic_words(pairs // count, pairs % count, left, toxic, int((~toxic[keep]).sum()), len(vocab))
    # train on the chains of the kept documents
    known = uses >= 3
    number = np.full(len(vocab), -1)
    number[known] = np.arange(known.sum())
    feature, label = np.full(len(h), -1), np.zeros(len(h), bool)
    feature[on], label[on] = number[word], marked[word] & toxic[row[on]]
    at, chain_row = windows(rows)
    at = at[np.isin(chain_row, keep)]
    live = at >= 0
    feat, y = np.where(live, feature[at], -2), np.where(live, label[at], False)
    y0, y1 = y[:, :-1], y[:, 1:]
    seen_pair = np.array([[(~y0 & ~y1 & live[:, 1:]).sum(), (~y0 & y1 & live[:, 1:]).sum()], [(y0 & ~y1 & live[:, 1:]).sum(), (y0 & y1 & live[:, 1:]).sum()]], float)
    size = int(known.sum())
    theta, m1, m2 = np.zeros(size + 7), np.zeros(size + 7), np.zeros(size + 7)
    theta[size] = -8.0
    slot = np.where(feat >= 0, feat, size)  # a known word's emission is the common one plus its own difference
    seen = np.bincount(slot[live], weights=y[live], minlength=size + 1)
    for step in range(1, steps + 1):
        trans, start = theta[size + 1 : size + 5].reshape(2, 2), theta[size + 5 : size + 7]
        pr, pair, _ = marginals(np.where(live, theta[size] + np.where(slot < size, theta[slot], 0.0), 0.0), live, trans, start)
        g = np.zeros_like(theta)
        g[: size + 1] = seen - np.bincount(slot[live], weights=pr[live], minlength=size + 1)
        g[size] = g[: size + 1].sum()
        g[size + 1 : size + 5] = (seen_pair - pair).ravel()
        g[size + 5 :] = [(~y[:, 0] - (1 - pr[:, 0])).sum(), (y[:, 0] - pr[:, 0]).sum()]
        g[:size] -= 0.02 * theta[:size]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta + (0.1 + 0.9 * (1 - step / steps)) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    strong = theta[:size] > 0.5  # words that never got a toxic label act alike: only those that stand out are kept
    model = Model(vocab[known][strong], theta[size] + theta[:size][strong], float(theta[size]), theta[size + 1 : size + 5].reshape(2, 2).copy(), theta[size + 5 :].copy(), 0.0, 1.0)
    x = np.log1p(document_sums(model, h, rows)[keep])
    t = toxic[keep].astype(float)
    a, b = 0.0, 1.0
    for _ in range(400):
        r = t - _sigmoid(a + b * x)
        a, b = a + 2.0 * r.mean(), b + 2.0 * ((r * x).mean() - 1e-4 * b)
    model.a, model.b = float(a), float(b)
    return model


def token_marginals(model: Model, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h))
    if len(h) and len(model.words):
        at, _ = windows(rows)
        live = at >= 0
        em = emissions(model, h)
        pr = marginals(np.where(live, em[at], 0.0), live, model.trans, model.start)[0]
        out[at[live]] = pr[live]
    return out


def document_sums(model: Model, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(token_marginals(model, h, rows) ** 2)]
    return total[rows[1:]] - total[rows[:-1]]


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, starts, ends, rows, data = tokens(b.column("text"))
            pr = token_marginals(model, h, rows)
            total = np.r_[0, np.cumsum(pr**2)]
            score = _sigmoid(model.a + model.b * np.log1p(np.maximum(total[rows[1:]] - total[rows[:-1]], 0)))
            bad = np.flatnonzero(pr >= 0.5)
            row = np.searchsorted(rows, bad, side="right") - 1
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            first = points[text_bytes(b.column("text"))[1][:-1]][row] if len(bad) else bad
            new = np.r_[True, (np.diff(bad) > 1) | (np.diff(row) > 0)] if len(bad) else np.zeros(0, bool)
            lo = np.flatnonzero(new)
            hi = np.r_[lo[1:], len(bad)] - 1 if len(bad) else lo
            spans = pa.StructArray.from_arrays([pa.array(points[starts[bad[lo]]] - first[lo]), pa.array(points[ends[bad[hi]]] - first[hi])], ["start", "end"])
            count = np.bincount(row[lo], minlength=b.num_rows) if len(bad) else np.zeros(b.num_rows, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), spans)
            keep = [b.column(c) for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(score), lists], [*[c for c in b.schema.names if c != "text"], "score", "spans"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_chains: int = MAX_CHAINS) -> Model:
    """Fit on labelled rows outside the held-out fold: at most max_toxic and max_clean of them, chosen by a hash of the id, and max_chains chains of each."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    known = known.filter(~held_out(id_col)).withColumn("h", F.xxhash64(F.col(id_col).cast("long")))
    chosen = known.filter("y = 1").orderBy("h").limit(max_toxic).unionByName(known.filter("y = 0").orderBy("h").limit(max_clean))
    # one text of each id, as the hashes of its tokens
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen.select(F.col(id_col).alias("id"), "y")), "id").filter("text is not null")
    sample = texts.mapInArrow(_sampled(max_chains), texts.drop("text").schema.add("tokens", "binary")).groupBy("id", "y").agg(F.min("tokens").alias("tokens"))
    fitted = sample.repartition(1).sortWithinPartitions("id").mapInArrow(_fit, "model binary").first()
    model = pickle.loads(fitted.model) if fitted else fit_tokens(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, bool))
    if model.b:  # the sample holds another share of toxic rows than the labels do
        n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
        model.a += float(np.log(max(1.0, n[1] / max_toxic)) - np.log(max(1.0, n[0] / max_clean)))
    return model


def _sampled(max_chains: int):
    """Rows with the token hashes of their text, of longer texts those of evenly spaced chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, _, _, rows, _ = tokens(b.column("text"))
            out = []
            for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                chains = -(-(hi - lo) // WINDOW)
                take = np.unique(np.linspace(0, chains - 1, min(chains, max_chains)).astype(np.int64))
                out.append(b"".join(h[lo + c * WINDOW : min(lo + (c + 1) * WINDOW, hi)].tobytes() for c in take.tolist()))
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out, pa.binary())], [*keep, "tokens"])

    return run


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, toxic = [], []
    for b in batches:
        parts += [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("tokens")]
        toxic += b.column("y").to_pylist()
    if parts:
        model = fit_tokens(np.concatenate(parts), np.r_[0, np.cumsum([len(x) for x in parts])], np.array(toxic) == 1)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        del parts, model
    give_back()


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(doc, score, spans): the whole input row as a struct, and the offending code point ranges."""
    sent = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).alias("text"))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([sent.schema["doc"], T.StructField("score", T.DoubleType()), T.StructField("spans", spans)])
    return sent.mapInArrow(_score(model), schema)
