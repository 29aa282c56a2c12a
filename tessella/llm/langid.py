"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of STEPS bytes in both directions (hidden size HIDDEN each way), labels every position with a
distribution over the learnt languages, and a document's probabilities are the mean over its letter positions. Training
is backpropagation through time in numpy, from a bounded sample: about `max_docs` documents of each language (those whose
id has a small hash), at most `per_doc` evenly spaced windows of each document and `max_windows` of each language. Tasks
cut the windows, one task fits the network. Labelling is one pass over whole texts without a shuffle: numpy runs a few
thousand windows side by side, so memory per task is bounded.

Defined results: text that is null or has no letter is `und` with score 0.0; a null id is not held out; rows with a null
language are never learnt from; with no learnable row (an empty table too) every text is `und`; ties go to the language
first in alphabetical order; repeated rows are each labelled, and learnt from once; extra columns are carried in `doc` and
never read; a very long text is labelled whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_bytes
from .toxicity import held_out

STEPS, HIDDEN, SIDE = 64, 8, 4096
MAX_DOCS, PER_DOC, MAX_WINDOWS = 400, 16, 1600
UNKNOWN = "und"
#: Bytes that are part of a letter: ASCII letters and all bytes of non-ASCII characters.
LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


@dataclass
class Model:
    langs: list[str]
    inputs: np.ndarray  # 2 x 256 x 3H: gate inputs of each byte (update, reset, candidate), each way
    hidden: np.ndarray  # 2 x H x 3H
    out: np.ndarray  # 2H x L
    bias: np.ndarray  # L


def byte_windows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x STEPS bytes, zero-padded; which are real; row of each window)."""
    n = np.diff(off)
    count = -(-n // STEPS)
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = (off[:-1][row] + nth * STEPS)[:, None] + np.arange(STEPS)
    real = at < off[1:][row][:, None]
    return np.where(real, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8), 0), real, row


def _run(x: np.ndarray, inputs: np.ndarray, hidden: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """Hidden states (STEPS x windows x H) of one direction. keep: gets what training needs of each step."""
    steps, n, size = x.shape[1], len(x), hidden.shape[0]
    kind = inputs.dtype
    h = np.zeros((n, size), kind)
    out = np.empty((steps, n, size), kind)
    half = np.concatenate([np.full(2 * size, 0.5), np.ones(size)]).astype(kind)
    inputs, hidden = inputs * half, hidden * half  # sigmoid(v) = (1 + tanh(v / 2)) / 2
    a, g = np.empty((n, 3 * size), kind), np.empty((n, 3 * size), kind)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        np.take(inputs, x[:, t], axis=0, out=a)
        np.matmul(h, hidden, out=g)
        zr = a[:, : 2 * size]
        zr += g[:, : 2 * size]
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r = zr[:, :size], zr[:, size:]
        c = g[:, 2 * size :]
        raw = c.copy() if keep is not None else None
        c *= r
        c += a[:, 2 * size :]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h.copy(), z.copy(), r.copy(), c.copy(), raw))
        h -= c
        h *= z
        h += c
        out[t] = h
    return out


def position_probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    """STEPS x windows x L."""
    f, b = (_run(x, model.inputs[d], model.hidden[d], bool(d)) for d in (0, 1))
    s = f @ model.out[:HIDDEN] + b @ model.out[HIDDEN:] + model.bias
    s -= s.max(-1, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(-1, keepdims=True)
    return s


def loss_and_gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of the positions (weight: STEPS x windows), and its gradients by backpropagation through time."""
    size, kept = p["hidden"].shape[1], ([], [])
    hs = [_run(x, p["inputs"][d], p["hidden"][d], bool(d), kept[d]) for d in (0, 1)]
    s = hs[0] @ p["out"][:size] + hs[1] @ p["out"][size:] + p["bias"]
    s -= s.max(-1, keepdims=True)
    e = np.exp(s)
    e /= e.sum(-1, keepdims=True)
    at, weight = np.arange(len(x)), weight / max(float(weight.sum()), 1.0)
    loss = -float((np.log(np.maximum(e[:, at, y], 1e-30)) * weight).sum())
    e[:, at, y] -= 1
    e *= weight[:, :, None]
    g = {"out": np.concatenate([np.einsum("tnh,tnl->hl", hs[d], e) for d in (0, 1)]), "bias": e.sum((0, 1)), "inputs": np.zeros_like(p["inputs"]), "hidden": np.zeros_like(p["hidden"])}
    for d in (0, 1):
        into = e @ p["out"][d * size : (d + 1) * size].T
        dh = np.zeros((len(x), size), into.dtype)
        for t, h, z, r, c, raw in reversed(kept[d]):
            dh = dh + into[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * raw * r * (1 - r)
            gates = np.concatenate([dz, dr, dc * r], 1)
            g["hidden"][d] += h.T @ gates
            np.add.at(g["inputs"][d], x[:, t], np.concatenate([dz, dr, dc], 1))
            dh = dh * z + gates @ p["hidden"][d].T
    return loss, g


def fit(x: np.ndarray, real: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 8, batch: int = 128, rate: float = 0.02) -> Model:
    """Train on windows x with language numbers y."""
    rng = np.random.default_rng(7)
    size, count = HIDDEN, len(langs)
    p = {
        "inputs": rng.normal(0, 0.3, (2, 256, 3 * size)),
        "hidden": rng.normal(0, 0.3, (2, size, 3 * size)),
        "out": rng.normal(0, 0.3, (2 * size, count)),
        "bias": np.zeros(count),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    weight = np.where(real & LETTER[x], 1.0, 0.0).astype(np.float32)
    share = np.maximum(np.bincount(y, minlength=count), 1)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            i = order[lo : lo + batch]
            xb, yb = x[i], y[i]
            wb = (weight[i] * (len(x) / count / share[yb])[:, None]).T.astype(np.float32)
            _, g = loss_and_gradients(p, xb, yb, wb)
            step += 1
            pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
            for k in p:
                w = g[k] * min(1.0, 1.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * w
                v[k] = 0.99 * v[k] + 0.01 * w * w
                p[k] = (p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Model(langs, p["inputs"], p["hidden"], p["out"], p["bias"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS, per_doc: int = PER_DOC, max_windows: int = MAX_WINDOWS) -> Model | None:
    """Fit on rows outside the held-out fold; the sample is bounded by the three parameters, for each language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("id is not null and lang is not null and text is not null").filter(~held_out("id"))
    shares = known.groupBy("lang").agg(F.least(F.lit(1.0), max_docs / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(shares), "lang").filter(place < F.col("share")).select("lang", "id", "text")
    cut = sample.mapInArrow(_windows(per_doc), sample.drop("text").schema.add("windows", "binary")).dropDuplicates(["lang", "id", "windows"])
    fitted = cut.repartition(1).sortWithinPartitions("lang", "id", "windows").mapInArrow(_fit(max_windows), "model binary").first()
    return pickle.loads(fitted.model) if fitted else None


def _windows(per_doc: int):
    """Rows with evenly spaced windows of their text, STEPS bytes each; the last may be padded with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x, _, row = byte_windows(*text_bytes(b.column("text")))
            at = np.searchsorted(row, np.arange(b.num_rows + 1))
            out = [x[lo + np.unique(np.linspace(0, hi - lo - 1, min(hi - lo, per_doc)).astype(np.int64))].astype(np.uint8).tobytes() if hi > lo else b"" for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out, pa.binary())], [*keep, "windows"])

    return run


def _fit(max_windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {}
        for b in batches:
            for lang, w in zip(b.column("lang").to_pylist(), b.column("windows"), strict=True):
                parts.setdefault(lang, []).append(np.frombuffer(w.as_buffer(), np.uint8).reshape(-1, STEPS))
        langs, rng = sorted(parts), np.random.default_rng(3)
        picked = [x[rng.permutation(len(x))[:max_windows]] for x in (np.concatenate(parts[g]) for g in langs)]
        if sum(map(len, picked)):
            x = np.concatenate(picked)
            model = fit(x, x != 0, np.repeat(np.arange(len(langs)), [len(p) for p in picked]), langs)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def _label(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            pred, score, runs = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), [[]] * b.num_rows
            if model is not None:
                data, off = text_bytes(b.column("text"))
                x, real, row = byte_windows(data, off)
                total, votes = np.zeros((b.num_rows, len(model.langs))), np.zeros((b.num_rows, len(model.langs)), np.int64)
                for lo in range(0, len(x), SIDE):
                    part = slice(lo, lo + SIDE)
                    p = position_probabilities(model, x[part])
                    on = (real[part] & LETTER[x[part]]).T
                    rows = row[part]
                    first = np.flatnonzero(np.r_[True, np.diff(rows) > 0])
                    summed = np.add.reduceat((p * on[:, :, None]).sum(0), first, axis=0)
                    total[rows[first]] += summed
                    best = p.argmax(2)
                    for n in range(len(model.langs)):
                        votes[rows[first], n] += np.add.reduceat(((best == n) & on).sum(0), first)
                has_letter = pc.fill_null(pc.match_substring_regex(b.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                mean = total / np.maximum(total.sum(1, keepdims=True), 1e-9)
                top = mean.argmax(1)
                score = np.where(has_letter, np.clip(mean[np.arange(len(top)), top], 0, 1), 0.0)
                pred = [model.langs[k] if on else UNKNOWN for k, on in zip(top.tolist(), has_letter.tolist(), strict=True)]
                runs = votes.tolist()
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(pred), pa.array(score), pa.array(runs, pa.list_(pa.int64()))], [*keep, "lang_pred", "score", "positions"])

    return run


def label(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """(doc, lang_pred, score, positions): the input row as a struct; positions counts the letter bytes labelled with each of model.langs."""
    sent = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([sent.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("positions", T.ArrayType(T.LongType()))])
    return sent.mapInArrow(_label(model), schema)
