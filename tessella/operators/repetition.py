"""Sliding repetition measures, loop removal and the ordered quality classifier."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

WINDOW, TITLE_WINDOW, TITLE_SHARE = 100, 50, 0.8
#: Tokens, and characters of text, that a task measures at once: its memory is bounded by these, or by one longer row.
TOKENS_AT_ONCE, CHARS_AT_ONCE = 1 << 18, 1 << 20


def _parts(size: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive rows (from, until) of about `limit` together, a larger row alone."""
    block = (np.cumsum(size) - size) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(size)]
    return [(lo, hi) for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if hi > lo]


def _token_parts(tokens: pa.ListArray) -> list[tuple[int, int]]:
    return _parts(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64), TOKENS_AT_ONCE)


def _coded(tokens: pa.ListArray, strip: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All rows' tokens end to end as numbers of distinct words, the n+1 row offsets, and the words."""
    off = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))].astype(np.int64)
    coded = pc.fill_null(tokens.flatten(), "").dictionary_encode()
    codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if strip:  # each distinct word once
        stripped = pc.utf8_trim(words, characters=tx.EDGES).dictionary_encode()
        codes, words = stripped.indices.to_numpy().astype(np.int64)[codes], stripped.dictionary
    return codes, off, words


def _window_counts(codes: np.ndarray, off: np.ndarray, row: np.ndarray, width: int, counted: np.ndarray) -> np.ndarray:
    """Distinct counted codes in the window from each position: a position adds to the windows in which it is its word's last."""
    n = len(codes)
    key = row * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    later = np.full(n, n + width)
    same = key[order][1:] == key[order][:-1]
    later[order[:-1][same]] = order[1:][same]
    at = np.flatnonzero(counted)
    # not in windows that also hold the word's next place, nor in those of the row before
    lo, hi = np.maximum(at - width + 1, off[row[at]]), np.minimum(at, later[at] - width)
    ok = hi >= lo
    return np.cumsum(np.bincount(lo[ok], minlength=n + 1) - np.bincount(hi[ok] + 1, minlength=n + 1))[:n]


def _rows(off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The row of each position, and the positions that start a full window."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return row, np.flatnonzero(np.arange(len(row)) + width <= off[row + 1])


def min_ratios(tokens: pa.ListArray, width: int = WINDOW) -> np.ndarray:
    """Least distinct share over each row's windows, linear in the number of words; a window of punctuation counts 0.0."""
    codes, off, words = _coded(tokens, strip=True)
    row, start = _rows(off, width)
    full = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[codes] if len(codes) else np.zeros(0, bool)
    # rows shorter than a window: their own distinct share
    seen = np.unique(row[full] * (int(codes.max(initial=0)) + 1) + codes[full]) // (int(codes.max(initial=0)) + 1)
    count = np.bincount(row[full], minlength=len(off) - 1)
    out = np.bincount(seen, minlength=len(off) - 1) / np.maximum(count, 1)
    if len(start):
        total = np.r_[0, np.cumsum(full)]
        total = total[start + width] - total[start]
        ratio = np.where(total > 0, _window_counts(codes, off, row, width, full)[start] / np.maximum(total, 1), 0.0)
        first = np.flatnonzero(np.r_[True, np.diff(row[start]) > 0])
        out[row[start][first]] = np.minimum(1.0, np.minimum.reduceat(ratio, first))
    return out


def title_ratios(tokens: pa.ListArray, wanted: list[list[str]], title: np.ndarray, width: int = TITLE_WINDOW) -> np.ndarray:
    """The best Jaccard similarity of a window's word set with the row's title; title[i] numbers row i's title in `wanted` (distinct words)."""
    codes, off, words = _coded(tokens, strip=True)
    row, start = _rows(off, width)
    out = np.zeros(len(off) - 1)
    if not len(start):
        return out
    known = pc.index_in(pa.array([x for w in wanted for x in w], words.type), words)  # all titles' words at once
    base = len(words) + 1
    pairs = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted]) * base + pc.fill_null(known, 0).to_numpy()
    pairs = np.sort(pairs[known.is_valid().to_numpy(zero_copy_only=False)])
    full = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[codes]
    mine = title[row] * base + codes
    at = np.minimum(np.searchsorted(pairs, mine), max(len(pairs) - 1, 0))
    inside = pairs[at] == mine if len(pairs) else np.zeros(len(mine), bool)
    distinct, both = (_window_counts(codes, off, row, width, on)[start] for on in (full, full & inside))
    size = np.array([len(w) for w in wanted])[title][row[start]]
    ratio = np.where((size > 0) & (distinct > 0), both / np.maximum(distinct + size - both, 1), 0.0)
    first = np.flatnonzero(np.r_[True, np.diff(row[start]) > 0])
    out[row[start][first]] = np.maximum.reduceat(ratio, first)
    return out


def title_matches(tokens: pa.ListArray, titles: list[str | None], width: int = TITLE_WINDOW, share: float = TITLE_SHARE) -> np.ndarray:
    """Has some window of each row a word set whose Jaccard similarity with the row's title is over `share`?"""
    number = {t: i for i, t in enumerate(dict.fromkeys(titles))}
    wanted = [sorted({w.strip(tx.EDGES) for w in (t or "").split()} - {""}) for t in number]
    return title_ratios(tokens, wanted, np.array([number[t] for t in titles], np.int64), width) > share


def collapse_all(tokens: pa.ListArray) -> pa.ListArray:
    """Adjacent repeats of phrases of 8 down to 3 words, once; each length's repeats are found as runs of w[i] == w[i + n]."""
    codes, off, words = _coded(tokens, strip=False)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    for n in range(8, 2, -1):
        same = np.r_[False, (codes[:-n] == codes[n:]) & (row[:-n] == row[n:]), False]
        starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        long = ends - starts >= n
        gone, free = np.zeros(len(codes), bool), 0
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            a = max(a, free)
            if b - a >= n:
                free = a + n * (1 + (b - a) // n)
                gone[a + n : free] = True
        codes, row = codes[~gone], row[~gone]
    new = np.r_[0, np.cumsum(np.bincount(row, minlength=len(off) - 1))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(new, mask=np.r_[tokens.is_null().to_numpy(zero_copy_only=False), False]), words.take(pa.array(codes)).cast(pa.string()))


def _runs(code: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest stretches [a, b) of 2p places or more that equal the place p later, without line breaks.

    Such a stretch holds two neighbouring multiples of p and what lies between them, so only multiples of p are looked at first.
    """
    n = len(code)
    at = code[::p]
    same = (at[:-1] == at[1:]) & (at[:-1] != 10)
    k = np.flatnonzero(same[:-1] & same[1:])
    for d in range(1, p):
        k = k[(code[k * p + d] == code[k * p + d + p]) & (code[k * p + d] != 10)]
    if not len(k):
        return k, k
    new = np.r_[True, np.diff(k) > 1]
    a, b = k[new] * p, (k[np.r_[new[1:], True]] + 1) * p + 1
    left, right = np.ones(len(a), bool), np.ones(len(b), bool)
    for _ in range(p):  # the next multiple of p on either side is no such place
        left &= a > 0
        left[left] = (code[a[left] - 1] == code[a[left] - 1 + p]) & (code[a[left] - 1] != 10)
        a = a - left
        right &= b + p < n
        right[right] = (code[b[right]] == code[b[right] + p]) & (code[b[right]] != 10)
        b = b + right
    long = b - a >= 2 * p
    return a[long], b[long]


def deglued(texts: list[str]) -> list[str]:
    """Texts with blocks of 2 to 20 characters repeated three or more times, once, as `functions.text.deglue` has it: at each
    place the shortest block, from left to right."""
    code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ways = [(a, p, b) for p in range(2, 21) for a, b in zip(*(x.tolist() for x in _runs(code, p)), strict=True)]
    if not ways:
        return texts
    heapq.heapify(ways)
    gone, free = [], 0
    while ways:
        a, p, b = heapq.heappop(ways)
        if a >= free:
            free = a + p * (1 + (b - a) // p)
            gone.append((a + p, free))
        elif b - free >= 2 * p:
            heapq.heappush(ways, (free, p, b))
    off = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    row = np.searchsorted(off, [a for a, _ in gone], side="right") - 1
    parts: dict[int, list[str]] = {}
    done: dict[int, int] = {}
    for i, (a, b) in zip(row.tolist(), gone, strict=True):
        parts.setdefault(i, []).append(texts[i][done.get(i, 0) : a - off[i]])
        done[i] = int(b - off[i])
    return [t if i not in parts else "".join(parts[i]) + t[done[i] :] for i, t in enumerate(texts)]


def min_ratio(words: list[str], width: int = WINDOW) -> float:
    return float(min_ratios(pa.array([list(words)], pa.list_(pa.string())), width)[0])


def title_match(words: list[str], title: str | None, width: int = TITLE_WINDOW, share: float = TITLE_SHARE) -> bool:
    return bool(title_matches(pa.array([list(words)], pa.list_(pa.string())), [title], width, share)[0])


def collapse(words: list[str]) -> list[str]:
    return collapse_all(pa.array([list(words)], pa.list_(pa.string())))[0].as_py()


@F.arrow_udf(T.DoubleType())
def min_sliding_ratio(tokens: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0), *(min_ratios(tokens.slice(lo, hi - lo)) for lo, hi in _token_parts(tokens))]))


@F.arrow_udf(T.BooleanType())
def title_contamination(tokens: pa.Array, title: pa.Array) -> pa.Array:
    found = [title_matches(tokens.slice(lo, hi - lo), title.slice(lo, hi - lo).to_pylist()) for lo, hi in _token_parts(tokens)]
    return pa.array(np.concatenate([np.zeros(0, bool), *found]))


@F.arrow_udf(T.ArrayType(T.StringType()))
def collapse_phrases(text: pa.Array) -> pa.Array:
    """Stages one and two of denoise: the words of texts, repeated blocks and then repeated phrases taken once; none for null."""
    out = []
    for lo, hi in _parts(pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64), CHARS_AT_ONCE):
        part = text.slice(lo, hi - lo)
        out.append(collapse_all(pa.array([t.split() for t in deglued(pc.fill_null(part, "").to_pylist())], pa.list_(pa.string()))))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.string()))


def denoise(df: DataFrame, text_col: str, out: str = "denoised") -> DataFrame:
    """Loop removal in four stages: glued blocks, phrases, word runs, suffix variants. Words end up joined by single blanks."""
    d = df.withColumn("_w", collapse_phrases(F.col(text_col)))
    d = d.withColumn("_w", tx.cap_runs(F.col("_w")))
    d = d.withColumn(out, F.when(F.coalesce(F.col(text_col), F.lit("")) == "", F.col(text_col)).when(F.size("_w") == 0, tx.deglue(F.col(text_col))).otherwise(F.array_join(tx.drop_variants(F.col("_w")), " ")))
    return d.drop("_w")


def ghost(text: Column, segments: Column) -> Column:
    return F.exists(F.coalesce(segments, F.array().cast("array<struct<id:int,start:double,end:double,text:string,avg_logprob:double>>")), lambda x: F.isnan(x["avg_logprob"])) | (F.length(F.coalesce(text, F.lit(""))) < 10)


def measure(docs: DataFrame) -> DataFrame:
    """docs (full_text, segments, title) with metrics and the first category whose rule holds. One pass, no shuffle."""
    text = F.coalesce("full_text", F.lit(""))
    d = docs.withColumn("_w", tx.words(text))
    d = d.withColumns(
        {
            "has_ghost": ghost(F.col("full_text"), F.col("segments")),
            "global_uwr": tx.distinct_ratio(F.col("_w")),
            "tail_uwr": tx.distinct_ratio(tx.tail(F.col("_w"))),
            "cps": tx.chars_per_second(text, F.col("segments")),
            "glued_count": tx.glued_count(text),
            "min_sliding_uwr": min_sliding_ratio("_w"),
            "prompt_contamination": title_contamination("_w", "title"),
        }
    ).drop("_w")
    return d.withColumn("category", category())


def category() -> Column:
    return (
        F.when(F.col("has_ghost"), "GHOST")
        .when(F.col("glued_count") >= 3, "SYLLABLE_TRAP")
        .when(F.col("prompt_contamination"), "PROMPT_CONTAMINATED")
        .when(F.col("min_sliding_uwr") < 0.25, "SANDWICH_LOOP")
        .when((F.col("global_uwr") > 0.4) & (F.col("tail_uwr") < 0.2), "TERMINAL_LOOP")
        .when((F.col("global_uwr") < 0.40) | (F.col("cps") > 12.0), "TERMINAL_LOOP")
        .otherwise("SUCCESS")
    )
