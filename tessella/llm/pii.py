"""Sanitisation by disclosure: base patterns, and terms that reveal the protected entities.

Protected entities are the personal data that four patterns find (email, ip, card, phone). The corpus tells which other
terms give them away, kind by kind: a term's exposure is how often it stands within `reach` words of an entity of the kind,
its use is how often it stands anywhere, both counted over all documents. Its pointwise mutual information with the kind is
log2(P(entity near | term) / P(entity near)), with the lower confidence bound of the exposure rate in the numerator, and
its disclosure is the share of the entity's own information, -log2 P(entity near), that this takes away: 0 for a term that
tells nothing, 1 for one that stands only beside entities. A term counts if its exposure can't be chance: the evidence of
its counts in bits (use times the divergence of its rate from the kind's) must exceed what the most exposed of all the
corpus's terms would show by chance, log2(terms x kinds), by `sure` bits. Both bars are relative, so they mean the same on
small and on large corpora.

A term of disclosure `remove` or more is a span of kind `reveal` wherever it stands, and is removed; one of `generalise` or
more is a span of kind `quasi`, generalised to `[term]`. Entities become `[kind]`.

Counting is one map-side combined aggregation over (term) with a row per distinct term and batch. Up to `max_terms`
sensitive terms are sent to every task; more are joined to the distinct words of each text, so that a row brings its own
terms along. The result is the same.

Defined results: null text is empty text; ids may be null; repeated rows are each counted and each returned; offsets are
code points, end exclusive; spans of one kind don't overlap, and a term inside an entity is no span of its own; an empty
table gives an empty result; extra columns are carried in `doc`; a very long text is read whole, with a table of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lookup, slices, span_hashes, stored, text_bytes, word_bounds

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "quasi", "reveal")
REACH, GENERALISE, REMOVE, SURE, MAX_TERMS = 4, 0.7, 0.85, 10.0, 100_000
#: Standard errors of the confidence bound.
BOUND = 2.0
#: Shares of a term's texts where terms are joined to texts.
SALTS = 16

# The base patterns. An email is searched from its @ and extended to the left, which is linear.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a start inside a run of digits matches only if the run's does
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind as in KINDS, then start."""
    out = []
    if "@" in text:
        done = 0
        for m in _AT.finditer(text):
            lo = m.start()
            while lo > done and text[lo - 1] in _LOCAL:
                lo -= 1
            if lo < m.start():
                out.append(("email", lo, m.end()))
                done = m.end()
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_MAYBE = r"[0-9]|@"


def _entities(b: pa.RecordBatch) -> list[list[tuple[str, int, int]]]:
    """Base spans of each row; rows without a digit or an @ are not read by the patterns."""
    maybe = pc.fill_null(pc.match_substring_regex(b.column("text"), _MAYBE), False).to_pylist()
    text = b.column("text")
    return [base_spans(text[i].as_py()) if on else [] for i, on in enumerate(maybe)]


def _words_near(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, off: np.ndarray, found: list, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(kinds x words: is one of that kind within reach in the word's row; is the word part of an entity)."""
    near, own = np.zeros((len(KINDS), len(starts) + 1), np.int64), np.zeros(len(starts), bool)
    for r, spans in enumerate(found):
        if not spans:
            continue
        at = np.flatnonzero((data[off[r] : off[r + 1]] & 0xC0) != 0x80)
        at = np.r_[at, off[r + 1] - off[r]] + off[r]
        for kind, lo, hi in spans:
            a = np.searchsorted(ends, at[lo], side="right")
            z = np.searchsorted(starts, at[hi], side="left")
            own[a:z] = True
            near[KINDS.index(kind), max(rows[r], a - reach)] += 1
            near[KINDS.index(kind), min(rows[r + 1], z + reach)] -= 1
    return (np.cumsum(near, axis=1)[:, :-1] > 0) & ~own, own


def _count(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = _entities(b)
            data, off = text_bytes(b.column("text"))
            starts, ends, rows = word_bounds(data, off)
            h = span_hashes(data, starts, ends, lower=True)
            order = np.argsort(h, kind="stable")
            sorted_ = h[order]
            first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(h) else np.zeros(0, np.int64)
            exposed = np.zeros((len(KINDS), len(first)), np.int64)
            if any(found) and len(first):
                near, _ = _words_near(data, starts, ends, rows, off, found, reach)
                exposed = np.add.reduceat(near[:, order].astype(np.int64), first, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(sorted_[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(h)])), *(pa.array(x) for x in exposed)], ["term", "uses", *KINDS])

    return run


def term_counts(docs: DataFrame, text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(term, uses, and for each kind the uses near an entity of it), over all rows; terms are hashes; stored."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_count(reach), "term long, uses long, " + ", ".join(f"{k} long" for k in KINDS))
    return stored(counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("uses", *KINDS)]), "terms")


def disclosures(counts: DataFrame, sure: float = SURE) -> DataFrame:
    """(term, disclosure) of the terms whose exposure to some kind is no chance: the highest over the kinds."""
    total = counts.agg(F.count("*").alias("terms"), *[F.sum(c).alias(c) for c in ("uses", *KINDS)]).first()
    uses, bars = F.col("uses").cast("double"), []
    for kind in KINDS:
        base = (total[kind] or 0) / max(total.uses or 0, 1)
        if not 0 < base < 1:
            continue
        rate = F.col(kind) / uses
        part = lambda r, b: F.when(r > 0, r * F.log2(r / b)).otherwise(0.0)
        evidence = uses * (part(rate, base) + part(1 - rate, 1 - base)) - float(np.log2(total.terms * len(KINDS)))
        # Wilson's lower bound of the rate
        z2 = BOUND**2
        low = (rate + z2 / (2 * uses) - BOUND * F.sqrt(rate * (1 - rate) / uses + z2 / (4 * uses * uses))) / (1 + z2 / uses)
        disclosure = F.log2(F.greatest(low, F.lit(1e-12)) / base) / -float(np.log2(base))
        bars.append(F.when((rate > base) & (evidence >= sure), disclosure))
    return counts.select("term", F.array_max(F.array(F.lit(None).cast("double"), *bars)).alias("disclosure")).filter("disclosure is not null")


def sensitive_terms(docs: DataFrame, text_col: str = "text", reach: int = REACH, generalise: float = GENERALISE, sure: float = SURE) -> DataFrame:
    """(term, disclosure): hashes of the terms whose presence discloses an entity; stored."""
    return stored(disclosures(term_counts(docs, text_col, reach), sure).filter(F.col("disclosure") >= generalise), "sensitive")


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(th, term): the distinct words of each text."""
    for b in slices(batches):
        data, off = text_bytes(b.column("text"))
        starts, ends, rows = word_bounds(data, off)
        h = span_hashes(data, starts, ends, lower=True).view(np.int64)
        th = np.repeat(b.column("th").to_numpy(), np.diff(rows))
        order = np.lexsort((h, th))
        h, th = h[order], th[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (th[1:] != th[:-1])] if len(h) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(th[new]), pa.array(h[new])], ["th", "term"])


def _own_terms(docs: DataFrame, terms: DataFrame, text_col: str, remove: float) -> DataFrame:
    """(th, own): the sensitive terms of each text, by the text's hash; bounded by the text's length.

    Texts with equal hashes share their terms, which adds none: whatever is in a set is sensitive wherever it stands.
    """
    keyed = docs.select(F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text")).filter("text is not null")
    pairs = keyed.mapInArrow(_distinct_terms, "th long, term long").distinct().withColumn("salt", F.pmod("th", F.lit(SALTS)).cast("int"))
    spread = terms.select("term", (F.col("disclosure") >= remove).alias("reveal"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return pairs.join(spread, ["term", "salt"]).groupBy("th").agg(F.collect_list(F.struct("term", "reveal")).alias("own"))


def _find(terms: np.ndarray, reveals: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield _spans(b, _entities(b), terms, reveals)

    return run


def _find_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As _find, with the terms that the rows bring along."""
    for b in slices(batches):
        own = pc.list_flatten(b.column("own"))
        terms, reveal = own.field(0).to_numpy().view(np.uint64), own.field(1).to_numpy(zero_copy_only=False).astype(bool)
        yield _spans(b.drop_columns(["own"]), _entities(b), np.unique(terms), np.unique(terms[reveal]))


def _spans(b: pa.RecordBatch, found: list, terms: np.ndarray, reveals: np.ndarray) -> pa.RecordBatch:
    """The rows of b with their spans: the entities found, then the sensitive terms outside them. terms: sorted."""
    if len(terms):
        data, off = text_bytes(b.column("text"))
        starts, ends, rows = word_bounds(data, off)
        at, number = lookup(terms, span_hashes(data, starts, ends, lower=True))
        if len(at) and any(found):
            own = _words_near(data, starts, ends, rows, off, found, 0)[1]
            at, number = at[~own[at]], number[~own[at]]
        kind = np.where(np.isin(terms, reveals)[number], "reveal", "quasi")
        row = np.searchsorted(rows, at, side="right") - 1
        for r in np.unique(row).tolist():
            points = np.cumsum((data[off[r] : off[r + 1]] & 0xC0) != 0x80)
            for i in np.flatnonzero(row == r).tolist():
                a, z = starts[at[i]] - off[r], ends[at[i]] - off[r]
                found[r].append((str(kind[i]), int(points[a] - 1), int(points[z - 1])))
            found[r].sort(key=lambda x: (ALL_KINDS.index(x[0]), x[1]))
    keep = [c for c in b.schema.names if c != "text"]
    lists = pa.array([[{"kind": k, "start": a, "end": z} for k, a, z in x] for x in found], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], [*keep, "spans"])


def find(docs: DataFrame, text_col: str = "text", reach: int = REACH, generalise: float = GENERALISE, remove: float = REMOVE, sure: float = SURE, max_terms: int = MAX_TERMS) -> DataFrame:
    """(doc, spans): the input row as a struct, its base spans by kind and start, then its term spans."""
    terms = sensitive_terms(docs, text_col, reach, generalise, sure)
    sent = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([sent.schema["doc"], T.StructField("spans", _SPANS)])
    if terms.count() > max_terms:
        own = _own_terms(docs, terms, text_col, remove)
        return sent.withColumn("th", F.xxhash64("text")).join(own, "th", "left").select("doc", "text", "own").mapInArrow(_find_own, schema)
    rows = list(terms.toLocalIterator())
    known, reveals = (np.sort(np.array([r.term for r in rows if r.disclosure >= bar], np.int64).view(np.uint64)) for bar in (generalise, remove))
    return sent.mapInArrow(_find(known, reveals), schema)


def sanitise(docs: DataFrame, text_col: str = "text", **parameters) -> DataFrame:
    """docs with text sanitised: entities become [kind], revealing terms go, quasi-identifying terms become [term]."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, marks in zip(text, spans, strict=True):
            parts, at = [], 0
            for m in sorted(marks if t is not None and marks is not None else [], key=lambda m: (m["start"], -m["end"])):
                if m["start"] >= at:
                    parts += [t[at : m["start"]], {"quasi": "[term]", "reveal": ""}.get(m["kind"], f"[{m['kind']}]")]
                    at = m["end"]
            out.append(None if t is None else "".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    found = find(docs, text_col, **parameters)
    return found.select(*[cut(F.col("doc").getField(c), "spans").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])
