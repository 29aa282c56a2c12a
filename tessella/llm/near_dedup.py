"""Near-duplicate groups: fast similarity sketches, banding, exact verification, components.

A document's set is its distinct 5-word shingles (64-bit). Its sketch has `BANDS * ROWS` coordinates, filled by rounds of
hashed bin placement: in round i every shingle goes to one hashed bin with a hashed value, later rounds only reach bins
that earlier ones left empty, and from round t on every shingle goes to bin i - t, so every coordinate is filled after at
most 2t rounds (for sets larger than t log t, mostly after one). The share of equal coordinates is concentrated around
the Jaccard similarity as for t independent samples: a pair at 0.75 misses every one of 32 bands of 4 rows with
probability 5e-6.

Equal sets are one class; classes meet in band buckets. A large bucket is never expanded into all its pairs: its most
central member meets the others, links are confirmed on the full sets, and components are merged. Where a bucket still
spans several components, the members outside its largest one meet those that share one of their rarest shingles, as any
link must (a prefix filter); these pairs are confirmed on the full sets too. So no link between members of different
components stays untested, whatever the size of a bucket.

Hot keys: a class of many equal documents, a bucket, a pivot, a shingle or a component may hold a share of all rows. They
are counted with map-side partial sums, and the table of counts is written before it is joined: both sides of such a join
are then plain shuffles of small rows, which Spark splits by size where one key stands out (skew join).

Defined results: null, empty or blank text has an empty set and links to nothing; null doc_id sorts before all others;
repeated rows fall into one class; rows that share an id but not a set are separate documents; a very long text is one set
like any other (a task holds one such set at a time); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, give_back, mix, ngram_hashes, row_keys, slices, stored, word_hashes
from .components import components

SHINGLE, BANDS, ROWS = 5, 32, 4
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Buckets up to this size are compared pair by pair; larger ones by a pivot, then by rare shingles.
SMALL = 8


def shingle_sets(text: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of the distinct shingles of each row, sorted by both."""
    h, off = word_hashes(text, lower=True)
    n = np.diff(off)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = ngram_hashes(h, k)
    count = np.maximum(n - k + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    at = np.repeat(off[:-1] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(len(row))
    value = grams[at] if len(row) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            on = n[short] > i
            whole[on] = mix(whole[on] ^ h[off[short[on]] + i], 50 + i)
        row, value = np.r_[row, short], np.r_[value, whole]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
    return row[new], value[new]


def sketches(row: np.ndarray, value: np.ndarray, rows: int, t: int) -> np.ndarray:
    """A rows x t array of sketch coordinates; rows without shingles stay at the largest value."""
    free = np.uint64(2**64 - 1)
    out = np.full(rows * t, free, np.uint64)
    for i in range(2 * t):
        if not len(row):
            break
        u = mix(value, 200 + i)
        slot = row * t + (mix(value, 5000 + i) % np.uint64(t)).astype(np.int64) if i < t else row * t + (i - t)
        empty = out[slot] == free
        np.minimum.at(out, slot[empty], u[empty])
        lacking = (out.reshape(rows, t) == free).any(1)
        on = lacking[row]
        row, value = row[on], value[on]
    return out.reshape(rows, t)


def _sketch(bands: int, rows: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, value = shingle_sets(b.column("text"), k)
            n = np.bincount(row, minlength=b.num_rows)
            s = sketches(row, value, b.num_rows, bands * rows).reshape(b.num_rows, bands, rows)
            key = np.zeros((b.num_rows, bands), np.uint64)
            for j in range(rows):
                key = mix(key ^ s[:, :, j], 30 + j)
            key = mix(key ^ np.arange(bands, dtype=np.uint64), 40)
            ends = np.cumsum(n)
            sums = []
            for seed in (60, 61):
                with np.errstate(over="ignore"):
                    total = np.r_[np.uint64(0), np.cumsum(mix(value, seed))]
                    sums.append(mix(total[ends] - total[ends - n] + n.astype(np.uint64), seed))
            c = np.empty((b.num_rows, 12), np.uint8)
            c[:, :8], c[:, 8:] = sums[0].view(np.uint8).reshape(-1, 8), sums[1].view(np.uint8).reshape(-1, 8)[:, :4]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, bands, dtype=np.int32)), pa.array(key.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("did"), b.column("th"), pa.array(n.astype(np.int64)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), b.num_rows, [None, pa.py_buffer(c.tobytes())]).cast(pa.binary()), lists], ["did", "th", "n", "c", "bands"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            row, value = shingle_sets(b.column("text"), k)
            ends = np.cumsum(np.bincount(row, minlength=b.num_rows))
            sets = np.split(value, ends[:-1])
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array([x.tobytes() for x in sets], pa.binary())], ["c", "set"])

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column("sa"), b.column("sb"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < percent * len(y):
                    continue
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok)], ["a", "b", "linked"])
        give_back()

    return run


def _pairs(buckets: DataFrame, pivots: DataFrame) -> DataFrame:
    """Each pivot with each other member of its bucket, once, smaller class first."""
    met = buckets.join(pivots, "band").filter(F.col("c") != F.col("pivot"))
    return met.select(F.least("c", "pivot").alias("a"), F.greatest("c", "pivot").alias("b")).distinct()


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x, c in zip(b.column("set"), b.column("c"), strict=True):
            v = np.frombuffer(x.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array([c.as_py()] * len(v), pa.binary()), pa.array(np.full(len(v), len(v)))], ["shingle", "c", "n"])


def _sharing(sets: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs across components, one of them outside, that can be links: their rarest shingles have one in common.

    Two sets of n and m shingles linked at `percent` have need = ceil(percent * (n + m) / (100 + percent)) in common. With
    all shingles in one order, they share one among the first n - need + 1 and m - need + 1. In order of rarity these are
    shingles of few sets, so members of a group that differ too much never meet, however large the group is.
    """
    rows = sets.join(open_.select("c"), "c", "left_semi").mapInArrow(_shingles, "shingle long, c binary, n long")
    often = stored(rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    common = rows.join(often, "shingle")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # shingles of this set alone come first and match nothing; a set's own size bounds what is gathered here
    own = common.groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("x"))
    take = first - (F.col("n") - F.size("x"))
    alone = (F.col("n") - F.size("x")).cast("long")
    heads = own.filter(take > 0).select("c", "n", alone.alias("alone"), F.posexplode(F.slice("x", F.lit(1), take.cast("int"))).alias("at", "x")).select("c", "n", (F.col("alone") + F.col("at")).alias("at"), "x.shingle")
    heads = stored(heads.join(open_, "c"), "heads")
    across = heads.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("outside").alias("out")).filter((F.col("lo") != F.col("hi")) & F.col("out"))
    heads = heads.join(stored(across.select("shingle"), "across"), "shingle", "left_semi")
    left = heads.filter("outside").select("shingle", F.col("c").alias("x"), F.col("comp").alias("xc"), F.col("n").alias("xn"), F.col("at").alias("xat"))
    right = heads.select("shingle", F.col("c").alias("y"), F.col("comp").alias("yc"), F.col("n").alias("yn"), F.col("at").alias("yat"), F.col("outside").alias("yout"))
    need = F.ceil((F.col("xn") + F.col("yn")) * percent / (100 + percent))
    early = (F.col("xat") <= F.col("xn") - need) & (F.col("yat") <= F.col("yn") - need)
    once = ~F.col("yout") | (F.col("x") < F.col("y"))
    met = left.join(right, "shingle").filter((F.col("xc") != F.col("yc")) & early & once)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE) -> DataFrame:
    """(did, th, n_shingles, component) for each row of docs: component is the smallest id of its group, did as in row_keys."""
    keyed = row_keys(docs, id_col, text_col)
    sketched = stored(keyed.mapInArrow(_sketch(bands, rows, k), "did long, th long, n long, c binary, bands array<long>"), "sketches")
    # one row of each class: its least (did, th)
    reps = stored(sketched.filter("n > 0").groupBy("c").agg(F.min(F.struct("did", "th")).alias("k")).select("c", "k.did", "k.th"), "classes")
    banded = sketched.filter("n > 0").groupBy("c").agg(F.first("bands").alias("bands")).select("c", F.explode("bands").alias("band"))
    sizes = stored(banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    buckets = stored(banded.join(sizes, "band"), "buckets")

    source = reps.join(buckets.select("c").distinct(), "c", "left_semi")
    texts = keyed.join(source, ["did", "th"]).select("c", "text")
    sets = stored(texts.mapInArrow(_sets(k), "c binary, set binary").dropDuplicates(["c"]), "sets")

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("c").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("c").alias("b"), F.col("set").alias("sb")), "b")
        return stored(both.mapInArrow(_linked(percent), "a binary, b binary, linked boolean"), "tested")

    small = buckets.filter(F.col("size") <= SMALL).select("band", "c")
    large = buckets.filter(F.col("size") > SMALL)
    # a large bucket's pivot is the member with most company over all its buckets: in a group of copies, their centre
    company = large.groupBy("c").agg(F.sum("size").alias("company"))
    pivots = stored(large.join(company, "c").groupBy("band").agg(F.max(F.struct("company", "c")).getField("c").alias("pivot")), "pivots")
    large = large.select("band", "c")
    tested = verify(_pairs(small, small.select("band", F.col("c").alias("pivot"))).unionByName(_pairs(large, pivots)).distinct())
    edges = components(tested.filter("linked").select("a", "b"))

    # buckets that still span several components: what lies outside the largest one may link to other members
    labelled = large.join(edges.select(F.col("a").alias("c"), F.col("b").alias("comp")), "c", "left").select("band", "c", F.coalesce("comp", "c").alias("comp"))
    lead = labelled.groupBy("band", "comp").agg(F.count("*").alias("n")).groupBy("band").agg(F.max(F.struct("n", "comp")).getField("comp").alias("lead"), F.count("*").alias("comps")).filter("comps > 1")
    lead = stored(lead.select("band", "lead"), "lead")
    open_ = stored(labelled.join(lead, "band").groupBy("c", "comp").agg(F.max(F.col("comp") != F.col("lead")).alias("outside")), "open")
    if not open_.isEmpty():
        found = _sharing(sets, open_, percent).join(tested.select("a", "b"), ["a", "b"], "left_anti")
        edges = components(edges.unionByName(verify(found).filter("linked").select("a", "b")))

    comp = stored(reps.join(edges.select(F.col("a").alias("c"), F.col("b").alias("comp")), "c", "left").select("c", "did", F.coalesce("comp", "c").alias("comp")), "members")
    least = stored(comp.groupBy("comp").agg(F.min("did").alias("component")), "least")
    groups = stored(comp.join(least, "comp").select("c", "component"), "groups")
    return sketched.join(groups, "c", "left").select("did", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("did")).alias("component"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of docs that stay: of each group the one with the smallest id, once; rows without words all stay."""
    groups = near_duplicates(docs, id_col, text_col, **parameters).dropDuplicates(["did", "th"])
    # rows that share the smallest id count as one: the one with the least text hash stays
    first = groups.filter("n_shingles > 0 and did = component").groupBy("component").agg(F.min("th").alias("th")).select(F.col("component").alias("did"), "th")
    empty = groups.filter("n_shingles = 0").select("did", "th")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text_col).alias("th"))
    kept = keyed.join(first, ["did", "th"], "left_semi").dropDuplicates(["did", "th"]).unionByName(keyed.join(empty, ["did", "th"], "left_semi"))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
