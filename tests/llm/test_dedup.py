"""Line, substring and near-duplicate operators against brute force on small hostile tables."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.llm import common, line_dedup, near_dedup, substring_dedup
from tessella.llm.common import NULL_ID

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(t, lower=False):
    t = t or ""
    return re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER) if lower else t)


def table(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], "doc_id long, text string, did string, th int, gone string")


def brute_lines(rows, chars, docs):
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = x.strip(WS).translate(LOWER)
            if len(k) >= chars:
                held.setdefault(k, set()).add(NULL_ID if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(s := held.get(x.strip(WS).translate(LOWER), ())) < docs or max(s) == (NULL_ID if i is None else i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(5)
    pool = [f"Line number {n} é with enough text to be long" + "!" * (n % 3) for n in range(12)] + ["short", "", "  "]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t", "\x0b"]) for _ in range(rng.randrange(6)))) for i in range(60)]
    rows += [(None, pool[0]), (None, pool[0]), (3, rows[3][1]), (3, pool[1] + "\n" + pool[2]), (100, None), (101, ""), (102, "\n"), (103, pool[0].upper() + "\n\n" + pool[0])]
    rows += [(200 + i, "A hot line that a third of all documents hold, no less\nown " + str(i)) for i in range(40)]
    return rows + [(400, "\n".join(pool * 50))]


@pytest.mark.parametrize("shard_keys", [2, 1 << 18])
def test_lines(spark, monkeypatch, shard_keys):
    monkeypatch.setattr(line_dedup, "SALT_REFS", 8)
    rows = line_rows()
    df = table(spark, rows)
    monkeypatch.setattr(line_dedup.build_index, "__defaults__", (20, shard_keys))
    got = line_dedup.dedup_lines(df, min_chars=20, min_docs=5)
    assert got.columns == [*df.columns, "_n_lines", "_n_dropped"]
    want = brute_lines(rows, 20, 5)
    assert sorted([(r.doc_id, r._n_lines, r._n_dropped, r.text or "") for r in got.collect()], key=str) == want
    assert any(w[2] for w in want)


def test_minimal_perfect_hash():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    keys = np.unique(keys)
    at = line_dedup.probe_mph(line_dedup.build_mph(keys), keys)
    assert sorted(at.tolist()) == list(range(len(keys)))


def test_empty_tables(spark):
    df = table(spark, [])
    assert line_dedup.dedup_lines(df).count() == 0
    assert near_dedup.near_duplicates(df).count() == 0
    assert near_dedup.dedup(df).count() == 0
    assert substring_dedup.dedup_substrings(df).count() == 0


def brute_windows(rows, width):
    least = {}
    ids = [NULL_ID if i is None else i for i, _ in rows]
    ws = [words(t) for _, t in rows]
    for i, w in zip(ids, ws, strict=True):
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            least[x] = min(least.get(x, i), i)
    out = []
    for (real, _), i, w in zip(rows, ids, ws, strict=True):
        gone = set()
        for k in range(len(w) - width + 1):
            if least[tuple(w[k : k + width])] < i:
                gone |= set(range(k, k + width))
        out.append((real, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(out, key=str)


def test_substrings(spark, monkeypatch):
    for name, value in (("SHARD_WORDS", 64), ("BLOCK_WORDS", 40), ("SALT_WORDS", 64)):
        monkeypatch.setattr(substring_dedup, name, value)
    rng = random.Random(9)
    parts = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 40))] for _ in range(12)]
    rows = []
    for i in range(70):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += rng.choice(parts) if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20))]
        for _ in range(rng.randrange(3)):
            if w:
                w[rng.randrange(len(w))] = "edit"
        rows.append((i, " ".join(w)))
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[7][1] + " tail"), (80, None), (81, ""), (82, " \n "), (83, "rep " * 60), (84, "rep " * 30), (90, " ".join(w for p in parts for w in p))]
    got = substring_dedup.dedup_substrings(table(spark, rows), width=10, gram=4)
    have = sorted([(None if r.did == NULL_ID else r.did, r.n_words, r.n_removed, r.kept) for r in got.collect()], key=str)
    want = brute_windows(rows, 10)
    assert have == want
    assert sum(w[2] > 0 for w in want) > 20


def test_substrings_of_one_very_long_repetitive_text(spark):
    n = 1_000_000
    got = {r.did: r for r in substring_dedup.dedup_substrings(table(spark, [(1, "rep " * n), (2, "a b " + "rep " * 3000 + "c")])).collect()}
    assert (got[1].n_words, got[1].n_removed, len(got[1].kept)) == (n, 0, 4 * n - 1)
    assert (got[2].n_words, got[2].n_removed, got[2].kept) == (3003, 3000, "a b c")


def test_substrings_held_by_another_segment_of_the_leader(spark):
    rows = []
    for i in range(0, 120, 3):  # the smallest document holds p twice, the next ones repeat its second place only
        w = iter([f"v{i}x{n}" for n in range(60)])
        u1, p, u2, u3 = ([next(w) for _ in range(n)] for n in (12, 6, 12, 12))
        rows += [(i, " ".join(u1 + p + u2 + p + u3)), (i + 1, " ".join(p + u3[:5])), (i + 2, " ".join(p + u3))]
    rows += [(500, "a b c d e f g h i j k"), (500, "z y a b c d e f g h q r"), (501, "y a b c d e f g h q r"), (502, "b c d e f g h i j k")]
    got = substring_dedup.dedup_substrings(table(spark, rows), width=10, gram=4)
    have = sorted([(r.did, r.n_words, r.n_removed, r.kept) for r in got.collect()], key=str)
    assert have == brute_windows(rows, 10)


def brute_near(rows, percent=75, k=5):
    sets = []
    for _, t in rows:
        w = words(t, True)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    boss = list(range(len(rows)))

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                boss[find(a)] = find(b)
    ids = [NULL_ID if i is None else i for i, _ in rows]
    out = []
    for n, i in enumerate(ids):
        group = [ids[m] for m in range(len(rows)) if sets[n] and find(m) == find(n)]
        out.append((i, len(sets[n]), min(group) if group else i))
    return sorted(out)


def near_rows():
    rng = random.Random(3)
    base = [f"b{n}" for n in range(120)]
    rows = []
    for i in range(90):  # copies of copies: some link only through others, some not at all
        w = list(base) if i % 3 == 0 else rng.choice(rows)[1].split()
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = rng.choice(["e1", "e2", f"u{rng.randrange(10**6)}"])
        rows.append((1000 - i, " ".join(w)))
    rows += [(i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(60)) + " " + " ".join(base[:40])) for i in range(40)]
    rows += [(5000, None), (5001, ""), (5002, " \t "), (5003, "One two"), (5004, "one  TWO"), (None, rows[0][1]), (7, rows[0][1]), (7, "another text with the same id as one above it")]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    want = brute_near(rows)
    assert sorted((r.did, r.n_shingles, r.component) for r in got) == want
    assert len({w[2] for w in want}) < len(rows) - 40


def test_one_of_each_group_stays(spark):
    rows = near_rows()
    df = table(spark, rows)
    kept = near_dedup.dedup(df)
    assert kept.columns == df.columns
    groups = {c for i, n, c in brute_near(rows) if n}
    ids = [r.doc_id for r in kept.filter(F.trim("text") != "").filter("trim(regexp_replace(text, '\\\\s', '')) <> ''").collect()]
    assert sorted(NULL_ID if i is None else i for i in ids) == sorted(groups)


def test_sketch_share_is_near_the_similarity():
    import numpy as np

    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.r_[a[:200], rng.integers(0, 2**63, 100).astype(np.uint64)]
    small = a[:3]
    row = np.repeat([0, 1, 2], [300, 300, 3])
    s = near_dedup.sketches(row, np.r_[a, b, small], 4, 512)
    assert (s[:3] != 2**64 - 1).all()
    assert (s[3] == 2**64 - 1).all()
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.08




def test_lines_of_long_documents_are_dropped_in_linear_time(spark):
    import time

    lines = [f"{i:09} a line that five documents share, long enough" for i in range(200_000)]
    text = "\n".join([*lines[:100_000], "own line", *lines[100_000:]])
    df = spark.createDataFrame([(i, text) for i in range(5)], "doc_id long, text string").repartition(5)
    began = time.time()
    got = {r.doc_id: (r._n_lines, r._n_dropped, r.text if r.doc_id < 4 else len(r.text)) for r in line_dedup.dedup_lines(df).collect()}
    assert time.time() - began < 120
    assert got == {i: (200_001, 200_000, "own line") for i in range(4)} | {4: (200_001, 0, len(text))}


def test_batches_for_the_workers_are_bounded(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        common.small_batches(spark)
        rows = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('ab', 5000) AS text")  # 20 MB in fewer rows than a batch may have
        got = rows.mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"]) for b in it), "n long, size long").collect()
        assert sum(r.n for r in got) == 2000 and max(r["size"] for r in got) <= 2 * common.BATCH_BYTES
        spark.conf.set(name, "8m")  # the user's own bound stays
        common.small_batches(spark)
        assert spark.conf.get(name) == "8m"
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
