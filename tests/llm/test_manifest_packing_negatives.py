"""Merkle manifests, packing and hard negatives against brute force and hostile rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import hard_negatives, merkle, packing, tiles

# -------------------------------------------------------------------------- op12


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def tree(leaves: list[str], fanout: int) -> tuple[str, list[str]]:
    """The root and each leaf's siblings, level by level."""
    proofs, at, level = [""] * len(leaves), list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, n in enumerate(at):
            run = level[n // fanout * fanout : n // fanout * fanout + fanout]
            proofs[i] += "".join(run[: n % fanout] + run[n % fanout + 1 :])
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [n // fanout for n in at]
    return level[0], proofs


def leaf(row) -> str:
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest(spark, fanout):
    rng = random.Random(fanout)
    rows = [(i, "hot" if i % 3 else f"s{rng.randrange(9)}", "en", i, f"Text {i} é") for i in range(60)]
    rows += [(1000, "lone", None, None, None), (1001, None, "x", 0, ""), (None, "hot", "x", 1, "A"), (7, "hot", "x", 1, "B"), (7, "hot", "x", 1, "B"), (1002, "", "y", -5, "y" * 50000)]
    df = spark.createDataFrame([(*r, "g", 1, 2) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, g string, k int, index int")
    shown = {"text": F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text"))}
    out = merkle.manifest(df, fanout=fanout, shown=shown).select("*", merkle.proof(F.col("path")).alias("proof"), merkle.folded(F.col("presented"), F.col("path")).alias("folded"))
    got = Counter((r.key, r.leaf, r.subroot, r.root, r.proof, r.folded == r.root) for r in out.collect())
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, want = [], []
    for s in names:
        of = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, proofs = tree([leaf(r) for r in of], fanout)
        subs.append(root)
        want += [(s, r, root, p) for r, p in zip(of, proofs, strict=True)]
    top, above = tree(subs, fanout)
    changed = lambda r: r[0] is not None and r[0] % 2 == 0 and r[4] is not None and r[4].lower() != r[4]
    assert got == Counter((r[0], leaf(r), root, top, sha(p + above[names.index(s)]), not changed(r)) for s, r, root, p in want)


def test_manifest_of_few_rows(spark):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], kind)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "a", "b", 2, "c")], kind)).select("*", merkle.proof(F.col("path")).alias("proof")).first()
    assert one.leaf == one.subroot == one.root == leaf((1, "a", "b", 2, "c"))
    assert one.proof == sha("")
    two = merkle.manifest(spark.createDataFrame([(1, "a", "b", 2, "c"), (1, "b", "b", 2, "c")], kind)).collect()
    assert {r.root for r in two} == {sha(two[0].leaf + two[1].leaf if two[0].group == "a" else two[1].leaf + two[0].leaf)}


# -------------------------------------------------------------------------- op11

_WORDS = packing.Words(packing.vocabulary_path())
_PART = st.sampled_from(["a", "The", "it's", "I'LL", "'", "<", "<|endoftext|>", "<|startoftext|>x", " ", "\n", "\t", "\x0b", "\x00", "\x7f", "é", "É", "é", "́", "Σ", "ß", "日本", "12", "3.5", "...", ",", "_-", " ", " ", "😀", "İ"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(_PART, max_size=12).map("".join), max_size=5))
def test_units_give_the_ids_of_whole_texts(texts):
    ids, off = packing.token_ids(pa.array(texts, pa.string()), _WORDS)
    want = [_WORDS.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == want


def fewest(lengths: tuple[int, ...], capacity: int) -> int:
    """The least number of sequences, by trying every subset for the longest piece's sequence."""

    @cache
    def best(left: tuple[int, ...]) -> int:
        if not left:
            return 0
        out = len(left)

        def fill(i: int, gap: int, rest: tuple[int, ...]) -> None:
            nonlocal out
            if i == len(left):
                out = min(out, 1 + best(rest))
                return
            if left[i] <= gap:
                fill(i + 1, gap - left[i], rest)
            fill(i + 1, gap, (*rest, left[i]))

        fill(1, capacity - left[0], ())
        return out

    return best(tuple(sorted(lengths, reverse=True)))


def test_plans_of_few_pieces_are_almost_the_best():
    rng = random.Random(5)
    more = 0
    for _ in range(60):
        lengths = tuple(rng.randint(1, 20) for _ in range(8))
        got = sum(n for n, _ in packing.plan(Counter(lengths), 20))
        assert got <= fewest(lengths, 20) + 1
        more += got > fewest(lengths, 20)
    assert more <= 6


def test_complements_fill_exactly():
    for parts in ((12, 8), (13, 5, 2), (11, 4, 3, 2)):
        for copies, used in packing.plan(Counter(dict.fromkeys(parts, 1000)), 20):
            assert copies == 1000
            assert sorted(used.elements(), reverse=True) == list(parts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=40))
def test_plans_use_every_piece_once(counts):
    patterns, total = packing.plan(counts, 64), Counter()
    for copies, used in patterns:
        assert sum(n * k for n, k in used.items()) <= 64
        total.update({n: k * copies for n, k in used.items()})
    assert total == Counter(counts)
    assert len(patterns) <= 4 * len(counts) + 4
    small = Counter({n: k for n, k in counts.items() if n <= 8})
    if small:  # short pieces leave hardly anything
        assert sum(c for c, _ in packing.plan(small, 64)) <= -(-sum(n * k for n, k in small.items()) // 64) + 1


def test_indexes_stay_right_as_lengths_are_used_up():
    have = packing.Lengths(dict.fromkeys((1, 3, 4, 7, 9, 12), 2), 24)
    for length in (4, 12, 1):
        have.take(Counter({length: 1}), 2)
        now = packing.Lengths({n: int(k) for n, k in enumerate(have.left) if k}, 24)
        assert (have.pairs == now.pairs).all()
        assert (have.triples == now.triples).all()


def test_pack(spark):
    texts = [None, "", " ", "a b c", "x " * 300, "日本語 " * 50, "it's <|endoftext|> fine", "y" * 100_000, "word " * 60_000, *["the same"] * 40]
    rows = [(i if i != 3 else None, t, 5, "z") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, piece string").repartition(3)
    out = packing.pack(df, capacity=128).collect()
    tokens = {i: (_WORDS.tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in rows}
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids)
    assert set(by) == set(tokens)
    for i, parts in by.items():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == [128 * n for n in range(len(parts))]
        assert all(r.length == 128 for r in parts[:-1])
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == tokens[i]
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 128
    assert len(sequences) == -(-sum(map(len, tokens.values())) // 128)
    assert packing.pack(df.filter("doc_id < 0")).count() == 0


# -------------------------------------------------------------------------- op13


def brute(rows, anchors, positives, negatives):
    out = set()
    for a, la, va in anchors:
        score = {n: sum(x * y for x, y in zip(va, v, strict=True)) for n, (i, _, v) in enumerate(rows) if i != a and len(v) == len(va)}
        mates = sorted((-s, rows[n][0], n) for n, s in score.items() if rows[n][1] == la)[:positives]
        for s, p, _ in mates:
            others = sorted((-x, rows[n][0]) for n, x in score.items() if rows[n][1] != la and 50 * -s <= 100 * x <= 95 * -s)[:negatives]
            out |= {(a, p, k + 1, i, -s, -x) for k, (x, i) in enumerate(others)}
    return out


@pytest.mark.parametrize("top", [3, 200, 2**24])
def test_hard_negatives(spark, monkeypatch, top):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_ROWS", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(tiles, "PART_SHARDS", 2)
    monkeypatch.setattr(tiles, "FAN_IN", 2)
    rng = np.random.default_rng(top)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-top, top + 1, 20).tolist()) for i in range(300)]
    rows += [(i, 1, [2] * 20) for i in range(300, 380)] + [(i, 2, [2] * 19 + [1]) for i in range(380, 400)]  # a common vector: ties
    rows += [(400, 0, [0] * 20), (401, 7, [1] * 20), (402, 1, [1] * 3), (402, 2, [2] * 3), (500, 2, [1] * 20), (500, 2, [1] * 20)]
    v = spark.createDataFrame(rows, "id long, label long, v array<long>")
    anchors = [r for r in rows if r[0] % 20 == 0]
    got = [tuple(r) for r in hard_negatives.mine(v.withColumn("version", F.lit(1)), v.filter("id % 20 = 0")).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, anchors, 5, 3)


def test_rows_that_take_part(spark):
    rows = [(1, 0, [0.5, -0.001]), (None, 0, [1.0]), (2, None, [1.0]), (3, 0, None), (4, 0, []), (5, 0, [None]), (6, 0, [float("nan")]), (7, 0, [float("inf")])]
    v = hard_negatives.labelled(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), "vec_id", "embedding", "label", 256)
    assert [tuple(r) for r in v.collect()] == [(1, 0, [128, -1])]
    assert hard_negatives.mine(v, v).count() == 0
    assert hard_negatives.mine(v.filter("id < 0"), v).count() == 0


def test_scan_drops_only_what_no_window_needs():
    rng = np.random.default_rng(3)
    m = rng.integers(-9, 10, (500, 24))
    shard = hard_negatives.Shard(24, 1, np.ascontiguousarray(m.T.astype(np.int8)).tobytes(), np.arange(500).tobytes(), np.zeros(500, np.int64).tobytes())
    for q in rng.integers(-9, 10, (20, 24)):
        s = m @ q
        low, high = np.array([50, 300, 10]), np.array([200, 2000, 5])
        rows, scores = hard_negatives.scan(q, shard, np.ones(500, bool), low, high, 3)
        assert (scores == s[rows]).all()
        for a, b in zip(low, high, strict=True):
            best = sorted(((-s[i], i) for i in range(500) if a <= s[i] <= b))[:3]
            assert {i for _, i in best} <= set(rows.tolist())
        assert len(rows) < 250
