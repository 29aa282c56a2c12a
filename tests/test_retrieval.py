"""Chunks, embeddings, search and rounding against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import export, retrieval


def plain_split(text, size, overlap, separators=("\n\n", "\n", ".", " ", "")):
    """The splitting rules, part by part."""
    sep = next((s for s in separators if s == "" or s in text), separators[-1])
    finer = separators[separators.index(sep) + 1 :]
    parts = list(text) if sep == "" else [p if i == 0 else sep + p for i, p in enumerate(text.split(sep))]
    out, held = [], []

    def flush():
        if chunk := "".join(held).strip():
            out.append(chunk)

    for p in parts:
        if len(p) > size and finer:
            flush()
            held = []
            out += plain_split(p, size, overlap, finer)
            continue
        total = sum(map(len, held))
        if held and total + len(p) > size:
            flush()
            while held and (total > overlap or total + len(p) > size):
                total -= len(held.pop(0))
        held.append(p)
    flush()
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["\n\n", "\n", ".", " ", "a", "bb", "ccccc", "é", "\n\n\n", "d" * 30, ". ", "  "]), max_size=60).map("".join), st.integers(1, 25), st.integers(0, 30))
def test_chunks_are_those_of_the_rules(text, size, overlap):
    assert retrieval.split_text(text, size, overlap) == plain_split(text, size, overlap)


def test_long_texts_take_linear_time():
    import time

    words = "".join(random.Random(1).choice(["ab ", "c", "def. ", "\n"]) for _ in range(400_000))
    began = time.process_time()
    chunks = retrieval.split_text(words) + retrieval.split_text("x" * 1_000_000) + retrieval.split_text("." * 300_000)
    assert time.process_time() - began < 20
    assert max(map(len, chunks)) <= 1000


def test_batches_go_to_the_embedder_whole(spark):
    rows = [(str(i), i % 7, f"t{i % 90}") for i in range(173)]
    chunks = spark.createDataFrame(rows, "id string, v int, document string").coalesce(1)

    def embed(texts):  # the size of each call shows in what it gives
        return [[float(len(texts)), float(t[1:])] for t in texts]

    got = retrieval.embedded(chunks, embed, 50).collect()
    assert sorted(r.embedding[0] for r in got) == [23.0] * 23 + [50.0] * 150
    assert all(r.embedding[1] == float(r.document[1:]) for r in got)
    assert retrieval.embedded(chunks.limit(0), embed).count() == 0
    store = retrieval.embedded(chunks.filter("v < 3"), embed)
    new = spark.createDataFrame([("5", 1, "t1"), ("5", 3, "t3"), ("5", 2, "t2"), ("new", 0, "t8")], "id string, v int, document string")
    after = {r.id: r.document for r in retrieval.upsert_chunks(store, new, embed, "v").collect()}
    assert after == {r[0]: r[2] for r in rows if r[1] < 3} | {"5": "t3", "new": "t8"}


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "SHARD_ROWS", 11)
    monkeypatch.setattr(retrieval, "BLOCK_ROWS", 3)
    rng = random.Random(6)
    rows = [(f"c{i:03}", [rng.choice([0.0, 1.0, -0.5, 0.25]) for _ in range(5)]) for i in range(120)] + [(f"d{i}", [1.0, 0.5, 0.0, 0.0, 0.25]) for i in range(40)]
    rows += [("null", None), ("empty", []), ("hole", [None] * 5), ("nan", [math.nan] * 5), ("inf", [math.inf] * 5), ("zero", [0.0] * 5), ("short", [1.0] * 3), (None, [1.0] * 5)]
    v = spark.createDataFrame([(*r, 1) for r in rows], "id string, v array<double>, part int")
    asked = v.filter("id like 'c%1' or id in ('d3', 'zero', 'short', 'nan')")
    got = {}
    for r in retrieval.nearest(v, asked, 4).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.id
    good = {i: np.array(x) for i, x in rows if i and x and all(c is not None and math.isfinite(c) for c in x) and any(x)}
    for q in [r.id for r in asked.collect()]:
        if q not in good:
            assert q not in got
            continue
        order = sorted((-round(float(x @ good[q] / np.linalg.norm(x) / np.linalg.norm(good[q])), 12), i) for i, x in good.items() if len(x) == len(good[q]))[:4]
        assert [got[q][n + 1] for n in range(len(order))] == [i for _, i in order]
    assert retrieval.nearest(v.filter("id = 'x'"), asked).count() == 0
    assert retrieval.nearest(v, asked.filter("id = 'x'")).count() == 0


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(8)
    values = [rng.uniform(-1000, 1000) for _ in range(4000)] + [n / 1000 for n in range(-3000, 3000, 5)] + [n / 8 for n in range(-200, 200)] + [rng.random() * 10 ** rng.randint(-8, 18) for _ in range(2000)]
    values += [2.675, 1.005, 0.125, 0.375, 1e300, 4503599627370497.5, 9007199254740993.0, 70368744177664.015, 0.0, -0.0, math.inf, -math.inf, math.nan]
    for digits in (0, 2, 3):
        got = spark.createDataFrame([(x,) for x in [*values, None]], "x double").select("x", tx.round_half_even(F.col("x"), digits).alias("r")).collect()
        for r in got:
            if r.x is None or not math.isfinite(r.x):
                assert str(r.r) == str(r.x)
            else:
                assert r.r == round(r.x, digits), (r.x, digits)


def test_the_gate_splits_a_text_once(spark):
    docs = spark.createDataFrame([("a", "u", "t", "w " * 40, [])], "video_id string, url string, title string, full_text string, segments array<struct<start:double,end:double,text:string>>")
    plan = export.training_records(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
