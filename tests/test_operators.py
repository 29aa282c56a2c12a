"""Operators against brute-force models and edge rows."""

from __future__ import annotations

import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.functions.text import EDGES
from tessella.operators import glossary, lifecycle, repetition, retrieval, speech

WORDS = st.lists(st.sampled_from(["a", "b", "c", "d,", "...", "e"]), max_size=40)


def ratio(words):
    w = [x.strip(EDGES) for x in words if x.strip(EDGES)]
    return len(set(w)) / len(w) if w else 0.0


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(2, 12))
def test_min_ratio(words, width):
    want = ratio(words) if len(words) < width else min(1.0, *(ratio(words[i : i + width]) for i in range(len(words) - width + 1)))
    assert repetition.min_ratio(words, width) == want


def test_a_first_window_of_punctuation_counts_zero():
    assert repetition.min_ratio(["..."] * 100 + ["a", "b"], 100) == 0.0


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS, st.integers(3, 8))
def test_title_match(words, title, width):
    t = {x.strip(EDGES) for x in title} - {""}
    want = False
    if t and len(words) >= width:
        for i in range(len(words) - width + 1):
            w = {x.strip(EDGES) for x in words[i : i + width]} - {""}
            want |= bool(w) and len(w & t) / len(w | t) > 0.8
    assert repetition.title_match(words, " ".join(title), width) == want


def greedy(words):
    for n in range(8, 2, -1):
        if len(words) < 2 * n:
            continue
        out, i = [], 0
        while i < len(words):
            out_n = words[i : i + n]
            if len(out_n) == n and words[i + n : i + 2 * n] == out_n:
                out += out_n
                i += n
                while words[i : i + n] == out_n:
                    i += n
            else:
                out.append(words[i])
                i += 1
        words = out
    return words


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_collapse(words):
    assert repetition.collapse(words) == (greedy(words) if len(words) >= 6 else words)


def _peak_mb(call):
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_large_batch_is_measured_in_bounded_parts():
    rng = random.Random(5)
    rows = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (120, 0, 3, 260_000)] * 2 + [["a", "b"] * 60_000] * 15
    tokens = pa.array([*rows, None], pa.list_(pa.string()))
    got, mb = _peak_mb(lambda: repetition.min_sliding_ratio.func(tokens).to_pylist())
    assert mb < 120
    assert got == [repetition.min_ratio(r) for r in [*rows, []]]
    titles = [" ".join(f"w{i}" for i in range(300)), None] * 12
    got, mb = _peak_mb(lambda: repetition.title_contamination.func(tokens, pa.array(titles)).to_pylist())
    assert mb < 120
    assert got == [repetition.title_match(r, t) for r, t in zip([*rows, []], titles, strict=True)]


def test_all_titles_words_are_looked_up_at_once(monkeypatch):
    calls, real = [], repetition.pc.index_in
    monkeypatch.setattr(repetition.pc, "index_in", lambda *a, **b: calls.append(1) or real(*a, **b))
    tokens = pa.array([[f"w{i}" for i in range(50)]] * 40)
    got = repetition.title_matches(tokens, [" ".join(f"w{i}" for i in range(n)) for n in range(12, 52)])
    assert len(calls) == 1
    assert got.tolist() == [n / 50 > 0.8 for n in range(12, 51)] + [50 / 51 > 0.8]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab\n😀", min_size=1, max_size=21), st.integers(1, 5)), max_size=6), max_size=4))
def test_deglued_equals_the_expression(rows):
    texts = ["".join(x * n for x, n in row) for row in rows]
    assert repetition.deglued(texts) == [re.sub(r"(.{2,20}?)\1{2,}", r"\1", t) for t in texts]


def test_denoise_has_no_expression_over_whole_texts_but_for_blank_ones(spark):
    big = ["".join(random.Random(i).choice("abcdefghij ") for _ in range(200_000)) for i in range(4)] * 8
    want = [" ".join(t.split()) for t in repetition.deglued(big[:4])]
    got, mb = _peak_mb(lambda: repetition.collapse_phrases.func(pa.array([*big, None, ""])).to_pylist())
    assert mb < 250
    assert [" ".join(x) for x in got[:4]] == want
    assert got[-2:] == [[], []]


def test_denoise(spark):
    d = spark.createDataFrame([("one two three one two three one two three end end end",), ("",), (None,)], "t string")
    assert [r.denoised for r in repetition.denoise(d, "t").collect()] == ["one two three end", "", None]


def brute_denoise(text):
    """The four stages, one after another, token by token."""
    if not text:
        return text
    text = re.sub(r"(.{2,20}?)\1{2,}", r"\1", text)
    words = text.split()
    if not words:
        return text
    if len(words) >= 6:
        words = greedy(words)
    bare = [w.strip(tx.EDGES) for w in words]
    words = [w for i, w in enumerate(words) if not (i >= 2 and bare[i] == bare[i - 1] == bare[i - 2])]

    def form(w):
        w = w.strip(tx.EDGES)
        return next((w[: len(w) - len(old)] + new for old, new in tx.SUFFIXES if w.endswith(old)), w)

    return " ".join(w for i, w in enumerate(words) if i == 0 or form(w) != form(words[i - 1]) or form(w) == "")


def test_denoise_equals_the_brute_force_model(spark):
    rng = random.Random(3)
    parts = ["a", "b", "a.", ",b", "...", "abab", "நிநி", *(f"x{s}" for pair in tx.SUFFIXES for s in pair)]
    texts = [rng.choice(["", " "]).join("".join(rng.choice("ab \n") for _ in range(rng.randrange(3))) + rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(400)] + [None, "", " ", "\n"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in repetition.denoise(d, "t").collect():
        assert r.denoised == brute_denoise(texts[r.i]), texts[r.i]


def test_retry_results(spark):
    seg = lambda *t: [(float(i), x) for i, x in enumerate(t)]
    rows = [(1, "v", None, "end end end", seg("no no no no", None, "x")), (2, None, None, "t", seg("y")), (3, "v", "HTTP_429", "t", []), (4, "v", None, None, [])]
    d = spark.createDataFrame(rows, "doc int, video_id string, problem string, text string, segments array<struct<start: double, text: string>>")
    got = {r.doc: (r.full_text, r.segments and [s.text for s in r.segments]) for r in lifecycle.retry_results(d).collect()}
    assert got == {1: ("end", ["no", "", "x"]), 2: (None, None), 3: (None, None), 4: ("", [])}


def test_classifier_edges(spark):
    nan = float("nan")
    many = " ".join(f"w{i}" for i in range(60))
    rows = [
        ("nan", many, [(0, 0.0, 100.0, "", nan)], "", "GHOST"),
        ("nine", "123456789", [], "", "GHOST"),
        ("ten", "1234567890", [], "", "SUCCESS"),
        ("glued", "aaaaa bbbbb ccccc", [], "", "SYLLABLE_TRAP"),
        ("two", "aaaaa bbbbb dd", [], "", "SUCCESS"),
        ("title", many, [(0, 0.0, 100.0, "", 0.0)], " ".join(f"w{i}" for i in range(50)), "PROMPT_CONTAMINATED"),
        ("sandwich", " ".join([f"x{i}" for i in range(100)] + ["y"] * 100 + [f"z{i}" for i in range(200)]), [], "", "SANDWICH_LOOP"),
        ("tail", " ".join([f"x{i}" for i in range(45)] + ["y"] * 50), [], "", "TERMINAL_LOOP"),
        ("fast", many, [(0, 0.0, 1.0, "", 0.0)], "", "TERMINAL_LOOP"),
        ("at040", "a b a a a", [], "", "GHOST"),
        ("edge", "aaa bbb aaa aaa aaa", [], "", "SUCCESS"),
        ("cps12", "x" * 3 + " yyyyyyyy", [(0, 0.0, 1.0, "", 0.0)], "", "SUCCESS"),
    ]
    schema = "id string, full_text string, segments array<struct<id:int,start:double,end:double,text:string,avg_logprob:double>>, title string, want string"
    got = repetition.measure(spark.createDataFrame(rows, schema)).select("id", "category", "want").collect()
    assert {r.id: r.category for r in got} == {r.id: r.want for r in got}


def vad(flags):
    """Straight hysteresis: a chunk closes after 16 silent frames."""
    out, start, silent = [], None, 0
    for i, s in enumerate(flags):
        if s:
            if start is None:
                start = i
            last, silent = i, 0
        elif start is not None:
            silent += 1
            if silent >= 16:
                out.append((start * 480, (last + 1) * 480))
                start = None
    if start is not None:
        out.append((start * 480, len(flags) * 480))
    return out


def test_speech_chunks(spark):
    rng = random.Random(1)
    docs = {n: [rng.random() < p for _ in range(120)] for n, p in enumerate((0.02, 0.05, 0.1, 0.5, 0.0))}
    for n, gap in enumerate((15, 16, 17), 10):
        docs[n] = [True] + [False] * gap + [True] + [False] * gap
    rows = [(d, i, s, len(f)) for d, f in docs.items() for i, s in enumerate(f)]
    got = speech.speech_chunks(spark.createDataFrame(rows, "doc long, idx long, speech boolean, n_frames long")).orderBy("doc", "chunk").collect()
    by = {}
    for r in got:
        by.setdefault(r.doc, []).append((r.start_s, r.end_s))
    # a chunk whose 16 silent frames end the audio is closed; the model agrees on both sides of the edge
    assert {d: v for d, f in docs.items() if (v := vad(f))} == by


def test_remap_clamps_to_the_last_chunk(spark):
    off = spark.createDataFrame([(1, 0, 100, 200, 100, 0), (1, 1, 500, 600, 100, 100)], "doc long, chunk long, lo long, hi long, length long, merged_start long")
    seg = spark.createDataFrame([(1, 0, 0, 50), (1, 1, 100, 120), (1, 2, 99, 101), (1, 3, 900, 950)], "doc long, seg long, at long, until long")
    got = {r.seg: (r.chunk, r.start_s, r.end_s) for r in speech.remap(seg, off).collect()}
    assert got == {0: (0, 100, 150), 1: (1, 500, 520), 2: (0, 199, 201), 3: (1, 1300, 1350)}


def test_routes(spark):
    rows = [(0.85, "CERTIFIED", None), (0.9, "FLAGGED", "NONE"), (0.84, "CERTIFIED", "NONE"), (0.9, "CERTIFIED", "API_ERROR")]
    d = spark.createDataFrame(rows, "s double, v string, r string")
    got = [r.x for r in d.select(lifecycle.certify(F.col("s"), F.col("v"), F.coalesce("r", F.lit(""))).alias("x")).collect()]
    assert got == ["CERTIFIED", "REPAIR", "REPAIR", "SKIPPED"]
    d = spark.createDataFrame([(None,), (0.0,), (89.0,), (90.0,)], "s double")
    assert [r.s for r in d.filter(lifecycle.long_enough(F.col("s"))).collect()] == [None, 0.0, 90.0]
    d = spark.createDataFrame([("x", "g" * 50), ("x", "g" * 51), ("STABLE", "g" * 60)], "v string, g string")
    assert [r.r.route for r in d.select(lifecycle.judge_route(F.col("v"), F.col("g"), F.lit("o")).alias("r")).collect()] == ["KEPT", "REPLACED", "CERTIFIED"]


def test_five_failures_stop_a_scan(spark):
    rows = [(1, i, i not in (2,)) for i in range(12)] + [(2, i, i % 5 != 4) for i in range(12)]
    d = spark.createDataFrame(rows, "s int, i int, f boolean")
    got = lifecycle.stop_after_failures(d, "s", "i", "f")
    assert {r.s: r.n for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()} == {1: 8, 2: 12}


def test_upsert_and_corrections(spark):
    cur = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, ts int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, ts int")
    assert {r.k: r.v for r in lifecycle.upsert(cur, new, "k", "ts").collect()} == {"a": 1, "b": 4, "c": 5}
    seg = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "doc int, id int, text string")
    fix = spark.createDataFrame([(1, 1, 0, "p"), (1, 1, 1, "q"), (1, 9, 0, "r")], "doc int, id int, ord int, corrected string")
    assert {r.id: r.text for r in lifecycle.apply_corrections(seg, fix).collect()} == {1: "q", 2: "y"}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=4000))
def test_chunks_are_bounded_and_keep_the_text(text):
    chunks = retrieval.split_text(text, 100, 20)
    assert all(0 < len(c) <= 100 for c in chunks)
    assert set("".join(chunks).replace(" ", "").replace("\n", "")) == set(text.replace(" ", "").replace("\n", ""))


def test_glossary_prompt(spark):
    t = spark.createDataFrame([(1, "about yogas"), (2, "zzz"), (3, "லக்னம் x")], "id int, title string")
    got = {r.id: (r.n_terms, r.prompt) for r in glossary.prompts(t, glossary.glossary_table(spark)).collect()}
    assert got[1][0] >= 16
    assert got[2][0] == 0
    assert "லக்னம் (Lagnam)" in got[3][1]


def test_glossary_lowers_a_title_once_and_equals_brute_force(spark):
    rng = random.Random(4)
    table = {"core_time": ["Karma (x)", "abc", "(only)"], "b_and": ["K-ā", "லக்னம் (Lagnam)", "சனி"], "z": ["a", "Karma (x)"]}
    parts = ["KARMA", "Karma", "karma", "abc", "ABC", "Time", "and", "லக்னம்", "சனி", "k-Ā", "K-ā", "q", " ", "b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(4))) for _ in range(200)] + [None, ""]
    want, cleans = {}, [(c, t, re.sub(r"\(.*?\)", "", t).strip(" ")) for c, ts in table.items() for t in ts]
    for i, t in enumerate(texts):
        hit = [] if t is None else [term for c, term, clean in cleans if any(k in t.lower() for k in c.split("_")) or clean in t or len(clean) > 3 and clean in t.lower()]
        want[i] = list(dict.fromkeys(hit))[:3]
    out = glossary.prompts(spark.createDataFrame(list(enumerate(texts)), "id int, title string"), glossary.glossary_table(spark, table), 3)
    assert {r.id: (r.n_terms, r.prompt) for r in out.collect()} == {i: (len(w), ", ".join(w) or glossary.CORE_TERMS) for i, w in want.items()}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("lower(title") == 1


def test_knn(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "id long, v array<double>")
    got = [(r.rank, r.id) for r in retrieval.nearest(v, v.filter("id = 0"), 2).orderBy("rank").collect()]
    assert got == [(1, 0), (2, 1)]


@pytest.mark.parametrize("n", [449, 450, 451])
def test_audit_sample(spark, n):
    text = " ".join(str(i) for i in range(n))
    d = spark.createDataFrame([(text, text.split())], "t string, w array<string>")
    got = d.select(lifecycle.audit_sample(F.col("w"), F.col("t")).alias("s")).first().s
    assert (got == text) == (n <= 450)
