"""Titles, names and as-of times against brute force."""

from __future__ import annotations

import random

import pytest

from tessella.operators import names, speech, titles


def brute_pairs(docs, items, width, share):
    out = {}
    for i, text in docs:
        ws = [w.strip(".,?!;:-") for w in (text or "").split()]
        for k, title in items:
            want = {w.strip(".,?!;:-") for w in (title or "").split()} - {""}
            best = max((len(want & w) / len(want | w) for p in range(len(ws) - width + 1) if (w := set(ws[p : p + width]) - {""}) and want), default=0)
            if best > share:
                out[i, k] = best
    return out


@pytest.mark.parametrize("share", [0.8, 0.5])
def test_title_pairs(spark, share):
    rng = random.Random(int(share * 10))
    word = lambda: rng.choice("abcdefghij") + rng.choice(["", "x", "y", ","])
    items = [(k, " ".join(word() for _ in range(rng.randint(1, 14)))) for k in range(30)] + [(90, None), (91, " . "), (92, " ".join(f"w{i}" for i in range(40))), (93, items_text := "a b, c"), (94, items_text)]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(60)]
    docs += [(100 + k, "q r s " + t + " u v") for k, t in items if t] + [(200, None), (201, ""), (202, "a " * 30), (203, "a b c d e f g h i j")]
    d = spark.createDataFrame([(*r, 1, "t") for r in docs], "id long, full_text string, title_id int, title string")
    t = spark.createDataFrame([(*r, "z") for r in items], "title_id long, title string, word string")
    got = titles.title_pairs(d, t, width=8, share=share)
    rows = got.collect()
    assert len({(r.id, r.title_id) for r in rows}) == len(rows)
    assert {(r.id, r.title_id): pytest.approx(r.similarity) for r in rows} == brute_pairs(docs, items, 8, share)
    assert titles.title_pairs(d.filter("id < 0"), t).count() == 0
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().optimizedPlan().toString())
    assert "Cross" not in plan


def test_names_with_ids(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK", 5)
    rng = random.Random(2)
    ids = ["".join(rng.choice("ab_") for _ in range(rng.randint(1, 9))) for _ in range(80)] + ["", None, "aaaa", "aaaa", "long" * 10]
    rows = [(n, "".join(rng.choice("ab_x") for _ in range(rng.randint(0, 30)))) for n in range(120)] + [(500, None), (501, "z" + "long" * 10), (501, "aaaa"), (502, "aaaaaaaa")]
    n = spark.createDataFrame([(*r, "id") for r in rows], "key long, name string, id string")
    got = [tuple(r) for r in names.names_with_ids(n, spark.createDataFrame([(i,) for i in ids], "id string")).collect()]
    want = {(k, i) for k, name in rows if name is not None for i in ids if i and i in name}
    assert len(got) == len(set(got))
    assert set(got) == want
    assert names.names_with_ids(n, spark.createDataFrame([(None,)], "id string")).count() == 0
    assert names.names_with_ids(n.filter("key < 0"), spark.createDataFrame([("a",)], "id string")).count() == 0


def test_as_of_times(spark):
    rng = random.Random(3)
    chunks, segs, want = [], [], set()
    for doc in range(12):
        at = 0
        spans = []
        for c in range(rng.randint(0, 6)):
            length = rng.choice([0, 5, 9])
            lo = at + rng.randint(0, 50)
            spans.append((c, lo, at, length))
            at += length
        chunks += [(doc, *s) for s in spans]
        for s in range(15):
            t = rng.randint(-2, 45)
            segs.append((doc, s, t, t + 3))
            hit = next((x for x in spans if t < x[2] + x[3]), spans[-1] if spans else None)
            if hit and not (t >= 0 and hit[3] == 0 and t >= hit[2] + hit[3] and hit is not spans[-1]):
                want.add((doc, s, hit[0], t + hit[1] - hit[2], t + 3 + hit[1] - hit[2]))
    c = spark.createDataFrame(chunks, "doc long, chunk long, lo long, merged_start long, length long")
    out = speech.remap(spark.createDataFrame(segs, "doc long, seg long, at long, until long"), c)
    got = {tuple(r) for r in out.collect()}
    solid = {d for d in range(12) if all(x[4] for x in chunks if x[0] == d)}  # ties of empty chunks apart
    assert {r for r in got if r[0] in solid} == {r for r in want if r[0] in solid}
    assert {r[:2] for r in got} == {r[:2] for r in want}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
