"""Search, scans, sanitising, decontamination against brute force and hostile rows."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import decontaminate, license_scan, pii, queries, tiles, topk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, did int, th string")


# --------------------------------------------------------------------------- op2


def test_topk(spark, monkeypatch):
    for where, name, value in ((topk, "SHARD_ROWS", 7), (topk, "BLOCK_ROWS", 3), (tiles, "FAN_IN", 2), (tiles, "PART_SHARDS", 2)):
        monkeypatch.setattr(where, name, value)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.51]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(120, 160)]  # a common vector: ties
    rows += [(200, None), (220, []), (240, [1.0, None, 0.0, 0.0]), (260, [float("nan")] * 4), (280, [float("inf")] * 4), (300, [1.0] * 3), (None, [1.0] * 4)]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", 64)
    got = {}
    for r in topk.top_k(v, v.filter("id % 20 = 0"), 5).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    good = {i: [int(np.floor(64 * float(np.float32(x)))) for x in e] for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    for q in [i for i in good if i % 20 == 0]:
        best = sorted(((-sum(a * b for a, b in zip(good[q], e, strict=True)), i) for i, e in good.items() if i != q and len(e) == len(good[q])))[:5]
        assert [got.get(q, {}).get(n + 1) for n in range(len(best))] == [(i, -s) for s, i in best]
        assert len(got.get(q, {})) == len(best)
    assert topk.top_k(v.filter("id < 0"), v, 5).count() == 0
    assert topk.top_k(v, v.filter("id < 0"), 5).count() == 0


def test_topk_ignores_columns_of_clashing_names(spark):
    rows = [(i, [float(i), 1.0], 5, 6, [7]) for i in range(1, 9)]
    v = spark.createDataFrame(rows + [rows[7]], "vec_id long, embedding array<float>, id int, part int, cells array<int>")
    plain = topk.quantised(v, "vec_id", "embedding", 1)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(plain, plain.filter("id < 3"), 2).collect()}
    assert got == {(1, 1): (8, 9), (1, 2): (8, 9), (2, 1): (8, 17), (2, 2): (8, 17)}  # the repeated row counts twice


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-2, 2), min_size=9, max_size=9), min_size=1, max_size=4), st.integers(1, 10))
def test_selection_of_whole_tiles(scores, k):
    ids = np.array([2, 3, 3, 5, 8, 9, 11, 12, 20])
    m = np.array(scores, np.int64)
    found = topk.select(ids, m, k)
    nothing = found[0][:, :0], found[1][:, :0]
    got = topk.join_lists(found, nothing, k)
    half = topk.join_lists(topk.select(ids[:4], m[:, :4], k), topk.select(ids[4:], m[:, 4:], k), k)
    for j, row in enumerate(scores):
        want = sorted(zip([-s for s in row], ids.tolist(), strict=True))[:k]
        for x in (got, half):
            assert [(-int(s), int(i)) for i, s in zip(x[0][j], x[1][j], strict=True)] == want


def test_products_stay_exact():
    q = np.array([[2**40, 3]])
    assert topk.products(q, np.array([[2**20, 1]]))[0, 0] == 2**60 + 3
    for top in (1, 100, 2**20, 2**28):
        a, b = (np.random.default_rng(top).integers(-top, top + 1, (5, 33)) for _ in range(2))
        assert (topk.products(topk.narrow(a), topk.narrow(b)) == a.astype(object) @ b.astype(object).T).all()


# --------------------------------------------------------------------------- op7


def test_license_scan(spark):
    rows = [
        (1, "CC BY cc-by Cc  by x"), (2, None), (3, ""), (4, "... !"), (5, "All rights reserved. General Public License all rights"), (None, "all RIGHTS\nreserved"),
        (7, "This is released under the mit license"), (8, "released under this mit license"), (9, "cc by " * 3000), (9, "cc by " * 3000), (10, "Kcc by"), (11, "éall rights reservedé all rights reserved"),
        (12, "licensed under the apache licence version 2 0"), (13, "cc"),
    ]
    got = license_scan.scan(docs(spark, rows)).collect()
    have = sorted([(r.did, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str)
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        at = [(k, label) for p, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want.append((-(2**63) if i is None else i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    assert have == sorted(want, key=str)
    labels = {r.did: r.labels for r in got}
    assert labels[7] == "mit"
    assert labels[12] == "apache-2.0"
    assert all(0 <= r.score <= 1 for r in got)
    assert license_scan.scan(docs(spark, [])).count() == 0


def brute_labels(text, slack=license_scan.SLACK, share=license_scan.SHARE):
    """Every template against every place of the text, run by run."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    labels, score = set(), 0.0
    for _, label, base, words, pairs, must, drift in license_scan.templates():
        hits = {}
        for p in range(len(w) - 1):
            for t, pair in pairs.items():
                if pair == f"{w[p]} {w[p + 1]}":
                    hits.setdefault(p - t, set()).add(t)
        groups, before = [], None
        for d in sorted(hits):
            if base or before is None or d - before > slack:
                groups.append([])
            groups[-1].append(d)
            before = d
        for g in groups:
            for k in {(d - g[0]) // (drift + 1) for d in g}:
                part = [d for d in g if (d - g[0]) // (drift + 1) == k]
                seen = set().union(*(hits[d] for d in part))
                length = max(d + max(hits[d]) for d in part) + 2 - min(d + min(hits[d]) for d in part)
                if set(must) <= seen and len(seen) >= share * len(pairs) and length <= len(words) + drift:
                    labels.add(label)
                    score = max(score, len(seen) / len(pairs))
    return ",".join(sorted(labels)), score


def test_license_labels_tell_relatives_apart(spark):
    rng = random.Random(5)
    notices = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc", "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa",
        "Licensed under CC BY-NC-SA 3.0.": "cc-by,cc-by-nc-sa", "Mozilla Public License, Version 2.0": "mpl-2.0", "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0", "under the GNU Lesser General Public License": "gpl,lgpl", "the GNU Affero General Public License": "agpl,gpl", "Released under the MIT License.": "mit", "version 2 0 of the license": "",
    }
    texts = list(notices)
    for _, text, _ in license_scan.TEMPLATES:  # whole notices, and with words lost, added and changed
        w = text.split()
        texts += [text, " ".join(x for x in w if rng.random() > 0.1), " ".join(y for x in w for y in ([x, "zzz"] if rng.random() < 0.1 else [x])), " ".join(w) + " " + " ".join(w[: len(w) // 2])]
    pool = sorted({x for _, text, _ in license_scan.TEMPLATES for x in text.split()})
    texts += [" ".join(rng.choice(pool) for _ in range(400)) for _ in range(30)] + ["mit license " * 500, "word " * 30000 + "mozilla public license version 2 0"]
    got = {r.did: (r.labels, r.score) for r in license_scan.scan(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = brute_labels(t)
        assert got[i][0] == want[0], t
        assert abs(got[i][1] - want[1]) < 1e-12
        assert t not in notices or want[0] == notices[t], t


def test_license_scan_has_no_python(spark):
    plan = license_scan.scan(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --------------------------------------------------------------------------- op5

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_pii(t):
    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, t) if ok(k, m[0])]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a.@-+ 0125é()", max_size=60))
def test_base_patterns(text):
    assert pii.base_spans(text) == brute_pii(text)


def test_base_patterns_on_cards_and_long_runs():
    for t in ("4845168114407329", "4845-1681 1440-7329x", "9807915762804490 " * 2, "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.1.1.1", "a@b.c@d.e", "1" * 3000 + "." + "2" * 3000, "a" * 20000 + "@"):
        assert pii.base_spans(t) == brute_pii(t) if len(t) < 10000 else pii.base_spans(t) == []


def test_disclosing_terms(spark):
    rng = random.Random(1)
    noise = [f"n{k}" for k in range(300)]
    rows = []
    for i in range(200):
        w = [rng.choice(noise) for _ in range(300)]
        if i % 2:
            w[30:30] = ["Contact", f"é{i}@mail.com", "Dr."]
        rows.append((i, " ".join(w)))
    rows += [(None, None), (500, ""), (3, rows[3][1]), (501, "Contact nobody"), (502, "rare a@mail.com word")]
    df = docs(spark, rows)
    found = pii.find(df)
    got = [(r.doc.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in found.collect()]
    texts = dict(rows)
    assert len(got) == len(rows)
    for i, spans in got:
        t = texts.get(i) or ""
        assert [s for s in spans if s[0] in pii.KINDS] == brute_pii(t)
        extra = {t[a:z] for k, a, z in spans if k not in pii.KINDS}
        assert extra == ({"Contact", "Dr."} if i is not None and i < 200 and i % 2 else {"Contact"} if i == 501 else set())
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "mail.com" not in clean[1]
    assert "Contact" not in clean[1]
    assert clean[501] == " nobody"  # a revealing term goes wherever it stands
    assert clean[502] == "rare [email] word"  # one sighting beside an entity is no evidence
    assert pii.sanitise(df).columns == df.columns
    assert pii.find(docs(spark, [])).count() == 0


def test_terms_beyond_the_bound_of_a_task(spark):
    rng = random.Random(2)
    noise = [f"n{k}" for k in range(300)]
    rows = []
    for i in range(200):
        w = [rng.choice(noise) for _ in range(300)]
        if i % 2:
            w[30:30] = [f"Label{i % 4}", f"é{i}@mail.com", "Dr."]
        rows.append((i, " ".join(w)))
    rows += [(None, None), (None, None), (500, ""), (3, rows[3][1]), (3, rows[3][1]), (501, "Label1 nobody"), (502, "é x@mail.com\tLABEL3")]
    df = docs(spark, rows)
    have = lambda **p: sorted([(r.doc, [tuple(s) for s in r.spans]) for r in pii.find(df, **p).collect()], key=str)
    want = have()
    terms = {t[a:z] for d, spans in want for k, a, z in spans if k not in pii.KINDS for t in [d.text]}
    assert terms == {"Label1", "Label3", "LABEL3", "Dr."}
    for most in (0, 1, 2):
        assert have(max_terms=most) == want
    bars = {"generalise": 0.5, "remove": 0.9}
    assert have(max_terms=1, **bars) == have(**bars)


def test_counts_disclosures_and_spans_by_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for i in range(300):
        w = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(60))]
        if i % 5 == 0:
            w[7:7] = [rng.choice(["Mr.", "Mme"]), f"p{i % 15}@x.org"]
        if i % 7 == 0:
            w += ["Host", f"10.0.0.{i % 9}", rng.choice(["up", "Mme"])]
        texts.append(" ".join(w))
    texts += ["Mme and Mr. and host alone", "p@q.rs", "", "a\xa0b 1.2.3.4\thost"]
    words = [[(m.start(), m.end(), m[0].translate(LOWER)) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    uses, near = {}, {}
    for t, ws in zip(texts, words, strict=True):
        spans = brute_pii(t)
        own = {j for j, (a, z, _) in enumerate(ws) for _, lo, hi in spans if a < hi and z > lo}
        for j, (_, _, w) in enumerate(ws):
            uses[w] = uses.get(w, 0) + 1
        for kind in pii.KINDS:
            close = set()
            for k, lo, hi in spans:
                inside = [j for j, (a, z, _) in enumerate(ws) if a < hi and z > lo]
                if k == kind:
                    close |= set(range(max(0, min(inside) - pii.REACH), min(len(ws), max(inside) + 1 + pii.REACH)))
            for j in close - own:
                near[kind, ws[j][2]] = near.get((kind, ws[j][2]), 0) + 1
    counts = {r.term: r for r in pii.term_counts(docs(spark, list(enumerate(texts)))).collect()}
    assert sorted((r.uses, *(r[k] for k in pii.KINDS)) for r in counts.values()) == sorted((n, *(near.get((k, w), 0) for k in pii.KINDS)) for w, n in uses.items())
    all_uses, want = sum(uses.values()), {}
    for w, n in uses.items():
        for kind in pii.KINDS:
            base = sum(v for (k, _), v in near.items() if k == kind) / all_uses
            x = near.get((kind, w), 0)
            if x and x / n > base:
                rate = x / n
                bits = x * math.log2(rate / base) + ((n - x) * math.log2((1 - rate) / (1 - base)) if x < n else 0)
                low = (rate + 2 / n - 2 * math.sqrt(rate * (1 - rate) / n + 1 / n**2)) / (1 + 4 / n)
                if bits - math.log2(len(uses) * 4) >= pii.SURE:
                    want[w] = max(want.get(w, -9), math.log2(low / base) / -math.log2(base))
    assert {"host", "mr.", "mme"} <= set(want)
    got = sorted(r.disclosure for r in pii.disclosures(pii.term_counts(docs(spark, list(enumerate(texts))))).collect())
    assert np.allclose(got, sorted(want.values()))
    for bars in ((0.7, 0.85), (0.1, 0.5)):
        for r in pii.find(docs(spark, list(enumerate(texts))), generalise=bars[0], remove=bars[1]).collect():
            t, ws = r.doc.text, words[r.doc.doc_id]
            spans = brute_pii(t)
            extra = [("reveal" if want[w] >= bars[1] else "quasi", a, z) for a, z, w in ws if want.get(w, -9) >= bars[0] and not any(a < hi and z > lo for _, lo, hi in spans)]
            assert [tuple(x) for x in r.spans] == spans + sorted(extra)


# --------------------------------------------------------------------------- op1


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20))
def test_common_subsequence(a, b):
    assert decontaminate.common_subsequence(np.array(a, int), np.array(b, int)) == lcs(a, b)


def test_leaks(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [[word() for _ in range(rng.randrange(12, 50))] for _ in range(30)]
    long = [word() for _ in range(150)]
    filler = [word() for _ in range(3000)]
    some = lambda n: [rng.choice(filler) for _ in range(n)]
    rows, want = [], set()
    for i in range(60):
        w = some(rng.randrange(0, 120))
        if i % 3 == 0:
            item = list(items[i // 3])
            for _ in range(len(item) // 8):  # a paraphrase: words lost, words put in
                item[rng.randrange(len(item))] = rng.choice(filler)
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
            want.add((i, i // 3))
        rows.append((i, " ".join(w)))
    rows += [(100, " ".join(some(50) + long[40:100] + some(30))), (101, None), (102, ""), (None, " ".join(items[29])), (None, " ".join(items[29])), (103, " ".join(items[28]).upper() + "!")]
    want |= {(100, 50), (-(2**63), 29), (103, 28)}
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in enumerate(items)] + [(50, " ".join(long)), (51, None), (52, ""), (None, None)], "item_id long, text string")
    for block in (2048, 8):
        got = decontaminate.leaks(docs(spark, rows), bench, block=block)
        assert {(r.did, r["item"]) for r in got.collect()} == want
    clean = decontaminate.decontaminate(docs(spark, rows), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want if i > 0} - {0, None}
    assert decontaminate.leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.leaks(docs(spark, rows), bench.limit(0)).count() == 0


def test_no_leak_is_missed_on_the_small_tables(spark):
    """Every window of every document against every passage, without the candidate search."""
    d = "/root/testdata/sf0.001"
    docs_, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    split = lambda t: [w.translate(LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    items = [(r.item_id, split(r.text)) for r in bench.collect()]
    texts = [(r.doc_id, split(r.text)) for r in docs_.collect()]
    got = {(r.did, r["item"]): r.common for r in decontaminate.leaks(docs_, bench).collect()}
    span, step = decontaminate.SPAN, decontaminate.STEP
    exact, seen = set(), set()
    for item, words in items:
        for part in np.array_split(np.array(words, object), max(1, -(-len(words) // span))):
            part = part.tolist()
            for i, text in texts:
                if len(set(part) & set(text)) < decontaminate.LOOSE * len(set(part)):
                    continue
                for at in range(0, len(text), step):
                    window = text[max(0, at - step) : at + span + step]
                    share = lcs(part, window) / len(part)
                    if share >= decontaminate.EXACT:
                        exact.add((i, item))
                    if share >= decontaminate.LOOSE:
                        seen.add((i, item))
    assert exact <= set(got) <= seen
    assert exact


def test_a_full_block_of_passages_is_bounded(spark):
    """What the tasks get of a block of passages that share no word stays within tens of megabytes."""
    rng = np.random.default_rng(3)
    n = decontaminate.BLOCK
    refs = [rng.integers(0, 2**63, decontaminate.SPAN).astype(np.uint64) for _ in range(n)]
    vocab = np.unique(np.concatenate(refs))
    rank = decontaminate.RANK
    search = decontaminate._search(vocab, np.ones(len(vocab)), rng.normal(size=(len(vocab), rank)), refs, list(range(n)), refs, decontaminate.SPAN, decontaminate.STEP, *(0.5,) * 5)
    arrays = [c.cell_contents for c in search.__closure__ if isinstance(c.cell_contents, np.ndarray)]
    assert sum(a.nbytes for a in arrays) <= n * decontaminate.SPAN * (4 * rank + 16) + 4 * n * (rank + 2)
    assert sum(a.nbytes for a in arrays) < 32 << 20


@pytest.mark.parametrize("name", ["op5_pii", "op7_license_scan"])
def test_queries_on_the_small_tables(spark, name):
    d = "/root/testdata/sf0.001"
    out = queries.QUERIES[name](spark, d)
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    assert out.count() == n
    if name == "op5_pii":
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
        for r in out.collect():
            s = ",".join(f"{k}:{a}:{z}" for k, a, z in brute_pii(texts[r.doc_id]))
            assert r.base_sha256 == hashlib.sha256(s.encode()).hexdigest()
    assert out.filter(F.col("doc_id").isNull()).count() == 0
