"""Trained operators: held-out accuracy, exact marginals, hostile rows; segmentation against enumeration."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.llm import langid, pieces, queries, toxicity
from tessella.llm.common import mix

SMALL = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, spans string")


# -------------------------------------------------------------------------- op10


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    em, trans, start = rng.normal(size=(2, 5)), rng.normal(size=(2, 2)), rng.normal(size=2)
    on = np.ones((2, 5), bool)
    on[1, 3:] = False
    got, _, _ = toxicity.marginals(em, on, trans, start)
    for c, n in ((0, 5), (1, 3)):
        total, hit = 0.0, np.zeros(5)
        for y in itertools.product((0, 1), repeat=n):
            s = math.exp(start[y[0]] + sum(em[c, i] for i in range(n) if y[i]) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += s
            hit[:n] += s * np.array(y)
        assert np.allclose(got[c], hit / total)


def test_scores_and_spans_by_enumeration(spark):
    words = ["bad", "worse", "fine", "é"]
    h = toxicity.tokens(pa.array([" ".join(words)], pa.large_string()))[0]
    order = np.argsort(h[:2])
    model = toxicity.Model(h[:2][order], np.array([3.0, 0.4])[order], -2.5, np.array([[0.3, -1.0], [-0.5, 1.2]]), np.array([0.1, -0.2]), -1.5, 2.0)
    weight = {"bad": 3.0, "worse": 0.4}
    rng = random.Random(3)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))) for _ in range(40)] + [None, "", "BAD!Bad, fine"]
    for r in toxicity.score(docs(spark, list(enumerate(texts))), model).collect():
        t = r.doc.text or ""
        found = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[A-Za-zé]+", t)]
        hit, total = np.zeros(len(found)), 0.0
        for y in itertools.product((0, 1), repeat=len(found)):
            s = sum(weight.get(f[2], -2.5) for f, on in zip(found, y, strict=True) if on) + sum(model.trans[a, b] for a, b in zip(y, y[1:], strict=False)) + (model.start[y[0]] if y else 0)
            total += math.exp(s)
            hit += math.exp(s) * np.array(y)
        p = hit / total
        assert abs(r.score - 1 / (1 + math.exp(1.5 - 2.0 * math.log1p((p**2).sum())))) < 1e-9
        spans, before = [], -2
        for i in np.flatnonzero(p >= 0.5):
            if i == before + 1:
                spans[-1][1] = found[i][1]
            else:
                spans.append([found[i][0], found[i][1]])
            before = i
        assert [[s.start, s.end] for s in r.spans] == spans


def test_words_of_a_rare_kind_are_marked():
    """Toxic words of a few documents aren't held against the toxic documents of a common kind; chance is no mark."""
    rng = random.Random(4)
    docs_ = [{f"w{rng.randrange(3000)}" for _ in range(80)} for _ in range(700)]
    toxic = np.arange(700) < 200
    for i in range(170):
        docs_[i] |= {f"common{k}" for k in range(5) if rng.random() < 0.5}
    for i in range(170, 200):
        docs_[i] |= {f"rare{k}" for k in range(6) if rng.random() < 0.25}
    vocab = sorted(set().union(*docs_))
    number = {w: n for n, w in enumerate(vocab)}
    pairs = sorted({(number[w], i) for i, d in enumerate(docs_) for w in d})
    word, doc = map(np.array, zip(*pairs, strict=True))
    marked = {vocab[n] for n in np.flatnonzero(toxicity.toxic_words(word, doc, toxic.copy(), toxic, 500, len(vocab)))}
    assert {w for w in marked if w[0] == "w"} == set()
    assert {f"common{k}" for k in range(5)} <= marked
    assert sum(w.startswith("rare") for w in marked) >= 4
    assert not toxicity.toxic_words(word, doc, np.zeros(700, bool), toxic, 500, len(vocab)).any()
    assert not toxicity.toxic_words(word, doc, toxic.copy(), toxic, 0, len(vocab)).any()


def test_scores_follow_the_share_of_the_labels(spark):
    """Fewer clean rows in the sample than among the labels: the score's offset says so, the ranking stays."""
    rows, labels = toxic_rows()
    df, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, lab, max_clean=50)
    clean = sum(not y for i, y in labels if zlib.crc32(str(i).encode()) % 5)
    few = [r.doc_id for r in lab.filter("toxic = 0").filter(~toxicity.held_out()).orderBy(F.xxhash64(F.col("doc_id"))).limit(50).collect()]
    alone = toxicity.train(df, lab.filter((F.col("toxic") == 1) | F.col("doc_id").isin(few)), max_clean=50)
    assert abs(model.b - alone.b) < 1e-9
    assert abs(alone.a - model.a - math.log(clean / 50)) < 1e-9


def toxic_rows():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 300))]
        y = rng.random() < 0.3
        if y:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(["Idiot!", "scum,", "moron"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(y)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    odd = [(1000, None), (1001, ""), (1002, "..."), (None, "idiot"), (1003, "é scum"), (1003, "é scum"), (1004, "w1 " * 30000 + "moron")]
    df = docs(spark, rows + odd)
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (7, labels[7][1])], "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    out = toxicity.score(df, model).collect()
    got = {r.doc.doc_id: r for r in out}
    assert len(out) == len(rows) + len(odd)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    truth = dict(labels)
    assert np.mean([(got[i].score >= 0.5) == truth[i] for i in held]) >= 0.98
    assert [got[i].score >= 0.5 for i in (1000, 1001, 1002, None, 1003, 1004)] == [False, False, False, True, True, True]
    assert [(s.start, s.end) for s in got[1003].spans] == [(2, 6)]
    texts = dict(rows + odd)
    for i in held:
        assert all(texts[i][s.start : s.end].strip("!,").lower() in ("idiot", "scum", "moron") or " " in texts[i][s.start : s.end] for s in got[i].spans)
    none = toxicity.train(df, lab.limit(0))
    assert {r.score for r in toxicity.score(df, none).select("score").collect()} == {0.0} or none.b == 0.0
    assert toxicity.score(docs(spark, []), model).count() == 0


# --------------------------------------------------------------------------- op3


def test_langid(spark):
    rng = random.Random(6)
    kinds = {"aa": ["the", "and", "tion", "ing"], "bb": ["der", "und", "sch", "keit"], "cc": ["qué", "los", "ción", "ñar"]}
    rows = []
    for i in range(240):
        lang = rng.choice(list(kinds))
        rows.append((i, " ".join(rng.choice(kinds[lang]) + rng.choice(kinds[lang]) for _ in range(rng.randrange(5, 60))), lang))
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", "cc"), (903, "the and", None), (None, "der und der und", "bb"), (904, "und " * 40000, None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = langid.train(df, max_windows=300)
    out = {r.doc.doc_id: r for r in langid.label(df.drop("lang"), model).collect()}
    held = [(i, g) for i, _, g in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i].lang_pred == g for i, g in held]) >= 0.97
    assert [(out[i].lang_pred, out[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "bb"
    assert out[904].lang_pred == "bb"
    assert sum(out[904].positions) == 120000
    assert all(0 <= r.score <= 1 for r in out.values())
    nothing = langid.train(df.limit(0))
    assert nothing is None
    assert {r.lang_pred for r in langid.label(df.select("doc_id", "text"), None).collect()} == {"und"}


def test_gradients_of_the_network():
    """Backpropagation through time against differences of the loss, in double precision."""
    rng = np.random.default_rng(3)
    size, count = langid.HIDDEN, 3
    p = {"inputs": rng.normal(0, 0.4, (2, 256, 3 * size)), "hidden": rng.normal(0, 0.4, (2, size, 3 * size)), "out": rng.normal(0, 0.4, (2 * size, count)), "bias": rng.normal(size=count)}
    x = rng.integers(97, 103, (5, 12)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 1, 0]), (rng.random((12, 5)) < 0.8).astype(float)
    loss, g = langid.loss_and_gradients(p, x, y, weight)
    assert loss > 0
    for name, grad in g.items():
        places = np.argwhere(grad != 0)
        for at in map(tuple, places[rng.permutation(len(places))[:25]]):
            ends = []
            for e in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in p.items()}
                moved[name][at] += e
                ends.append(langid.loss_and_gradients(moved, x, y, weight)[0])
            assert abs((ends[0] - ends[1]) / 2e-5 - grad[at]) < 1e-7, (name, at)
    assert (g["inputs"][:, :97] == 0).all()  # bytes that don't occur


def test_a_short_fit_lowers_the_loss():
    """A short fit lowers the loss of a separable task: backpropagation points downhill."""
    x = np.array([[97, 98] * 32, [99, 100] * 32] * 40, np.uint8)
    m = langid.fit(x, np.ones(x.shape, bool), np.array([0, 1] * 40), ["a", "b"], epochs=4, batch=16)
    p = langid.position_probabilities(m, x[:2])
    assert p[:, 0, 0].mean() > 0.9
    assert p[:, 1, 1].mean() > 0.9


# --------------------------------------------------------------------------- op9

VOCAB = pieces.vocabulary(pieces.MODEL)


def test_new_words_take_bounded_memory_in_a_task():
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(3000)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(60)), "key": list(range(60)), "text": texts})
    pieces.powers(1)
    tracemalloc.start()
    rows = sum(b.num_rows for b in pieces._segment(pieces.MODEL, pieces.ALPHA, pieces.SAMPLES, True)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60
    assert peak < 240e6


def enumerate_all(text):
    sp = VOCAB.processor
    names = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}

    def ways(s):
        if not s:
            yield (), 0.0
            return
        for n in range(1, min(VOCAB.longest, len(s)) + 1):
            if s[:n] in names:
                i = names[s[:n]]
                for r, w in ways(s[n:]):
                    yield (i, *r), w - pieces.ALPHA * math.log(2 + max(0.0, -sp.get_score(i)))
        if s[0] not in names:
            b = s[0].encode()
            for r, w in ways(s[1:]):
                yield (*(int(VOCAB.bytes[x]) for x in b), *r), w - pieces.ALPHA * math.log(2 + len(VOCAB.rank)) * len(b)

    all_ = list(ways("▁" + text.replace(" ", "▁")))
    z = math.log(sum(math.exp(w) for _, w in all_))
    return {s: w - z for s, w in all_}


@pytest.mark.parametrize("text", ["hello wor", "a  b\nc é🙂", "the", "x"])
def test_samples_are_distinct_exact_and_fair(text):
    n, k = 3000, 3
    every = enumerate_all(text)
    lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
    lattice.read(pa.array([text] * n))
    samples, kappa = pieces.draw(lattice, mix(np.arange(n, dtype=np.uint64), 12), k)
    ids = [pieces.token_ids(lattice, VOCAB, s) for s in samples]
    first, second = {}, {}
    for r in range(n):
        got, keys = [], []
        for s, (x, off) in zip(samples, ids, strict=True):
            if r in s.rows:
                g = tuple(x[off[r] : off[r + 1]].tolist())
                assert abs(every[g] - s.logp[r]) < 1e-6
                got.append(g)
                keys.append(s.key[r])
        assert len(set(got)) == len(got) == min(k, len(every))
        assert keys == sorted(keys, reverse=True)
        assert kappa[r] <= keys[-1]
        first[got[0]] = first.get(got[0], 0) + 1
        if len(got) > 1:
            second[got[1]] = second.get(got[1], 0) + 1
    p = {g: math.exp(v) for g, v in every.items()}
    for g in sorted(p, key=p.get)[-3:]:
        assert abs(first.get(g, 0) / n - p[g]) < 0.04
        if len(p) > 1:
            want = sum(p[h] * p[g] / (1 - p[h]) for h in p if h != g and p[h] < 1 - 1e-9)
            if max(p.values()) < 0.99:
                assert abs(second.get(g, 0) / n - want) < 0.05


def test_units_end_where_no_piece_joins_the_characters():
    lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
    lattice.read(pa.array(["words, words. words!!", "(words)"]))
    assert len(lattice.unit) == 9
    assert len(lattice.begin) == len(set(lattice.unit.tolist())) == 7  # ▁words , . !! ▁( words )


def test_units_encode_as_whole_texts_do():
    rng = random.Random(4)
    parts = ["a", "the", "ing", ",", ".", "!!", "''", "(", "0", "42", "é", "ß", "ñ", "的", "是", "ا", "🙂", "e\u0301", "\u200d", "\t", "\n", "\n\n", "\r\n", " ", "  ", "    ", "▁", "</s>", "<0x41>", "http://", "=="]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(400)]
    lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
    lattice.read(pa.array(texts))
    ids, off = lattice.encoded()
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == VOCAB.processor.encode(t), t
    assert lattice.decoded().tolist() == [VOCAB.processor.decode(VOCAB.processor.encode(t)) == t for t in texts]


def test_likely_beginnings_suffice_for_the_best_branches(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "reading", "of", "segmentations", "in", "Wörter"]) for _ in range(n)) for n in (20_000, 1, 30, 3000)] + ["." * 500, "." * 5000 + " reading words", ""]
    lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
    lattice.read(pa.array(texts))
    key, seen, truncated = mix(np.arange(len(texts), dtype=np.uint64), 12), [], pieces._truncated
    monkeypatch.setattr(pieces, "_truncated", lambda phi, top, u: seen.append(len(phi)) or truncated(phi, top, u))
    some, kappa = pieces.draw(lattice, key, 3)
    looked = sum(seen)
    seen.clear()
    monkeypatch.setattr(pieces, "SPAN", 2.0**31)  # every place at once
    every, same = pieces.draw(lattice, key, 3)
    assert looked < sum(seen) / 20
    assert kappa.tolist() == same.tolist()
    for a, b in zip(some, every, strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("rows", "edges", "off", "logp", "key"))


@pytest.mark.parametrize("texts", [[""], ["", ""], [None], [None, ""], ["."], ["", ".", None]])
def test_slices_without_any_choice(texts):
    lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
    lattice.read(pa.array(texts, pa.string()))
    samples, _ = pieces.draw(lattice, mix(np.arange(len(texts), dtype=np.uint64), 12), 3)
    assert samples[0].rows.tolist() == list(range(len(texts)))
    batch = pa.RecordBatch.from_pydict({"doc": list(range(len(texts))), "key": [0] * len(texts), "text": pa.array(texts, pa.string())})
    for packed in (True, False):
        (out,) = pieces._segment(pieces.MODEL, pieces.ALPHA, pieces.SAMPLES, packed)(iter([batch]))
        for text, n, got in zip(texts, out.column("n_ids").to_pylist(), out.column("samples").to_pylist(), strict=True):
            if text is None:
                assert (n, got) == (0, [])
            elif not text:
                assert n == 0 and [(s["n_ids"], s["inclusion"]) for s in got] == [(0, 1.0)]


def test_text_without_spaces_takes_seconds():
    import time

    rng = np.random.default_rng(1)
    for text in ("".join(map(chr, rng.choice([*range(48, 58), *range(65, 91), *range(97, 123)], 1_000_000))), "".join(map(chr, rng.integers(0x4E00, 0x5600, 500_000)))):
        began = time.process_time()
        lattice = pieces.Lattice(VOCAB, pieces.ALPHA)
        lattice.read(pa.array([text]))
        samples, _ = pieces.draw(lattice, np.array([7], np.uint64), pieces.SAMPLES)
        assert time.process_time() - began < 40
        ids = [pieces.token_ids(lattice, VOCAB, s)[0].tolist() for s in samples if len(s.rows)]
        assert len(set(map(tuple, ids))) == len(ids) == (pieces.SAMPLES if text[0] < "z" else 1)  # no piece joins two of the others
        assert all(VOCAB.processor.decode(x) == text for x in ids)


def test_segment_round_trip_and_partitions(spark):
    rows = [(i, f"Line {i}  with\ttabs\nand é🙂 " + "x" * (i % 40)) for i in range(30)] + [(100, None), (101, ""), (102, " "), (103, "a▁b"), (None, "null id"), (3, "repeated"), (3, "repeated"), (104, "y" * 3000)]
    df = docs(spark, rows)
    one = sorted(map(str, pieces.segment(df.coalesce(1)).collect()))
    assert one == sorted(map(str, pieces.segment(df.repartition(7)).collect()))
    for r in pieces.segment(df).collect():
        t = r.doc.text
        if t is None:
            assert (r.n_ids, r.same, r.samples) == (0, None, [])
            continue
        assert r.same == ("▁" not in t)
        for s in r.samples:
            assert VOCAB.processor.decode(s.ids) == t.replace("▁", " ")
            assert 0 <= s.inclusion <= 1
        assert len({tuple(s.ids) for s in r.samples}) == len(r.samples) == (pieces.SAMPLES if t.strip() else len(r.samples))
    back = pieces.decode(pieces.segment(df).select("ids", "same", F.col("doc.text").alias("was"))).filter("same").collect()
    assert back and all(r.text == r.was for r in back)
    packed = pieces.decode(pieces.segment(df, packed=True).select("ids", "same", "samples", F.col("doc.text").alias("was")))
    assert sorted(str((r.was, r.text)) for r in packed.filter("same").collect()) == sorted(str((r.was, r.text)) for r in back)
    assert packed.filter("was is null and ids is null and size(samples) = 0").count() == 1
    assert pieces.segment(docs(spark, [])).count() == 0


def test_queries_on_the_small_tables(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op9_pieces", "op10_toxicity"):
        assert queries.QUERIES[name](spark, SMALL).count() == n


def test_queries_return_the_segmentations(spark):
    import sentencepiece

    import corpus_pipeline
    from tessella.llm.common import table

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    for out in (queries.QUERIES["op9_pieces"](spark, SMALL), corpus_pipeline.encode_pieces(spark, table(spark, SMALL, "documents"), SMALL)):
        rows = out.collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert np.frombuffer(r["ids"], "<u2").tolist() == sp.encode(texts[r.doc_id])
            assert [s["rank"] for s in r["samples"]] == list(range(1, len(r["samples"]) + 1))
            for s in [r, *r["samples"]]:
                ids = np.frombuffer(s["ids"], "<u2")
                assert len(ids) == s["n_ids"]
                assert hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest() == s["ids_sha256"]
                assert sp.decode(ids.tolist()) == sp.decode(np.frombuffer(r["ids"], "<u2").tolist())


def test_pieces_that_spell_a_text_are_not_decoded_for_it():
    vocab = pieces.vocabulary(pieces.MODEL)
    for text in ("\nplain words of a text", "\nzwölf Boxkämpfer", "\n\u0ba4\u0bae\u0bbf\u0bb4\u0bcd x", "\n  two  spaces", "\na \U00013000 rare", "\ntab\tinside \u00a0 and \ufb01"):
        ids = np.asarray(vocab.processor.encode(text), np.int64)[1:]
        chars = np.array([pieces.SPACE if c == " " else ord(c) for c in text])
        if vocab.spells(ids, chars):
            assert vocab.processor.decode(ids.tolist()) == text
            assert not vocab.spells(ids, np.r_[chars[:-1], 64]) and not vocab.spells(ids, chars[:-1])
    plain = np.array([10, *map(ord, "a"), pieces.SPACE, *map(ord, "bc")])
    assert vocab.spells(np.asarray(vocab.processor.encode("\na bc"), np.int64)[1:], plain)
