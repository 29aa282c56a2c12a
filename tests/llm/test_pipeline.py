"""The pipeline over the smallest tables, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

import numpy as np
import sentencepiece

import corpus_pipeline
from tessella.llm import pieces, toxicity
from tessella.llm.common import stored, table

from .test_dedup import brute_lines, brute_near, words

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    model = toxicity.train(docs, table(spark, SF, "labels"))
    clean = {r.doc.doc_id for r in toxicity.score(docs, model).filter("score < 0.5").collect()}
    bench = [words(r.text, True) for r in table(spark, SF, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near dedup", "decontamination", "pieces"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = texts(docs)
        docs = stored(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        after = texts(docs)
        if name == "toxicity":
            assert after == [x for x in before if x[0] in clean]
        elif name == "line dedup":
            assert after == sorted((i, t) for i, _, _, t in brute_lines(before, 40, 5))
        elif name == "near dedup":
            groups = {c for _, n, c in brute_near(before) if n}
            assert after == [x for x in before if x[0] in groups or not words(x[1])]
        else:
            def share(item, w):
                grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
                own = [tuple(item[k : k + 5]) for k in range(len(item) - 4)]
                return sum(g in grams for g in own) / max(1, len(own))

            def most(t):
                return max((share(item, words(t, True)) for item in bench), default=0)

            kept = {i for i, _ in after}
            assert {i for i, t in before if most(t) >= 0.9}.isdisjoint(kept)
            assert {i for i, t in before if most(t) < 0.2} <= kept
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert {i: np.frombuffer(r["ids"], "<u2").tolist() for i, r in out.items()} == {i: sp.encode(t) for i, t in texts(docs)}


def test_hostile_rows_and_clashing_columns(spark):
    rows = [(None, None, "a"), (1, "", "b"), (2, "short text", "c"), (2, "short text", "c"), (3, "word " * 30000, "d"), (4, "é\n\n \n", "e")]
    schema = "doc_id long, text string, ids string, did int, th string, _n_lines int, n_ids int, score string, doc string, samples string"
    full = [(i, t, x, 1, "t", 7, 8, "s", "d", "m") for i, t, x in rows]
    docs = spark.createDataFrame(full, schema)
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "hostile")
        assert docs.columns == columns
    assert sorted([(r.doc_id, r.ids, r["_n_lines"]) for r in docs.collect()], key=str) == sorted([(None, "a", 7), (1, "b", 7), (2, "c", 7), (3, "d", 7), (4, "e", 7)], key=str)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert len(set(last.columns)) == len(last.columns)
    assert {r.doc_id: r.n_ids for r in last.collect()}[1] == 0
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
