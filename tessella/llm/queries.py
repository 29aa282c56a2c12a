"""The queries opN_<name> and their SQL: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, langid, license_scan, line_dedup, merkle, near_dedup, packing, pieces, pii, substring_dedup, topk, toxicity
from .common import real_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE["op4_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
lines AS (SELECT doc_id, r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT x.*, o.top IS NOT NULL AND o.top <> x.doc_id AS gone FROM keyed x LEFT JOIN often o ON x.k = o.k)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, r
"""


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        real_id("did").alias("doc_id"),
        "n_shingles",
        real_id("component").alias("component_id"),
        (F.col("did") == F.col("component")).alias("kept"),
    )


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    return topk.top_k(vectors, vectors.filter(F.col("id") % 20 == 0), 20)


ORACLE["op2_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        toxicity.held_out("doc.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(real_id("did").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(real_id("did").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op6_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r,
                     list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
starts AS (SELECT doc_id, r, unnest(range(1, len(w) - 48)) AS i, w FROM docs WHERE len(w) >= 50),
wins AS (SELECT doc_id, r, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS lead FROM wins GROUP BY k),
hits AS (SELECT r, i FROM wins JOIN firsts USING (k) WHERE doc_id > lead),
covered AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS pos FROM hits),
words AS (SELECT doc_id, r, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
kept AS (SELECT x.r, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE c.pos IS NULL) AS kept
         FROM words x LEFT JOIN covered c ON x.r = c.r AND x.pos = c.pos GROUP BY x.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        *[F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang"))
    out = langid.label(docs.select("doc_id", "text"), model)
    return out.select(F.col("doc.doc_id").cast("long").alias("doc_id"), langid.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(real_id("did").alias("doc_id"), F.col("item").alias("item_id"), "start", "cosine", "common")


@query
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids are packed: little-endian numbers of 16 bits."""
    out = pieces.segment(table(spark, sf_dir, "documents").select("doc_id", "text"), packed=True)
    return out.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        "n_ids",
        "ids",
        "ids_sha256",
        "same",
        "samples",
    )


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    out = merkle.manifest(table(spark, sf_dir, "documents"), shown={"text": altered})
    out = out.withColumn("folded_root", merkle.folded(F.col("presented"), F.col("path")))
    return out.select(
        F.col("key").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _merkle_sql(fanout: int = 16, levels: int = 5) -> str:
    """Trees of up to fanout ** levels leaves: every level groups the runs of trees that have several nodes; a last tree takes the roots."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"
    )
    parts = [
        f"d AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown FROM documents)",
        f"l AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('shown')} AS presented FROM d)",
        "a0 AS MATERIALIZED (SELECT coalesce('s' || source, '') AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS h, doc_id, presented FROM l)",
    ]
    for tree in "ab":
        if tree == "b":
            parts.append(f"b0 AS MATERIALIZED (SELECT 0 AS t, row_number() OVER (ORDER BY encode(t)) - 1 AS i, count(*) OVER () AS n, h, t AS g FROM a{levels})")
        for k in range(levels):
            parts.append(f"{tree}{k + 1} AS MATERIALIZED (SELECT t, i // {fanout} AS i, max((n + {fanout - 1}) // {fanout}) AS n, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {tree}{k} GROUP BY t, i // {fanout})")
            parts.append(f"{tree}p{k} AS MATERIALIZED (SELECT x.t, x.i, max(x.n) AS n, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS lo, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS hi FROM {tree}{k} x JOIN {tree}{k} y ON x.t = y.t AND x.i // {fanout} = y.i // {fanout} GROUP BY x.t, x.i)")
    steps, joins, fold = [], "", "presented"
    for tree in "ab":
        key, at = ("a0.t", "a0.i") if tree == "a" else ("0", "b0.i")
        joins += " JOIN b0 ON b0.g = a0.t" if tree == "b" else ""
        for k in range(levels):
            p = f"{tree}p{k}"
            joins += f" JOIN {p} ON {p}.t = {key} AND {p}.i = {at} // {fanout**k}"
            steps.append(f"{p}.lo || {p}.hi")
            fold = f"CASE WHEN {p}.n = 1 THEN f{len(steps) - 1} ELSE sha256({p}.lo || f{len(steps) - 1} || {p}.hi) END AS f{len(steps)}"
            steps[-1] = (steps[-1], fold)
    folds = ", ".join(f for _, f in steps)
    body = (
        f"SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(steps)} AS folded_root, f{len(steps)} = root AS verified FROM (SELECT *, {folds} FROM (SELECT a0.doc_id, a0.h AS leaf, a0.presented AS f0, b0.h AS subroot, r.h AS root, sha256({' || '.join(s for s, _ in steps)}) AS proof_sha256, "
        + ", ".join(f"{t}p{k}.{c} AS {t}p{k}_{c}" for t in "ab" for k in range(levels) for c in ("lo", "hi", "n"))
        + f" FROM a0{joins} JOIN b{levels} r ON r.t = 0))"
    )
    for t in "ab":
        for k in range(levels):
            for c in ("lo", "hi", "n"):
                head, tail = body.split(" FROM (SELECT a0.doc_id", 1)
                body = head.replace(f"{t}p{k}.{c}", f"{t}p{k}_{c}") + " FROM (SELECT a0.doc_id" + tail
    return "WITH " + ",\n".join(parts) + "\n" + body


ORACLE["op12_merkle"] = _merkle_sql()


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    v = hard_negatives.labelled(e, "vec_id", "embedding", "label", 256)
    return hard_negatives.mine(v, v.filter(F.col("id") % 50 == 0))


ORACLE["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score FROM v a JOIN v c ON a.id % 50 = 0 AND a.id <> c.id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
      FROM p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
