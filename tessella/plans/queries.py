"""Registered queries for the reference's operators, each beside its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.glossary import CORE_TERMS, GLOSSARY
from ..operators import export, glossary, lifecycle, names, repetition, retrieval, speech, titles
from ..schemas import CATEGORIES, CORRECTIONS
from ..sources import readers, sinks
from ..streaming import streams
from . import fixtures as fx
from .fixtures import sql, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return keep


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return fx.transcripts(spark, d).select("doc_id", "full_text", tx.words(F.col("full_text")).alias("ws"))


# ------------------------------------------------------------- tokens and ratios


@query(sql("SELECT doc_id, len(ws)::INTEGER AS n_tokens, ws[1] AS first_token, ws[-1] AS last_token, length(full_text)::INTEGER AS n_chars FROM tok", "tok"))
def t1_t3_tokens(spark, d):
    return _tokens(spark, d).select("doc_id", F.size("ws").alias("n_tokens"), F.get("ws", F.lit(0)).alias("first_token"), F.try_element_at("ws", F.lit(-1)).alias("last_token"), F.length("full_text").alias("n_chars"))


@query(sql("SELECT doc_id, CASE WHEN len(cs) > 0 THEN len(list_distinct(cs)) / len(cs) ELSE 0.0 END AS global_uwr, CASE WHEN len(ws) > 0 THEN len(list_distinct(ws)) / len(ws) ELSE 0.0 END AS raw_uwr, len(cs)::INTEGER AS word_count FROM con", "con"))
def a1_a13_uwr(spark, d):
    """A1, A1b, A13, T2, U4."""
    return _tokens(spark, d).select("doc_id", tx.distinct_ratio(F.col("ws")).alias("global_uwr"), tx.raw_ratio(F.col("ws")).alias("raw_uwr"), F.size(tx.content(F.col("ws"))).alias("word_count"))


@query(sql("SELECT doc_id, CASE WHEN len(t) > 0 THEN len(list_distinct(t)) / len(t) ELSE 0.0 END AS tail_uwr FROM (SELECT doc_id, list_filter(list_transform(CASE WHEN len(ws) > 50 THEN ws[-50:] ELSE ws END, lambda x: trim(x, '.,?!;:-')), lambda x: x <> '') AS t FROM tok)", "tok"))
def a2_tail_uwr(spark, d):
    return _tokens(spark, d).select("doc_id", tx.distinct_ratio(tx.tail(F.col("ws"))).alias("tail_uwr"))


_SLIDE = """, flat AS (SELECT doc_id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM tok),
w AS (SELECT doc_id, pos, n, trim(raw, '.,?!;:-') AS w FROM flat),
win AS (SELECT doc_id, pos, n, list(w) FILTER (WHERE w <> '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING) AS l FROM w),
low AS (SELECT doc_id, min(CASE WHEN len(l) > 0 THEN len(list_distinct(l)) / len(l) ELSE 0.0 END) AS m FROM win WHERE n >= 100 AND pos <= n - 99 GROUP BY doc_id)
"""


@query(sql("SELECT c.doc_id, coalesce(m, CASE WHEN len(cs) > 0 THEN len(list_distinct(cs)) / len(cs) ELSE 0.0 END) AS min_sliding_uwr FROM con c LEFT JOIN low ON c.doc_id = low.doc_id", "con").replace("\nSELECT c.doc_id", _SLIDE + "SELECT c.doc_id"))
def a3_min_sliding_uwr(spark, d):
    return _tokens(spark, d).select("doc_id", repetition.min_sliding_ratio("ws").alias("min_sliding_uwr"))


_TITLE = """, ti AS (SELECT t.doc_id, list_distinct(list_filter(list_transform(regexp_split_to_array(b.text, '\\s+'), lambda x: trim(x, '.,?!;:-')), lambda x: x <> '')) AS ts
        FROM tr t JOIN benchmark b ON b.item_id = t.doc_id % (SELECT max(item_id) + 1 FROM benchmark)),
flat AS (SELECT doc_id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM tok WHERE len(ws) >= 50),
win AS (SELECT doc_id, pos, n, list(trim(raw, '.,?!;:-')) FILTER (WHERE trim(raw, '.,?!;:-') <> '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS l FROM flat),
j AS (SELECT win.doc_id, len(list_intersect(list_distinct(l), ts)) AS x, len(list_distinct(l)) AS n_w, len(ts) AS n_t FROM win JOIN ti USING (doc_id) WHERE pos <= n - 49 AND len(l) > 0 AND len(ts) > 0),
hit AS (SELECT doc_id, max(x / (n_w + n_t - x)) AS best FROM j GROUP BY doc_id)
"""


@query(sql("SELECT tr.doc_id, coalesce(best > 0.8, false) AS prompt_contamination FROM tr LEFT JOIN hit USING (doc_id)", "tok").replace("\nSELECT tr.doc_id", _TITLE + "SELECT tr.doc_id"))
def a4_j7_prompt_contamination(spark, d):
    return fx.titled(spark, d).select("doc_id", repetition.title_contamination(tx.words(F.col("full_text")), F.col("title")).alias("prompt_contamination"))


_PAIRS = """, ti AS (SELECT item_id, list_distinct(list_filter(list_transform(regexp_split_to_array(text, '\\s+'), lambda x: trim(x, '.,?!;:-')), lambda x: x <> '')) AS ts FROM benchmark),
flat AS MATERIALIZED (SELECT doc_id, trim(raw, '.,?!;:-') AS w, pos, n FROM (SELECT doc_id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM tok WHERE len(ws) >= 50)),
may AS MATERIALIZED (SELECT doc_id, item_id, any_value(ts) AS ts FROM (SELECT DISTINCT doc_id, w FROM flat) JOIN (SELECT item_id, ts, unnest(ts) AS w FROM ti) USING (w) GROUP BY doc_id, item_id HAVING count(*) > 0.8 * len(any_value(ts))),
win AS (SELECT doc_id, pos, n, list_distinct(list(w) FILTER (WHERE w <> '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS l FROM flat WHERE doc_id IN (SELECT doc_id FROM may)),
j AS (SELECT win.doc_id, item_id, len(list_intersect(l, ts)) AS x, len(l) AS n_w, len(ts) AS n_t FROM win JOIN may USING (doc_id) WHERE pos <= n - 49 AND len(l) > 0)
"""


@query(sql("SELECT doc_id, item_id, max(x / (n_w + n_t - x)) AS similarity FROM j GROUP BY doc_id, item_id HAVING max(x / (n_w + n_t - x)) > 0.8", "tok").replace("\nSELECT doc_id, item_id", _PAIRS + "SELECT doc_id, item_id"))
def j7_title_pairs(spark, d):
    """Every document against every benchmark item as title: the pairs over the contamination share."""
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("title_id"), F.col("text").alias("title"))
    return titles.title_pairs(fx.transcripts(spark, d).select(F.col("doc_id").alias("id"), "full_text"), items).select(F.col("id").alias("doc_id"), F.col("title_id").alias("item_id"), "similarity")


@query(sql("SELECT x.doc_id, count(*) AS glued FROM (SELECT doc_id, c, pos, pos - row_number() OVER (PARTITION BY doc_id, c ORDER BY pos) AS g FROM (SELECT doc_id, unnest(string_split(full_text, '')) AS c, generate_subscripts(string_split(full_text, ''), 1) AS pos FROM tr) WHERE c <> chr(10)) x GROUP BY x.doc_id, c, g HAVING count(*) >= 5", "tr").replace("SELECT x.doc_id, count(*) AS glued", "SELECT doc_id, count(*)::INTEGER AS glued_count FROM (SELECT x.doc_id") + ") GROUP BY doc_id")
def a14_glued_hits(spark, d):
    n = tx.glued_count(F.col("full_text"))
    return fx.transcripts(spark, d).select("doc_id", n.alias("glued_count")).filter("glued_count > 0")


def _periods() -> str:
    """Positions with c = the character p later: a run of 4p of them is a block of p five times over."""
    parts = " UNION ".join(f"SELECT doc_id FROM (SELECT doc_id, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g, same FROM (SELECT doc_id, pos, c <> chr(10) AND c = lead(c, {p}) OVER (PARTITION BY doc_id ORDER BY pos) AS same FROM ch)) WHERE same GROUP BY doc_id, g HAVING count(*) >= {n}" for p, n in [(2, 8), (3, 12), (4, 16), (5, 20), (6, 24)])
    return parts


@query(
    sql("SELECT tr.doc_id, m.doc_id IS NOT NULL AS mono_run, p.doc_id IS NOT NULL AS period_loop, m.doc_id IS NOT NULL OR p.doc_id IS NOT NULL AS severe FROM tr LEFT JOIN m USING (doc_id) LEFT JOIN p ON tr.doc_id = p.doc_id", "tr").replace(
        "\nSELECT tr.doc_id",
        ",\nch AS (SELECT doc_id, unnest(string_split(replace(full_text, ' ', ''), '')) AS c, generate_subscripts(string_split(replace(full_text, ' ', ''), ''), 1) AS pos FROM tr),\n"
        "m AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g, same FROM (SELECT doc_id, pos, c <> chr(10) AND c = lead(c) OVER (PARTITION BY doc_id ORDER BY pos) AS same FROM ch)) WHERE same GROUP BY doc_id, g HAVING count(*) >= 10),\n"
        f"p AS ({_periods()})\nSELECT tr.doc_id",
    )
)
def p6_p8_severe_loops(spark, d):
    t = F.col("full_text")
    return fx.transcripts(spark, d).select("doc_id", tx.char_run(t).alias("mono_run"), tx.period_loop(t).alias("period_loop"), tx.severe_loop(t).alias("severe"))


# --------------------------------------------------------------------- classifier


@query()
def p5_p9_classify(spark, d):
    m = repetition.measure(fx.titled(spark, d))
    return m.select("doc_id", "category", "global_uwr", "tail_uwr", "cps", "glued_count", "min_sliding_uwr", "prompt_contamination")


_CLASS = (
    sql("", "con")
    + _SLIDE
    + """, gl AS (SELECT doc_id, count(*) AS glued FROM (SELECT doc_id FROM (SELECT doc_id, c, pos - row_number() OVER (PARTITION BY doc_id, c ORDER BY pos) AS g FROM (SELECT doc_id, unnest(string_split(full_text, '')) AS c, generate_subscripts(string_split(full_text, ''), 1) AS pos FROM tr) WHERE c <> chr(10)) GROUP BY doc_id, c, g HAVING count(*) >= 5) GROUP BY doc_id)
"""
    + _TITLE.replace("flat AS", "flat2 AS").replace("FROM flat)", "FROM flat2)").replace("win AS", "win2 AS").replace("win.doc_id", "win2.doc_id").replace("FROM win ", "FROM win2 ")
    + """, met AS (SELECT c.doc_id, tr.nan OR length(c.full_text) < 10 AS ghost, coalesce(gl.glued, 0) AS glued, coalesce(best > 0.8, false) AS title,
  CASE WHEN len(cs) > 0 THEN len(list_distinct(cs)) / len(cs) ELSE 0.0 END AS g,
  coalesce(low.m, CASE WHEN len(cs) > 0 THEN len(list_distinct(cs)) / len(cs) ELSE 0.0 END) AS m,
  (SELECT CASE WHEN len(t) > 0 THEN len(list_distinct(t)) / len(t) ELSE 0.0 END FROM (SELECT list_filter(list_transform(CASE WHEN len(ws) > 50 THEN ws[-50:] ELSE ws END, lambda x: trim(x, '.,?!;:-')), lambda x: x <> '') AS t)) AS tail,
  CASE WHEN duration > 0 THEN length(c.full_text) / duration ELSE 0.0 END AS cps
  FROM con c JOIN tr USING (doc_id) LEFT JOIN gl USING (doc_id) LEFT JOIN low USING (doc_id) LEFT JOIN hit USING (doc_id)),
cat AS (SELECT doc_id, CASE WHEN ghost THEN 'GHOST' WHEN glued >= 3 THEN 'SYLLABLE_TRAP' WHEN title THEN 'PROMPT_CONTAMINATED' WHEN m < 0.25 THEN 'SANDWICH_LOOP'
  WHEN g > 0.4 AND tail < 0.2 THEN 'TERMINAL_LOOP' WHEN g < 0.40 OR cps > 12.0 THEN 'TERMINAL_LOOP' ELSE 'SUCCESS' END AS category, g, tail, cps, glued, m, title FROM met)
"""
)
ORACLE["p5_p9_classify"] = _CLASS + "SELECT doc_id, category, g AS global_uwr, tail AS tail_uwr, cps, glued::INTEGER AS glued_count, m AS min_sliding_uwr, title AS prompt_contamination FROM cat"


@query(_CLASS + "SELECT d.category, coalesce(n, 0)::BIGINT AS n FROM (SELECT unnest(['SUCCESS', 'GHOST', 'SYLLABLE_TRAP', 'PROMPT_CONTAMINATED', 'SANDWICH_LOOP', 'TERMINAL_LOOP']) AS category) d LEFT JOIN (SELECT category, count(*) AS n FROM cat GROUP BY category) c USING (category)")
def a5_k13_category_counts(spark, d):
    """The failure matrix: six categories, zero-filled."""
    counts = p5_p9_classify(spark, d).groupBy("category").agg(F.count("*").alias("n"))
    domain = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return F.broadcast(domain).join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


@query()
def t4_cps(spark, d):
    t = fx.transcripts(spark, d)
    return t.select("doc_id", tx.chars_per_second(F.col("full_text"), F.col("segments")).alias("cps"))


ORACLE["t4_cps"] = sql("SELECT doc_id, CASE WHEN duration > 0 THEN length(full_text) / duration ELSE 0.0 END AS cps FROM tr", "tr")


# ------------------------------------------------------------------------ denoise


@query()
def w1_w2_w5_denoise(spark, d):
    """All four stages; back-references and greedy phrase runs have no SQL twin: tested against a brute-force model."""
    return repetition.denoise(fx.transcripts(spark, d).select("doc_id", "full_text"), "full_text").select("doc_id", "denoised")


_CAP = """, k AS (SELECT doc_id, list_filter(ws, lambda w, i: NOT coalesce(i > 2 AND trim(w, '.,?!;:-') = trim(ws[i - 1], '.,?!;:-') AND trim(ws[i - 1], '.,?!;:-') = trim(ws[i - 2], '.,?!;:-'), false)) AS k FROM tok)
"""


@query(sql("SELECT doc_id, array_to_string(k, ' ') AS capped, array_to_string(list_filter(k, lambda w, i: i = 1 OR trim(w, '.,?!;:-') <> trim(k[i - 1], '.,?!;:-') OR trim(w, '.,?!;:-') = ''), ' ') AS deduped FROM k", "tok").replace("\nSELECT doc_id, array", _CAP + "SELECT doc_id, array"))
def w3_w4_word_runs(spark, d):
    """The documents hold no Tamil, so the suffix forms are the stripped words; w4_suffix_variants adds suffixes."""
    t = _tokens(spark, d).select("doc_id", tx.cap_runs(F.col("ws")).alias("k"))
    return t.select("doc_id", F.array_join("k", " ").alias("capped"), F.array_join(tx.drop_variants(F.col("k")), " ").alias("deduped"))


@query(sql("SELECT doc_id, CASE WHEN len(ws) > 2000 THEN array_to_string(ws[1:2000], ' ') ELSE full_text END AS head, CASE WHEN len(ws) > 2000 THEN array_to_string(ws[2001:], ' ') ELSE '' END AS suffix FROM tok", "tok"))
def w17_cut(spark, d):
    """What goes to a corrector, and the rest, which apply_discard puts back."""
    return fx.transcripts(spark, d).select("doc_id", tx.cut_words(F.col("full_text")).alias("c")).select("doc_id", "c.head", "c.suffix")


@query()
def p22_retry_results(spark, d):
    """Every document as a second attempt, with its lines as segments; every seventh failed. The loop stages are held against a brute-force model."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.cast("double").alias("start"), x.alias("text")))
    a = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.col("doc_id").cast("string").alias("video_id"), F.when(F.col("doc_id") % 7 == 0, "HTTP_429").alias("problem"), "text", lines.alias("segments"))
    return lifecycle.retry_results(a)


# ------------------------------------------------------------------------- speech


@query(sql("SELECT doc, chunk, start_s, end_s FROM ch", "ch"))
def w6_vad_sessions(spark, d):
    return speech.speech_chunks(fx.frames(spark, d)).select("doc", "chunk", "start_s", "end_s")


@query(sql("SELECT doc, chunk, lo, hi, length, merged_start FROM off_", "off"))
def w7_pad_and_offsets(spark, d):
    return speech.padded_offsets(speech.speech_chunks(fx.frames(spark, d)))


@query(
    sql(
        "SELECT s.doc, s.id AS seg, o.chunk, s.lo + o.lo - o.merged_start AS start_s, s.hi + o.lo - o.merged_start AS end_s FROM seg s JOIN "
        "(SELECT *, CASE WHEN chunk = max(chunk) OVER (PARTITION BY doc) THEN 4611686018427387904 ELSE merged_start + length END AS until FROM off_) o ON s.doc = o.doc AND s.lo >= o.merged_start AND s.lo < o.until",
        "off",
        "seg",
    )
)
def j4_segment_remap(spark, d):
    seg = fx.segments(spark, d).select("doc", F.col("id").alias("seg"), F.col("from").alias("at"), "until")
    return speech.remap(seg, speech.padded_offsets(speech.speech_chunks(fx.frames(spark, d))))


@query("SELECT vec_id, pos::INTEGER - 1 AS pos, x / m AS scaled, trunc(x / m * 32767)::INTEGER AS pcm FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos, list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS m FROM embeddings)")
def a10_t21_peak_pcm(spark, d):
    s = table(spark, d, "embeddings").select("vec_id", tx.peak_normal(F.col("embedding")).alias("s")).select("vec_id", F.posexplode(F.arrays_zip(F.col("s").alias("scaled"), tx.pcm16(F.col("s")).alias("pcm"))).alias("pos", "x"))
    return s.select("vec_id", "pos", F.col("x.scaled").alias("scaled"), F.col("x.pcm").cast("int").alias("pcm"))


@query("SELECT vec_id, i::INTEGER AS frame, embedding[i * 16 + 1] AS first, 16::INTEGER AS size FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding) // 16)) AS i FROM embeddings)")
def w18_frame_signal(spark, d):
    f = table(spark, d, "embeddings").select("vec_id", F.posexplode(speech.split_frames(F.col("embedding"), 16)).alias("frame", "f"))
    return f.select("vec_id", "frame", F.get("f", F.lit(0)).alias("first"), F.size("f").alias("size"))


# ---------------------------------------------------------------------- lifecycle


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def j1_u3_r4_new_only(spark, d):
    return lifecycle.new_only(table(spark, d, "documents").select("doc_id", "source"), fx.manifest(spark, d), "doc_id")


@query(sql("SELECT doc_id, duration FROM tr WHERE NOT (duration > 0 AND duration < 90)", "tr"))
def p2_skip_shorts(spark, d):
    return fx.transcripts(spark, d).filter(lifecycle.long_enough(F.col("duration"))).select("doc_id", "duration")


@query(sql("SELECT m.doc_id, source, length(text)::INTEGER AS n FROM man m JOIN documents d ON m.doc_id = d.doc_id WHERE category = 'SUCCESS'", "man"))
def j2_p3_s5_manifest_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.length("text").alias("n"))
    return readers.scan_by_manifest(fx.manifest(spark, d).filter("category = 'SUCCESS'").select("doc_id"), docs, "doc_id")


@query("SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def w8_k2_latest_by_key(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return lifecycle.latest_by_key(e, "user_id", "ts", "event_id").select("user_id", "event_type", "value")


@query("WITH ch AS (SELECT user_id AS k, max_by(event_type, (ts, event_id)) AS v FROM events GROUP BY user_id), cur AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer) SELECT * FROM ch UNION ALL SELECT * FROM cur WHERE k NOT IN (SELECT k FROM ch)")
def k2_k6_upsert(spark, d):
    cur = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(0).cast("long").alias("n"))
    new = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("v"), "ts", F.col("event_id").alias("n"))
    return lifecycle.upsert(cur, new, "k", "ts", "n").select("k", "v")


@query("SELECT c.conv_id AS doc, c.turn AS id, coalesce(k.corrected, c.text) AS text FROM conversations c LEFT JOIN (SELECT conv_id, turn % 3 AS id, max_by('fixed ' || text, turn) AS corrected FROM conversations GROUP BY 1, 2) k ON c.conv_id = k.conv_id AND c.turn = k.id")
def j3_apply_corrections(spark, d):
    c = table(spark, d, "conversations")
    fixes = c.select(F.col("conv_id").alias("doc"), (F.col("turn") % 3).alias("id"), F.col("turn").alias("ord"), F.concat(F.lit("fixed "), "text").alias("corrected"))
    return lifecycle.apply_corrections(c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("id"), "text"), fixes)


@query("SELECT DISTINCT page_id FROM pages, (SELECT DISTINCT lang FROM documents) q WHERE contains(url, '/' || q.lang) OR contains(url, q.lang || '.')")
def j5_k12_name_contains(spark, d):
    """Names that contain one of a list of ids, each with its border: after a slash or before a full stop."""
    lang = table(spark, d, "documents").select("lang").distinct()
    ids = lang.select(F.explode(F.array(F.concat(F.lit("/"), "lang"), F.concat("lang", F.lit(".")))).alias("id"))
    return names.names_with_ids(table(spark, d, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("name")), ids).select(F.col("key").alias("page_id")).distinct()


@query("SELECT p.page_id, i.id FROM pages p, (SELECT DISTINCT '/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '.html' WHEN doc_id % 3 = 1 THEN '?' ELSE '' END AS id FROM labels) i WHERE contains(p.url, i.id)")
def j5_names_with_ids(spark, d):
    """All pages and queued ids where the address contains the id: ids of a dozen lengths, the usual ones by substrings, the others by automata."""
    n = F.col("doc_id") % 3
    ids = table(spark, d, "labels").select(F.concat(F.lit("/"), F.col("doc_id").cast("string"), F.when(n == 0, ".html").when(n == 1, "?").otherwise("")).alias("id"))
    return names.names_with_ids(table(spark, d, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("name")), ids).select(F.col("key").alias("page_id"), "id")


@query(sql("SELECT doc_id, CASE WHEN category = 'SUCCESS' OR in_escrow THEN NULL ELSE 'LOOP_HARVEST' END AS dest, CASE WHEN category = 'GHOST' THEN doc_id || '.json' ELSE 'REJECTED_' || doc_id || '.json' END AS name FROM man", "man"))
def k7_k8_route(spark, d):
    c, n = F.col("category"), F.concat(F.col("doc_id").cast("string"), F.lit(".json"))
    return fx.manifest(spark, d).select("doc_id", lifecycle.reject_route(c, F.col("in_escrow")).alias("dest"), lifecycle.reject_name(c, n).alias("name"))


_VERDICT = "v AS (SELECT event_id, (value % 100) / 100.0 AS score, CASE WHEN event_id % 4 = 0 THEN 'FLAGGED' ELSE 'CERTIFIED' END AS verdict, CASE event_id % 7 WHEN 0 THEN 'API_ERROR' WHEN 1 THEN 'SILENCE_LOOPING' WHEN 2 THEN 'STRUCTURAL_DECAY' WHEN 3 THEN 'PHONETIC_GLUING' WHEN 4 THEN 'LOW_CONFIDENCE' ELSE 'NONE' END AS failure_reason, user_id FROM events)"


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    e, m = table(spark, d, "events"), F.col("event_id") % 7
    reason = F.when(m == 0, "API_ERROR").when(m == 1, "SILENCE_LOOPING").when(m == 2, "STRUCTURAL_DECAY").when(m == 3, "PHONETIC_GLUING").when(m == 4, "LOW_CONFIDENCE").otherwise("NONE")
    return e.select("event_id", "user_id", ((F.col("value") % 100) / 100.0).alias("score"), F.when(F.col("event_id") % 4 == 0, "FLAGGED").otherwise("CERTIFIED").alias("verdict"), reason.alias("failure_reason"))


@query(f"WITH {_VERDICT} SELECT event_id, CASE WHEN failure_reason IN ('API_ERROR', 'PARSE_ERROR') THEN 'SKIPPED' WHEN score >= 0.85 AND verdict = 'CERTIFIED' THEN 'CERTIFIED' ELSE 'REPAIR' END AS route FROM v")
def p10_certify_gate(spark, d):
    return _verdicts(spark, d).select("event_id", lifecycle.certify(F.col("score"), F.col("verdict"), F.col("failure_reason")).alias("route"))


@query(
    f"WITH {_VERDICT} SELECT event_id, failure_reason, true AS use_vad, failure_reason = 'LOW_CONFIDENCE' AS with_context, CASE failure_reason WHEN 'STRUCTURAL_DECAY' THEN '0.2' WHEN 'PHONETIC_GLUING' THEN '0.0,0.2,0.4' ELSE '0.0' END AS temperatures, "
    "CASE failure_reason WHEN 'SILENCE_LOOPING' THEN 'VAD + context-free' WHEN 'LOW_CONFIDENCE' THEN 'Title-primed context' WHEN 'STRUCTURAL_DECAY' THEN 'Thermal variance + context-free' WHEN 'PHONETIC_GLUING' THEN 'Multi-temp fallback sweep' ELSE 'Generic context-free retry' END AS strategy FROM v"
)
def p15_engineer_params(spark, d):
    return lifecycle.suggest_retry(_verdicts(spark, d).select("event_id", "failure_reason")).select("event_id", "failure_reason", "use_vad", "with_context", "temperatures", "strategy")


@query(
    "WITH a AS (SELECT conv_id AS doc, turn + 1 AS attempt, length(text) % 5 = 0 AS looped, CASE WHEN length(text) % 3 = 0 THEN 'SUCCESS' ELSE 'TERMINAL_LOOP' END AS category FROM conversations WHERE turn < 2), "
    "b AS (SELECT doc, coalesce(min(attempt) FILTER (WHERE NOT looped AND category = 'SUCCESS'), max(attempt)) AS attempt, count(*) AS passes FROM a GROUP BY doc) "
    "SELECT a.doc, a.attempt, CASE WHEN looped THEN 'HALLUCINATION_LOOP' ELSE category END AS category, passes FROM a JOIN b ON a.doc = b.doc AND a.attempt = b.attempt"
)
def p16_p22_retry_policy(spark, d):
    n = F.length("text")
    a = table(spark, d, "conversations").filter("turn < 2").select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).alias("attempt"), (n % 5 == 0).alias("looped"), F.when(n % 3 == 0, "SUCCESS").otherwise("TERMINAL_LOOP").alias("category"))
    return lifecycle.final_attempt(a).select("doc", "attempt", "category", "passes")


@query("SELECT conv_id, turn, CASE WHEN contains(trim(text), '[DISCARD]') THEN '[DISCARD]' WHEN length(trim(text)) > 20 THEN trim(text) ELSE role END AS text, CASE WHEN trim(text) <> '' AND trim(text) <> role THEN 'CORRECTED' ELSE 'RAW_ONLY' END AS status, CASE WHEN contains(upper(trim(text)), 'VALID') THEN 'VALID' ELSE 'HALLUCINATION' END AS reply FROM conversations")
def p17_p19_replies(spark, d):
    t = F.col("text")
    return table(spark, d, "conversations").select("conv_id", "turn", tx.apply_discard(t, F.col("role")).alias("text"), tx.sentry_status(F.trim(t), F.col("role")).alias("status"), tx.oracle_reply(t).alias("reply"))


@query("SELECT a.conv_id, CASE WHEN a.role = 'STABLE' THEN 'CERTIFIED' WHEN length(b.text) > 50 THEN 'REPLACED' ELSE 'KEPT' END AS route, CASE WHEN a.role <> 'STABLE' AND length(b.text) > 50 THEN b.text ELSE a.text END AS text, CASE WHEN a.role <> 'STABLE' AND length(b.text) > 50 THEN length(a.text) ELSE 0 END::INTEGER AS original_len, CASE WHEN a.role <> 'STABLE' AND length(b.text) > 50 THEN length(b.text) ELSE 0 END::INTEGER AS golden_len FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id WHERE a.turn = 0 AND b.turn = 1")
def j9_p20_judge_route(spark, d):
    c = table(spark, d, "conversations")
    a = c.filter("turn = 0").select("conv_id", "role", "text")
    both = a.join(c.filter("turn = 1").select("conv_id", F.col("text").alias("golden")), "conv_id")
    return both.select("conv_id", lifecycle.judge_route(F.col("role"), F.col("golden"), F.col("text")).alias("r")).select("conv_id", "r.route", "r.text", F.coalesce("r.original_len", F.lit(0)).alias("original_len"), F.coalesce("r.golden_len", F.lit(0)).alias("golden_len"))


@query("SELECT a.conv_id, array_to_string(regexp_split_to_array(trim(a.text), '\\s+')[1:600], ' ') AS a, array_to_string(regexp_split_to_array(trim(b.text), '\\s+')[1:600], ' ') AS b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id WHERE a.turn = 0 AND b.turn = 1")
def j9_ab_compare(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", lifecycle.sample_words(tx.words(F.col("text")), 600).alias("t"))
    return c.filter("turn = 0").select("conv_id", F.col("t").alias("a")).join(c.filter("turn = 1").select("conv_id", F.col("t").alias("b")), "conv_id")


@query(
    "WITH e AS (SELECT user_id, event_id, value < 70 AS failed, sum(CASE WHEN value < 70 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events), "
    "s AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY event_id)::BIGINT AS streak FROM e), "
    "f AS (SELECT *, coalesce(sum(CASE WHEN streak = 5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM s) "
    "SELECT user_id, event_id, failed, streak FROM f WHERE stopped = 0"
)
def w12_consecutive_failures(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", (F.col("value") < 70).alias("failed"))
    return lifecycle.stop_after_failures(e, "user_id", "event_id", "failed")


@query("SELECT user_id, event_id, least(sum(CASE WHEN value < 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id), 5)::BIGINT AS restarts FROM events")
def w14_restart_counter(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", (F.col("value") < 20).alias("down"))
    return lifecycle.restarts(e, "user_id", "event_id", "down").select("user_id", "event_id", "restarts")


@query("SELECT user_id, event_id, row_number() OVER w AS done, sum(floor(value)::BIGINT) OVER w / row_number() OVER w * (count(*) OVER (PARTITION BY user_id) - row_number() OVER w) AS eta FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def w11_running_eta(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.floor("value").alias("s"))
    return lifecycle.running_eta(e, "user_id", "event_id", "s").select("user_id", "event_id", "done", "eta")


@query("SELECT event_id, least(20 * 2 ** (event_id % 6), 160)::BIGINT AS wait FROM events")
def w13_backoff(spark, d):
    return table(spark, d, "events").select("event_id", tx.backoff((F.col("event_id") % 6).cast("int")).alias("wait"))


@query("SELECT user_id, min_by(event_type, (CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, event_id)) AS choice FROM events GROUP BY user_id")
def w9_prefer_first(spark, d):
    rank = F.struct(F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "view", 1).otherwise(2), F.col("event_id"))
    return lifecycle.prefer(table(spark, d, "events").withColumn("prio", rank), "user_id", "event_type", "prio").select("user_id", F.col("event_type").alias("choice"))


@query("SELECT conv_id, (turn // 10)::BIGINT AS batch, count(*) AS n, string_agg(text, ' ' ORDER BY turn) FILTER (WHERE text <> '[REJECTED_LOOP]') AS text FROM conversations WHERE text IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2")
def w10_a9_j10_batches(spark, d):
    """Tumbling groups of ten segments, recompiled in order (W10, A9, J10)."""
    c = table(spark, d, "conversations").filter(F.col("text").isNotNull() & F.col("turn").isNotNull())
    spoken = F.filter(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"] != "[REJECTED_LOOP]")
    return c.groupBy("conv_id", lifecycle.tumbling(F.col("turn")).alias("batch")).agg(F.count("*").alias("n"), F.array_join(F.transform(spoken, lambda x: x["text"]), " ").alias("text"))


@query(
    sql(
        "SELECT doc_id, CASE WHEN n <= 450 THEN full_text ELSE '[OPENING]' || chr(10) || array_to_string(ws[1:150], ' ') || chr(10) || chr(10) || '[MIDDLE]' || chr(10) || array_to_string(ws[greatest(0, n // 2 - 75) + 1:greatest(0, n // 2 - 75) + 150], ' ') || chr(10) || chr(10) || '[ENDING]' || chr(10) || array_to_string(ws[n - 149:n], ' ') END AS sample, "
        "array_to_string(ws[1:400], ' ') AS head FROM (SELECT *, len(ws) AS n FROM tok)",
        "tok",
    )
)
def w16_w17_audit_sample(spark, d):
    t = _tokens(spark, d)
    return t.select("doc_id", lifecycle.audit_sample(F.col("ws"), F.col("full_text")).alias("sample"), lifecycle.sample_words(F.col("ws"), 400).alias("head"))


@query(f"WITH {_VERDICT} SELECT user_id % 10 AS scan, count(*) AS scanned, count_if(score >= 0.85 AND verdict = 'CERTIFIED' AND failure_reason <> 'API_ERROR')::BIGINT AS certified, count_if(failure_reason = 'API_ERROR')::BIGINT AS skipped, count_if(verdict = 'FLAGGED')::BIGINT AS flagged, count_if(failure_reason = 'SILENCE_LOOPING')::BIGINT AS silence, count_if(failure_reason = 'PHONETIC_GLUING')::BIGINT AS glued, count_if(score < 0.5)::BIGINT AS low FROM v GROUP BY 1")
def a6_k13_sweep_stats(spark, d):
    route = lifecycle.certify(F.col("score"), F.col("verdict"), F.col("failure_reason"))
    r = F.col("failure_reason")
    return _verdicts(spark, d).groupBy((F.col("user_id") % 10).alias("scan")).agg(
        F.count("*").alias("scanned"), F.count_if(route == "CERTIFIED").alias("certified"), F.count_if(route == "SKIPPED").alias("skipped"), F.count_if(F.col("verdict") == "FLAGGED").alias("flagged"),
        F.count_if(r == "SILENCE_LOOPING").alias("silence"), F.count_if(r == "PHONETIC_GLUING").alias("glued"), F.count_if(F.col("score") < 0.5).alias("low"),
    )


# ------------------------------------------------------------- logs and health


@query(sql("SELECT '[' || upper(event_type) || ']' AS status, count(*) AS n FROM lg GROUP BY 1", "lg"))
def a8_s9_log_counts(spark, d):
    p = readers.parse_log(fx.log(spark, d))
    return p.groupBy(F.concat(F.lit("["), "status", F.lit("]")).alias("status")).agg(F.count("*").alias("n"))


@query(sql("SELECT event_id, value FROM lg", "lg"))
def k11_log_lines(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", sinks.log_line(F.upper("event_type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"), F.col("props")).alias("value"))


@query("SELECT user_id, (floor(epoch((SELECT max(ts) FROM events)))::BIGINT - floor(epoch(max(ts)))::BIGINT) AS age, (floor(epoch((SELECT max(ts) FROM events)))::BIGINT - floor(epoch(max(ts)))::BIGINT) > 120 AS stale FROM events GROUP BY user_id")
def t19_r3_heartbeat(spark, d):
    """The age of each user's last beat at the time of the last event."""
    beats = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    return streams.heartbeat_ages(beats, "user_id", beats.agg(F.max("at").alias("now")))


@query("SELECT event_id, CASE WHEN value < 70 THEN 3 WHEN value < 85 THEN 2 WHEN value < 95 THEN 1 ELSE 0 END AS level, CASE WHEN value < 70 THEN 'throttled' WHEN value < 90 THEN 'warm' ELSE 'nominal' END AS monitor, array_to_string(list_filter([CASE WHEN value < 70 THEN 'thermal' END, CASE WHEN value > 90 THEN 'memory' END, CASE WHEN value >= 0 AND value < 5 THEN 'disk' END, CASE WHEN value * 150 > 12000 THEN 'rss' END], lambda x: x IS NOT NULL), ',') AS alerts, CASE WHEN value < 20 THEN 'green' WHEN value < 80 THEN 'yellow' ELSE 'red' END AS icon FROM events")
def p12_p13_health(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select("event_id", tx.thermal_level(F.lit(None).cast("int"), v).alias("level"), tx.monitor_thermal(v).alias("monitor"), F.array_join(tx.health_alerts(v < 70, v, v, v * 150), ",").alias("alerts"), tx.age_icon(v, 20, 80).alias("icon"))


# -------------------------------------------------------------------- text scalars


@query(
    "SELECT page_id, coalesce(nullif(regexp_extract(u, '@([^/]+)', 1), ''), 'unknown') AS channel, split_part(list_extract(string_split(u, '@'), -1), '/', 1) AS last_channel, "
    "coalesce(regexp_replace(nullif(regexp_extract(u, '@([^/]+)', 1), ''), '[^\\p{L}\\p{N} _-]', '', 'g'), 'Unknown_Channel') AS clean_channel FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE 'https://x/@' || page_id || '.' || left(url, 12) || '@b-c/videos' END AS u FROM pages)"
)
def t5_channels(spark, d):
    u = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat(F.lit("https://x/@"), F.col("page_id").cast("string"), F.lit("."), F.substring("url", 1, 12), F.lit("@b-c/videos")))
    p = table(spark, d, "pages").select("page_id", u.alias("u"))
    return p.select("page_id", tx.channel_of(F.col("u")).alias("channel"), tx.last_channel(F.col("u")).alias("last_channel"), tx.clean_channel(F.col("u")).alias("clean_channel"))


@query(
    "SELECT doc_id, left(trim(regexp_replace(t, '[^\\p{L}\\p{N} _-]', '', 'g'), ' '), 100) || '_' || doc_id || '.json' AS name, coalesce(try_cast(regexp_extract(t, '202[0-9]', 0) AS INTEGER), 0) AS year, regexp_replace(t, '\\(.*?\\)', '', 'g') AS plain, contains(lower(t), 'aditya') OR contains(lower(t), 'guruji') AS primary_source, "
    "contains(source, 'LOOP_HARVEST') OR contains(source, 'NULL_HARVEST') AS escrow FROM (SELECT doc_id, source, replace(text, chr(10), ' ') || ' (' || (2015 + doc_id % 12) || ')' AS t FROM documents)"
)
def t6_t7_t12_titles(spark, d):
    t = F.concat(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(" ("), (2015 + F.col("doc_id") % 12).cast("string"), F.lit(")"))
    p = table(spark, d, "documents").select("doc_id", "source", t.alias("t"))
    return p.select("doc_id", tx.file_name(F.col("t"), F.col("doc_id").cast("string")).alias("name"), tx.year_of(F.col("t")).alias("year"), tx.without_parentheses(F.col("t")).alias("plain"), tx.is_primary_source(F.col("t")).alias("primary_source"), tx.in_escrow(F.col("source")).alias("escrow"))


def _normal_sql(w: str) -> str:
    """The normal form of a token in SQL: stripped, the first matching suffix replaced."""
    s = f"trim({w}, '.,?!;:-')"
    return "CASE " + " ".join(f"WHEN ends_with({s}, '{old}') THEN left({s}, length({s}) - {len(old)}) || '{new}'" for old, new in tx.SUFFIXES) + f" ELSE {s} END"


def _suffixed(i: Column) -> Column:
    """A suffix by number: the rules' left sides, then their right sides, then none."""
    every = [x for old, new in tx.SUFFIXES for x in (old, new)] + [""]
    return F.element_at(F.array(*[F.lit(x) for x in every]), (i % len(every) + 1).cast("int"))


_SUFFIXED = "[" + ", ".join(f"'{x}'" for old, new in tx.SUFFIXES for x in (old, new)) + ", '']"


@query(sql(f"SELECT doc_id, {_normal_sql('w')} AS form FROM (SELECT doc_id, ws[1] || ({_SUFFIXED})[doc_id % 19 + 1] || CASE WHEN doc_id % 3 = 0 THEN '.,' ELSE '' END AS w FROM tok)", "tok"))
def t8_suffix_forms(spark, d):
    """The normal form of each document's first token with a suffix by the document's number, every third with punctuation."""
    w = F.concat(F.get("ws", F.lit(0)), _suffixed(F.col("doc_id")), F.when(F.col("doc_id") % 3 == 0, ".,").otherwise(""))
    return _tokens(spark, d).select("doc_id", tx.normal_suffix(w).alias("form"))


@query(
    sql(
        f"SELECT doc_id, array_to_string(list_filter(v, lambda w, i: i = 1 OR f[i] <> f[i - 1] OR f[i] = ''), ' ') AS deduped FROM (SELECT doc_id, v, list_transform(v, lambda w: {_normal_sql('w')}) AS f FROM "
        f"(SELECT doc_id, flatten(list_transform(ws, lambda w, i: [w || ({_SUFFIXED})[i % 19 + 1], w || ({_SUFFIXED})[(i + 1) % 19 + 1]])) AS v FROM tok))",
        "tok",
    )
)
def w4_suffix_variants(spark, d):
    """Every token twice, with two suffixes in turn: where both have one normal form the second goes."""
    pair = lambda w, i: F.array(F.concat(w, _suffixed(i + 1)), F.concat(w, _suffixed(i + 2)))
    t = _tokens(spark, d).select("doc_id", F.flatten(F.transform("ws", pair)).alias("v"))
    return t.select("doc_id", F.array_join(tx.drop_variants(F.col("v")), " ").alias("deduped"))


@query(
    "WITH l AS (SELECT page_id, list_filter(list_transform(list_filter(list_transform(string_split(html, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '' AND NOT starts_with(x, 'WEBVTT') AND NOT starts_with(x, 'NOTE') AND NOT contains(x, '-->') AND NOT regexp_full_match(x, '[0-9]+')), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), lambda x: x <> '') AS l FROM pages) "
    "SELECT page_id, array_to_string(list_filter(regexp_split_to_array(array_to_string(l, ' '), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+'), lambda x: x <> '')[1:200], ' ') AS text FROM l"
)
def t9_s10_captions(spark, d):
    return table(spark, d, "pages").select("page_id", tx.caption_text(F.col("html")).alias("text"))


@query(
    "WITH t AS (SELECT page_id // 4 AS video_id, page_id % 4 AS n, array_to_string(list_filter(regexp_split_to_array(array_to_string(list_filter(list_transform(list_filter(list_transform(string_split(html, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '' AND NOT starts_with(x, 'WEBVTT') AND NOT starts_with(x, 'NOTE') AND NOT contains(x, '-->') AND NOT regexp_full_match(x, '[0-9]+')), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), lambda x: x <> ''), ' '), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+'), lambda x: x <> '')[1:200], ' ') AS text FROM pages) "
    "SELECT video_id, min_by(text, CASE n WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 4 ELSE 9 END) AS text FROM t WHERE n < 3 AND text <> '' GROUP BY video_id"
)
def s10_choose_captions(spark, d):
    """Pages as caption tracks, four a video: manual ta, automatic ta-IN, manual ta-IN, and one in English that never counts."""
    n = F.col("page_id") % 4
    lang = F.when(n == 0, "ta").when(n < 3, "ta-IN").otherwise("en")
    return readers.choose_captions(table(spark, d, "pages").select(F.floor(F.col("page_id") / 4).alias("video_id"), lang.alias("lang"), (n == 1).alias("auto"), F.col("html").alias("text")))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def t10_reply_json(spark, d):
    """Replies wrapped in prose, every third; the object is found either way."""
    said = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", tx.reply_object(said, "k INT").getField("k").alias("k"))


@query("SELECT event_id, event_id::INTEGER AS id, event_type AS corrected FROM events WHERE event_id % 2 = 0")
def t11_reply_corrections(spark, d):
    said = F.concat(F.lit('Here: [ {"id": '), F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.lit("null")), F.lit(', "original": "a", "corrected": "'), "event_type", F.lit('"} ] done'))
    return table(spark, d, "events").select("event_id", F.explode(tx.reply_corrections(said, CORRECTIONS)).alias("c")).select("event_id", "c.id", "c.corrected")


@query("SELECT event_id, CASE WHEN value > 0 AND event_id % 500 > 0 THEN (event_id % 500) / value END AS rtf, CASE WHEN value > 0 THEN 30 * 16000 / value / 160 END AS fps FROM events")
def t14_t16_d21_speed(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", tx.realtime_factor((F.col("event_id") % 500).cast("double"), F.col("value")).alias("rtf"), F.when(F.col("value") > 0, tx.frames_per_second(F.lit(30), F.col("value"))).alias("fps"))


@query("SELECT event_id, floor(7000 * 35.0::DOUBLE / (1 + event_id % 20) / 60 / 24)::BIGINT AS days, 7000 * 35.0::DOUBLE / (1 + event_id % 20) / 60 - floor(7000 * 35.0::DOUBLE / (1 + event_id % 20) / 60 / 24) * 24 AS hours FROM events")
def t15_harvest_estimate(spark, d):
    return table(spark, d, "events").select("event_id", tx.harvest_days((1 + F.col("event_id") % 20).cast("double")).alias("e")).select("event_id", "e.days", "e.hours")


@query("SELECT event_id, (n // 10 + CASE WHEN n % 10 > 5 OR n % 10 = 5 AND n // 10 % 2 = 1 THEN 1 ELSE 0 END) / 100 AS rounded FROM (SELECT event_id, (event_id % 100000) * 125 AS n FROM events)")
def t13_rounding(spark, d):
    """Eighths rounded to two digits: every fourth is an exact tie, which goes to the even digit."""
    return table(spark, d, "events").select("event_id", tx.round_half_even((F.col("event_id") % 100000) / 8, 2).alias("rounded"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def t17_timestamps(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("SELECT event_id, k = 4 AS four_bit, CASE k WHEN 32 THEN 'large' WHEN 4 THEN 'turbo' ELSE 'other' END AS depth, CASE WHEN event_id % 2 = 0 THEN 'native' ELSE 'unknown' END AS format FROM (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)")
def s15_u2_config(spark, d):
    k = F.get_json_object("props", "$.k")
    conf = F.concat(F.lit('{"quantization": {"bits": '), k, F.lit('}, "n_audio_layer": '), k, F.when(F.col("event_id") % 2 == 0, F.lit(', "n_mels": 80}')).otherwise(F.lit("}")))
    return table(spark, d, "events").select("event_id", tx.config_kind(conf).alias("c")).select("event_id", "c.*")


@query(sql("SELECT m.doc_id, len(list_intersect(list_distinct(a.cs), list_distinct(b.cs))) / (len(list_distinct(a.cs)) + len(list_distinct(b.cs)) - len(list_intersect(list_distinct(a.cs), list_distinct(b.cs)))) AS jaccard FROM man m JOIN con a ON m.doc_id = a.doc_id JOIN con b ON b.doc_id = m.doc_id + 1 WHERE len(a.cs) + len(b.cs) > 0", "con", "man"))
def u1_jaccard(spark, d):
    w = _tokens(spark, d).select("doc_id", F.array_distinct(tx.content(F.col("ws"))).alias("s"))
    pair = fx.manifest(spark, d).select("doc_id").join(w.withColumnRenamed("s", "a"), "doc_id").join(w.select((F.col("doc_id") - 1).alias("doc_id"), F.col("s").alias("b")), "doc_id")
    return pair.filter("size(a) + size(b) > 0").select("doc_id", tx.jaccard(F.col("a"), F.col("b")).alias("jaccard"))


# ---------------------------------------------------------------- glossary, export


_TERMS = "terms AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {n}, '{t}')" for n, (c, t) in enumerate((c, t) for c, ts in GLOSSARY.items() for t in ts)) + ") AS x(category, ord, term))"


@query(
    f"WITH {_TERMS}, c AS (SELECT ord, term, trim(regexp_replace(term, '\\(.*?\\)', '', 'g')) AS clean, string_split(category, '_') AS keys FROM terms), "
    "hit AS (SELECT doc_id, term, min(ord) AS ord FROM documents, c WHERE len(list_filter(keys, lambda k: contains(lower(text), k))) > 0 OR contains(text, clean) OR length(clean) > 3 AND contains(lower(text), clean) GROUP BY doc_id, term), "
    "top AS (SELECT doc_id, string_agg(term, ', ' ORDER BY ord) AS prompt, count(*)::INTEGER AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS r FROM hit) WHERE r <= 30 GROUP BY doc_id) "
    f"SELECT doc_id AS id, coalesce(prompt, '{CORE_TERMS}') AS prompt, coalesce(n, 0) AS n_terms FROM documents LEFT JOIN top USING (doc_id)"
)
def j6_l3_glossary_prompt(spark, d):
    """Whole texts as titles; at most 30 terms of each (the operator's cap)."""
    return glossary.prompts(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title")), glossary.glossary_table(spark))


@query(f"WITH {_TERMS} SELECT lang, count(*) AS n, (SELECT string_agg(term, ', ' ORDER BY ord) FROM terms) AS terms FROM documents GROUP BY lang")
def a12_glossary_flat(spark, d):
    """The flat term list beside each language's document count."""
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")).join(F.broadcast(glossary.flat_glossary(glossary.glossary_table(spark))))


_GATED = ", g AS (SELECT c.doc_id, c.full_text, len(cs) AS n, CASE WHEN len(cs) > 0 THEN len(list_distinct(cs)) / len(cs) ELSE 0.0 END AS u FROM con c)\n"


@query(sql("SELECT doc_id, n::BIGINT AS word_count FROM g WHERE full_text <> '' AND n >= 30 AND u >= 0.35", "con").replace("\nSELECT doc_id, n", _GATED + "SELECT doc_id, n"))
def p4_export_gate(spark, d):
    return export.gated(fx.transcripts(spark, d)).select("doc_id", "word_count")


def _records(spark: SparkSession, d: str) -> DataFrame:
    t = fx.transcripts(spark, d).withColumn("video_id", F.col("doc_id").cast("string")).withColumn("title", F.col("lang"))
    return export.training_records(t)


@query(sql("SELECT g.doc_id::VARCHAR AS id, tr.source, 'ta' AS language, lang AS title, trunc(duration)::BIGINT AS duration_s, n::BIGINT AS word_count, 1::INTEGER AS n_segments FROM g JOIN tr USING (doc_id) WHERE g.full_text <> '' AND n >= 30 AND u >= 0.35", "con").replace("\nSELECT g.doc_id", _GATED + "SELECT g.doc_id"))
def d6_k4_p14_training_records(spark, d):
    return _records(spark, d).select("id", "source", "language", "title", "duration_s", "word_count", F.size("segments").alias("n_segments"))


@query(
    sql(
        "SELECT count(*) AS records, (SELECT count(*) FROM tr) - count(*) AS skipped, sum(n)::BIGINT AS words, count(*)::BIGINT AS segments, sum(trunc(duration)::BIGINT) / 3600 AS hours, sum(length(g.full_text)) / greatest((SELECT sum(length(full_text)) FROM tr)::DOUBLE, 0.01) AS size_ratio FROM g JOIN tr USING (doc_id) WHERE g.full_text <> '' AND n >= 30 AND u >= 0.35",
        "con",
    ).replace("\nSELECT count(*) AS records", _GATED + "SELECT count(*) AS records")
)
def a7_k13_export_stats(spark, d):
    return export.totals(_records(spark, d), fx.transcripts(spark, d))


@query(sql("SELECT doc, id, lo / 16000.0 AS start, hi / 16000.0 AS end, trim(text, ' ') AS text FROM seg WHERE trim(text, ' ') <> ''", "seg"))
def p14_segments(spark, d):
    """Segments stripped, blank ones left out; times unrounded here (rounding of ties has unit tests)."""
    s = fx.segments(spark, d).select("doc", F.struct((F.col("from") / 16000.0).alias("start"), (F.col("until") / 16000.0).alias("end"), F.concat(F.lit(" "), "text").alias("text")).alias("s"), "id")
    return s.select("doc", "id", F.explode(export.spoken_segments(F.array("s"), digits=None)).alias("s")).select("doc", "id", "s.*")


# ---------------------------------------------------------------------- retrieval


@query()
def w15_t18_chunks(spark, d):
    """Chunk ids, urls and texts; the splitter's rules have property tests."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("doc_id").cast("string")).alias("source_url"))
    return retrieval.chunk_table(docs, "doc_id", "text", "source_url")


def _hits(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    queries = v.filter("id % 50 = 0")  # the stated query set
    return retrieval.nearest(v, queries)


_KNN = "SELECT query_id, rank, id FROM (SELECT q.vec_id AS query_id, c.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) DESC, c.vec_id)::INTEGER AS rank FROM (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q, embeddings c) WHERE rank <= 7"


@query(_KNN)
def j8_l1_s13_knn(spark, d):
    return _hits(spark, d).select("query_id", "rank", "id")


@query(f"SELECT query_id, label::VARCHAR AS title, min(rank) AS first FROM ({_KNN}) JOIN embeddings ON id = vec_id GROUP BY 1, 2")
def a11_distinct_sources(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("title"))
    return retrieval.distinct_sources(_hits(spark, d).join(e, "id"))


@query(f"SELECT query_id, string_agg('[' || rank || '] ' || label, chr(10) || chr(10) ORDER BY rank) AS context FROM ({_KNN}) JOIN embeddings ON id = vec_id GROUP BY 1")
def l1_context(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("document"))
    return retrieval.context(_hits(spark, d).join(e, "id"))


def _hashed(texts: list[str]) -> list[list[float]]:
    """An embedder for tests: two numbers of the text's hash."""
    names = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    return [[int(n[:4], 16) / 65536, int(n[4:8], 16) / 65536] for n in names]


@query(
    "WITH n AS (SELECT conv_id || '_chunk_' || turn // 2 AS id, max_by(text, turn) AS document FROM conversations WHERE conv_id % 3 <> 0 AND text IS NOT NULL GROUP BY 1), "
    "o AS (SELECT conv_id || '_chunk_' || turn AS id, role AS document FROM conversations WHERE id NOT IN (SELECT id FROM n)), a AS (SELECT * FROM n UNION ALL SELECT * FROM o) "
    "SELECT id, document, ('0x' || md5(document)[1:4])::BIGINT / 65536 AS a, ('0x' || md5(document)[5:8])::BIGINT / 65536 AS b FROM a"
)
def k6_batched_upsert(spark, d):
    """Turns as chunks in two versions, embedded fifty at a time, put in place of what the store holds under their ids."""
    c = table(spark, d, "conversations")
    store = retrieval.embedded(c.select(F.concat(F.col("conv_id").cast("string"), F.lit("_chunk_"), F.col("turn").cast("string")).alias("id"), F.lit(-1).cast("long").alias("turn"), F.col("role").alias("document")), _hashed)
    new = c.filter((F.col("conv_id") % 3 != 0) & F.col("text").isNotNull()).select(F.concat(F.col("conv_id").cast("string"), F.lit("_chunk_"), F.floor(F.col("turn") / 2).cast("string")).alias("id"), "turn", F.col("text").alias("document"))
    return retrieval.upsert_chunks(store, new, _hashed, "turn").select("id", "document", F.col("embedding")[0].alias("a"), F.col("embedding")[1].alias("b"))


# ---------------------------------------------------------------- limits, stamps


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def l2_l4_l6_scan_limit(spark, d):
    """A scan limit (the operator's feature), in a declared order."""
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy("doc_id").limit(100)


@query()
def l5_shuffle(spark, d):
    """Channels in a seeded random order: a key to sort by, spread evenly, instead of a number given out by one task."""
    c = table(spark, d, "documents").select("source").distinct()
    return c.withColumn("place", F.xxhash64("source", F.lit(42))).orderBy("place", "source")


@query(sql("SELECT doc_id, in_escrow IS NOT TRUE AS certified, category AS notes, CASE WHEN in_escrow THEN category END AS quarantine_reason FROM man", "man"))
def k8_k9_stamps(spark, d):
    m = fx.manifest(spark, d).select("doc_id", "category", "in_escrow", F.struct(F.lit(False).alias("omega_certified"), F.lit(None).cast("string").alias("omega_quarantine_reason")).alias("metadata"))
    done = lifecycle.stamp_certified(F.col("metadata"), F.lit("2025-01-01T00:00:00"), F.col("category"))
    held = lifecycle.stamp_quarantine(F.col("metadata").withField("omega_timestamp", F.lit(None).cast("string")).withField("omega_merge_notes", F.col("category")), F.col("category"))
    m = m.withColumn("a", done).withColumn("b", held)
    pick = lambda c: F.when(F.col("in_escrow"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return m.select("doc_id", *[pick(c).alias(n) for n, c in (("certified", "omega_certified"), ("notes", "omega_merge_notes"), ("quarantine_reason", "omega_quarantine_reason"))])


@query(sql("SELECT d.doc_id, d.source FROM documents d LEFT JOIN man m ON d.doc_id = m.doc_id WHERE NOT coalesce(category = 'SUCCESS', false)", "man"))
def p1_skip_certified(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source").join(fx.manifest(spark, d).select("doc_id", (F.col("category") == "SUCCESS").alias("certified")), "doc_id", "left")
    return docs.filter(~F.coalesce("certified", F.lit(False))).select("doc_id", "source")


@query(sql("SELECT doc_id, in_escrow::VARCHAR AS in_escrow, category, in_escrow OR category <> 'SUCCESS' AS p11 FROM man", "man"))
def k5_s7_p11_report(spark, d):
    """The audit report's columns; in_escrow is compared as text in any case."""
    m = fx.manifest(spark, d)
    path = F.when(F.col("category") != "SUCCESS", F.lit("/x/LOOP_HARVEST/a.json")).when(F.col("in_escrow"), F.lit("/x/NULL_HARVEST/a.json")).otherwise(F.lit("/x/a.json"))
    return m.select("doc_id", F.col("in_escrow").cast("string").alias("in_escrow"), "category", tx.in_escrow(path).alias("p11"))


@query("SELECT source AS channel_name, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def k10_partition_by_channel(spark, d):
    """Documents written to a folder a channel, and what each folder holds when read again."""
    path = fx.work_path(spark, "channels")
    t = fx.transcripts(spark, d).select("doc_id", "full_text", tx.last_channel(F.col("url")).alias("channel_name"))
    sinks.write_documents(t, path, by="channel_name")
    back = spark.read.schema("doc_id long, full_text string, channel_name string").json(path)
    return back.groupBy("channel_name").agg(F.count("*").alias("n"), F.sum(F.length("full_text")).alias("chars"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def x1_event_windows(spark, d):
    """Tumbling event-time windows, as the streaming form has them (an extension)."""
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# ------------------------------------------------- files written and read again


def _tree(spark: SparkSession, d: str) -> str:
    root = fx.work_path(spark, "tree")
    fx.tree(spark, d, root)
    return root


_NAME = "source || '/' || CASE doc_id % 12 WHEN 0 THEN 'review/' WHEN 3 THEN 'backup/' ELSE '' END || CASE WHEN doc_id % 12 = 1 THEN 'REJECTED_' ELSE '' END || 't_' || doc_id || CASE WHEN doc_id % 12 = 4 THEN '.json.tmp' ELSE '.json' END"


@query("SELECT doc_id::VARCHAR AS video_id, 'title ' || lang AS title, length(text)::INTEGER AS n FROM documents WHERE doc_id % 12 IN (1, 3, 8, 9, 10, 11)")
def s1_scan_docs(spark, d):
    """A tree of document files: what is not certified, under review or no JSON."""
    return readers.scan_docs(spark, _tree(spark, d)).select("metadata.video_id", "metadata.title", F.length("full_text").alias("n"))


@query(f"SELECT doc_id::VARCHAR AS video_id FROM (SELECT * FROM documents WHERE doc_id % 12 IN (1, 3, 8, 9, 10, 11) ORDER BY encode({_NAME}) LIMIT 30)")
def l2_scan_docs_limit(spark, d):
    """The first thirty paths of a scan (the operator's limit)."""
    return readers.scan_docs(spark, _tree(spark, d), 30).select("metadata.video_id")


@query("SELECT doc_id::VARCHAR AS video_id, length(text)::INTEGER AS n FROM documents WHERE doc_id % 12 IN (3, 8, 9, 10, 11)")
def s2_scan_export(spark, d):
    return readers.scan_export(spark, _tree(spark, d)).select("metadata.video_id", F.length("full_text").alias("n"))


@query("SELECT doc_id::VARCHAR AS video_id, 'title ' || lang AS title, CASE WHEN doc_id % 12 = 8 THEN 'GHOST' ELSE 'SUCCESS' END AS category, n_chars / 4 AS duration FROM documents WHERE doc_id % 12 IN (2, 8, 9, 10, 11)")
def s3_scan_rebuild(spark, d):
    """A manifest rebuilt from the names and contents of document files."""
    return readers.scan_rebuild(spark, _tree(spark, d)).select("video_id", "title", "category", "duration")


@query(f"SELECT {_NAME} AS file, CASE doc_id % 12 WHEN 4 THEN 'temporary' WHEN 5 THEN 'empty' WHEN 6 THEN 'blank' ELSE 'unparsable' END AS problem FROM documents WHERE doc_id % 12 IN (4, 5, 6, 7)")
def s14_corrupt_files(spark, d):
    """The files of a tree that a clean start would have to remove, and why; nothing is removed."""
    root = _tree(spark, d)
    return readers.corrupt_files(spark, root).select(F.regexp_replace(F.col("path"), "^.*?/tree-[0-9a-f]+/", "").alias("file"), "problem")


#: A trigger that fails is done again as a whole.
FILES_A_TRIGGER = 100_000
#: Files of a folder, on average: a folder is listed by one task.
FILES_A_FOLDER = 10_000


@query("SELECT doc_id::VARCHAR AS video_id, length(text)::INTEGER AS n FROM documents")
def s6_l4_queue_files(spark, d):
    """Document files as a queue that a stream works off, some files a trigger; each is handled once."""
    root, listed, out, state = (fx.work_path(spark, n) for n in ("queue-files", "queue-names", "handled", "queue-state"))
    docs = table(spark, d, "documents")
    n = docs.count()
    folder = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // FILES_A_FOLDER))).cast("string")
    value = F.to_json(F.struct(F.struct(F.col("doc_id").cast("string").alias("video_id")).alias("metadata"), F.col("text").alias("full_text")))
    sinks.write_files(docs.select(F.concat(folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), value.alias("content")), root).write.format("noop").mode("overwrite").save()
    per_trigger = min(max(5, n // 4), FILES_A_TRIGGER)
    a_part = min(per_trigger, readers.NAMES_A_PART)
    readers.list_queue(spark, root, listed, a_part)
    files = readers.listed_queue(spark, listed, per_trigger // a_part)
    streams.append_stream(files.select("metadata.video_id", F.length("full_text").alias("n")), out, state).awaitTermination()
    return spark.read.schema("video_id string, n int").parquet(out)


@query(sql("SELECT doc_id, CASE WHEN category = 'GHOST' THEN 'NULL_HARVEST' ELSE 'LOOP_HARVEST' END AS dest, CASE WHEN category = 'GHOST' THEN '' ELSE 'REJECTED_' END || doc_id || '.json' AS name FROM (SELECT doc_id, in_escrow, CASE WHEN category <> 'SUCCESS' AND doc_id % 5 = 0 THEN 'GHOST' ELSE category END AS category FROM man) WHERE category <> 'SUCCESS' AND NOT in_escrow", "man"))
def k7_routed_files(spark, d):
    """Rejected documents written to a folder each destination, and what the folders hold when read again."""
    path = fx.work_path(spark, "routed")
    m = fx.manifest(spark, d).withColumn("category", F.when((F.col("category") != "SUCCESS") & (F.col("doc_id") % 5 == 0), "GHOST").otherwise(F.col("category")))
    name = lifecycle.reject_name(F.col("category"), F.concat(F.col("doc_id").cast("string"), F.lit(".json")))
    sinks.write_routed(m.select("doc_id", name.alias("name"), lifecycle.reject_route(F.col("category"), F.col("in_escrow")).alias("dest")), path)
    return spark.read.schema("doc_id long, name string, dest string").json(path)


@query(sql("SELECT doc_id::VARCHAR AS video_id, category, in_escrow FROM man", "man"))
def s4_manifest_files(spark, d):
    """A manifest as other writers leave it: in part files of one map over many lines, in part a map a line, with broken files between."""
    path = fx.work_path(spark, "manifests")
    m = fx.manifest(spark, d).select(F.col("doc_id").cast("string").alias("video_id"), F.struct("category", "in_escrow").alias("e"))
    entry = F.concat(F.lit('  "'), "video_id", F.lit('": '), F.to_json("e"))
    group = (F.col("video_id").cast("long") / 64).cast("long")
    maps = m.groupBy(group.alias("g")).agg(F.array_join(F.collect_list(entry), ",\n").alias("text"))
    wide = F.concat(F.lit("{\n"), "text", F.lit("\n}\n"))
    flat = F.concat(F.lit("{"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("}\n\n"))
    good = maps.select(F.concat(F.lit("m"), F.col("g").cast("string"), F.lit(".json")).alias("path"), F.when(F.col("g") % 2 == 0, wide).otherwise(flat).alias("content"))
    bad = maps.filter("g % 7 = 0").select(F.concat(F.lit("bad"), F.col("g").cast("string"), F.lit(".json")).alias("path"), F.concat(F.lit("{\n"), "text", F.lit(",\n")).alias("content"))
    sinks.write_files(good.unionByName(bad), path).write.format("noop").mode("overwrite").save()
    return readers.scan_manifest(spark, path).select("video_id", "category", "in_escrow")


@query(sql("SELECT g.doc_id::VARCHAR AS id, tr.source, n::BIGINT AS word_count FROM g JOIN tr USING (doc_id) WHERE g.full_text <> '' AND n >= 30 AND u >= 0.35", "con").replace("\nSELECT g.doc_id", _GATED + "SELECT g.doc_id"))
def k1_k3_k4_records_round_trip(spark, d):
    """Training rows written as JSON lines, appended again, and read with each id once."""
    path, rows = fx.work_path(spark, "records"), _records(spark, d)
    sinks.overwrite_records(rows, path)
    sinks.append_records(rows, path)
    return sinks.read_records(spark, path, rows.schema).select("id", "source", "word_count")


@query(sql("SELECT doc_id::VARCHAR AS vid_id, category, in_escrow FROM man", "man"))
def k5_s7_report_round_trip(spark, d):
    path = fx.work_path(spark, "report")
    m = fx.manifest(spark, d)
    sinks.write_report(m.select(F.col("doc_id").cast("string").alias("vid_id"), "category", F.initcap(F.col("in_escrow").cast("string")).alias("in_escrow")), path)
    return readers.scan_report(spark, path).select("vid_id", "category", "in_escrow")


@query(sql("SELECT upper(event_type) AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id::VARCHAR AS id, props AS extra FROM events", "lg"))
def k11_s9_log_round_trip(spark, d):
    path = fx.work_path(spark, "log")
    sinks.append_log(fx.log(spark, d).select("value"), path)
    return readers.scan_log(spark, path)


@query(sql("SELECT doc_id::VARCHAR AS video_id, category, in_escrow FROM man", "man"))
def s4_k2_manifest_round_trip(spark, d):
    """The manifest written as JSON maps of bounded size and read back to rows."""
    path = fx.work_path(spark, "manifest")
    sinks.write_manifest(fx.manifest(spark, d).select(F.col("doc_id").cast("string").alias("video_id"), "category", "in_escrow"), path)
    return readers.scan_manifest(spark, path).select("video_id", "category", "in_escrow")


@query("SELECT doc_id::VARCHAR AS id FROM labels")
def s8_queue_list(spark, d):
    """Ids written as JSON arrays of bounded size and read back."""
    path = fx.work_path(spark, "queue")
    sinks.write_id_list(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id")), path)
    return readers.scan_id_list(spark, path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def r1_r4_unseen_stream(spark, d):
    """Events read as a stream, each (user, type) once, appended to a table; known keys are on disk (RocksDB), the checkpoint is the resume state."""
    source, path, state = (fx.work_path(spark, n) for n in ("events", "unseen", "state"))
    e = table(spark, d, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("k"), "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    e.repartition(4).write.parquet(source)
    stream = streams.unseen(spark.readStream.schema(e.schema).parquet(source), "k", "at", "10000 days")
    streams.append_stream(stream.select("user_id", "event_type"), path, state).awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(path)


def _beats(spark: SparkSession, d: str) -> DataFrame:
    """Events written as beats and read as a stream."""
    source = fx.work_path(spark, "beats")
    beats = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    beats.repartition(4).write.parquet(source)
    return spark.readStream.schema(beats.schema).parquet(source)


_SILENT = """WITH b AS (SELECT DISTINCT user_id, epoch_us(ts) // 1000 AS ms FROM events), w AS (SELECT max(ms) AS w FROM b),
g AS (SELECT user_id, ms, (coalesce(lead(ms) OVER (PARTITION BY user_id ORDER BY ms), w) - ms - 1) // 120000 AS n FROM b, w),
t AS (SELECT user_id, ms + 120000 * unnest(range(1, least(n, 6) + 1)) AS ms FROM g WHERE n > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms) AS k FROM t)
"""


@query(_SILENT + "SELECT user_id, make_timestamp(ms * 1000) AS decided, CASE WHEN k <= 5 THEN 'restart' ELSE 'stop' END AS action FROM r WHERE k <= 6")
def r2_watchdog_stream(spark, d):
    """Events as beats, watched as a stream with keyed state: what is done at every 120 seconds of a user's silence, until it is stopped."""
    path, state = fx.work_path(spark, "actions"), fx.work_path(spark, "watch")
    streams.append_stream(streams.watchdog(_beats(spark, d), "user_id"), path, state).awaitTermination()
    done = spark.read.schema("user_id long, at timestamp, action string").parquet(path)
    return done.filter("action <> 'ok'").select("user_id", F.col("at").cast("timestamp_ntz").alias("decided"), "action")


@query(_SILENT + "SELECT user_id, make_timestamp(max(ms) * 1000) AS last, max(w) - max(ms) > 120000 AS stale FROM b, w GROUP BY user_id")
def r3_stale_by_timer(spark, d):
    """Every user's last beat, and whether silence alone, by a timer, has made it stale."""
    path, state = fx.work_path(spark, "statuses"), fx.work_path(spark, "timers")
    streams.append_stream(streams.heartbeats(_beats(spark, d), "user_id"), path, state).awaitTermination()
    done = spark.read.schema("user_id long, at timestamp, status string").parquet(path)
    return done.groupBy("user_id").agg(F.max("at").cast("timestamp_ntz").alias("last"), (F.max_by("status", F.struct("at", "status")) == "stale").alias("stale"))


ENTRY = p5_p9_classify
