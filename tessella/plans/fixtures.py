"""The given tables seen as transcripts, manifests, frames, logs and so on; each view has its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import sinks
from ..sources.shared import work_path  # noqa: F401


#: Bytes of one input split below which a small table is dealt out again.
SPLIT_BYTES = 4 << 20


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table of texts that has less than a split for each core (often one row group, so one task) is spread over them."""
    df, cores = spark.read.parquet(f"{d}/{name}.parquet"), spark.sparkContext.defaultParallelism
    small = name in ("documents", "pages", "conversations") and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SPLIT_BYTES * cores
    return df.repartition(cores) if small else df


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """documents as transcripts: one segment with a declared end; every 97th has a NaN log probability."""
    seconds = F.col("n_chars") / (5 + F.col("doc_id") % 15)
    seg = F.struct(F.lit(0).alias("id"), F.lit(0.0).alias("start"), seconds.alias("end"), F.col("text").alias("text"), F.when(F.col("doc_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.lit(-0.5)).alias("avg_logprob"))
    return table(spark, d, "documents").select(
        "doc_id", F.col("text").alias("full_text"), F.concat(F.lit("https://x/@"), "source", F.lit("/videos")).alias("url"), F.array(seg).alias("segments"), seconds.alias("duration"), "lang", "source"
    )


def titled(spark: SparkSession, d: str) -> DataFrame:
    """transcripts with a benchmark item (by number, over the whole benchmark) as title."""
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("k"), F.col("text").alias("title"))
    count = items.agg((F.max("k") + 1).alias("count"))
    docs = transcripts(spark, d).join(F.broadcast(count)).withColumn("k", F.col("doc_id") % F.col("count"))
    return docs.join(items, "k", "left").drop("k", "count")


def segments(spark: SparkSession, d: str) -> DataFrame:
    """conversations as segments (doc, id, text, from, until): times by text length, in samples."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    length = F.length("text") * 960
    return table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("id"), "text", (F.sum(length).over(w) - length).alias("from"), F.sum(length).over(w).alias("until"))


def frames(spark: SparkSession, d: str) -> DataFrame:
    """events as speech frames per user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select(F.col("user_id").alias("doc"), (F.row_number().over(w) - 1).cast("long").alias("idx"), (F.col("value") >= 50).alias("speech"), F.count("*").over(Window.partitionBy("user_id")).alias("n_frames"))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """labels as manifest entries of the documents."""
    return table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "SUCCESS").otherwise("SANDWICH_LOOP").alias("category"), (F.col("toxic") == 1).alias("in_escrow"))


def log(spark: SparkSession, d: str) -> DataFrame:
    """events as log lines."""
    return table(spark, d, "events").select(F.concat_ws(" | ", F.concat(F.lit("["), F.upper("event_type"), F.lit("]")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"), "props").alias("value"), "ts", "user_id", "event_id", "event_type")


SQL = {
    "tr": "tr AS (SELECT doc_id, text AS full_text, 'https://x/@' || source || '/videos' AS url, n_chars / (5 + doc_id % 15) AS duration, lang, source, doc_id % 97 = 0 AS nan FROM documents)",
    "tok": r"tok AS (SELECT doc_id, list_filter(regexp_split_to_array(full_text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'), lambda x: x <> '') AS ws, full_text FROM tr)",
    "con": "con AS (SELECT doc_id, ws, full_text, list_filter(list_transform(ws, lambda x: trim(x, '.,?!;:-')), lambda x: x <> '') AS cs FROM tok)",
    "seg": "seg AS (SELECT conv_id AS doc, turn AS id, text, (sum(length(text) * 960) OVER w - length(text) * 960)::BIGINT AS lo, (sum(length(text) * 960) OVER w)::BIGINT AS hi FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))",
    "fr": "fr AS (SELECT user_id AS doc, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, value >= 50 AS speech, count(*) OVER (PARTITION BY user_id) AS n FROM events)",
    "man": "man AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'SUCCESS' ELSE 'SANDWICH_LOOP' END AS category, toxic = 1 AS in_escrow FROM labels)",
    "lg": "lg AS (SELECT '[' || upper(event_type) || '] | ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | ' || user_id || ' | ' || props AS value, ts, user_id, event_id, event_type FROM events)",
    "ch": """spoken AS (SELECT *, idx - lag(idx) OVER (PARTITION BY doc ORDER BY idx) AS gap FROM fr WHERE speech),
num AS (SELECT *, sum(CASE WHEN gap > 16 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY idx) AS chunk FROM spoken),
ch AS (SELECT doc, chunk::BIGINT AS chunk, min(idx) * 480 AS start_s, CASE WHEN max(n) - 1 - max(idx) < 16 THEN max(n) ELSE max(idx) + 1 END * 480 AS end_s, max(n) * 480 AS total_s FROM num GROUP BY doc, chunk)""",
    "off": """pad AS (SELECT doc, chunk, greatest(start_s - 6400, 0) AS lo, least(end_s + 6400, total_s) AS hi FROM ch),
off_ AS (SELECT *, hi - lo AS length, coalesce(sum(hi - lo) OVER (PARTITION BY doc ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS merged_start FROM pad)""",
}
_NEEDS = {"tok": ["tr"], "con": ["tr", "tok"], "ch": ["fr"], "off": ["fr", "ch"]}


def sql(body: str, *names: str) -> str:
    """WITH the named views, then the body."""
    order: list[str] = []
    for n in names:
        order += [x for x in [*_NEEDS.get(n, []), n] if x not in order]
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n" + body


def tree(spark: SparkSession, d: str, root: str) -> None:
    """documents written as files of their own in a folder a source: of every dozen, one lies under review, one in a backup, one is
    rejected, one certified, one temporary, one empty, one blank and one no JSON."""
    n = F.col("doc_id") % 12
    folder = F.when(n == 0, "review/").when(n == 3, "backup/").otherwise("")
    name = F.concat(F.when(n == 1, "REJECTED_").otherwise(""), F.lit("t_"), F.col("doc_id").cast("string"), F.when(n == 4, ".json.tmp").otherwise(".json"))
    meta = F.struct(F.col("doc_id").cast("string").alias("video_id"), F.concat(F.lit("title "), "lang").alias("title"), (F.col("n_chars") / 4).alias("duration"), (n == 2).alias("omega_certified"))
    value = F.to_json(F.struct(meta.alias("metadata"), F.col("text").alias("full_text"), F.struct(F.when(n == 8, "GHOST").otherwise("SUCCESS").alias("category")).alias("audit")))
    content = F.when(n == 5, "").when(n == 6, " \n").when(n == 7, F.concat(F.lit("{"), value)).otherwise(value)
    files = table(spark, d, "documents").select(F.concat("source", F.lit("/"), folder, name).alias("path"), content.alias("content"))
    sinks.write_files(files, root).write.format("noop").mode("overwrite").save()
