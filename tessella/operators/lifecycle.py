"""Document lifecycle: keyed state, routing, retries, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from .repetition import denoise

#: Retry parameters by diagnosed failure; the last row is the default.
RETRIES = [
    ("SILENCE_LOOPING", True, False, "0.0", "VAD + context-free"),
    ("LOW_CONFIDENCE", True, True, "0.0", "Title-primed context"),
    ("STRUCTURAL_DECAY", True, False, "0.2", "Thermal variance + context-free"),
    ("PHONETIC_GLUING", True, False, "0.0,0.2,0.4", "Multi-temp fallback sweep"),
    (None, True, False, "0.0", "Generic context-free retry"),
]


def latest_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key: an aggregate, so hot keys combine before the shuffle and nothing is sorted."""
    whole = F.struct(*[c for c in df.columns if c != key])
    best = df.groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("r"))
    return best.select(*[F.col(key) if c == key else F.col("r").getField(c).alias(c) for c in df.columns])


def upsert(current: DataFrame, changes: DataFrame, key: str, *order: str) -> DataFrame:
    """A new snapshot: the last change of each key, else what was there."""
    new = latest_by_key(changes, key, *order)
    return current.join(new.select(key), key, "left_anti").select(*current.columns).unionByName(new.select(*current.columns))


def new_only(listing: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return listing.join(known.select(key).distinct(), key, "left_anti")


def long_enough(duration: Column, least: float = 90.0) -> Column:
    """Entries of unknown (0 or null) duration stay."""
    d = F.coalesce(duration, F.lit(0.0))
    return ~((d > 0) & (d < least))


def apply_corrections(segments: DataFrame, corrections: DataFrame) -> DataFrame:
    """Segments (doc, id, text) with the last correction (doc, id, ord, corrected) of each."""
    last = corrections.groupBy("doc", "id").agg(F.max_by("corrected", "ord").alias("corrected"))
    return segments.join(last, ["doc", "id"], "left").withColumn("text", F.coalesce("corrected", "text")).drop("corrected")


def reject_route(category: Column, in_escrow: Column) -> Column:
    """Where a rejected document goes; null if it stays."""
    return F.when(in_escrow | (category == "SUCCESS"), F.lit(None)).when(category == "GHOST", "NULL_HARVEST").otherwise("LOOP_HARVEST")


def reject_name(category: Column, name: Column) -> Column:
    return F.when(category == "GHOST", name).otherwise(F.concat(F.lit("REJECTED_"), name))


def certify(score: Column, verdict: Column, reason: Column) -> Column:
    return F.when(reason.isin("API_ERROR", "PARSE_ERROR"), "SKIPPED").when((score >= 0.85) & (verdict == "CERTIFIED"), "CERTIFIED").otherwise("REPAIR")


def retry_parameters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RETRIES, "failure_reason string, use_vad boolean, with_context boolean, temperatures string, strategy string")


def suggest_retry(verdicts: DataFrame) -> DataFrame:
    """verdicts with retry parameters, the default for other reasons."""
    table = retry_parameters(verdicts.sparkSession)
    out = verdicts.join(F.broadcast(table.filter("failure_reason is not null")), "failure_reason", "left")
    for c, v in zip(("use_vad", "with_context", "temperatures", "strategy"), RETRIES[-1][1:], strict=True):
        out = out.withColumn(c, F.coalesce(c, F.lit(v)))
    return out


def final_attempt(attempts: DataFrame, limit: int = 2) -> DataFrame:
    """The attempt that counts, of (doc, attempt, looped, category): the first that is clean, else the last within the limit."""
    ok = ~F.col("looped") & (F.col("category") == "SUCCESS")
    tried = attempts.filter(F.col("attempt") <= limit)
    pick = F.coalesce(F.min(F.when(ok, F.col("attempt"))), F.max("attempt"))
    best = tried.groupBy("doc").agg(pick.alias("attempt"), F.count("*").alias("passes"))
    return tried.join(best, ["doc", "attempt"]).withColumn("category", F.when(F.col("looped"), "HALLUCINATION_LOOP").otherwise(F.col("category")))


def retry_results(attempts: DataFrame) -> DataFrame:
    """(doc, full_text, segments) of second attempts (doc, video_id, problem, text, segments), loops removed from the text and from
    each segment; null where the attempt failed (a problem, or no id)."""
    failed = F.col("video_id").isNull() | (F.col("video_id") == "") | F.col("problem").isNotNull()
    texts = denoise(attempts.withColumn("_failed", failed), "text", "full_text")
    parts = attempts.filter(~failed).select("doc", F.posexplode("segments").alias("pos", "s")).select("doc", "pos", "s", F.col("s.text").alias("t"))
    parts = denoise(parts, "t", "clean").select("doc", F.struct("pos", F.col("s").withField("text", F.coalesce("clean", F.lit(""))).alias("s")).alias("x"))
    segments = parts.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]).alias("found"))
    out = texts.select("doc", "_failed", "full_text", F.col("segments").alias("was")).join(segments, "doc", "left")
    return out.select("doc", F.when(~F.col("_failed"), F.coalesce("full_text", F.lit(""))).alias("full_text"), F.when(~F.col("_failed"), F.coalesce("found", "was")).alias("segments"))


def judge_route(verdict: Column, golden: Column, original: Column) -> Column:
    """(route, text, original_len, golden_len) of a consensus."""
    take = F.coalesce((verdict != "STABLE") & (F.length(golden) > 50), F.lit(False))
    return F.struct(
        F.when(verdict == "STABLE", "CERTIFIED").when(take, "REPLACED").otherwise("KEPT").alias("route"),
        F.when(take, golden).otherwise(original).alias("text"),
        F.when(take, F.length(original)).alias("original_len"),
        F.when(take, F.length(golden)).alias("golden_len"),
    )


def stop_after_failures(scan: DataFrame, by: str, order: str, failed: str, limit: int = 5) -> DataFrame:
    """Rows of each scan up to and with the one that makes `limit` failures in a row; `streak` counts them."""
    w = Window.partitionBy(by).orderBy(order)
    runs = scan.withColumn("_run", F.sum((~F.col(failed)).cast("int")).over(w))
    streak = runs.withColumn("streak", F.sum(F.col(failed).cast("long")).over(Window.partitionBy(by, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    stopped = F.sum(F.when(F.col("streak") == limit, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return streak.withColumn("_stopped", F.coalesce(stopped, F.lit(0))).filter("_stopped = 0").drop("_run", "_stopped")


def audit_sample(tokens: Column, text: Column) -> Column:
    """The whole text up to 450 tokens; else labelled first, middle and last 150."""
    n = F.size(tokens)
    cut = lambda lo: F.array_join(F.slice(tokens, lo + 1, 150), " ")
    mid = F.greatest(F.lit(0), F.floor(n / 2).cast("int") - 75)
    long = F.concat(F.lit("[OPENING]\n"), cut(F.lit(0)), F.lit("\n\n[MIDDLE]\n"), cut(mid), F.lit("\n\n[ENDING]\n"), cut(n - 150))
    return F.when(n <= 450, text).otherwise(long)


def tumbling(position: Column, size: int = 10) -> Column:
    return F.floor(position / size).cast("long")


def stamp_certified(metadata: Column, at: Column, notes: Column) -> Column:
    return metadata.withField("omega_certified", F.lit(True)).withField("omega_timestamp", at).withField("omega_merge_notes", notes)


def stamp_quarantine(metadata: Column, reason: Column) -> Column:
    return metadata.withField("omega_quarantine_reason", reason)


def prefer(df: DataFrame, key: str, value: str, priority: str) -> DataFrame:
    """The value with the least priority number of each key."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, priority).alias(value))


def running_eta(scan: DataFrame, by: str, order: str, elapsed: str) -> DataFrame:
    """Mean seconds so far times what remains, per scan."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.count("*").over(Window.partitionBy(by))
    done = F.count("*").over(w)
    return scan.withColumn("done", done).withColumn("eta", F.sum(elapsed).over(w) / done * (total - done))


def restarts(polls: DataFrame, by: str, order: str, down: str, limit: int = 5) -> DataFrame:
    """Lifetime restart counter at each poll; it stops at the limit and never resets."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return polls.withColumn("restarts", F.least(F.sum(F.col(down).cast("long")).over(w), F.lit(limit).cast("long")))


def sample_words(tokens: Column, n: int) -> Column:
    return F.array_join(tx.head(tokens, n), " ")
