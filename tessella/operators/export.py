"""Training records and export totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

MIN_WORDS, MIN_RATIO = 30, 0.35


def _measured(docs: DataFrame) -> DataFrame:
    """docs with the number of content words and their distinct share, the text split once a row."""
    counts = tx.let(tx.content(tx.words(F.col("full_text"))), lambda c: F.struct(F.size(c).alias("n"), F.when(F.size(c) > 0, F.size(F.array_distinct(c)) / F.size(c)).otherwise(F.lit(0.0)).alias("ratio")))
    return docs.withColumn("_m", counts)


def gate(text: Column, words: Column, ratio: Column) -> Column:
    """Non-empty, at least 30 content words, distinct share at least 0.35."""
    return (F.coalesce(text, F.lit("")) != "") & (words >= MIN_WORDS) & (ratio >= MIN_RATIO)


def gated(docs: DataFrame) -> DataFrame:
    """docs that pass the gate, with word_count and distinct_ratio. The measures come before the filter, which the optimiser would
    else compute again after it."""
    rows = _measured(docs).select(*docs.columns, F.explode(F.array("_m")).alias("_m"))
    return rows.filter(gate(F.col("full_text"), F.col("_m.n"), F.col("_m.ratio"))).select(*docs.columns, F.col("_m.n").cast("long").alias("word_count"), F.col("_m.ratio").alias("distinct_ratio"))


def spoken_segments(segments: Column, digits: int | None = 2) -> Column:
    """Segments with text, stripped; times rounded to so many digits (None: as they are)."""
    time = lambda c: c if digits is None else tx.round_half_even(c, digits)
    return F.filter(F.transform(segments, lambda s: F.struct(time(s["start"]).alias("start"), time(s["end"]).alias("end"), F.trim(s["text"]).alias("text"))), lambda s: s["text"] != "")


def training_records(docs: DataFrame, language: str = "ta", domain: str = "vedic_astrology") -> DataFrame:
    """docs (video_id, url, title, full_text, segments) that pass the gate, as training rows."""
    return gated(docs).select(
        F.col("video_id").alias("id"),
        tx.channel_of(F.col("url")).alias("source"),
        F.lit(language).alias("language"),
        F.lit(domain).alias("domain"),
        "title",
        F.coalesce(F.try_element_at("segments", F.lit(-1)).getField("end"), F.lit(0.0)).cast("long").alias("duration_s"),
        F.col("full_text").alias("text"),
        spoken_segments(F.col("segments")).alias("segments"),
        "word_count",
        F.struct(tx.round_half_even(F.col("distinct_ratio"), 3).alias("global_uwr"), tx.glued_count(F.col("full_text")).cast("long").alias("glued_hits")).alias("quality"),
    )


def totals(records: DataFrame, scanned: DataFrame) -> DataFrame:
    """Record, skip, word, segment and hour totals, and the share of characters exported."""
    r = records.agg(F.count("*").alias("records"), F.sum("word_count").alias("words"), F.sum(F.size("segments")).alias("segments"), (F.sum("duration_s") / 3600).alias("hours"), F.sum(F.length("text")).alias("chars"))
    s = scanned.agg(F.count("*").alias("n"), F.sum(F.length("full_text")).alias("all_chars"))
    return r.join(s).select("records", (F.col("n") - F.col("records")).alias("skipped"), "words", "segments", "hours", (F.col("chars") / F.greatest(F.col("all_chars").cast("double"), F.lit(0.01))).alias("size_ratio"))
