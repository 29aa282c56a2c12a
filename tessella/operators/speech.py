"""Speech frames to chunks, chunk padding and offsets, segment times back to the original clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FRAME, RATE, SILENT, PAD = 480, 16000, 16, 6400


def speech_chunks(frames: DataFrame, silent: int = SILENT, frame: int = FRAME) -> DataFrame:
    """(doc, chunk, start_s, end_s) from frames (doc, idx, speech, n_frames): a chunk ends after `silent` silent frames.

    The last chunk stays open to the end of the audio when fewer silent frames follow it.
    """
    by = Window.partitionBy("doc").orderBy("idx")
    spoken = frames.filter("speech").withColumn("gap", F.col("idx") - F.lag("idx").over(by))
    numbered = spoken.withColumn("chunk", F.sum(F.coalesce((F.col("gap") > silent).cast("int"), F.lit(0))).over(by))
    chunks = numbered.groupBy("doc", "chunk").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.max("n_frames").alias("n"))
    open_ = F.col("n") - 1 - F.col("hi") < silent
    return chunks.select("doc", "chunk", (F.col("lo") * frame).alias("start_s"), (F.when(open_, F.col("n")).otherwise(F.col("hi") + 1) * frame).alias("end_s"), (F.col("n") * frame).alias("total_s"))


def padded_offsets(chunks: DataFrame, pad: int = PAD) -> DataFrame:
    """(doc, chunk, lo, hi, length, merged_start): chunks padded within the audio, laid end to end."""
    before = Window.partitionBy("doc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    padded = chunks.withColumn("lo", F.greatest(F.col("start_s") - pad, F.lit(0))).withColumn("hi", F.least(F.col("end_s") + pad, F.col("total_s"))).withColumn("length", F.col("hi") - F.col("lo"))
    return padded.select("doc", "chunk", "lo", "hi", "length", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("merged_start"))


def remap(segments: DataFrame, offsets: DataFrame) -> DataFrame:
    """Segment times (doc, seg, at, until: merged samples) on the original clock: the first chunk that ends after `at`, or the last.

    Chunks lie end to end, so that is the last chunk that begins at or before `at` (the first one for times before it): an as-of
    pass over both tables together, which a document's rows go through once, in order, without a join.
    """
    chunk = F.struct(F.col("chunk").cast("long").alias("chunk"), F.col("lo").cast("long").alias("lo"), F.col("merged_start").cast("long").alias("from"))
    starts = offsets.select("doc", F.col("merged_start").cast("long").alias("time"), F.lit(0).alias("kind"), chunk.alias("c"), F.lit(None).alias("seg"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("until"))
    seg = segments.select("doc", F.greatest(F.col("at"), F.lit(0)).cast("long").alias("time"), F.lit(1).alias("kind"), F.lit(None).alias("c"), "seg", F.col("at").cast("long").alias("at"), F.col("until").cast("long").alias("until"))
    so_far = Window.partitionBy("doc").orderBy("time", "kind", "c.chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = starts.unionByName(seg).withColumn("c", F.last("c", ignorenulls=True).over(so_far)).filter((F.col("kind") == 1) & F.col("c").isNotNull())
    move = F.col("c.lo") - F.col("c.from")
    return hit.select("doc", "seg", F.col("c.chunk").alias("chunk"), (F.col("at") + move).alias("start_s"), (F.col("until") + move).alias("end_s"))


def frame_starts(length, frame: int = FRAME):
    """First samples of the full frames of a signal; a last partial frame is dropped."""
    return F.when(length >= frame, F.sequence(F.lit(0).cast("long"), (length - frame).cast("long"), F.lit(frame).cast("long"))).otherwise(F.array().cast("array<long>"))


def split_frames(samples, frame: int = FRAME):
    return F.transform(frame_starts(F.size(samples), frame), lambda i: F.slice(samples, (i + 1).cast("int"), frame))
