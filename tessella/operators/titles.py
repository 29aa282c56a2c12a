"""Titles met by documents: all pairs whose similarity is over a share, by a prefix filter."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from .repetition import TITLE_SHARE, TITLE_WINDOW, title_ratios

#: Copies of each title prefix, so that the documents of a frequent word go to as many tasks.
SALTS = 16


def title_pairs(docs: DataFrame, titles: DataFrame, width: int = TITLE_WINDOW, share: float = TITLE_SHARE) -> DataFrame:
    """(id, title_id, similarity) of docs (id, full_text) and titles (title_id, title): the best Jaccard similarity, over `share`, of a
    title's word set with that of a window of `width` tokens.

    A window over the share holds more than `share` of a title's words, so it holds one of its rarest few, whichever it lacks:
    documents and titles meet on those words only. What meets must share enough words in the whole document before its
    windows are measured. Document frequencies are counted before anything is joined; titles too long for a window and
    texts shorter than one have no pairs, nor have null ids.
    """
    tokens = docs.filter(F.col("id").isNotNull()).select("id", tx.words(F.col("full_text")).alias("ws")).filter(F.size("ws") >= width)
    words = tokens.select("id", F.explode(F.array_distinct(tx.content(F.col("ws")))).alias("word"))
    sets = titles.filter(F.col("title_id").isNotNull()).select("title_id", F.array_distinct(tx.content(tx.words(F.col("title")))).alias("wanted"))
    sets = sets.filter((F.size("wanted") > 0) & (F.size("wanted") * share < width))
    wanted = sets.select("title_id", F.explode("wanted").alias("word"))
    known = words.groupBy("word").agg(F.count("*").alias("df")).join(wanted.select("word").distinct(), "word", "left_semi")
    # a title has fewer words than fit a window over the share, so its list is short
    ranked = wanted.join(known, "word", "left").groupBy("title_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word"))).alias("words"))
    rare = F.slice("words", 1, F.size("words") - F.floor(F.size("words") * share).cast("int"))
    prefix = ranked.select("title_id", F.transform("words", lambda w: w["word"]).alias("wanted"), F.explode(rare).alias("w")).select("title_id", "wanted", F.col("w.word").alias("word"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = words.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS)))
    met = salted.join(prefix, ["word", "salt"]).groupBy("id", "title_id").agg(F.first("wanted").alias("wanted"))
    both = tokens.join(met, "id").filter(F.size(F.array_intersect(tx.content(F.col("ws")), "wanted")) > F.size("wanted") * share)
    return both.select("id", "title_id", _similarity(width)("ws", "wanted").alias("similarity")).filter(F.col("similarity") > share)


def _similarity(width: int):
    @F.arrow_udf(T.DoubleType())
    def similarity(tokens: pa.Array, wanted: pa.Array) -> pa.Array:
        rows = wanted.to_pylist()
        number = {t: i for i, t in enumerate(dict.fromkeys(map(tuple, rows)))}
        return pa.array(title_ratios(tokens, [list(t) for t in number], np.array([number[tuple(r)] for r in rows], np.int64), width))

    return similarity
