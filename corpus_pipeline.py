"""The document pipeline: each stage is written as Parquet and reread as the next one's documents.

Defined results: documents with null or empty text pass every stage (they score as the toxicity model scores wordless text,
have one empty line, no shingles, no leaks and no pieces); null ids stay; of repeated rows one stays, as of any near copies;
an empty table gives an empty result with the same columns; columns besides doc_id and text pass through, but the last
stage's own columns (ENCODED) replace input columns of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, line_dedup, near_dedup, pieces, toxicity
from tessella.llm.common import stored, table


#: What the last stage adds.
ENCODED = ("n_ids", "ids", "ids_sha256", "same", "samples")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay; the model learns from the labels outside the held-out fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    clean = toxicity.score(docs, model).filter("score < 0.5")
    return clean.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that five or more documents share, but for the largest id's."""
    return line_dedup.dedup_lines(docs, counts=False)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dedup.dedup(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's piece ids, and its sampled segmentations with their piece ids (packed) and inclusion scores."""
    out = pieces.segment(docs, packed=True)
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in ("text", *ENCODED)], *ENCODED)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pieces", encode_pieces),
]

#: Trained models and sampled segmentations can't be expressed in SQL: tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
