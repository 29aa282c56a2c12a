"""Names that contain one of many ids, without testing each name against each id."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths of ids that are looked up by their substrings: the most frequent ones.
LENGTHS = 4
#: Ids of other lengths searched in one pass over the names.
BLOCK = 1 << 18


def names_with_ids(names: DataFrame, ids: DataFrame) -> DataFrame:
    """(key, id), each once, of names (key, name) and ids (id) where the name contains the id.

    Most lists hold ids of one length or a few. For those lengths the distinct substrings of each name are joined with the
    ids as any other key, so neither side is broadcast and a substring of many names is split as any hot key. Ids of all other
    lengths are dealt into blocks, and each block goes over the names in Arrow batches as an Aho-Corasick automaton. Null
    names and null or empty ids take no part; an id that repeats counts once.
    """
    ids = ids.filter(F.length("id") > 0).select("id").distinct()
    names = names.filter(F.col("name").isNotNull()).select("key", "name")
    by_length = ids.groupBy(F.length("id").alias("n")).count()
    usual = [r.n for r in by_length.orderBy(F.desc("count"), "n").limit(LENGTHS).collect()]
    if not usual:
        return names.select("key", F.lit("").alias("id")).limit(0)
    out = names.select("key", F.explode(F.array_distinct(F.concat(*[_substrings(n) for n in usual]))).alias("id")).join(ids.filter(F.length("id").isin(usual)), "id").select("key", "id")
    rest = ids.filter(~F.length("id").isin(usual))
    blocks = -(-rest.count() // BLOCK)
    for n in range(blocks):
        out = out.unionByName(_searched(names, rest.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n)))
    return out.distinct()


def _substrings(n: int) -> Column:
    """All substrings of n characters of the name."""
    size = F.length("name")
    every = F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substr(F.col("name"), i, F.lit(n)))
    return F.when(size >= n, every).otherwise(F.array().cast("array<string>"))


def _searched(names: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs with a block of ids, of bounded number, by one pass over the names."""
    block = names.sparkSession.sparkContext.broadcast([r.id for r in ids.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        index = ahocorasick.Automaton()
        for i in block.value:
            index.add_word(i, i)
        index.make_automaton()
        for b in batches:
            found = [(k, i) for k, name in enumerate(b.column("name").to_pylist()) for i in {i for _, i in index.iter(name)}]
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array([k for k, _ in found], pa.int64())), pa.array([i for _, i in found], pa.string())], ["key", "id"])

    return names.mapInArrow(run, f"key {names.schema['key'].dataType.simpleString()}, id string")
