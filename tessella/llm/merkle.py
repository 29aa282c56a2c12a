"""Merkle manifest of a dataset: leaves, subtree roots of groups, one root over them, and an inclusion proof of every row.

A leaf is the SHA-256 of a row's columns; within a group the leaves are in the order of a key. Every level of all groups'
trees is one equijoin of the nodes with themselves: each node is sent to the computed indices of its siblings (index XOR 1
in a binary tree, else its run's other slots by offset), and the rows of slot zero, which then hold their run, emit the
parents. The groups' roots are the leaves of a last tree of the same kind. Proofs are put together from the top down, by
joins of children with their parents, which have at most `fanout` of them, so no group is a hot key.

Places within a group come from a range-sorted, written table and the row counts of its parts: no group is sorted or
numbered in one task. Only digests are shuffled, never texts; the driver learns the number of levels and nothing else.

Defined results: a null value is "-" in a leaf, an empty one "0:"; a null group is a group of its own, before all others; null
keys come first in their group; rows that share a key are ordered by their digests, and repeated rows are leaves each;
a lone leaf is its group's root, and a lone group's root the root; a row without any sibling has the proof of the empty
text; an empty table gives an empty result; other columns are not read; a very long text is hashed where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Hexadecimal digits of a digest.
_HEX = 64


def digest(values: dict[str, Column]) -> Column:
    """SHA-256 (binary) of the values end to end: "-" for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for v in values.values():
        s = v.cast("string")
        parts.append(F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def siblings(index: Column, count: Column, fanout: int) -> Column:
    """Indices of the other nodes in the run of `index`, of `count` nodes in all."""
    if fanout == 2:
        others = F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    else:
        slot = index % fanout
        others = F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda d: index - slot + (slot + d) % fanout)
    return F.filter(others, lambda i: i < count)


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes (tree, index, count, digest, ...) with `slot` and `others`: the digests of their siblings, in order."""
    sent = nodes.select("tree", F.explode(siblings(F.col("index"), F.col("count"), fanout)).alias("index"), F.struct(F.col("index").alias("i"), F.col("digest").alias("d")).alias("sibling"))
    rest = [c for c in nodes.columns if c not in ("tree", "index")]
    # the exchange that brings the siblings to a node serves the grouping too
    met = nodes.join(sent, ["tree", "index"], "left").groupBy("tree", "index").agg(*[F.first(c).alias(c) for c in rest], F.array_sort(F.collect_list("sibling")).alias("run"))
    return met.select("tree", "index", *rest, (F.col("index") % fanout).cast("int").alias("slot"), F.reduce("run", F.lit(b""), lambda a, x: F.concat(a, x["d"])).alias("others"))


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    whole = F.unhex(F.sha2(F.concat(text_of(F.col("digest")), text_of(F.col("others"))), 256))
    return level.filter("slot = 0").select(
        "tree",
        F.floor(F.col("index") / fanout).alias("index"),
        F.ceil(F.col("count") / fanout).alias("count"),
        F.when(F.col("count") == 1, F.col("digest")).otherwise(whole).alias("digest"),  # a tree's root stays as it is
    )


def _climb(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels below the roots, and the roots: a node for each tree."""
    most = nodes.agg(F.max("count")).first()[0] or 0
    levels = []
    while most > 1:
        levels.append(stored(_level(nodes, fanout), f"{name}{len(levels)}"))
        nodes, most = _parents(levels[-1], fanout), -(-most // fanout)
    return levels, nodes


def _descend(levels: list[DataFrame], roots: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with `path`, the (slot, others) from there to the top, and the roots' columns subroot and root."""
    above = roots
    for level in reversed(levels):
        step = F.when(F.col("count") > 1, F.array(F.struct("slot", "others"))).otherwise(F.array().cast("array<struct<slot:int,others:binary>>"))
        here = level.withColumns({"_step": step, "_up": F.floor(F.col("index") / fanout)}).drop("slot", "others", "count").withColumnRenamed("digest", "leaf")
        carried = above.select("tree", F.col("index").alias("_up"), F.col("path").alias("_path"), *[c for c in above.columns if c in ("subroot", "root") and c not in here.columns])
        above = here.join(carried, ["tree", "_up"]).withColumn("path", F.concat("_step", "_path")).drop("_step", "_up", "_path")
    return above


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", key: str = "doc_id", fanout: int = FANOUT, shown: dict[str, Column] | None = None) -> DataFrame:
    """(key, group, index, leaf, subroot, root, path, presented) of every row; digests are hexadecimal text.

    `path` holds (slot, others) of each level from the leaf to the root. `presented` is the leaf of the row as somebody else
    shows it: with the columns of `shown` in place of the row's own.
    """
    own = {c: F.col(c) for c in columns}
    leaves = docs.select(F.col(group).alias("g"), F.col(key).alias("k"), digest(own).alias("digest"), digest(own | (shown or {})).alias("presented"))
    rows, starts = ranked(leaves, ["g"], ["k", "digest"], "leaves")
    sizes = starts.groupBy("g").agg(F.sum("_rows").alias("count"))
    groups, firsts = ranked(sizes, [], ["g"], "groups")  # groups get numbers by their order
    trees = stored(groups.join(firsts, "_part").select("g", (F.col("_at") + F.col("_shift")).alias("tree"), "count"), "trees")
    starts = starts.join(trees.withColumnRenamed("g", "tg"), F.col("g").eqNullSafe(F.col("tg"))).select("tg", F.col("_part").alias("tp"), "_shift", "tree", "count")
    nodes = rows.join(starts, F.col("g").eqNullSafe(F.col("tg")) & (F.col("_part") == F.col("tp"))).select("tree", (F.col("_at") + F.col("_shift")).alias("index"), "count", "digest", "g", "k", "presented")

    levels, subroots = _climb(nodes, fanout, "merkle")
    subroots = stored(subroots.select("tree", F.col("digest").alias("subroot")), "subroots")
    # the last tree: the groups' roots by number
    every = trees.agg(F.count("*").alias("count"))
    tops, root = _climb(subroots.join(F.broadcast(every)).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), "count", F.col("subroot").alias("digest"), "subroot"), fanout, "merkle-top")
    none = F.array().cast("array<struct<slot:int,others:binary>>").alias("path")
    root = root.select("tree", "index", F.col("digest").alias("root"), none)
    over = _descend(tops, root, fanout) if tops else root.withColumn("subroot", F.col("root"))
    over = stored(over.select(F.col("index").alias("tree"), F.lit(0).cast("long").alias("index"), "subroot", "root", "path"), "roots")
    out = _descend(levels, over, fanout) if levels else nodes.drop("count").join(over, ["tree", "index"]).withColumnRenamed("digest", "leaf")
    return out.select(F.col("k").alias("key"), F.col("g").alias("group"), "index", *[text_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root", "presented")], "path")


def proof(path: Column) -> Column:
    """SHA-256 of all siblings' digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: text_of(s["others"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def up(below: Column, step: Column) -> Column:
        others = text_of(step["others"])
        return F.sha2(F.concat(F.substr(others, F.lit(1), step["slot"] * _HEX), below, F.substr(others, step["slot"] * _HEX + 1)), 256)

    return F.reduce(path, leaf, up)
