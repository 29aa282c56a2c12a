"""Glossary prompts: titles against a fixed, small term table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.glossary import CORE_TERMS, GLOSSARY
from ..functions.text import let, without_parentheses


def glossary_table(spark: SparkSession, glossary: dict[str, list[str]] | None = None) -> DataFrame:
    """(category, ord, term) in declared order."""
    n, rows = 0, []
    for category, terms in (glossary or GLOSSARY).items():
        for t in terms:
            rows.append((category, n, t))
            n += 1
    return spark.createDataFrame(rows, "category string, ord int, term string")


def flat_glossary(table: DataFrame) -> DataFrame:
    return table.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "term"))), lambda x: x["term"]), ", ").alias("terms"))


def prompts(titles: DataFrame, table: DataFrame, cap: int = 30) -> DataFrame:
    """titles (id, title) with the terms of matching categories, and single matching terms; at most cap, in glossary order.

    The glossary is a fixed table of 136 rows: its packed array is broadcast, and each title is matched in place. A title is
    lower-cased once; the categories' words are looked up once each, and terms only if their first character is in it.
    """
    clean = F.trim(without_parentheses(F.col("term")))
    term = table.select("ord", "term", clean.alias("clean"), F.substring(clean, 1, 1).alias("first"), F.split("category", "_").alias("keys"))
    packed = term.agg(F.array_sort(F.collect_list(F.struct("ord", "term", "clean", "first", "keys"))).alias("terms"))
    packed = packed.select("terms", F.array_distinct(F.flatten(F.filter(F.col("terms.keys"), lambda k: k.isNotNull()))).alias("keys"), F.array_distinct(F.col("terms.first")).alias("firsts"))
    met = titles.join(F.broadcast(packed))
    title = F.col("title")

    def hits(low: Column, keys: Column, firsts: Column) -> Column:
        named = lambda t: F.contains(title, t["clean"]) | ((F.length(t["clean"]) > 3) & F.contains(low, t["clean"]))
        return F.filter("terms", lambda t: F.arrays_overlap(t["keys"], keys) | (F.array_contains(firsts, t["first"]) & named(t)))

    def met_terms(low: Column) -> Column:
        keys = F.filter("keys", lambda k: F.contains(low, k))
        firsts = F.filter("firsts", lambda c: F.contains(title, c) | F.contains(low, c))
        return let(keys, lambda k: let(firsts, lambda f: hits(low, k, f)))

    chosen = F.slice(F.array_distinct(F.transform(let(F.lower("title"), met_terms), lambda t: t["term"])), 1, cap)
    prompt = lambda c: F.struct(F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise(F.lit(CORE_TERMS)).alias("prompt"), F.size(c).alias("n_terms"))
    return met.select("id", let(chosen, prompt).alias("p")).select("id", "p.prompt", "p.n_terms")
