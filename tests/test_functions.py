"""Column functions on hand-made edge rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tessella.functions import text as tx


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text", ["", "   ", "a b", " a b\u0085c\x1cd ", "... --", None, "x\n\ty"])
def test_words_split_as_python_does(spark, text):
    assert one(spark, text, tx.words) == (text or "").split()


@pytest.mark.parametrize(("text", "want"), [("", 0.0), ("... -", 0.0), ("a b a", 2 / 3), ("a, a. A", 2 / 3), ("a", 1.0)])
def test_distinct_ratio(spark, text, want):
    assert one(spark, text, lambda c: tx.distinct_ratio(tx.words(c))) == want


@pytest.mark.parametrize(("text", "want"), [("aaaa", 0), ("aaaaa", 1), ("aaaaa bbbbbb", 2), ("aaa\naaa", 0), ("\n\n\n\n\n\n", 0)])
def test_glued_count(spark, text, want):
    assert one(spark, text, tx.glued_count) == want


@pytest.mark.parametrize("text", ["a" * 10, "a" * 11, "a a a a a a a a a a a", "07 07 07 07", "07 07 07 07 07", "ab" * 5, "abcdefg" * 5, None, "", "ab\nab\nab\nab\nab"])
def test_severe_loop(spark, text):
    s = (text or "").replace(" ", "")
    assert one(spark, text, tx.severe_loop) == bool(re.search(r"(.)\1{10,}", s) or re.search(r"(.{2,6})\1{4,}", s))


def test_deglue_keeps_its_known_effect_on_digits(spark):
    assert one(spark, "1000000", tx.deglue) == re.sub(r"(.{2,20}?)\1{2,}", r"\1", "1000000")


@pytest.mark.parametrize(("word", "want"), [("பற்றிய", "பற்றி"), ("என்ற,", "என்று"), ("abc.", "abc"), ("...", "")])
def test_normal_suffix(spark, word, want):
    assert one(spark, word, tx.normal_suffix) == want


def test_word_runs(spark):
    assert one(spark, "a a a b, b b c", lambda c: tx.cap_runs(tx.words(c))) == ["a", "a", "b,", "b", "c"]
    assert one(spark, "a a. b ... ... c", lambda c: tx.drop_variants(tx.words(c))) == ["a", "b", "...", "...", "c"]


def test_channels(spark):
    assert one(spark, "https://x/@one@two/videos", tx.channel_of) == "one@two"
    assert one(spark, "https://x/@one@two/videos", tx.last_channel) == "two"
    assert one(spark, "https://x/", tx.channel_of) == "unknown"
    assert one(spark, "https://x/@a.b!/v", tx.clean_channel) == "ab"


def test_replies(spark):
    ddl = "verdict STRING, score DOUBLE"
    assert one(spark, 'ok ```{"verdict": "A", "score": 1}```', lambda c: tx.reply_object(c, ddl)).verdict == "A"
    assert one(spark, "nothing", lambda c: tx.reply_object(c, ddl)) is None
    got = one(spark, 'x [ {"id": 1, "corrected": "a"}, {"id": 2} ] y', lambda c: tx.reply_corrections(c, "array<struct<id: int, original: string, corrected: string>>"))
    assert [(r.id, r.corrected) for r in got] == [(1, "a")]
    assert one(spark, "INVALID", tx.oracle_reply) == "VALID"
    assert one(spark, "INVALID", lambda c: tx.oracle_reply(c, strict=True)) == "HALLUCINATION"


def test_captions(spark):
    text = "WEBVTT\n\n1\n00:00 --> 00:01\n<c>Hello</c> there\nNOTE x\n 42 \nend"
    assert one(spark, text, tx.caption_text) == "Hello there end"
