"""Column functions over text and tokens. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything the token split treats as white space (more than Java's \s).
SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"
EDGES = ".,?!;:-"

# Suffix pairs, tried in this order.
SUFFIXES = [
    ("பற்றிய", "பற்றி"), ("என்ற", "என்று"), ("ஆன", "ஆக"),
    ("இல்", "இல்லை"), ("உள்ள", "உள்ளது"), ("செய்த", "செய்து"),
    ("வரும்", "வர"), ("இருக்கும்", "இருக்கு"), ("பண்ண", "பண்ணு"),
]


def let(value: Column, body) -> Column:
    """body of a value that is computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """White-space tokens, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def strip(word: Column) -> Column:
    """A token without the edge punctuation."""
    return F.btrim(word, F.lit(EDGES))


def content(tokens: Column) -> Column:
    """Tokens stripped, without those that were all punctuation."""
    return F.filter(F.transform(tokens, strip), lambda w: w != "")


def distinct_ratio(tokens: Column) -> Column:
    """Distinct share of the content tokens; 0.0 if there are none."""
    return let(content(tokens), lambda c: F.when(F.size(c) > 0, F.size(F.array_distinct(c)) / F.size(c)).otherwise(F.lit(0.0)))


def raw_ratio(tokens: Column) -> Column:
    """Distinct share of the tokens as they are."""
    return F.when(F.size(tokens) > 0, F.size(F.array_distinct(tokens)) / F.size(tokens)).otherwise(F.lit(0.0))


def tail(tokens: Column, n: int = 50) -> Column:
    return F.when(F.size(tokens) > n, F.slice(tokens, -n, n)).otherwise(tokens)


def head(tokens: Column, n: int) -> Column:
    return F.slice(tokens, 1, n)


def cut_words(text: Column, n: int = 2000) -> Column:
    """(head, suffix): a text of more than n tokens cut after them, both parts joined by single blanks; else the text and ''."""
    parts = lambda w: F.when(F.size(w) > n, F.struct(F.array_join(F.slice(w, 1, n), " ").alias("head"), F.array_join(F.slice(w, n + 1, F.size(w)), " ").alias("suffix"))).otherwise(F.struct(text.alias("head"), F.lit("").alias("suffix")))
    return let(words(text), parts)


def chars_per_second(text: Column, segments: Column) -> Column:
    """Code points over the last segment's end (by position); 0.0 without one or where it isn't positive."""
    end = F.try_element_at(segments, F.lit(-1)).getField("end")
    return F.when(end > 0, F.length(text) / end).otherwise(F.lit(0.0))


def glued_count(text: Column) -> Column:
    """Runs of five or more equal characters within a line."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(?d)(.)\1{4,}"), F.lit(0)))


def char_run(text: Column) -> Column:
    """Eleven or more equal characters in a row, blanks left out."""
    return F.replace(text, F.lit(" "), F.lit("")).rlike(r"(?d)(.)\1{10,}")


def period_loop(text: Column) -> Column:
    """A block of two to six characters five or more times in a row, blanks left out."""
    return F.replace(text, F.lit(" "), F.lit("")).rlike(r"(?d)(.{2,6})\1{4,}")


def severe_loop(text: Column) -> Column:
    return F.coalesce(char_run(text) | period_loop(text), F.lit(False))


def deglue(text: Column) -> Column:
    """Blocks of 2 to 20 characters repeated three or more times, once."""
    return F.regexp_replace(text, r"(?d)(.{2,20}?)\1{2,}", "$1")


def _suffix(s: Column) -> Column:
    out = None
    for old, new in SUFFIXES:
        changed = F.concat(F.substring(s, F.lit(1), F.length(s) - len(old)), F.lit(new))
        out = F.when(s.endswith(old), changed) if out is None else out.when(s.endswith(old), changed)
    return out.otherwise(s)


def normal_suffix(word: Column) -> Column:
    """A stripped word with the first matching suffix replaced."""
    return let(strip(word), _suffix)


def cap_runs(tokens: Column) -> Column:
    """At most two of a run of tokens that are equal once stripped."""
    run = lambda s, i: (i >= 2) & (F.get(s, i) == F.get(s, i - 1)) & (F.get(s, i - 1) == F.get(s, i - 2))
    return let(F.transform(tokens, strip), lambda s: F.filter(tokens, lambda _, i: ~F.coalesce(run(s, i), F.lit(False))))


def drop_variants(tokens: Column) -> Column:
    """Tokens but those whose normal form is that of the token before (unless it is empty)."""
    forms = F.transform(F.transform(tokens, strip), _suffix)
    return let(forms, lambda f: F.filter(tokens, lambda _, i: (i == 0) | (F.get(f, i) != F.get(f, i - 1)) | (F.get(f, i) == "")))


def channel_of(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, "@([^/]+)", 1), F.lit("")), F.lit("unknown"))


def clean_channel(url: Column) -> Column:
    """The harvest's variant: letters, digits, blanks, - and _ only."""
    raw = F.nullif(F.regexp_extract(url, "@([^/]+)", 1), F.lit(""))
    return F.coalesce(F.regexp_replace(raw, r"[^\p{L}\p{N} _-]", ""), F.lit("Unknown_Channel"))


def last_channel(url: Column) -> Column:
    """After the last @, before the next slash."""
    return F.substring_index(F.substring_index(url, "@", -1), "/", 1)


def file_name(title: Column, video_id: Column) -> Column:
    safe = F.trim(F.regexp_replace(title, r"[^\p{L}\p{N} _-]", ""))
    return F.concat(F.substring(safe, 1, 100), F.lit("_"), video_id, F.lit(".json"))


def year_of(title: Column) -> Column:
    return F.coalesce(F.regexp_extract(title, "202[0-9]", 0).try_cast("int"), F.lit(0))


def without_parentheses(text: Column) -> Column:
    return F.regexp_replace(text, r"(?d)\(.*?\)", "")


def caption_text(text: Column, limit: int = 200) -> Column:
    """Caption lines without headers, notes, cues, counters and tags; the first words of them."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    spoken = F.filter(lines, lambda x: (x != "") & ~x.startswith("WEBVTT") & ~x.startswith("NOTE") & ~x.contains("-->") & ~x.rlike("^[0-9]+$"))
    plain = F.filter(F.transform(spoken, lambda x: F.regexp_replace(x, "<[^>]+>", "")), lambda x: x != "")
    return F.array_join(head(words(F.array_join(plain, " ")), limit), " ")


def reply_object(reply: Column, ddl: str) -> Column:
    """A model's JSON object: the whole reply, else the text between its outermost braces, else null."""
    whole = F.from_json(reply, ddl)
    inner = F.from_json(F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit("")), ddl)
    usable = lambda s: F.coalesce(*[s.getField(f.split()[0]).cast("string") for f in ddl.split(", ")]).isNotNull()
    return F.when(usable(whole), whole).when(usable(inner), inner)


def reply_corrections(reply: Column, ddl: str) -> Column:
    """A model's list of corrections; items without an id or a correction are left out."""
    found = F.from_json(F.nullif(F.regexp_extract(reply, r"(?s)\[\s*\{.*?\}\s*\]", 0), F.lit("")), ddl)
    return F.coalesce(F.filter(found, lambda x: x["id"].isNotNull() & x["corrected"].isNotNull()), F.array().cast(ddl))


def realtime_factor(duration: Column, seconds: Column) -> Column:
    return F.when((duration > 0) & (seconds > 0), duration / seconds)


def frames_per_second(seconds: Column, elapsed: Column, rate: int = 16000, frame: int = 160) -> Column:
    return F.try_divide(seconds * rate, elapsed) / frame


def harvest_days(rtf: Column, videos: int = 7000, minutes: float = 35.0) -> Column:
    """(days, hours left) for so many videos at a real-time factor."""
    hours = F.lit(videos * minutes) / rtf / 60
    return F.struct(F.floor(hours / 24).alias("days"), (hours - F.floor(hours / 24) * 24).alias("hours"))


def thermal_level(level: Column, cpu_limit: Column) -> Column:
    """A reported level, else by the CPU limit in percent."""
    return F.coalesce(level, F.when(cpu_limit < 70, 3).when(cpu_limit < 85, 2).when(cpu_limit < 95, 1).otherwise(0))


def monitor_thermal(cpu_limit: Column) -> Column:
    """The monitor's cut-offs differ."""
    return F.when(cpu_limit < 70, "throttled").when(cpu_limit < 90, "warm").otherwise("nominal")


def health_alerts(throttled: Column, memory_pct: Column, disk_gb: Column, rss_mb: Column) -> Column:
    """Names of the alerts that hold."""
    return F.filter(
        F.array(F.when(throttled, "thermal"), F.when(memory_pct > 90, "memory"), F.when((disk_gb >= 0) & (disk_gb < 5), "disk"), F.when(rss_mb > 12000, "rss")),
        lambda x: x.isNotNull(),
    )


def age_icon(value: Column, low: int, high: int) -> Column:
    return F.when(value < low, "green").when(value < high, "yellow").otherwise("red")


def apply_discard(reply: Column, original: Column, suffix: Column | None = None) -> Column:
    """A corrector's reply: the discard mark alone, else the reply if it is longer than 20, else the original."""
    mark = F.lit("[DISCARD]")
    said = F.trim(reply)
    full = said if suffix is None else F.when(F.coalesce(suffix, F.lit("")) != "", F.concat(said, F.lit(" "), suffix)).otherwise(said)
    return F.when(said.contains("[DISCARD]"), mark).when(F.length(said) > 20, full).otherwise(original)


def sentry_status(corrected: Column, raw: Column) -> Column:
    return F.when((F.coalesce(corrected, F.lit("")) != "") & ~corrected.eqNullSafe(raw), "CORRECTED").otherwise("RAW_ONLY")


def oracle_reply(reply: Column, strict: bool = False) -> Column:
    """VALID if the reply holds the word; strict: if it is the word."""
    said = F.upper(F.trim(reply))
    return F.when((said == "VALID") if strict else said.contains("VALID"), "VALID").otherwise("HALLUCINATION")


def is_primary_source(title: Column) -> Column:
    return F.lower(title).contains("aditya") | F.lower(title).contains("guruji")


def in_escrow(path: Column) -> Column:
    return path.contains("LOOP_HARVEST") | path.contains("NULL_HARVEST")


def backoff(failures: Column) -> Column:
    return F.least(F.lit(20) * F.pow(F.lit(2.0), failures), F.lit(160.0)).cast("long")


def config_kind(config: Column) -> Column:
    """A model config's quantisation, depth and family, from its keys."""
    keys = F.json_object_keys(config)
    layers = F.get_json_object(config, "$.n_audio_layer").try_cast("int")
    return F.struct(
        (F.get_json_object(config, "$.quantization.bits").try_cast("int") == 4).alias("four_bit"),
        F.when(layers == 32, "large").when(layers == 4, "turbo").otherwise("other").alias("depth"),
        F.when(F.arrays_overlap(keys, F.array(F.lit("n_mels"), F.lit("n_audio_state"))), "native").when(F.arrays_overlap(keys, F.array(F.lit("d_model"), F.lit("encoder_layers"))), "converted").otherwise("unknown").alias("format"),
    )


def pcm16(samples: Column) -> Column:
    """Float samples as 16-bit numbers, truncating."""
    return F.transform(samples, lambda x: (x * 32767).cast("int").cast("short"))


def peak_normal(samples: Column) -> Column:
    """Samples divided by their largest magnitude, if that isn't zero."""
    peak = F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double"))))
    return F.transform(samples, lambda x: F.when(peak > 0, x.cast("double") / peak).otherwise(x.cast("double")))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def round_half_even(x: Column, digits: int) -> Column:
    """A double rounded by its exact binary value, exact ties to the even digit: 2.675 to 2.67, 0.125 to 0.12.

    The product with the power of ten is taken with its rounding error (x split in halves whose products are exact), so a
    product that looks like a tie is decided by the error's sign. Where the power takes a number beyond 2**53 the number's own
    spacing is coarser than the digits, and it stays.
    """
    scale = float(10**digits)

    def exact(v: Column) -> Column:
        head = v * 134217729.0 - (v * 134217729.0 - v)
        p = v * scale
        error = (head * scale - p) + (v - head) * scale
        whole = F.rint(p)
        off = p - whole
        up, down = (off == 0.5) & (error > 0), (off == -0.5) & (error < 0)
        return F.when(up, whole + 1).when(down, whole - 1).otherwise(whole) / scale

    return F.when(F.abs(x * scale) < 2.0**53, exact(x)).otherwise(x)
