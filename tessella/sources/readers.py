"""Sources. Schemas are declared; unreadable files are classified, never deleted."""

from __future__ import annotations

import codecs
import contextlib
import json
import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import caption_text
from ..operators.lifecycle import prefer
from ..schemas import MANIFEST_ENTRY, REPORT, TRANSCRIPT
from .shared import work_path


def _files(spark: SparkSession, root: str) -> DataFrame:
    raw = spark.read.schema(f"{TRANSCRIPT}, _corrupt string").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(root)
    return raw.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_modification_time").alias("modified"))


def _folder(path: str = "path"):
    return F.regexp_replace(path, "[^/]*$", "")


def scan_docs(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """Transcripts not yet certified, outside review folders; the manifest itself is no transcript. A limit takes the first paths."""
    docs = _files(spark, root).filter(~_folder().contains("review") & F.col("_corrupt").isNull() & (F.col("file_name") != "manifest.json"))
    docs = docs.filter(~F.coalesce("metadata.omega_certified", F.lit(False)))
    return docs if limit is None else docs.orderBy("path").limit(limit)


def scan_export(spark: SparkSession, root: str) -> DataFrame:
    return scan_docs(spark, root).filter(~F.col("file_name").startswith("REJECTED_"))


def scan_rebuild(spark: SparkSession, root: str) -> DataFrame:
    """Manifest entries rebuilt from the files: the id is the file name's part after the last underscore; names without one are no entries."""
    skip = _folder().contains("backup") | _folder().contains("review") | (F.col("file_name") == "manifest.json") | F.col("file_name").startswith("REJECTED_")
    docs = _files(spark, root).filter(~skip & F.col("_corrupt").isNull() & F.col("file_name").contains("_"))
    from_name = F.regexp_replace(F.substring_index("file_name", "_", -1), r"\.json$", "")
    return docs.select(
        from_name.alias("video_id"),
        F.col("modified").cast("double").alias("timestamp"),
        F.col("path").alias("filepath"),
        F.coalesce("metadata.title", F.lit("Unknown")).alias("title"),
        F.coalesce("audit.category", F.lit("SUCCESS")).alias("category"),
        F.coalesce("metadata.duration", F.lit(0.0)).alias("duration"),
        F.lit(False).alias("in_escrow"),
        "sentry_status",
    )


#: Tasks for each core that list folders or read files: Spark counts 4 MB for opening a file, so by itself it gives a task 32 small files and the sink a part of each.
TASKS_PER_CORE = 3


def _tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def _uri(path: str) -> str:
    return path if ":" in path else f"file://{path}"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of all files below root, also those of no bytes, which Spark's scans skip.

    The folders of one depth are dealt to tasks that list them; the driver learns how many there are at the next depth.
    """
    kind = "path string, size long"
    level, found = spark.createDataFrame([(_uri(root),)], "path string"), []
    while True:
        at = work_path(spark, "listing")
        level.repartition(_tasks(spark), "path").mapInArrow(_list, kind).write.parquet(at)  # without a number, few folders are one task's
        seen = spark.read.schema(kind).parquet(at)
        found.append(seen.filter("size is not null"))
        level = seen.filter("size is null").select("path")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


#: Entries of a folder handed on at once.
LISTED_AT_ONCE = 10_000


def _entries_of(folder: str) -> Iterator[tuple[str, int | None]]:
    """(name, size) of what a folder holds, without a size for folders; a local one is read as a stream, however much it holds."""
    files, at = FileSystem.from_uri(folder)
    if isinstance(files, LocalFileSystem):
        with os.scandir(at) as found:
            for x in found:
                yield x.name, x.stat().st_size if x.is_file() else None
    else:
        for x in files.get_file_info(FileSelector(at)):
            yield x.base_name, x.size if x.type == FileType.File else None


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for folder in b.column("path").to_pylist():
            base, entries = folder.rstrip("/"), _entries_of(folder)
            while part := list(islice(entries, LISTED_AT_ONCE)):
                yield pa.RecordBatch.from_arrays([pa.array([f"{base}/{quote(name)}" for name, _ in part], pa.string()), pa.array([size for _, size in part], pa.int64())], ["path", "size"])


def _problem(path: str) -> str | None:
    files, at = FileSystem.from_uri(path)
    with files.open_input_stream(at) as f:
        content = f.read()
    try:
        text = content.decode("utf-8")
        if not text.strip():
            return "blank"
        json.loads(text)
    except ValueError:
        return "unparsable"


def corrupt_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, problem) of temporary, empty, blank and unparsable files. Only JSON files are read, one at a time; nothing is deleted."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, _problem(p)) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.string())], ["path", "problem"])

    files = list_files(spark, root)
    known = F.when(F.col("path").endswith(".tmp"), "temporary").when(F.col("path").endswith(".json") & (F.col("size") == 0), "empty")
    content = files.filter(F.col("path").endswith(".json") & (F.col("size") > 0)).select("path").repartition("path").mapInArrow(read, "path string, problem string")
    return files.select("path", known.alias("problem")).unionByName(content).filter("problem is not null")


#: Bytes of a file read at once.
BLOCK = 1 << 20
_MARKS = re.compile(r'["{}\[\],]')
_TEXT_END = re.compile(r'["\\]')


def split_value(blocks: Iterator[str]) -> Iterator[str]:
    """The entries of one JSON object or array, each as a value of its own with one entry; ValueError if it is none.

    It holds one entry and one block of the text, whatever the size of the whole.
    """
    depth, inside, skip, entry, closed, opening = 0, False, False, [], False, ""

    def done() -> str:
        text = "".join(entry).strip()
        entry.clear()
        json.loads(value := opening + text + {"{": "}", "[": "]"}[opening])
        return value if text else ""

    more = False  # a comma promises another entry
    for block in blocks:
        at = start = 0
        if skip and block:  # an escaped character
            at, skip = 1, False
        while m := (_TEXT_END if inside else _MARKS).search(block, at):
            c, at = m[0], m.end()
            if inside:
                if c == '"':
                    inside = False
                elif at < len(block):
                    at += 1
                else:
                    skip = True
            elif c == '"':
                inside = True
                if not depth:
                    raise ValueError("not an object or an array")
            elif c in "{[":
                if not depth:
                    if closed or block[start : at - 1].strip() or "".join(entry).strip():
                        raise ValueError("text around the value")
                    opening, start = c, at
                    entry.clear()
                depth += 1
            elif c in "}]":
                depth -= 1
                if depth < 0:
                    raise ValueError("closed too often")
                if not depth:
                    entry.append(block[start : at - 1])
                    value, start, closed = done(), at, True
                    if c != {"{": "}", "[": "]"}[opening] or more and not value:
                        raise ValueError("closed wrongly")
                    if value:
                        yield value
            elif depth == 1:
                entry.append(block[start : at - 1])
                start, more = at, True
                if not (value := done()):
                    raise ValueError("an entry is missing")
                yield value
        entry.append(block[start:])
    if not closed or depth or "".join(entry).strip():
        raise ValueError("no whole value")


def _blocks(path: str) -> Iterator[str]:
    decode = codecs.getincrementaldecoder("utf-8")().decode
    files, at = FileSystem.from_uri(path)
    with files.open_input_stream(at) as f:
        while block := f.read(BLOCK):
            yield decode(block)
    yield decode(b"", True)


def _whole_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of these files those that are one value, over several lines: read once for that, holding nothing."""
    for b in batches:
        good = []
        for path in b.column("file").to_pylist():
            with contextlib.suppress(ValueError):
                for _ in split_value(_blocks(path)):
                    pass
                good.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(good, pa.string())], ["file"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column("file").to_pylist():
            values = split_value(_blocks(path))
            while part := list(islice(values, 1000)):
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["value"])


def _values(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The JSON values of text files: a file has one on each line, or is one, over several lines.

    Files are read by lines, which Spark splits; only a file with a line that is no value is looked at as a whole, by a task
    that streams through it. If it is no value either, its other lines count.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.from_json("value", kind).alias("x"))
    odd = lines.filter(F.col("x").isNull() & (F.trim("value") != "")).select("file").distinct()
    whole = odd.mapInArrow(_whole_values, "file string")
    entries = whole.mapInArrow(_entries, "value string").select(F.from_json("value", kind).alias("x"))
    return lines.join(whole, "file", "left_anti").select("x").unionByName(entries).filter("x is not null")


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; an empty or invalid file gives none."""
    return _values(spark, path, f"map<string, {MANIFEST_ENTRY}>").select(F.explode("x").alias("video_id", "e")).select("video_id", "e.*")


def scan_by_manifest(manifest: DataFrame, docs: DataFrame, key: str = "filepath") -> DataFrame:
    """Manifest entries whose documents exist."""
    return manifest.join(docs, key)


def scan_report(spark: SparkSession, path: str) -> DataFrame:
    """The audit report; in_escrow is text in any case."""
    return spark.read.schema(REPORT).option("header", True).csv(path).withColumn("in_escrow", F.lower("in_escrow") == "true")


def scan_id_list(spark: SparkSession, path: str) -> DataFrame:
    return _values(spark, path, "array<string>").select(F.explode("x").alias("id"))


def choose_captions(tracks: DataFrame, key: str = "video_id", langs: tuple[str, ...] = ("ta", "ta-IN")) -> DataFrame:
    """(key, text): of each video's tracks (key, lang, auto, text) the first with words, by language in this order, manual before automatic."""
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang"))
    spoken = tracks.select(key, (place * 2 + F.col("auto").cast("int")).alias("priority"), caption_text(F.col("text")).alias("text"), place.alias("place"))
    return prefer(spoken.filter((F.col("place") > 0) & (F.col("text") != "")), key, "text", "priority")


def parse_log(lines: DataFrame) -> DataFrame:
    """(status, ts, id, extra) of lines `[STATUS] | ts | id | extra`."""
    part = F.split("value", r" \| ", 4)
    return lines.select(F.regexp_extract("value", r"^\[([^\]]*)\]", 1).alias("status"), F.get(part, 1).alias("ts"), F.get(part, 2).alias("id"), F.coalesce(F.get(part, 3), F.lit("")).alias("extra"))


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_log(spark.read.text(path))


def queue_stream(spark: SparkSession, folder: str, per_trigger: int = 5, archive: str | None = None) -> DataFrame:
    """A folder as a work queue, a few files at a time, one document a file; handled files are moved to `archive`, if there is one.

    The files of a trigger are read by a number of tasks that follows the cores, each one file after another. Spark's file source
    keeps the name of every file on the driver, about 1 KB each: a folder of many files is for `list_queue` and `listed_queue`.
    """
    r = spark.readStream.schema(TRANSCRIPT).option("maxFilesPerTrigger", per_trigger).option("multiLine", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    if archive is not None:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.json(folder).coalesce(_tasks(spark))


#: Names in a part of a queue's list; the driver knows the parts.
NAMES_A_PART = 10_000


def list_queue(spark: SparkSession, folder: str, names: str, a_part: int = NAMES_A_PART) -> None:
    """Add to the table at the path `names` the JSON files of a folder that it doesn't name yet, in parts of at most `a_part` names.

    Tasks list, compare and write; no file's name passes the driver. As for Spark's sources, files of no bytes don't count, nor
    names, or folders, that begin with a dot or an underscore. Called again, also while a stream reads the table, it adds what
    is new; one caller at a time. Both folders are made where they are missing, so that a queue can begin empty.
    """
    for path in (folder, names):
        target, at = FileSystem.from_uri(_uri(path))
        target.create_dir(at, recursive=True)
    below = F.expr(f"substring(path, {len(_uri(folder).rstrip('/')) + 1})")
    found = list_files(spark, folder).filter(F.col("path").endswith(".json") & (F.col("size") > 0) & ~below.rlike("/[._]")).select("path")
    new = found.join(spark.read.schema("path string").parquet(names), "path", "left_anti")
    if not new.isEmpty():  # else a part of no names
        new.write.mode("append").option("maxRecordsPerFile", a_part).parquet(names)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of files, some BLOCK bytes at once; blank files give none, those in no encoding of JSON an unparsable one."""
    for b in batches:
        part, held = [], 0
        for path in b.column("path"):
            files, at = FileSystem.from_uri(path.as_py())
            with files.open_input_stream(at) as f:
                data = f.read()
            try:
                text = data.decode(json.detect_encoding(data))
            except ValueError:
                text = "{"
            if text.strip(" \t\r\n"):
                part.append(text)
                held += len(data)
            if held >= BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["content"])
                part, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["content"])


def listed_queue(spark: SparkSession, names: str, parts: int = 1) -> DataFrame:
    """The files named in a table of `list_queue` as a work queue, this many of its parts a trigger; rows as those of `queue_stream`.

    The driver and the checkpoint hold the names of parts, not of files: tasks read a trigger's names and open the files. Parts
    wait as long as they must (Spark forgets those a week older than the newest by itself).
    """
    listed = spark.readStream.schema("path string").option("maxFilesPerTrigger", parts).option("maxFileAge", "36500d").parquet(names)
    texts = listed.repartition(_tasks(spark)).mapInArrow(_contents, "content string")
    kind = f"struct<{TRANSCRIPT}>"
    documents = F.from_json("content", f"array<{kind}>")  # of one, where a file is one object
    return texts.select(F.explode(F.coalesce(documents, F.array(F.lit(None).cast(kind)))).alias("x")).select("x.*")
