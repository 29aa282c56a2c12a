"""Sinks: Spark's commit protocol gives the atomicity; routing is a partition column, inputs are never moved."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REPORT


def write_documents(docs: DataFrame, path: str, by: str | None = None) -> None:
    w = docs.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def write_files(files: DataFrame, root: str) -> DataFrame:
    """(path, size) of files (path below root, content) written, a file each, by the tasks that hold them.

    A file appears under its name whole or not at all: it is written under a name of the task's own and then renamed, so a task
    that runs again replaces its files.
    """
    base = (root if ":" in root else f"file://{root}").rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, top = FileSystem.from_uri(base)
        made = set()
        for b in batches:
            sizes = []
            for path, content in zip(b.column("path"), b.column("content"), strict=True):  # one content at a time as a Python value
                full = f"{top}/{path.as_py()}"
                folder, name = full.rsplit("/", 1)
                if folder not in made:
                    target.create_dir(folder, recursive=True)
                    made.add(folder)
                own = f"{folder}/.{name}.{uuid.uuid4().hex}"
                data = (content.as_py() or "").encode()
                with target.open_output_stream(own) as f:
                    f.write(data)
                target.move(own, full)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(sizes, pa.int64())], ["path", "size"])

    return files.select("path", "content").mapInArrow(run, "path string, size long")


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def overwrite_records(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def read_records(spark, path: str, schema, key: str = "id") -> DataFrame:
    """Appended records, each id once."""
    return spark.read.schema(schema).json(path).dropDuplicates([key])


def write_report(rows: DataFrame, path: str) -> None:
    """The audit report with its fixed columns; missing ones are empty."""
    have = set(rows.columns)
    fields = [f.split() for f in REPORT.split(", ")]
    rows.select(*[(F.col(n) if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in fields]).write.mode("overwrite").option("header", True).csv(path)


#: Entries of one JSON map or array, on average.
ENTRIES = 10_000


def _bounded(rows: DataFrame, key: str) -> tuple[DataFrame, str]:
    """rows with a group number by a hash of the key, so that a group holds about ENTRIES rows however many there are."""
    groups = max(1, -(-rows.count() // ENTRIES))
    return rows.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups))), "_group"


def write_manifest(manifest: DataFrame, path: str, key: str = "video_id") -> None:
    """A snapshot as JSON maps from key to entry, a line each."""
    rows, group = _bounded(manifest, key)
    entry = F.struct(*[c for c in manifest.columns if c != key])
    rows.groupBy(group).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(key, entry)))).alias("value")).select("value").write.mode("overwrite").text(path)


def write_id_list(ids: DataFrame, path: str, key: str = "id") -> None:
    """Ids as JSON arrays, a line each."""
    rows, group = _bounded(ids, key)
    rows.groupBy(group).agg(F.to_json(F.collect_list(key)).alias("value")).select("value").write.mode("overwrite").text(path)


def log_line(status: Column, ts: Column, key: Column, extra: Column) -> Column:
    return F.concat_ws(" | ", F.concat(F.lit("["), status, F.lit("]")), ts, key, extra)


def append_log(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").text(path)


def write_routed(docs: DataFrame, path: str, dest: str = "dest") -> None:
    docs.filter(F.col(dest).isNotNull()).write.mode("overwrite").partitionBy(dest).json(path)
