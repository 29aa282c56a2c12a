"""Sources, sinks and streams in temporary folders."""

from __future__ import annotations

import json
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.plans import queries as plans
from tessella.schemas import TRANSCRIPT
from tessella.sources import readers, sinks
from tessella.streaming import streams


def write(path, x):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(x if isinstance(x, str) else json.dumps(x), encoding="utf-8")


def doc(i, **meta):
    return {"metadata": {"video_id": i, "title": i, **meta}, "full_text": f"text {i}", "segments": [], "audit": {"category": "GHOST"}}


def test_scans(spark, tmp_path):
    root = tmp_path / "docs"
    write(root / "a" / "x_a_1.json", doc("a_1"))
    write(root / "a" / "REJECTED_b.json", doc("b"))
    write(root / "review_me" / "c.json", doc("c"))
    write(root / "backup" / "e.json", doc("e"))
    write(root / "a" / "d.json", doc("d", omega_certified=True))
    write(root / "a" / "bad.json", "{nope")
    write(root / "a" / "empty.json", "")
    write(root / "a" / "z.tmp", "x")
    write(root / "manifest.json", {})
    ids = lambda df: sorted(r.i for r in df.select(F.col("metadata.video_id").alias("i")).collect() if r.i)
    assert ids(readers.scan_docs(spark, str(root))) == ["a_1", "b", "e"]
    assert ids(readers.scan_export(spark, str(root))) == ["a_1", "e"]
    write(root / "a" / "no title_x9.json", {"full_text": "t"})
    rebuilt = {r.video_id: (r.title, r.category) for r in readers.scan_rebuild(spark, str(root)).collect()}
    assert rebuilt == {"1": ("a_1", "GHOST"), "x9": ("Unknown", "SUCCESS")}  # names without an underscore have no id
    assert readers.scan_docs(spark, str(root), 1).count() == 1
    bad = {r.path.rsplit("/", 1)[1]: r.problem for r in readers.corrupt_files(spark, str(root)).collect()}
    assert bad == {"bad.json": "unparsable", "empty.json": "empty", "z.tmp": "temporary"}


def test_nan_survives_json(spark, tmp_path):
    write(tmp_path / "n" / "n.json", '{"full_text": "x", "segments": [{"avg_logprob": NaN}]}')
    assert spark.read.schema(TRANSCRIPT).option("multiLine", True).json(str(tmp_path / "n")).select(F.isnan(F.col("segments")[0]["avg_logprob"]).alias("x")).first().x


def test_manifest_lists_and_logs(spark, tmp_path):
    write(tmp_path / "m.json", {"a": {"category": "SUCCESS", "timestamp": 1.5}, "b": {"category": "GHOST"}})
    assert {r.video_id: r.category for r in readers.scan_manifest(spark, str(tmp_path / "m.json")).collect()} == {"a": "SUCCESS", "b": "GHOST"}
    write(tmp_path / "bad.json", "{oops")
    assert readers.scan_manifest(spark, str(tmp_path / "bad.json")).count() == 0
    write(tmp_path / "q.json", ["x", "y"])
    assert [r.id for r in readers.scan_id_list(spark, str(tmp_path / "q.json")).collect()] == ["x", "y"]
    line = spark.range(1).select(sinks.log_line(F.lit("SUCCESS"), F.lit("2025-01-01 00:00:00"), F.lit("v1"), F.lit("RTF")).alias("value"))
    sinks.append_log(line, str(tmp_path / "log"))
    r = readers.scan_log(spark, str(tmp_path / "log")).first()
    assert (r.status, r.ts, r.id, r.extra) == ("SUCCESS", "2025-01-01 00:00:00", "v1", "RTF")


def test_report_and_records_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "f", "GHOST", "True", 0.5), ("b", "g", "SUCCESS", "False", 1.0)], "vid_id string, filepath string, category string, in_escrow string, global_uwr double")
    sinks.write_report(rows, str(tmp_path / "r"))
    assert {r.vid_id: r.in_escrow for r in readers.scan_report(spark, str(tmp_path / "r")).collect()} == {"a": True, "b": False}
    recs = spark.createDataFrame([("a", 1)], "id string, n int")
    for _ in range(2):
        sinks.append_records(recs, str(tmp_path / "t"))
    assert sinks.read_records(spark, str(tmp_path / "t"), recs.schema).count() == 1
    sinks.write_routed(rows.withColumn("dest", F.when(F.col("category") == "GHOST", "NULL_HARVEST")), str(tmp_path / "routed"))
    assert [p.name for p in (tmp_path / "routed").glob("dest=*")] == ["dest=NULL_HARVEST"]


def test_queue_resumes_from_its_checkpoint(spark, tmp_path):
    for i in range(7):
        write(tmp_path / "in" / f"{i}.json", doc(str(i)))
    seen: list[str] = []

    def handle(batch, _):
        got = [r.i for r in batch.select(F.col("metadata.video_id").alias("i")).collect()]
        assert len(got) <= 5
        seen.extend(got)

    for _ in range(2):  # the second run finds nothing new
        streams.work_queue(readers.queue_stream(spark, str(tmp_path / "in")), handle, str(tmp_path / "cp")).awaitTermination()
    assert sorted(seen) == [str(i) for i in range(7)]


def test_a_triggers_files_are_listed_and_read_by_few_tasks(spark, tmp_path):
    for i in range(40):
        write(tmp_path / "in" / f"{i}.json", doc(str(i)))
    cores, name = spark.sparkContext.defaultParallelism, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tracker = spark.conf.get(name), spark.sparkContext.statusTracker()
    with streams.few_listers(spark):
        q = streams.append_stream(readers.queue_stream(spark, str(tmp_path / "in"), 40).select("metadata.video_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
    assert spark.conf.get(name) == before
    stages = [tracker.getStageInfo(i) for job in tracker.getJobIdsForGroup(str(q.runId)) for i in tracker.getJobInfo(job).stageIds]
    assert len(stages) >= 2 and max(x.numTasks for x in stages) <= 3 * cores  # a task a file lists them without few_listers
    assert sorted(int(r.video_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))


def odd_files(folder):
    """Files as other writers leave them; what Spark's JSON source makes of them is the measure."""
    write(folder / "a" / "1.json", doc("1"))
    write(folder / "a b" / "ü %41.json", json.dumps(doc("2"), indent=1))
    write(folder / "two.json", [doc("3"), doc("4", duration=1.5)])
    write(folder / "none.json", [])
    write(folder / "scalars.json", [1, "x"])
    write(folder / "null.json", "null")
    write(folder / "cut.json", '{"full_text": "te')
    write(folder / "lines.json", '{"full_text": "first"}\n{"full_text": "second"}\n')
    write(folder / "kinds.json", '{"metadata": {"video_id": 7, "duration": "x"}, "full_text": ["y"], "sentry_status": "kept", "more": 1}')
    write(folder / "nan.json", '{"full_text": "x", "segments": [{"avg_logprob": NaN}]}')
    write(folder / "blank.json", " \n\t")
    write(folder / "empty.json", "")
    write(folder / "mark.json", "\ufeff" + json.dumps(doc("5")))
    for name, data in {"wide": json.dumps(doc("6")).encode("utf-16"), "broken": b'{"full_text": "\xff\xfe x"}'}.items():
        (folder / f"{name}.json").write_bytes(data)
    for name in ("x.json.tmp", "x.JSON", ".hidden.json", "_skipped.json", "_folder/y.json", ".folder/y.json"):
        write(folder / name, doc("no"))


def test_a_listed_queue_reads_what_the_file_source_reads(spark, tmp_path):
    odd_files(tmp_path / "in")
    names, rows = str(tmp_path / "names"), {}
    readers.list_queue(spark, str(tmp_path / "in"), names)
    for kind, stream in (("file", readers.queue_stream(spark, str(tmp_path / "in"), 100)), ("listed", readers.listed_queue(spark, names))):
        streams.append_stream(stream, str(tmp_path / kind), str(tmp_path / f"cp-{kind}")).awaitTermination()
        got = spark.read.schema(TRANSCRIPT).parquet(str(tmp_path / kind))
        rows[kind] = sorted(map(str, got.collect()))
        assert got.schema.simpleString() == stream.schema.simpleString()
    assert rows["listed"] == rows["file"]
    assert len(rows["listed"]) > 10


def test_a_listed_queue_takes_new_files_and_each_once(spark, tmp_path):
    seen: list[str] = []

    def handle(batch, _):
        got = [r.i for r in batch.select(F.col("metadata.video_id").alias("i")).collect()]
        assert len(got) <= 6
        seen.extend(got)

    names = str(tmp_path / "names")  # neither folder is there at first
    for had, now in ((0, 0), (0, 17), (17, 17), (17, 20)):
        for i in range(had, now):
            write(tmp_path / "in" / str(i % 2) / f"{i}.json", doc(str(i)))
        readers.list_queue(spark, str(tmp_path / "in"), names, 3)
        streams.work_queue(readers.listed_queue(spark, names, 2), handle, str(tmp_path / "cp")).awaitTermination()
        assert sorted(seen, key=int) == [str(i) for i in range(now)]
    assert max(spark.read.parquet(names).groupBy(F.input_file_name()).count().select("count").toPandas()["count"]) <= 3


def test_the_queue_querys_driver_knows_no_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans.fx, "work_path", lambda _, name: f"file://{tmp_path}/{name}")
    d = "/root/testdata/sf0.001"
    got = plans.QUERIES["s6_l4_queue_files"](spark, d)
    want = spark.read.parquet(f"{d}/documents.parquet").selectExpr("cast(doc_id as string)", "length(text)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    log = "".join(p.read_text() for p in (tmp_path / "queue-state" / "sources").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert 1 <= log.count('"path"') <= 10  # the list's parts; there are 200 documents
    assert ".json" not in log


def test_event_windows_equal_the_batch(spark, tmp_path):
    src = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(100)], "s int, k string").select(F.timestamp_seconds(F.col("s") * 37).alias("ts"), "k")
    src.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "ev"))
    got = streams.run_once(streams.event_windows(stream, "ts", "10 minutes", None, "1 hour", "k"), "win", str(tmp_path / "c1"), "complete")
    want = src.groupBy(F.window("ts", "10 minutes"), "k").count()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    once = streams.run_once(streams.unseen(stream, "k", "ts"), "once", str(tmp_path / "c2"))
    assert sorted(r.k for r in once.select("k").distinct().collect()) == ["a", "b"]


def test_heartbeat(spark):
    now = F.timestamp_seconds(F.lit(1000))
    beats = spark.createDataFrame([(870,), (850,)], "s int").select(F.timestamp_seconds("s").alias("ts"))
    assert tuple(streams.heartbeat_age(beats, now).first()) == (130, True)
    assert tuple(streams.heartbeat_age(beats.limit(0), now).first()) == (-1, False)


def beats_into(spark, folder, number, rows):
    spark.createDataFrame(rows, "k string, s int").select("k", F.timestamp_seconds("s").alias("at")).coalesce(1).write.parquet(str(folder / str(number)))


def watched(spark, tmp_path, make):
    """Run what is there of the beats in tmp_path/in and return all rows so far."""
    stream = spark.readStream.schema("k string, at timestamp").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    streams.append_stream(make(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return sorted([(r[0], int(r[1].timestamp()), r[2]) for r in spark.read.parquet(str(tmp_path / "out")).collect()], key=lambda r: (r[1], r[2]))


def test_watchdog_restarts_by_silence_alone_then_stops(spark, tmp_path):
    make = lambda s: streams.watchdog(s, "k", stale=100, most=3)
    beats_into(spark, tmp_path / "in", 0, [("quiet", 1000), ("busy", 1000), ("gap", 900), ("gap", 1200), (None, 5)])
    done = watched(spark, tmp_path, make)
    assert {r for r in done if r[2] != "ok"} == {("gap", 1000, "restart"), ("gap", 1100, "restart"), ("quiet", 1100, "restart"), ("busy", 1100, "restart")}
    beats_into(spark, tmp_path / "in", 1, [("busy", 1290), ("busy", 1291)])  # no event of the quiet key: its timer is enough
    done = watched(spark, tmp_path, make)
    assert [r for r in done if r[0] == "quiet"] == [("quiet", 1000, "ok"), ("quiet", 1100, "restart"), ("quiet", 1200, "restart")]
    beats_into(spark, tmp_path / "in", 2, [("busy", 1900)])
    done = watched(spark, tmp_path, make)
    assert [r[1:] for r in done if r[0] == "quiet"] == [(1000, "ok"), (1100, "restart"), (1200, "restart"), (1300, "restart"), (1400, "stop")]
    assert [r[2] for r in done if r[0] == "gap"][-2:] == ["restart", "stop"]  # two in its first gap, one of its life left
    assert len([r for r in done if r[2] == "stop"]) == 3  # busy was silent too long as well
    beats_into(spark, tmp_path / "in", 3, [("quiet", 2000), ("busy", 2500)])
    assert len([r for r in watched(spark, tmp_path, make) if r[0] == "quiet"]) == 5  # stopped for good


def test_batches_give_what_one_batch_gives(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = sorted([(rng.choice("abc"), rng.randint(0, 3000)) for _ in range(60)], key=lambda r: r[1])
    make = lambda s: streams.watchdog(s, "k", stale=60, most=30)
    for n in range(3):
        beats_into(spark, tmp_path / "many" / "in", n, rows[n * 20 : n * 20 + 20])
        many = watched(spark, tmp_path / "many", make)
    beats_into(spark, tmp_path / "one" / "in", 0, rows)
    one = watched(spark, tmp_path / "one", make)
    assert sorted(r for r in many if r[2] != "ok") == sorted(r for r in one if r[2] != "ok")


def test_heartbeats_turn_stale_by_a_timer(spark, tmp_path):
    make = lambda s: streams.heartbeats(s, "k", stale=120)
    beats_into(spark, tmp_path / "in", 0, [("a", 1000), ("b", 1000)])
    assert sorted(watched(spark, tmp_path, make)) == [("a", 1000, "alive"), ("b", 1000, "alive")]
    beats_into(spark, tmp_path / "in", 1, [("b", 1121)])
    assert [r for r in watched(spark, tmp_path, make) if r[0] == "a"] == [("a", 1000, "alive"), ("a", 1000, "stale")]
    beats_into(spark, tmp_path / "in", 2, [("a", 1130)])
    assert ("a", 1130, "alive") in watched(spark, tmp_path, make)


def test_beats_are_written(spark, tmp_path):
    q = streams.beat(spark, "harvest", str(tmp_path / "beats"), str(tmp_path / "cp"), "1 second")
    try:
        import time

        for _ in range(60):
            time.sleep(1)
            if (tmp_path / "beats").exists() and spark.read.schema("name string, at timestamp").parquet(str(tmp_path / "beats")).count() >= 2:
                break
    finally:
        q.stop()
    rows = spark.read.parquet(str(tmp_path / "beats")).collect()
    assert len(rows) >= 2
    assert {r.name for r in rows} == {"harvest"}
    assert len({r.at for r in rows}) == len(rows)


_JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text(alphabet='a"\\\\{}[],: é\n', max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='k"\\\\,}', max_size=3), x, max_size=3), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(_JSON, max_size=5) | st.dictionaries(st.text(max_size=3), _JSON, max_size=5), st.integers(1, 9), st.sampled_from([None, 1]))
def test_values_are_split_wherever_blocks_end(value, size, indent):
    text = " " + json.dumps(value, indent=indent, ensure_ascii=False) + "\n"
    parts = [json.loads(x) for x in readers.split_value(text[i : i + size] for i in range(0, len(text), size))]
    want = [{k: v} for k, v in value.items()] if isinstance(value, dict) else [[v] for v in value]
    assert parts == want


@pytest.mark.parametrize("text", ["", " ", "1", '"a"', "[1", "[1,]", "[,1]", "[1]]", "[1] x", "[1] [2]", '{"a": 1', '{"a"}', '{"a": 1]', "x [1]", "[1}", "[nope]", '["a]', "[1],"])
def test_what_is_no_whole_value_is_refused(text):
    with pytest.raises(ValueError):
        list(readers.split_value(iter([text])))


def test_large_values_are_read_in_pieces(spark, tmp_path):
    big = {f"v{i}": {"category": "SUCCESS", "title": 'a "quoted", [odd] {title}\n' * 20} for i in range(5000)}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "wide.json").write_text(json.dumps(big, indent=2))
    (tmp_path / "m" / "lines.json").write_text('{"x1": {"category": "GHOST"}}\n\n{"x2": {"category": "GHOST"}}\nbroken\n')
    (tmp_path / "m" / "broken.json").write_text(json.dumps({"y": {"category": "GHOST"}}, indent=2)[:-1])
    (tmp_path / "m" / "empty.json").write_text("")
    got = {r.video_id: (r.category, r.title) for r in readers.scan_manifest(spark, str(tmp_path / "m")).collect()}
    assert got == {k: (v["category"], v["title"]) for k, v in big.items()} | {"x1": ("GHOST", None), "x2": ("GHOST", None)}
    (tmp_path / "q.json").write_text(json.dumps([f"id {i}" for i in range(300)], indent=1))
    assert sorted(r.id for r in readers.scan_id_list(spark, str(tmp_path / "q.json")).collect()) == sorted(f"id {i}" for i in range(300))


def test_listing_and_file_sink(spark, tmp_path):
    rows = [("a/b c/é 1.json", "{}"), ("a/empty.json", ""), ("top.json", None), ("a/x.tmp", "z")]
    out = sinks.write_files(spark.createDataFrame(rows, "path string, content string").repartition(3), str(tmp_path / "t"))
    assert {r.path: r.size for r in out.collect()} == {p: len(c or "") for p, c in rows}
    found = {r.path.split("/t/", 1)[1]: r.size for r in readers.list_files(spark, str(tmp_path / "t")).collect()}
    assert found == {"a/b%20c/%C3%A9%201.json": 2, "a/empty.json": 0, "top.json": 0, "a/x.tmp": 1}
    assert {(r.path.rsplit("/", 1)[1], r.problem) for r in readers.corrupt_files(spark, str(tmp_path / "t")).collect()} == {("empty.json", "empty"), ("top.json", "empty"), ("x.tmp", "temporary")}
    (tmp_path / "none").mkdir()
    assert readers.list_files(spark, str(tmp_path / "none")).count() == 0


def test_a_full_folder_is_listed_in_bounded_parts(tmp_path):
    for i in range(25_000):
        (tmp_path / f"{i}.json").touch()
    (tmp_path / "sub dir").mkdir()
    tracemalloc.start()
    sizes, found = [], 0
    for b in readers._list(iter([pa.RecordBatch.from_pydict({"path": [f"file://{tmp_path}"]})])):
        sizes.append(b.num_rows)
        found += b.column("size").null_count
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (sizes, found) == ([10_000, 10_000, 5_001], 1)
    assert peak < 6e6


def test_handled_files_are_set_aside(spark, tmp_path):
    for i in range(12):
        write(tmp_path / "in" / f"{i:02}.json", doc(f"d{i}"))
    sizes = []

    def handle(batch, number):
        sizes.append(batch.count())

    for _ in range(2):  # what one run has handled is moved when the next ones are listed
        streams.work_queue(readers.queue_stream(spark, f"file://{tmp_path}/in", 5, archive=f"file://{tmp_path}/done"), handle, str(tmp_path / "cp")).awaitTermination()
    assert [n for n in sizes if n] == [5, 5, 2]
    left, moved = list((tmp_path / "in").glob("*.json")), list((tmp_path / "done").rglob("*.json"))
    assert len(left) + len(moved) == 12
    assert moved
