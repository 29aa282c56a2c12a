"""Long-running jobs as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def work_queue(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Each micro-batch of a queue goes to `handle`; the checkpoint is the resume state."""
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def unseen(stream: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, which bounds the state; with a long one start the query under `rocksdb`, whose state is on disk."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def heartbeat_age(beats: DataFrame, now, stale: int = 120) -> DataFrame:
    """Seconds since the last beat and whether that is stale; (-1, false) without one."""
    last = beats.agg(F.max("ts").alias("last"))
    age = F.coalesce(F.unix_timestamp(now) - F.unix_timestamp("last"), F.lit(-1).cast("long"))
    return last.select(age.alias("age"), (age > stale).alias("stale"))


def heartbeat_ages(beats: DataFrame, key: str, now: DataFrame, stale: int = 120) -> DataFrame:
    """(key, age, stale): seconds from each key's last beat (`at`) to `now`, a one-row table."""
    last = beats.groupBy(key).agg(F.max("at").alias("last")).join(F.broadcast(now))
    age = F.unix_timestamp("now") - F.unix_timestamp("last")
    return last.select(key, age.alias("age"), (age > stale).alias("stale"))


#: What a watched key's state holds: its last beat (milliseconds) and the restarts of its life.
_WATCHED = "last long, restarts int, stopped boolean"


def _frame(key: str, value, times: list[int], column: str, values: list[str]) -> pd.DataFrame:
    """Rows of one key; texts as plain objects, which the state's serializer takes."""
    at = pd.to_datetime(times, unit="ms", utc=True)
    return pd.DataFrame({key: pd.Series([value] * len(times), dtype=object if isinstance(value, str) else None), "at": at, column: pd.Series(values, dtype=object)})


class Watchdog(StatefulProcessor):
    """Beats of a key, by event time: every `stale` milliseconds without one it is restarted, `most` times in its life, then stopped.

    Silence shows by a timer alone, once the watermark has passed it; between two beats of a batch it is counted likewise,
    so results don't depend on how beats are cut into batches. A stopped key stays stopped.
    """

    def __init__(self, key: str, stale: int, most: int):
        self.key, self.stale, self.most = key, stale, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("watched", _WATCHED)

    def _silence(self, last: int, until: int, restarts: int, stopped: bool) -> tuple[list[tuple[int, str]], int, bool]:
        """Decisions at last + stale, last + 2 stale and so on, before `until`."""
        out = []
        for n in range(1, (until - last - 1) // self.stale + 1):
            if stopped:
                break
            stopped = restarts >= self.most
            restarts += not stopped
            out.append((last + n * self.stale, "stop" if stopped else "restart"))
        return out, restarts, stopped

    def _rows(self, key, decisions: list[tuple[int, str]]) -> pd.DataFrame:
        return _frame(self.key, key[0], [t for t, _ in decisions], "action", [a for _, a in decisions])

    def _watch(self, last: int, restarts: int, stopped: bool) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not stopped:
            self.handle.registerTimer(last + self.stale + 1)  # a timer is due at its very time
        self.state.update((last, restarts, stopped))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        spans = sorted(x for part in rows for x in zip(part["first"].tolist(), part["last"].tolist(), strict=True))
        last, restarts, stopped = self.state.get() if self.state.exists() else (None, 0, False)
        out = []
        for first, end in spans:
            if last is not None and first > last:
                done, restarts, stopped = self._silence(last, first, restarts, stopped)
                out += done
            last = end if last is None else max(last, end)
        self._watch(last, restarts, stopped)
        yield self._rows(key, [*out, *([] if stopped else [(last, "ok")])])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, restarts, stopped = self.state.get()
        until = timerValues.getCurrentWatermarkInMs()
        out, restarts, stopped = self._silence(last, until, restarts, stopped)
        self._watch(out[-1][0], restarts, stopped)  # the next look is after the last one
        yield self._rows(key, out)

    def close(self) -> None:
        pass


class Heartbeat(StatefulProcessor):
    """(key, at, status) of a key's beats: alive at the last beat of each batch, stale once the watermark is `stale` milliseconds past it."""

    def __init__(self, key: str, stale: int):
        self.key, self.stale = key, stale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last long")

    def _row(self, key, last: int, status: str) -> pd.DataFrame:
        return _frame(self.key, key[0], [last], "status", [status])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = max(int(part["last"].max()) for part in rows)
        before = self.last.get()[0] if self.last.exists() else None
        if before is None or last > before:
            if before is not None:
                self.handle.deleteTimer(before + self.stale + 1)
            self.last.update((last,))
            self.handle.registerTimer(last + self.stale + 1)
            yield self._row(key, last, "alive")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._row(key, self.last.get()[0], "stale")

    def close(self) -> None:
        pass


def _spans(key: str, at: str, stale: int):
    """Beats of a batch as (key, at, first, last): one row for each key and stretch of `stale` milliseconds, in which no silence fits."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p = p.dropna(subset=[key, at])
            ms = p[at].astype("datetime64[ms]").astype("int64")
            g = pd.DataFrame({key: p[key], "at": p[at], "ms": ms, "stretch": ms // stale}).groupby([key, "stretch"], as_index=False).agg(at=("at", "max"), first=("ms", "min"), last=("ms", "max"))
            yield g[[key, "at", "first", "last"]].astype({key: object})

    return run


def _keyed(beats: DataFrame, key: str, at: str, late: str, processor: StatefulProcessor, column: str) -> DataFrame:
    kind = beats.schema[key].dataType.simpleString()
    spans = beats.select(key, F.col(at).cast("timestamp").alias(at)).mapInPandas(_spans(key, at, processor.stale), f"{key} {kind}, at timestamp, first long, last long")
    return spans.withWatermark("at", late).groupBy(key).transformWithStateInPandas(processor, f"{key} {kind}, at timestamp, {column} string", "Append", "EventTime")


def watchdog(beats: DataFrame, key: str, at: str = "at", stale: int = 120, most: int = 5, late: str = "0 seconds") -> DataFrame:
    """A stream of (key, at, action) from a stream of beats (key, at): ok, restart or stop; null keys and times don't count.

    A batch costs what its own beats and due timers cost: what a key's history leaves is one row of keyed state. The query
    needs the RocksDB state store (see `rocksdb`).
    """
    return _keyed(beats, key, at, late, Watchdog(key, stale * 1000, most), "action")


def heartbeats(beats: DataFrame, key: str, at: str = "at", stale: int = 120, late: str = "0 seconds") -> DataFrame:
    """A stream of (key, at, status): alive with each beat, stale by a timer when none follows. It needs the RocksDB state store."""
    return _keyed(beats, key, at, late, Heartbeat(key, stale * 1000), "status")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk and in the checkpoint, instead of in memory."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


#: Tasks for each core that list the files of a trigger.
LISTERS_PER_CORE = 3


@contextmanager
def few_listers(spark: SparkSession) -> Iterator[None]:
    """Queries over files that run inside list a trigger's files by a few tasks a core; else Spark starts one a file, up to 10,000.

    A file source reads this setting of its session at every trigger, so the block has to last as long as the query.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), LISTERS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """A stream appended to a Parquet table; each batch is committed once."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    with rocksdb(stream.sparkSession):
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def beat(spark: SparkSession, name: str, path: str, checkpoint: str, every: str = "60 seconds"):
    """A heartbeat: each trigger appends one row (name, at) with the time of its batch to the table at `path`."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def write(batch: DataFrame, number: int) -> None:
        now = spark.range(1).select(F.lit(name).alias("name"), F.current_timestamp().alias("at"))
        now.coalesce(1).write.mode("append").parquet(path)

    return work_queue(ticks, write, checkpoint, every)


def event_windows(events: DataFrame, ts: str, width: str, slide: str | None = None, late: str = "10 minutes", *keys: str) -> DataFrame:
    """Tumbling or sliding counts by event time (an extension)."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(w, *keys).count()


def run_once(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there into a memory table and return it; for tests and small results."""
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
