"""The batch operators on a live event feed (Structured Streaming)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isfinite
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from icuflow.session import shared_dir
from icuflow.sources.schema import EVENTS


def event_stream(spark: SparkSession, folder: str, glob: str = "events.parquet", schema: str = EVENTS) -> DataFrame:
    """File stream of events; `ts` becomes a zoned timestamp, as watermarks need one."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def event_rows(spark: SparkSession, folder: str, glob: str = "events.parquet", schema: str = EVENTS) -> DataFrame:
    """The rows of `event_stream` as a batch frame."""
    raw = spark.read.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_stream(events: DataFrame, by: list[str], value: str, late: str = "2 hours") -> DataFrame:
    """Tumbling hourly mean and count per key, with a bound on late data."""
    return (
        events.withWatermark("ts", late)
        .groupBy(*by, F.window("ts", "1 hour"))
        .agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
        .select(*by, F.col("window.start").alias("hour"), "mean", "n")
    )


def sliding(events: DataFrame, by: list[str], value: str, span: str = "6 hours", step: str = "1 hour") -> DataFrame:
    """Sliding time windows (a span of time, not a number of rows) with mean, min and max.

    Works on batch frames and, behind a watermark, on streams.
    """
    return (
        events.groupBy(*by, F.window("ts", span, step))
        .agg(
            F.avg(value).alias("mean"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(*by, F.col("window.start").alias("start"), "mean", "low", "high", "n")
    )


def distinct_readings(events: DataFrame, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Drop repeated readings that arrive within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


class PreviousReading(StatefulProcessor):
    """Per key: each reading with the value before it, if less than `memory` seconds old.

    State is one (time, value) per key and rows pass through in Arrow batches, so a hot key
    needs no more memory than a quiet one. Readings are expected in time order per key, as a
    live feed delivers them; a late one gets no previous value and leaves the state alone.
    """

    def __init__(self, memory: float = 6 * 3600):
        self.memory = memory

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ts timestamp, value double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = self.last.get() if self.last.exists() else None
        for batch in rows:
            batch = batch.sort_values("ts", kind="stable").reset_index(drop=True)
            before_ts, before_value = batch["ts"].shift(), batch["value"].shift()
            if seen is not None:
                newer = batch["ts"] >= pd.Timestamp(seen[0])
                before_ts = before_ts.where(newer & newer.shift(fill_value=False))
                before_value = before_value.where(newer & newer.shift(fill_value=False))
                if newer.any():
                    first = int(newer.to_numpy().argmax())
                    before_ts.iloc[first], before_value.iloc[first] = pd.Timestamp(seen[0]), seen[1]
            recent = (batch["ts"] - before_ts).dt.total_seconds() < self.memory
            newest = batch.iloc[-1]
            if seen is None or newest["ts"] >= pd.Timestamp(seen[0]):
                seen = (newest["ts"].to_pydatetime(), float(newest["value"]))
            yield pd.DataFrame(
                {"user_id": key[0], "ts": batch["ts"], "value": batch["value"], "previous": before_value.where(recent)}
            )
        if seen is not None:
            self.last.update(seen)

    def close(self) -> None:
        pass


def previous_reading(events: DataFrame, memory: float = 6 * 3600) -> DataFrame:
    """Carry-forward on a stream; idle keys keep one small state row until the query ends."""
    return (
        events.select("user_id", "ts", "value")
        .groupBy("user_id")
        .transformWithStateInPandas(
            PreviousReading(memory),
            outputStructType="user_id long, ts timestamp, value double, previous double",
            outputMode="Append",
            timeMode="None",
        )
    )


def stored(stream: DataFrame) -> DataFrame:
    """Run a stream over what is there now, append what is final to Parquet files, and read them.

    Files and state lie in the shared folder: a restarted query goes on from them, nothing passes through the driver, and
    what the watermark has closed leaves the state.
    """
    folder = f"{shared_dir(stream.sparkSession).rstrip('/')}/stream-{uuid4().hex}"
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer.option("checkpointLocation", f"{folder}/state").start(f"{folder}/rows").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def every_window(
    spark: SparkSession, folder: str, start: str, windows: Callable[[DataFrame], DataFrame], glob: str = "events.parquet"
) -> DataFrame:
    """All windows of a feed: those its stream has closed (`stored`), and from a batch run of the same operator those that
    are still open behind the watermark.

    A stream closes windows of one length in the order of their starts, so what starts after its last one is open.
    """
    closed = stored(windows(event_stream(spark, folder, glob)))
    # As a number, since a local time can be ambiguous.
    last = closed.agg(F.max(F.unix_micros(start))).first()[0]
    still = windows(event_rows(spark, folder, glob))
    return closed.unionByName(still if last is None else still.where(F.unix_micros(start) > last))


#: How the partial results of a window are made from rows, and brought together.
PARTS = {"sum": (F.sum, F.sum), "n": (F.count, F.sum), "low": (F.min, F.min), "high": (F.max, F.max)}


#: Rows of a micro-batch that one task brings together.
TASK_ROWS = 250_000


class PartialWindows:
    """A sink of window results that no order of arrival can spoil.

    Every micro-batch appends one row for each key and window that it touches: sum, count, least and greatest value of its
    own rows, under its batch number. A window is the sum of its rows, so a row that comes days late adds one more and
    reopens its window; nothing is kept in state and no watermark drops it. A batch that is written again after a restart
    overwrites its own folder, so it counts once.
    """

    def __init__(self, folder: str, keys: list[str], value: str, window: Callable[[], Column]) -> None:
        self.folder, self.keys, self.value, self.window = folder, keys, value, window

    def write(self, batch: DataFrame, number: int) -> None:
        # Rows may give as many windows as there are of them, and a task holds its own: it takes so many rows, however large
        # the files are.
        tasks = -(-batch.count() // TASK_ROWS)
        if tasks > 1:
            batch = batch.repartition(tasks, F.xxhash64(*batch.columns))
        made = [own(F.col(self.value)).alias(name) for name, (own, _) in PARTS.items()]
        parts = batch.groupBy(*self.keys, self.window().alias("window")).agg(*made)
        parts.select(*self.keys, F.col("window.start").alias("start"), *PARTS).write.mode("overwrite").parquet(f"{self.folder}/rows/batch={number}")

    def take_in(self, stream: DataFrame) -> None:
        """Go on from the last batch over what is there now."""
        writer = stream.writeStream.foreachBatch(self.write).option("checkpointLocation", f"{self.folder}/state")
        writer.trigger(availableNow=True).start().awaitTermination()

    def read(self, spark: SparkSession) -> DataFrame:
        """Every window so far: keys, start, mean, low, high and n."""
        rows = spark.read.parquet(f"{self.folder}/rows")
        merged = [both(name).alias(name) for name, (_, both) in PARTS.items()]
        whole = rows.groupBy(*self.keys, "start").agg(*merged)
        return whole.select(*self.keys, "start", F.try_divide("sum", "n").alias("mean"), "low", "high", "n")


def many_files(events: DataFrame, files: int = 8, order: str | None = None) -> str:
    """The rows of a frame as a feed: as many files, in no order of time, or one after the other by ranges of `order`."""
    spark = events.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/feed-{uuid4().hex}"
    if order is None:
        events.repartition(files, F.xxhash64(*events.columns)).write.parquet(folder)
        return folder
    rows = events.withColumn("_at", F.unix_micros(F.col(order).cast("timestamp")))
    low, high = rows.agg(F.min("_at"), F.max("_at")).first()
    step = 1 if low is None else (high - low) // files + 1
    for k in range(files):
        part = rows.where(F.floor((F.col("_at") - F.lit(low or 0)) / step) == k).drop("_at")
        # All tasks read; one writes the file.
        part.repartition(1).write.mode("append").parquet(folder)
    return folder


def feed(spark: SparkSession, folder: str, schema: str = EVENTS, files: int = 2) -> DataFrame:
    """A file stream that takes so many files a micro-batch; `ts` becomes a zoned timestamp."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


class CarryForward(StatefulProcessor):
    """Per key: each reading with the latest earlier value of every field that is less than `memory` seconds old.

    State is one (time, value) a field and key. An event-time timer set to the end of the newest one's memory clears a key
    that has gone quiet. A reading older than what the key has seen cannot be placed any more: it is given out marked
    `late`, without carried values, and leaves the state alone.
    """

    def __init__(self, fields: tuple[str, ...], memory: float) -> None:
        self.fields, self.memory = fields, memory

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = ", ".join(f"at_{k} double, value_{k} double" for k in range(len(self.fields)))
        self.held = handle.getValueState("held", f"newest double, {columns}")

    def _end(self, newest: float) -> int:
        """When a key's memory is over, in milliseconds."""
        return int((newest + self.memory) * 1000) + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Most keys have a few readings a batch: plain rows cost less than a frame for each key.
        known = self.held.exists()
        held = list(self.held.get()) if known else [float("-inf")] + [float("nan")] * 2 * len(self.fields)
        batch = [(r["at"], r["event_id"], r["event_type"], r["value"]) for r in rows]
        batch.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))
        before, memory = _micros(held[0]), self.memory * 1e6
        number = {name: k for k, name in enumerate(self.fields)}
        seen, value = [_micros(x) for x in held[1::2]], [None if x != x else x for x in held[2::2]]
        made = Row("user_id", "event_id", "at", "late", *self.fields)
        out, newest = [], held[0]
        for at, event, kind, own in batch:
            # A reading without a time cannot be placed either.
            late = at is None or (before is not None and at < before)
            carried = [None if late or x is None or at - x >= memory else v for x, v in zip(seen, value, strict=True)]
            out.append(made(key[0], event, at, late, *carried))
            if late:
                continue
            newest = max(newest, at / 1e6)
            if (k := number.get(kind)) is not None:
                missing = own is None or own != own
                seen[k], held[1 + 2 * k] = at, at / 1e6
                value[k], held[2 + 2 * k] = (value[k], float("nan")) if missing else (own, own)
        if newest > float("-inf"):
            if known and newest > held[0]:
                self.handle.deleteTimer(self._end(held[0]))
            if not known or newest > held[0]:
                self.handle.registerTimer(self._end(newest))
            held[0] = newest
            self.held.update(tuple(held))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def _micros(seconds: float) -> int | None:
    """Seconds of the state as whole microseconds; nothing for those of no reading."""
    return round(seconds * 1e6) if isfinite(seconds) else None


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def carry_forward(events: DataFrame, fields: tuple[str, ...], memory: float = 6 * 3600, late: str = "2 hours") -> DataFrame:
    """`CarryForward` on a stream of event_id, user_id, ts, event_type, value, behind a watermark that moves the timers."""
    columns = ", ".join(f"{name} double" for name in fields)
    rows = events.select("user_id", "event_id", "ts", F.unix_micros("ts").alias("at"), "event_type", "value").withWatermark("ts", late)
    found = rows.groupBy("user_id").transformWithState(
        CarryForward(fields, memory),
        outputStructType=f"user_id long, event_id long, at long, late boolean, {columns}",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select("user_id", "event_id", F.timestamp_micros("at").alias("ts"), "late", *fields)


def with_rocks(spark: SparkSession, run: Callable[[], DataFrame]) -> DataFrame:
    """Run a stream that needs the state store for timers, and put the session's own store back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        return run()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drain(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there now into a table in the driver's memory: for small feeds only, see `stored`."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
