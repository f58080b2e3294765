"""Sources, sinks, stored views and streams."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from __spark_entry__ import queries
from icuflow.operators import ordered
from icuflow.sources import io
from icuflow.sources.schema import CLINICAL, EVENTS
from icuflow.streaming import live

SF = "/root/testdata/sf0.001"


def test_csv_round_trip_with_index(spark, tmp_path, stay):
    stays = stay((1, 0), (2, 5))
    io.write_csv(stays, str(tmp_path / "stays"), index="icustay_id")
    ordered_columns = "icustay_id long, " + CLINICAL["icustays"].replace("icustay_id long, ", "")
    back = io.read_csv(spark, str(tmp_path / "stays"), ordered_columns)
    assert back.columns[0] == "icustay_id"
    assert sorted(back.select(stays.columns).collect()) == sorted(stays.collect())


def test_sql_file_binds_arguments(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT :word AS w, count(*) AS n FROM range(10) WHERE id >= :least")
    row = io.query_file(spark, path, word="'; drop", least=4).first()
    assert (row["w"], row["n"]) == ("'; drop", 6)


def test_schema_resolution(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS clinic_test")
    spark.range(3).write.mode("overwrite").saveAsTable("clinic_test.three")
    io.use_schema(spark, "clinic_test")
    try:
        assert io.query_text(spark, "SELECT count(*) AS n FROM three").first()["n"] == 3
    finally:
        io.use_schema(spark, "default")


def test_clinical_tables_have_declared_schemas(spark, tmp_path, stay):
    folder = str(tmp_path / "clinic")
    for name, schema in CLINICAL.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    tables = io.clinical_tables(spark, folder)
    assert set(tables) == set(CLINICAL)
    assert all(tables[n].count() == 0 for n in ("patients", "chartevents"))


def test_views_are_rebuilt_and_bucketed_joins_do_not_shuffle(spark, tmp_path):
    built = io.build_views({"one": lambda: spark.range(5), "two": lambda: spark.range(7)}, str(tmp_path))
    assert (built["one"].count(), built["two"].count()) == (5, 7)
    assert io.materialize(spark.range(2), str(tmp_path), "one").count() == 2
    left = io.materialize_bucketed(spark.range(100).withColumnRenamed("id", "k"), "bucket_left", "k", 4)
    right = io.materialize_bucketed(spark.range(50).withColumnRenamed("id", "k"), "bucket_right", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.join(right, "k", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    events = io.Tables(spark, SF).events
    plan = events.filter(F.col("event_type").isin("click", "view")).select("user_id", "value")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(event_type" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


# --- streams --------------------------------------------------------------------------------


def test_complete_stream_equals_batch(spark):
    feed = live.hourly_stream(live.event_stream(spark, SF), ["user_id"], "value")
    done = live.drain(feed, "complete_hours")
    batch = spark.read.schema(EVENTS).parquet(f"{SF}/events.parquet").groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    stream = {(r["user_id"], r["hour"]): r["n"] for r in done.collect()}
    assert stream == {(r["user_id"], r["hour"]): r["n"] for r in batch.collect()}


def test_append_stream_leaves_open_windows_out(spark):
    feed = live.hourly_stream(live.event_stream(spark, SF), ["user_id"], "value")
    closed = live.drain(feed, "append_hours", "append").count()
    every = spark.table("append_hours").count()
    batch = spark.read.parquet(f"{SF}/events.parquet").select("user_id", F.date_trunc("hour", "ts")).distinct().count()
    assert closed == every and 0 < batch - closed <= 20


def test_stream_queries_return_every_window(spark):
    events = spark.read.schema(EVENTS).parquet(f"{SF}/events.parquet")
    hour = F.date_trunc("hour", "ts")
    hours = events.groupBy("user_id", "event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    got = queries()["stream_hourly"](spark, SF).select(hours.columns)
    assert sorted(got.collect()) == sorted(hours.select("user_id", "event_type", F.col("hour").cast("timestamp_ntz"), "n").collect())
    starts = events.select("user_id", F.explode(F.sequence(hour - F.expr("INTERVAL 5 HOURS"), hour, F.expr("INTERVAL 1 HOUR"))).alias("start"))
    starts = starts.groupBy("user_id", F.col("start").cast("timestamp_ntz").alias("start")).agg(F.count(F.lit(1)).alias("n"))
    got = queries()["stream_sliding"](spark, SF).select(starts.columns)
    assert sorted(got.collect()) == sorted(starts.collect())


def test_a_feed_without_closed_windows_is_whole(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (2, "2024-01-01 01:20:00")], "event_id long, ts string")
    rows = rows.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(7).cast("long").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    rows.write.parquet(str(tmp_path / "feed"))
    got = live.every_window(spark, str(tmp_path / "feed"), "hour", lambda feed: live.hourly_stream(feed, ["user_id"], "value"), "*.parquet")
    assert sorted(r["hour"].hour for r in got.collect()) == [0, 1]


def test_sliding_windows_are_time_frames(spark):
    rows = spark.createDataFrame([(1, "2024-01-01 00:10:00", 1.0), (1, "2024-01-01 05:50:00", 3.0)], "k int, ts string, v double")
    got = live.sliding(rows.withColumn("ts", F.col("ts").cast("timestamp")), ["k"], "v").collect()
    assert len(got) == 11 and max(r["n"] for r in got) == 2


def test_repeated_readings_are_dropped(spark, tmp_path):
    events = spark.read.schema(EVENTS).parquet(f"{SF}/events.parquet").limit(50)
    events.unionByName(events).coalesce(1).write.parquet(str(tmp_path / "feed"))
    feed = live.event_stream(spark, str(tmp_path / "feed"), "*.parquet")
    assert live.drain(live.distinct_readings(feed, ["event_id"]), "distinct_events", "append").count() == 50


def test_previous_reading_carries_state_over_batches(spark, tmp_path):
    folder = str(tmp_path / "feed")

    def write(rows):
        frame = spark.createDataFrame(rows, "event_id long, user_id long, ts string, value double")
        frame.select(
            "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.lit("click").alias("event_type"), "value", F.lit("{}").alias("props")
        ).coalesce(1).write.mode("append").parquet(folder)

    store = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    try:
        write([(1, 7, "2024-01-01 00:00:00", 1.0), (2, 7, "2024-01-01 05:59:00", 2.0), (3, 8, "2024-01-01 00:00:00", 9.0)])
        feed = live.previous_reading(live.event_stream(spark, folder, "*.parquet"))
        check = str(tmp_path / "check")
        sink = str(tmp_path / "out")

        def run():
            query = feed.writeStream.format("parquet").option("checkpointLocation", check).option("path", sink).trigger(availableNow=True).start()
            query.awaitTermination()

        run()
        write([(4, 7, "2024-01-01 11:59:00", 3.0), (5, 7, "2024-01-01 12:00:00", 4.0), (6, 8, "2024-01-01 01:00:00", 5.0)])
        run()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {(r["user_id"], r["value"]): r["previous"] for r in spark.read.parquet(sink).collect()}
    # 5 h 59 min back counts, exactly 6 h does not.
    assert got == {(7, 1.0): None, (7, 2.0): 1.0, (7, 3.0): None, (7, 4.0): 3.0, (8, 9.0): None, (8, 5.0): 9.0}


def readings(spark, rows):
    frame = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double")
    return frame.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", F.lit("{}").alias("props"))


def test_windows_of_a_feed_in_any_order_with_late_and_repeated_batches(spark, tmp_path):
    folder, keys = str(tmp_path / "feed"), ["user_id"]
    hours = lambda: F.window("ts", "1 hour")
    rows = [(i, i % 3, f"2024-01-{1 + i % 9:02d} {i % 24:02d}:{i % 60:02d}:00", "click", float(i)) for i in range(200)]
    events = readings(spark, rows)
    events.where("event_id >= 80").repartition(7, "event_id").write.parquet(folder)
    sink = live.PartialWindows(str(tmp_path / "sink"), keys, "value", hours)
    sink.take_in(live.feed(spark, folder))
    first = sink.read(spark).count()
    # Rows of all days come a second time round, long after the others.
    events.where("event_id < 80").repartition(3, "event_id").write.mode("append").parquet(folder)
    again = live.PartialWindows(str(tmp_path / "sink"), keys, "value", hours)
    again.take_in(live.feed(spark, folder))
    # A batch that is written again counts once.
    done = events.withColumn("ts", F.col("ts").cast("timestamp"))
    again.write(done.where("event_id = 0"), 1000)
    before = again.read(spark).agg(F.sum("n")).first()[0]
    again.write(done.where("event_id = 0"), 1000)
    assert again.read(spark).agg(F.sum("n")).first()[0] == before == 201
    again.write(done.where("false"), 1000)
    batch = done.groupBy("user_id", hours().alias("w")).agg(F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))
    want = sorted(map(tuple, batch.select("user_id", "w.start", "mean", "low", "high", "n").collect()))
    assert sorted(map(tuple, again.read(spark).collect())) == want and first <= len(want)


def test_a_feed_by_ranges_of_time_is_in_order(spark):
    events = readings(spark, [(i, 1, f"2024-01-01 {i % 24:02d}:00:00", "click", 1.0) for i in range(48)])
    folder = live.many_files(events, 4, "ts")
    spans = spark.read.parquet(folder).groupBy(F.input_file_name()).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("a").collect()
    spans = [r for r in spans if r["n"]]
    assert sum(r["n"] for r in spans) == 48 and all(x["b"] < y["a"] for x, y in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(live.many_files(events.where("false"), 2, "ts")).count() == 0


def test_carry_forward_marks_late_readings_and_forgets_quiet_keys(spark, tmp_path):
    folder, check, out = str(tmp_path / "feed"), str(tmp_path / "check"), str(tmp_path / "out")

    def run(*rows):
        readings(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = live.carry_forward(live.feed(spark, folder, files=1), ("click", "view"))
        writer = stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
        live.with_rocks(spark, lambda: writer.start(out).awaitTermination())

    def held():
        state = spark.read.format("statestore").option("stateVarName", "held").load(check)
        return {r["key"]["user_id"] for r in live.with_rocks(spark, lambda: state.select("key").collect())}

    run((1, 7, "2024-01-01 00:00:00", "click", 1.0), (2, 7, "2024-01-01 01:00:00", "view", 2.0), (3, 8, "2024-01-01 01:00:00", "click", 5.0))
    # An hour late, but before the watermark's two hours are over; and exactly six hours after the click.
    run((4, 7, "2024-01-01 00:30:00", "click", 9.0), (5, 7, "2024-01-01 06:00:00", "click", 3.0), (6, 7, "2024-01-01 06:30:00", "view", 4.0))
    assert held() == {7, 8}
    # The watermark passes the end of both keys' memory.
    run((7, 9, "2024-01-02 00:00:00", "click", 1.0))
    run((8, 9, "2024-01-02 00:10:00", "view", 2.0))
    assert held() == {9}
    got = {r["event_id"]: (r["late"], r["click"], r["view"]) for r in spark.read.parquet(out).collect()}
    assert got == {
        1: (False, None, None), 2: (False, 1.0, None), 3: (False, None, None), 4: (True, None, None), 5: (False, None, 2.0),
        6: (False, 3.0, 2.0), 7: (False, None, None), 8: (False, 1.0, None),
    }


class OneKey:
    """A handle for one key that notes what is asked of it."""

    def __init__(self):
        self.calls, self.state, self.timers = [], None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.calls.append("exists") or self.state is not None

    def get(self):
        return self.calls.append("get") or self.state

    def update(self, state):
        self.calls.append("update")
        self.state = state

    def deleteTimer(self, at):  # noqa: N802
        self.calls.append("delete")
        self.timers.remove(at)

    def registerTimer(self, at):  # noqa: N802
        self.calls.append("register")
        self.timers.add(at)


def test_carry_forward_takes_plain_rows_and_few_state_calls():
    """A key costs a few state calls and no frames, as there are many keys; six hours are exact to the microsecond."""
    handle, carry = OneKey(), live.CarryForward(("click", "view"), 21600.0)
    carry.init(handle)
    start, hours = 1_704_067_211_172_425, 21_600_000_000

    def given(*rows):
        handle.calls.clear()
        out = carry.handleInputRows((7,), iter([Row(user_id=7, event_id=i, at=at, event_type=kind, value=v) for i, at, kind, v in rows]), None)
        return [(r["event_id"], r["late"], r["click"], r["view"]) for r in out]

    assert given((2, start + 5, "view", None), (1, start, "click", 1.0)) == [(1, False, None, None), (2, False, 1.0, None)]
    assert handle.calls == ["exists", "register", "update"] and len(handle.timers) == 1
    for k in range(1, 200):
        # Older than the last reading, then a microsecond less than six hours after the click, then six hours after that one.
        at = start + 2 * k * (hours - 1)
        got = given((3, at - hours - 10, "view", 9.0), (4, at - hours + 1, "click", 4.0), (5, at, "view", 5.0), (6, at + 5, "click", 6.0), (7, at + hours + 5, "x", 0.0))
        assert got[2] == (5, False, 4.0, None) and got[3][2] is None and got[4][2] is None
        assert len(handle.calls) <= 5 and len(handle.timers) == 1
        handle.state, handle.timers = None, set()


def test_stable_frames_survive_in_the_shared_folder(spark):
    kept = ordered.stable(spark.range(10))
    assert spark.sparkContext.getCheckpointDir() is not None and kept.count() == 10


def test_a_task_brings_together_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """A file of any size is dealt over tasks before its windows are made, and they stay the same."""
    rows = spark.range(90, numPartitions=1).select("id", F.timestamp_seconds(F.col("id") * 900).alias("ts"), F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("k"))
    dealt, deal = [], type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda self, n, *by: dealt.append(n) or deal(self, n, *by))
    found = {}
    for most in (1000, 20):
        monkeypatch.setattr(live, "TASK_ROWS", most, raising=False)
        sink = live.PartialWindows(str(tmp_path / str(most)), ["k"], "v", lambda: F.window("ts", "6 hours", "1 hour"))
        sink.write(rows, 0)
        found[most] = sorted(sink.read(spark).collect())
    assert dealt == [5] and found[20] == found[1000]
