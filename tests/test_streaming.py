"""Streams fed in several batches against the same operator on the whole input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import device_temperature
from millrace.operators import gold
from millrace.session import scratch_dir
from millrace.sources import sinks, tables
from millrace.streaming import heartbeat, jobs, progress

START = dt.datetime(2024, 1, 1)


def as_stream(spark, batches, schema):
    """One file per batch, read one file per trigger in the order written."""
    path = scratch_dir(spark, "feed")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def beats(n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(f"d{i % 3}", START + dt.timedelta(seconds=rnd.randrange(40_000))) for i in range(n)]
    return sorted(rows, key=lambda r: r[1])


def test_tracker_over_batches_equals_batch(spark):
    rows = beats()
    schema = "device_id string, timestamp timestamp"
    out = jobs.run_to_files(heartbeat.track(as_stream(spark, [rows[:150], rows[150:300], rows[300:]], schema)), "t")
    end = rows[-1][1] - dt.timedelta(minutes=1)
    want = heartbeat.changes_batch(spark.createDataFrame(rows, schema), str(end)).collect()
    keep = lambda rs: sorted((r.device_id, r.status, r.changed_at) for r in rs if r.changed_at < end)
    assert keep(out.collect()) == keep(want)


def test_duplicates_across_batches_are_dropped(spark):
    rows = beats(90)
    stream = as_stream(spark, [rows[:60], rows[30:], rows[80:]], "device_id string, timestamp timestamp")
    out = jobs.run_to_files(jobs.deduplicated(stream, late="1 day"), "d")
    assert out.count() == len(set(rows))


def test_hourly_stream_equals_batch_on_closed_hours(spark, root):
    events = tables.table(spark, root, "events")
    cuts = [events.where(c) for c in ("ts < '2024-01-10'", "ts >= '2024-01-10' AND ts < '2024-01-20'", "ts >= '2024-01-20'")]
    path = scratch_dir(spark, "events-feed")
    for part in cuts:
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = jobs.fold_hourly_health(jobs.run_to_files(jobs.hourly_health(tables.as_telemetry(stream)), "h"))
    end = events.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    want = gold.device_health_hourly(tables.telemetry(spark, root)).where(
        F.col("hour_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(end))
    cols = ["device_id", "hour_start", "uptime_minutes", "status", "max_vibration", "cycle_count_delta"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_late_silver_batches_and_progress(spark, root):
    t = tables.telemetry(spark, root).limit(300)
    path = scratch_dir(spark, "topic")
    for _ in range(2):  # the same messages twice, in two files
        tables.as_messages(t.orderBy("message_id")).coalesce(1).write.mode("append").parquet(path)
    raw = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(path)
    with progress.ProgressLog(spark, scratch_dir(spark, "log")) as log:
        out, query = jobs.run_writer(
            lambda o, s: jobs.to_silver(raw, o, s, {"availableNow": True}, ["cycle_count"]), "silver", spark)
        log.wait(query)
    kept = spark.read.parquet(out)
    rejected = spark.read.parquet(jobs.rejected_path(out))
    assert rejected.count() == 2 * t.where("vibration_mm_s > 50").count()
    assert kept.count() == t.where("vibration_mm_s IS NULL OR vibration_mm_s <= 50").count()
    assert kept.select("batch").distinct().count() == 1
    assert log.rows().agg(F.sum("input_rows")).first()[0] == 600


def test_every_message_is_stored_rejected_or_repeated(spark, root):
    t = tables.telemetry(spark, root).where("message_id < 200")
    other = t.withColumn("cycle_count", F.col("cycle_count") + 1000)  # other messages of the same devices and instants
    path = scratch_dir(spark, "topic")
    for part in (t.unionByName(other), other.withColumn("cycle_count", F.col("cycle_count") + 1000)):
        tables.as_messages(part).coalesce(1).write.mode("append").parquet(path)
    raw = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(path)
    out, _ = jobs.run_writer(lambda o, s: jobs.to_silver(raw, o, s, {"availableNow": True}, ["cycle_count"]), "silver", spark)
    stored, repeated = spark.read.parquet(out), spark.read.parquet(jobs.repeated_path(out))
    good = t.where("vibration_mm_s IS NULL OR vibration_mm_s <= 50").count()
    assert stored.count() == good and repeated.count() == 2 * good
    assert repeated.groupBy("batch").count().orderBy("batch").collect() == [(0, good), (1, good)]
    assert stored.count() + repeated.count() + spark.read.parquet(jobs.rejected_path(out)).count() == 3 * t.count()


def test_progress_of_more_batches_than_a_query_remembers(spark):
    path = scratch_dir(spark, "many")
    spark.range(105).select(F.col("id").cast("string").alias("value"), "id").repartitionByRange(105, "id").write.partitionBy("id").text(path)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    with progress.ProgressLog(spark, scratch_dir(spark, "log")) as log:
        query = (stream.writeStream.format("noop").option("checkpointLocation", scratch_dir(spark, "state"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        log.wait(query)
    rows = log.rows().where(F.col("run_id") == str(query.runId))
    assert rows.agg(F.sum("input_rows"), F.count_distinct("batch_id")).first()[:2] == (105, 105)


def test_late_branch_and_the_rest_make_the_whole(spark, root):
    t = tables.telemetry(spark, root)
    in_time, late = jobs.split_late(t)
    assert in_time.columns == t.columns and in_time.count() + late.count() == t.count()
    assert late.agg(F.min("latency_seconds")).first()[0] > 600


def test_lag_counts_from_next_offsets(spark):
    rows = [(1, "telemetry", '{"t":{"0":5,"1":20}}', '{"t":{"0":1510,"1":20,"2":12000}}')]
    df = spark.createDataFrame(rows, "batch_id long, source string, end_offset string, latest_offset string")
    got = {r.partition: (r.lag, r.level) for r in progress.lag_alerts(progress.lag_per_partition(df)).collect()}
    assert got == {"t-0": (1505, "warning"), "t-1": (0, "ok"), "t-2": (12000, "critical")}


def test_keyed_messages_hold_the_whole_row(spark):
    df = spark.createDataFrame([("c", "e", 1.5)], "customer_id string, event_id string, value double")
    m = sinks.keyed_messages(df).first()
    assert m.key == "c" and m.value == '{"customer_id":"c","event_id":"e","value":1.5}'


def test_open_device_temperature(spark):
    df = spark.createDataFrame([(None, 2.0, 3.0)], "tool_temperature_c double, motor_temperature_c double, air_temperature_c double")
    assert df.select(device_temperature().alias("t")).first().t == pytest.approx(2.0)
