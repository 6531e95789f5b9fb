"""Streaming queries: each runs a stream over the whole stored table to its end and returns its output.

Windows that are still open when the input ends are not emitted; the SQL leaves them out by the same
watermark rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.quantiles import merged_quantiles, rank_errors, sketches
from millrace.operators.silver import with_reject_reason
from millrace.plans.base import REQUESTS, TELEMETRY, day, query, rounded, ts, with_
from millrace.plans.reliability import METRICS_SQL, alert_sql
from millrace.plans.telemetry import EVENTS, HOURLY, with_temperature
from millrace.session import scratch_dir, staged
from millrace.sources import sinks, tables, topics
from millrace.sources.messages import read_bronze, table_stream
from millrace.streaming import alerting, heartbeat, hot, jobs, late, progress

T_ = with_(TELEMETRY)
WATERMARK = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


def telemetry_stream(spark, root):
    return tables.as_telemetry(table_stream(spark, root, "events"))


def message_stream(spark, root):
    """The table's rows as keyed JSON messages in a folder, read as a stream."""
    folder = scratch_dir(spark, "topic")
    tables.as_messages(tables.spread(tables.telemetry(spark, root))).write.parquet(folder)
    return spark.readStream.schema("key string, value string").parquet(folder)


@query("stream_deduplicated", "ST3 S1", T_ + f"""
SELECT DISTINCT device_id, {ts('"timestamp"')} AS "timestamp", message_id FROM telemetry""")
def _(spark, root):
    # Every message arrives twice.
    twice = telemetry_stream(spark, root).unionByName(telemetry_stream(spark, root))
    out = jobs.run_to_files(jobs.deduplicated(twice), "dedup")
    return out.select("device_id", "timestamp", "message_id")


@query("stream_hourly_health", "ST4", with_(HOURLY) + f"""
SELECT device_id, customer_id, device_type, {ts('hour_start')} AS hour_start, round(avg_spindle_rpm, 8) AS avg_spindle_rpm,
       round(avg_temperature, 10) AS avg_temperature, max_vibration, round(avg_power_kw, 10) AS avg_power_kw,
       cycle_count_delta, uptime_minutes, status
FROM hourly WHERE hour_start + INTERVAL 1 HOUR <= {WATERMARK}""")
def _(spark, root):
    parts = jobs.run_to_files(jobs.hourly_health(telemetry_stream(spark, root)), "hourly")
    return rounded(jobs.fold_hourly_health(parts), avg_spindle_rpm=8)


@query("stream_sliding_requests", "ST5", with_(REQUESTS) + f"""
SELECT {ts('w')} AS window_start, endpoint, count(*) AS requests, count(*) FILTER (status_code LIKE '5%') AS failed
FROM (SELECT *, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w
      FROM requests) x WHERE w + INTERVAL 5 MINUTE <= {WATERMARK} GROUP BY w, endpoint""")
def _(spark, root):
    log = tables.as_requests(table_stream(spark, root, "events"))
    out = jobs.run_to_files(jobs.sliding_requests(log), "rates")
    return out.select("window_start", "endpoint", "requests", "failed")


@query("stream_sessions", "ST6", T_ + f"""
, marked AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w <= INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS new
             FROM telemetry WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", message_id)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY device_id ORDER BY "timestamp", message_id) AS s FROM marked)
SELECT device_id, {ts('min("timestamp")')} AS session_start, {ts('max("timestamp")')} AS last_message, count(*) AS messages
FROM numbered GROUP BY device_id, s HAVING max("timestamp") + INTERVAL 5 MINUTE <= {WATERMARK}""")
def _(spark, root):
    return jobs.run_to_files(jobs.sessions(telemetry_stream(spark, root)), "sessions")


@query("stream_threshold_events", "ST9", with_(TELEMETRY, EVENTS) + f"""
SELECT event_id, device_id, {ts('"timestamp"')} AS "timestamp", error_code, severity, message, value FROM threshold_events""")
def _(spark, root):
    out = jobs.run_to_files(jobs.events(telemetry_stream(spark, root)), "events")
    return out.select("event_id", "device_id", "timestamp", "error_code", "severity", "message", "value")


@query("stream_event_topic", "S2 ST9", with_(TELEMETRY, EVENTS) + """
SELECT customer_id AS key, error_code, count(*) AS messages FROM threshold_events GROUP BY 1, 2""")
def _(spark, root):
    # The keyed messages a topic would receive, read back from files.
    out = jobs.run_to_files(sinks.keyed_messages(jobs.events(telemetry_stream(spark, root))), "topic")
    code = F.get_json_object("value", "$.error_code")
    return out.groupBy("key", code.alias("error_code")).agg(F.count(F.lit(1)).alias("messages"))


@query("stream_enriched", "J11", T_ + """
SELECT t.message_id, c.c_mktsegment AS segment FROM telemetry t LEFT JOIN customer c ON c.c_custkey = t.user_id""")
def _(spark, root):
    registry = tables.table(spark, root, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    joined = jobs.enriched(telemetry_stream(spark, root), registry, "user_id").select("message_id", "segment")
    return jobs.run_to_files(joined, "enriched")


@query("stream_bronze", "ST1 S1 S3", T_ + f"""
SELECT customer_id, {day('"timestamp"')} AS date, count(*) AS messages,
       count(*) FILTER (device_type = 'hvac') AS hvac_messages FROM telemetry GROUP BY 1, 2""")
def _(spark, root):
    raw = message_stream(spark, root)
    by = ["customer_id", "date"]
    path, _ = jobs.run_writer(
        lambda out, state: jobs.to_bronze(raw, out, state, {"availableNow": True}, by), "bronze", spark)
    stored = read_bronze(spark, path)
    return stored.groupBy("customer_id", "date").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("device_type") == "hvac").alias("hvac_messages"))


@query("stream_silver", "ST2 S6", T_ + f"""
SELECT device_id, {day('"timestamp"')} AS date, count(DISTINCT "timestamp") AS rows_held FROM telemetry
WHERE (vibration_mm_s IS NULL OR vibration_mm_s <= 50) GROUP BY 1, 2""")
def _(spark, root):
    raw = message_stream(spark, root)
    path, _ = jobs.run_writer(
        lambda out, state: jobs.to_silver(raw, out, state, {"availableNow": True}, ["cycle_count"]), "silver", spark)
    return spark.read.parquet(path).groupBy("device_id", "date").agg(F.count(F.lit(1)).alias("rows_held"))


@query("stream_device_status", "ST8 UD4", T_ + f"""
, beats AS (SELECT DISTINCT device_id, "timestamp" AS t FROM telemetry WHERE status = 'view'),
gaps AS (SELECT device_id, t, lead(t) OVER (PARTITION BY device_id ORDER BY t) AS n FROM beats),
mark AS (SELECT max(t) - INTERVAL 1 MINUTE AS w FROM beats)
SELECT device_id, 'online' AS status, {ts('min(t)')} AS changed_at FROM beats GROUP BY 1
UNION ALL SELECT device_id, 'offline', {ts('t + INTERVAL 5 MINUTE')} FROM gaps, mark
  WHERE (n IS NOT NULL AND n > t + INTERVAL 5 MINUTE) OR (n IS NULL AND w > t + INTERVAL 5 MINUTE)
UNION ALL SELECT device_id, 'online', {ts('n')} FROM gaps WHERE n > t + INTERVAL 5 MINUTE""")
def _(spark, root):
    beats = telemetry_stream(spark, root).where("status = 'view'")
    out = jobs.run_to_files(heartbeat.track(beats), "status")
    return out.select("device_id", "status", "changed_at")


@query("device_status_batch", "ST8", T_ + f"""
, beats AS (SELECT DISTINCT device_id, "timestamp" AS t FROM telemetry WHERE status = 'view'),
gaps AS (SELECT device_id, t, lead(t) OVER (PARTITION BY device_id ORDER BY t) AS n FROM beats)
SELECT device_id, 'online' AS status, {ts('min(t)')} AS changed_at FROM beats GROUP BY 1
UNION ALL SELECT device_id, 'offline', {ts('t + INTERVAL 5 MINUTE')} FROM gaps
  WHERE coalesce(n, TIMESTAMP '2024-01-31') > t + INTERVAL 5 MINUTE
UNION ALL SELECT device_id, 'online', {ts('n')} FROM gaps WHERE n > t + INTERVAL 5 MINUTE""")
def _(spark, root):
    beats = tables.telemetry(spark, root).where("status = 'view'")
    return heartbeat.changes_batch(beats, "2024-01-31 00:00:00").select("device_id", "status", "changed_at")


@query("stream_dead_letters", "F3 ST2", T_ + """
SELECT 'rejected' AS part, reject_reason, count(*) AS messages FROM (
  SELECT CASE WHEN vibration_mm_s > 50 THEN 'out_of_range_vibration_mm_s' END AS reject_reason FROM telemetry) x
WHERE reject_reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'stored', NULL, count(*) FROM telemetry WHERE vibration_mm_s IS NULL OR vibration_mm_s <= 50""")
def _(spark, root):
    # No message is lost: every row is stored or rejected with a reason. Silver has one row per device and instant; SQL
    # counts further ones as stored, here they are rejected as repeated.
    raw = message_stream(spark, root)
    path, _ = jobs.run_writer(
        lambda out, state: jobs.to_silver(raw, out, state, {"availableNow": True}, ["cycle_count"]), "letters", spark)
    rejected = spark.read.parquet(jobs.rejected_path(path)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))
    silver = spark.read.parquet(path)
    stored = silver.agg(F.count(F.lit(1)).alias("messages"))
    repeated = spark.read.schema(silver.schema).parquet(jobs.repeated_path(path)).groupBy(
        F.lit("repeated_device_timestamp").alias("reject_reason")).agg(F.count(F.lit(1)).alias("messages"))
    return rejected.unionByName(repeated).select(F.lit("rejected").alias("part"), "reject_reason", "messages").unionByName(
        stored.select(F.lit("stored").alias("part"), F.lit(None).cast("string").alias("reject_reason"), "messages"))


@query("stream_late_rows", "ST7 ST11", T_ + f"""
SELECT CASE WHEN epoch(sent_at - "timestamp") > 600 THEN 'late' ELSE 'in time' END AS part, customer_id,
       {ts('date_trunc(\'hour\', "timestamp")')} AS hour, count(*) AS messages FROM telemetry GROUP BY 1, 2, 3""")
def _(spark, root):
    # The two branches of one stream: what the stateful steps get, and the hours to reprocess.
    in_time, late = jobs.split_late(telemetry_stream(spark, root))
    out = None
    for part, stream in (("in time", in_time), ("late", late)):
        stored = jobs.run_to_files(stream.select("customer_id", "timestamp"), "branch")
        counted = stored.groupBy("customer_id", F.date_trunc("hour", "timestamp").alias("hour")).agg(
            F.count(F.lit(1)).alias("messages")).withColumn("part", F.lit(part))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("stream_progress", "S10 ST10", "SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS timed FROM events")
def _(spark, root):
    raw = message_stream(spark, root)
    with progress.ProgressLog(spark, scratch_dir(spark, "progress-log")) as log:
        _, run = jobs.run_writer(
            lambda out, state: jobs.to_silver(raw, out, state, {"availableNow": True}, ["cycle_count"]), "progress", spark)
        log.wait(run)
    return log.rows().agg(F.sum("input_rows").alias("input_rows"), (F.sum("duration_ms") > 0).alias("timed"))


@query("job_counters", "S10", T_ + """
SELECT count(*) AS consumed, count(*) FILTER (vibration_mm_s > 50) AS rejected,
       count(*) FILTER (vibration_mm_s IS NULL OR vibration_mm_s <= 50) AS inserted FROM telemetry""")
def _(spark, root):
    # The counters are filled by the write itself.
    marked = with_reject_reason(with_temperature(tables.telemetry(spark, root)))
    counted, seen = progress.counted(marked, F.col("reject_reason").isNotNull())
    counted.select("message_id", "reject_reason").write.parquet(scratch_dir(spark, "counted"))
    got = seen.get
    return spark.createDataFrame([(got["consumed"], got["rejected"], got["inserted"])],
                                 "consumed long, rejected long, inserted long")


@query("partition_lag", "ST10", """
SELECT 'telemetry-' || (user_id % 8) AS partition, count(*) - count(*) FILTER (ts < TIMESTAMP '2024-01-25') AS lag,
       CASE WHEN count(*) FILTER (ts >= TIMESTAMP '2024-01-25') > 10000 THEN 'critical'
            WHEN count(*) FILTER (ts >= TIMESTAMP '2024-01-25') > 1000 THEN 'warning' ELSE 'ok' END AS level
FROM events GROUP BY user_id % 8""")
def _(spark, root):
    # Offsets of a topic of eight partitions whose consumer has read up to one instant.
    e = tables.table(spark, root, "events").select(
        (F.col("user_id") % 8).cast("string").alias("p"), (F.col("ts").cast("timestamp") < "2024-01-25").alias("read"))
    per = e.groupBy("p").agg(F.count(F.lit(1)).alias("latest"), F.count_if("read").alias("done"))
    offsets = per.agg(*[F.to_json(F.map_from_arrays(F.array(F.lit("telemetry")), F.array(F.map_from_entries(
        F.collect_list(F.struct("p", c)))))).alias(n) for c, n in (("done", "end_offset"), ("latest", "latest_offset"))])
    last = offsets.select(F.lit(0).cast("long").alias("batch_id"), F.lit("telemetry").alias("source"),
                          "end_offset", "latest_offset")
    return progress.lag_alerts(progress.lag_per_partition(last))


# Out-of-order input ------------------------------------------------------------------------------

# The table as it might arrive: every seventh message three hours after it was sent, in batches of some days.
ARRIVALS = TELEMETRY + """,
arrivals AS (SELECT *, CAST(floor((epoch(sent_at) + CASE WHEN message_id % 7 = 0 THEN 10800 ELSE 0 END - 1704067200) / 432000.0) AS INT) AS batch
             FROM telemetry),
tops AS (SELECT batch, max("timestamp") AS top FROM arrivals GROUP BY 1),
marks AS (SELECT batch, date_trunc('millisecond', max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                        - INTERVAL 10 MINUTE AS mark FROM tops),
judged AS (SELECT a.*, mark FROM arrivals a JOIN marks USING (batch)),
final AS (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 10 MINUTE AS mark FROM telemetry)"""


def arrivals(spark, root):
    """A stream of those batches: one file per batch, each a micro-batch, in order."""
    folder = scratch_dir(spark, "arrivals")
    delay = F.when(F.col("message_id") % 7 == 0, 10800).otherwise(0)
    rows = tables.telemetry(spark, root).withColumn(
        "batch", F.floor((F.unix_seconds("sent_at") + delay - 1704067200) / 432000).cast("int"))
    low, high = rows.agg(F.min("batch"), F.max("batch")).first()
    for i in range(low, high + 1):
        rows.where(F.col("batch") == i).drop("batch").repartition(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", "1").parquet(folder)


def run_late(spark, stream, name):
    with late.keyed_state(spark):
        return jobs.run_to_files(stream, name)


@query("stream_hourly_health_late", "ST4 ST7", with_(ARRIVALS) + f""",
split AS (SELECT *, date_trunc('hour', "timestamp") AS hour,
                 coalesce(date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= mark, false) AS late FROM judged)
SELECT 'hour' AS part, device_id, {ts('hour')} AS hour, count(*) AS messages, max(vibration_mm_s) AS max_vibration,
       round(sum(power_kw), 6) AS power, max(cycle_count) - min(cycle_count) AS cycles
FROM split WHERE NOT late AND hour + INTERVAL 1 HOUR <= (SELECT mark FROM final) GROUP BY 2, 3
UNION ALL
SELECT 'late', device_id, {ts('hour')}, count(*), max(vibration_mm_s), round(sum(power_kw), 6), max(cycle_count) - min(cycle_count)
FROM split WHERE late GROUP BY 2, 3""")
def _(spark, root):
    out = run_late(spark, late.hourly_health(arrivals(spark, root)), "hourly-late")
    hours = jobs.fold_hourly_health(late.closed_hours(out)).select(
        F.lit("hour").alias("part"), "device_id", F.col("hour_start").alias("hour"), F.col("uptime_minutes").alias("messages"),
        "max_vibration", (F.col("avg_power_kw") * F.col("uptime_minutes")).alias("power"), F.col("cycle_count_delta").alias("cycles"))
    behind = late.late_rows(out, ["device_id", "timestamp", "vibration_mm_s", "power_kw", "cycle_count"]).groupBy(
        F.lit("late").alias("part"), "device_id", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("messages"), F.max("vibration_mm_s").alias("max_vibration"), F.sum("power_kw").alias("power"),
        (F.max("cycle_count") - F.min("cycle_count")).cast("long").alias("cycles"))
    return rounded(hours.unionByName(behind), 6)


@query("stream_sessions_late", "ST6 ST7", with_(ARRIVALS) + f""",
split AS (SELECT *, coalesce("timestamp" + INTERVAL 5 MINUTE <= mark, false) AS late FROM judged),
marked AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w <= INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS new
           FROM split WHERE NOT late WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", message_id)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY device_id ORDER BY "timestamp", message_id) AS s FROM marked)
SELECT 'session' AS part, device_id, {ts('min("timestamp")')} AS session_start, {ts('max("timestamp")')} AS last_message,
       count(*) AS messages
FROM numbered GROUP BY device_id, s HAVING max("timestamp") + INTERVAL 5 MINUTE <= (SELECT mark FROM final)
UNION ALL SELECT 'late', device_id, {ts('"timestamp"')}, {ts('"timestamp"')}, count(*) FROM split WHERE late GROUP BY 2, 3""")
def _(spark, root):
    out = run_late(spark, late.sessions(arrivals(spark, root)), "sessions-late")
    behind = late.late_rows(out, ["device_id", "timestamp"]).groupBy("device_id", F.col("timestamp").alias("session_start")).agg(
        F.max("timestamp").alias("last_message"), F.count(F.lit(1)).alias("messages"))
    return late.closed_sessions(out).withColumn("part", F.lit("session")).unionByName(behind.withColumn("part", F.lit("late")))


@query("stream_deduplicated_late", "ST3 ST7 U2", with_(ARRIVALS) + f""",
split AS (SELECT *, coalesce("timestamp" <= mark, false) AS late FROM judged)
SELECT 'first' AS part, device_id, {ts('"timestamp"')} AS "timestamp", arg_min(message_id, (batch, message_id)) AS message_id, 1 AS copies
FROM split WHERE NOT late GROUP BY 2, 3
UNION ALL SELECT 'late', device_id, {ts('"timestamp"')}, message_id, 2 FROM split WHERE late""")
def _(spark, root):
    # Every message arrives twice; late copies are handed on, not dropped.
    stream = arrivals(spark, root).select("device_id", "timestamp", "message_id")
    twice = stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = run_late(spark, late.deduplicated(twice, ["message_id"]), "first-late")
    return out.groupBy(F.when(F.col("late"), "late").otherwise("first").alias("part"), "device_id", "timestamp", "message_id").agg(
        F.count(F.lit(1)).alias("copies"))


# Alerts of the minutes behind the final watermark, as the batch has them; the last of them may be without requests.
CLOSED = """log AS (SELECT * FROM requests),
closed AS (SELECT date_trunc('minute', date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE) AS stop FROM log)"""
STREAM_ALERTS = with_(
    REQUESTS, CLOSED, METRICS_SQL.replace("FROM requests GROUP BY 1", "FROM log WHERE ts < (SELECT stop FROM closed) GROUP BY 1")
    .replace("max(minute), INTERVAL 1 MINUTE", "(SELECT stop FROM closed) - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE")) + alert_sql()


@query("stream_alerts", "ST9 W8 K4", STREAM_ALERTS.replace("\nSELECT alert, severity, ", ", fired AS (SELECT alert, severity, ") + f""")
SELECT alert, severity, 'firing' AS state, started_at, fired_at AS at FROM fired
UNION ALL SELECT alert, severity, 'resolved', started_at, last_true_at FROM fired
WHERE last_true_at < {ts("(SELECT stop FROM closed) - INTERVAL 1 MINUTE")}""")
def _(spark, root):
    # The same alerts as the batch, told as they begin to fire and end.
    log = tables.as_requests(table_stream(spark, root, "events"))
    out = run_late(spark, alerting.alert_changes(log), "alerts")
    return out.where("state <> 'pending'").drop("service")


LAG_BATCHES, LAG_PARTITIONS, LAG_EVERY_S = 6, 4, 60


@query("consumer_lag", "ST10 S10", f"""
WITH sized AS (SELECT partition, count(*) AS n FROM (
  SELECT user_id % {LAG_PARTITIONS} AS partition FROM events) x GROUP BY 1),
limits AS (SELECT max(n) // {LAG_BATCHES} + 1 AS step, max(n) // 4 AS warning, max(n) // 2 AS critical FROM sized),
samples AS (SELECT 'telemetry-' || partition AS partition, b, n - least(n, (b + 1) * step) AS lag, warning, critical
            FROM sized CROSS JOIN limits CROSS JOIN (SELECT unnest(range({LAG_BATCHES})) AS b) r),
-- Batches are a minute apart: a lag above its limit for 5 and 2 minutes is one above it in 6 and 3 batches running.
held AS (SELECT *, min(lag) OVER (PARTITION BY partition ORDER BY b ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS low_3,
                min(lag) OVER (PARTITION BY partition ORDER BY b ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS low_6 FROM samples)
SELECT partition, b AS batch_id, lag,
       CASE WHEN b >= 2 AND low_3 > critical THEN 'critical' WHEN b >= 5 AND low_6 > warning THEN 'warning' ELSE 'ok' END AS level
FROM held""")
def _(spark, root):
    # A topic in files read in several batches; lags and levels from the progress events of the run.
    path = scratch_dir(spark, "topic")
    events = tables.table(spark, root, "events")
    messages = events.select((F.col("user_id") % LAG_PARTITIONS).alias("partition"), F.col("user_id").cast("string").alias("key"),
                             F.col("event_type").alias("value"), "event_id")
    topics.append_topic(messages, path, LAG_PARTITIONS, ["event_id"])
    heads = topics.head_offsets(path, LAG_PARTITIONS)
    stream = topics.topic_stream(spark, path, LAG_PARTITIONS, "telemetry", max(heads) // LAG_BATCHES + 1, "lag")
    with progress.ProgressLog(spark, scratch_dir(spark, "lag-log")) as log:
        run = (stream.writeStream.format("noop").option("checkpointLocation", scratch_dir(spark, "lag-state"))
               .trigger(processingTime="0 seconds").start())
        run.processAllAvailable()
        run.stop()
        log.wait(run)
    at = F.timestamp_seconds(F.col("batch_id") * LAG_EVERY_S)
    samples = progress.lag_samples(log.rows().where("input_rows > 0")).withColumn("at", at)
    return progress.held_lag_alerts(samples, warning=max(heads) // 4, critical=max(heads) // 2).select(
        "partition", "batch_id", "lag", "level")


@query("latency_quantiles_sketched", "A11 ST5", with_(REQUESTS) + f"""
SELECT 'day' AS part, endpoint, {ts("date_trunc('day', ts)")} AS window_start, count(*) AS n, true AS within_one_percent
FROM requests GROUP BY 2, 3
UNION ALL SELECT 'sliding', endpoint, {ts('w')}, count(*), true
FROM (SELECT *, unnest(generate_series(date_trunc('day', ts) + to_hours(CAST(6 * (date_part('hour', ts) // 6) AS BIGINT)) - INTERVAL 18 HOUR,
      date_trunc('day', ts) + to_hours(CAST(6 * (date_part('hour', ts) // 6) AS BIGINT)), INTERVAL 6 HOUR)) AS w FROM requests) x GROUP BY 2, 3
UNION ALL SELECT 'stream', endpoint, {ts("date_trunc('day', ts)")}, count(*), true
FROM requests WHERE ts < date_trunc('minute', {WATERMARK}) GROUP BY 2, 3""")
def _(spark, root):
    # One table of minute sketches answers for days and for sliding windows; a stream fills the same table.
    q = {"p95": 0.95}
    log = tables.requests(spark, root).select("endpoint", "ts", "duration_s")
    stored = staged(sketches(log, ["endpoint", F.date_trunc("minute", "ts").alias("minute")], "duration_s"), "minute-sketches")
    live = jobs.run_to_files(jobs.minute_sketches(tables.as_requests(table_stream(spark, root, "events")), ["endpoint"]), "sketches")
    closed = log.join(live.select("minute").distinct(), F.date_trunc("minute", "ts") == F.col("minute"), "left_semi")
    of_day = lambda c: F.date_trunc("day", c).alias("window_start")
    sliding = lambda c: F.window(c, "24 hours", "6 hours")
    out = None
    for part, rows, minutes, start in (("day", log, stored, of_day), ("sliding", log, stored, sliding), ("stream", closed, live, of_day)):
        windowed = lambda df, c: (df.withColumn("w", start(c)).withColumn("window_start", F.col("w.start")).drop("w")
                                  if start is sliding else df.withColumn("window_start", start(c)))
        found = merged_quantiles(windowed(minutes, "minute"), ["endpoint", "window_start"], q)
        errors = rank_errors(windowed(rows, "ts"), found, ["endpoint", "window_start"], "duration_s", "p95", 0.95)
        one = found.join(errors, ["endpoint", "window_start"]).select(
            F.lit(part).alias("part"), "endpoint", "window_start", "n", (F.col("rank_error") <= 0.01).alias("within_one_percent"))
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_hot_customers", "A25 P9 ST5", T_ + """
, skewed AS (SELECT CASE WHEN user_id % 10 < 4 THEN 'cust-0' ELSE 'cust-' || (1 + user_id % 37) END AS customer_id, facility FROM telemetry),
shares AS (SELECT customer_id, count(*) / (SELECT count(*) FROM skewed)::DOUBLE AS share FROM skewed GROUP BY 1)
SELECT CASE WHEN share > 0.2 THEN customer_id || ':' || facility ELSE customer_id END AS routing_key, count(*) AS messages
FROM skewed JOIN shares USING (customer_id) GROUP BY 1""")
def _(spark, root):
    # The busiest customer's key is split by facility as soon as the stream's summaries show it.
    def skewed(rows):
        return rows.withColumn("customer_id", F.when(F.col("user_id") % 10 < 4, "cust-0").otherwise(
            F.concat(F.lit("cust-"), 1 + F.col("user_id") % 37)))

    told = run_late(spark, hot.summaries(skewed(arrivals(spark, root))), "hot")
    routed = hot.split_keys(skewed(tables.telemetry(spark, root)), hot.hot_tenants(told))
    return routed.groupBy("routing_key").agg(F.count(F.lit(1)).alias("messages"))
