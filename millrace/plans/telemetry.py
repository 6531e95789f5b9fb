"""Telemetry queries: cleaning, keyed writes, hourly and daily aggregates, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import gold, rules, silver, state, upsert
from millrace.plans.base import TELEMETRY, day, query, rounded, ts, with_
from millrace.schemas import METRICS
from millrace.session import scratch_dir, staged
from millrace.sources import sinks, tables
from millrace.sources.messages import read_bronze, run_summary
from millrace.streaming import heartbeat

ASOF = "2024-01-15 00:00:00"
T_ = with_(TELEMETRY)

HOURLY = TELEMETRY + """,
status_rank AS (
  SELECT device_id, date_trunc('hour', "timestamp") AS hour_start, status,
         row_number() OVER (PARTITION BY device_id, date_trunc('hour', "timestamp")
                            ORDER BY count(*) DESC, status) AS r
  FROM telemetry GROUP BY 1, 2, 3),
hourly AS (
  SELECT t.*, s.status FROM (
    SELECT device_id, customer_id, device_type, date_trunc('hour', "timestamp") AS hour_start,
           avg(spindle_rpm) AS avg_spindle_rpm,
           avg(coalesce(tool_temperature_c, motor_temperature_c, air_temperature_c)) AS avg_temperature,
           max(vibration_mm_s) AS max_vibration, avg(power_kw) AS avg_power_kw,
           CAST(max(cycle_count) - min(cycle_count) AS BIGINT) AS cycle_count_delta,
           count(*) AS uptime_minutes
    FROM telemetry GROUP BY 1, 2, 3, 4) t
  JOIN status_rank s ON s.device_id = t.device_id AND s.hour_start = t.hour_start AND s.r = 1)"""


@query("device_health_hourly", "A1 A2 A3 P3 X1 X5", with_(HOURLY) + f"""
SELECT device_id, customer_id, device_type, {ts('hour_start')} AS hour_start,
       round(avg_spindle_rpm, 8) AS avg_spindle_rpm, round(avg_temperature, 10) AS avg_temperature,
       max_vibration, round(avg_power_kw, 10) AS avg_power_kw, cycle_count_delta, uptime_minutes, status
FROM hourly""")
def _(spark, root):
    return rounded(gold.device_health_hourly(tables.telemetry(spark, root)), avg_spindle_rpm=8)


@query("cycle_increase", "A3", T_ + f"""
SELECT device_id, {ts('hour_start')} AS hour_start, CAST(max(c) - min(c) AS BIGINT) AS max_min_delta,
       CAST(coalesce(sum(greatest(c - p, 0)), 0) AS BIGINT) AS reset_aware_delta
FROM (SELECT device_id, date_trunc('hour', "timestamp") AS hour_start, cycle_count % 1000 AS c,
             lag(cycle_count % 1000) OVER (PARTITION BY device_id, date_trunc('hour', "timestamp")
                                           ORDER BY "timestamp", message_id) AS p
      FROM telemetry) x GROUP BY 1, 2""")
def _(spark, root):
    # A counter that starts anew every thousand cycles.
    t = tables.telemetry(spark, root).withColumn("cycle_count", F.col("cycle_count") % 1000)
    return gold.counter_increase(t, tie=["message_id"])


@query("customer_metrics_daily", "A4 A5", with_(HOURLY) + f"""
SELECT customer_id, {day('hour_start')} AS date, count(DISTINCT device_id) AS device_count,
       CAST(sum(cycle_count_delta) AS BIGINT) AS total_cycles,
       round(avg(CAST(uptime_minutes AS DOUBLE) / 60.0 * 100.0), 10) AS avg_uptime_pct,
       CAST(sum(CASE WHEN max_vibration > 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
FROM hourly GROUP BY 1, 2""")
def _(spark, root):
    return rounded(gold.customer_metrics_daily(gold.device_health_hourly(tables.telemetry(spark, root))))


DAILY = """daily0 AS (
  SELECT device_id, customer_id, CAST("timestamp" AS DATE) AS date, max(device_type) AS device_type,
         max(model) AS model, max(facility) AS facility, count(*) AS reading_count,
         CAST(count(*) AS DOUBLE) / 60.0 AS runtime_hours, CAST(count(*) AS DOUBLE) / 1440.0 * 100.0 AS uptime_pct,
         CAST(max(cycle_count) - min(cycle_count) AS BIGINT) AS cycle_count,
         avg(vibration_mm_s) AS avg_vibration_mm_s, max(vibration_mm_s) AS max_vibration_mm_s,
         quantile_cont(vibration_mm_s, 0.95) AS p95_vibration_mm_s,
         avg(tool_temperature_c) AS avg_temperature_c, max(tool_temperature_c) AS max_temperature_c,
         sum(power_kw) / 60.0 AS total_energy_kwh, avg(power_kw) AS avg_power_kw, max(power_kw) AS peak_power_kw,
         CAST(sum(CASE WHEN vibration_mm_s > 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS vibration_anomalies,
         CAST(sum(CASE WHEN tool_temperature_c > 80 THEN 1 ELSE 0 END) AS BIGINT) AS temperature_anomalies
  FROM telemetry GROUP BY 1, 2, 3),
errors AS (SELECT device_id, CAST("timestamp" AS DATE) AS date, count(*) AS error_count
           FROM telemetry WHERE status = 'error' GROUP BY 1, 2),
daily AS (
  SELECT d.*, greatest(0.0, 100.0 - CAST(vibration_anomalies AS DOUBLE) / 10.0
                            - CAST(temperature_anomalies AS DOUBLE) / 10.0) AS health_score,
         coalesce(e.error_count, 0) AS error_count
  FROM daily0 d LEFT JOIN errors e ON e.device_id = d.device_id AND e.date = d.date)"""
DAILY_SQL = with_(TELEMETRY, DAILY)


def daily_summary(spark, root):
    t = tables.telemetry(spark, root)
    return gold.device_daily_summary(t, t.where("status = 'error'"))


@query("device_daily_summary", "A6 J8 X13", DAILY_SQL + f"""
SELECT device_id, customer_id, {day('date')} AS date, device_type, model, facility, reading_count,
       round(runtime_hours, 10) AS runtime_hours, round(uptime_pct, 10) AS uptime_pct, cycle_count,
       round(avg_vibration_mm_s, 10) AS avg_vibration_mm_s, max_vibration_mm_s,
       round(p95_vibration_mm_s, 8) AS p95_vibration_mm_s, round(avg_temperature_c, 10) AS avg_temperature_c,
       max_temperature_c, round(total_energy_kwh, 8) AS total_energy_kwh, round(avg_power_kw, 10) AS avg_power_kw,
       peak_power_kw, vibration_anomalies, temperature_anomalies, round(health_score, 10) AS health_score,
       error_count
FROM daily""")
def _(spark, root):
    return rounded(daily_summary(spark, root), p95_vibration_mm_s=8, total_energy_kwh=8)


@query("device_health_trend", "A7", DAILY_SQL + f"""
SELECT device_id, {day('date')} AS date, round(health_score, 10) AS health_score,
       CASE WHEN c > 5.0 THEN 'improving' WHEN c < -5.0 THEN 'degrading' ELSE 'stable' END AS health_trend
FROM (SELECT *, health_score - lag(health_score) OVER (PARTITION BY device_id ORDER BY date) AS c FROM (
        SELECT device_id, date, greatest(0.0, 100.0 - 5.0 * vibration_anomalies) AS health_score FROM daily) a) b""")
def _(spark, root):
    # A steeper score than the default, so that all three trends occur.
    t = tables.telemetry(spark, root)
    s = gold.device_daily_summary(t).withColumn(
        "health_score", F.greatest(F.lit(0.0), F.lit(100.0) - F.lit(5.0) * F.col("vibration_anomalies")))
    return rounded(gold.health_trend(s).select("device_id", "date", "health_score", "health_trend"))


@query("customer_daily_rollup", "A8 U5", DAILY_SQL + f""", last_seen AS (
  SELECT d.date, t.customer_id, t.device_id, max(t."timestamp") AS seen
  FROM (SELECT DISTINCT date FROM daily) d JOIN telemetry t ON t."timestamp" <= d.date + INTERVAL 1 DAY GROUP BY 1, 2, 3)
SELECT customer_id, {day('date')} AS date, count(*) AS total_devices,
       count(*) FILTER (health_score >= 80) AS devices_operational,
       count(*) FILTER (health_score >= 60 AND health_score < 80) AS devices_warning,
       count(*) FILTER (health_score < 60) AS devices_critical,
       round(sum(total_energy_kwh), 8) AS total_energy_kwh,
       round(sum(total_energy_kwh) * 0.12, 8) AS energy_cost_usd,
       any_value((SELECT count(*) FROM last_seen l WHERE l.customer_id = daily.customer_id AND l.date = daily.date
                  AND l.seen + INTERVAL 5 MINUTE <= daily.date + INTERVAL 1 DAY)) AS devices_offline
FROM daily GROUP BY 1, 2""")
def _(spark, root):
    t = tables.telemetry(spark, root)
    intervals = state.state_intervals(heartbeat.changes_batch(t, "2024-03-01 00:00:00"))
    offline = state.offline_by_day(intervals, t.select("device_id", "customer_id").distinct(), "2024-02-28")
    return rounded(gold.customer_daily_rollup(daily_summary(spark, root), offline), 8)


@query("device_state_as_of", "U5 A8", T_ + f"""
SELECT device_id, CASE WHEN seen + INTERVAL 5 MINUTE <= TIMESTAMP '2024-01-15 12:00:00' THEN 'offline' ELSE 'online' END AS status,
       {ts("CASE WHEN seen + INTERVAL 5 MINUTE <= TIMESTAMP '2024-01-15 12:00:00' THEN seen + INTERVAL 5 MINUTE ELSE began END")} AS valid_from
FROM (SELECT device_id, max("timestamp") AS seen, max("timestamp") FILTER (new) AS began FROM (
  SELECT *, coalesce("timestamp" - lag("timestamp") OVER w > INTERVAL 5 MINUTE, true) AS new FROM telemetry
  WHERE "timestamp" <= TIMESTAMP '2024-01-15 12:00:00' WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp")) x GROUP BY 1) y""")
def _(spark, root):
    # What the state was at noon of a past day.
    changes = heartbeat.changes_batch(tables.telemetry(spark, root), "2024-03-01 00:00:00")
    return state.as_of(state.state_intervals(changes), "2024-01-15 12:00:00").select("device_id", "status", "valid_from")


@query("rolling_features", "W4 W5 W6", DAILY_SQL + f"""
SELECT device_id, {day('date')} AS date,
       round(avg(avg_vibration_mm_s) OVER w, 8) AS vibration_mean_7d,
       round(stddev_samp(avg_vibration_mm_s) OVER w, 8) AS vibration_std_7d,
       round(regr_slope(avg_vibration_mm_s, date - DATE '1970-01-01') OVER w, 8) AS vibration_trend_7d,
       round(stddev_samp(avg_vibration_mm_s) OVER w / nullif(avg(avg_vibration_mm_s) OVER w, 0), 8) AS vibration_cv_7d,
       round(avg(avg_temperature_c) OVER w, 8) AS temperature_mean_7d,
       round(stddev_samp(avg_temperature_c) OVER w, 8) AS temperature_std_7d,
       round(CAST(sum(cycle_count) OVER w AS DOUBLE) / nullif(sum(total_energy_kwh) OVER w, 0), 6) AS energy_efficiency_7d,
       round(CAST(sum(vibration_anomalies + temperature_anomalies) OVER w AS DOUBLE)
             / nullif(CAST(sum(reading_count) OVER w AS DOUBLE), 0), 10) AS anomaly_rate_7d
FROM daily
WINDOW w AS (PARTITION BY device_id ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def _(spark, root):
    f = gold.rolling_features(gold.device_daily_summary(tables.telemetry(spark, root)))
    return rounded(f, 8, energy_efficiency_7d=6, anomaly_rate_7d=10)


def bronze_messages(spark, root):
    """Telemetry as parsed JSON messages, as they would come from a stored topic."""
    return silver.parse_messages(staged(tables.as_messages(tables.telemetry(spark, root)), "messages"))


@query("telemetry_flatten", "P1 X10 S1 X2", T_ + f"""
SELECT device_id, customer_id, device_type, model, firmware_version, {ts('"timestamp"')} AS "timestamp", facility, zone,
       {', '.join(METRICS)}, status, {ts('"timestamp"')} AS device_timestamp, {ts('sent_at')} AS sent_at
FROM telemetry""")
def _(spark, root):
    return silver.flatten_telemetry(bronze_messages(spark, root))


@query("typed_coercion", "P2 X2", f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS reading,
       CASE WHEN event_type <> 'view' THEN {ts('ts')} END AS read_at
FROM events""")
def _(spark, root):
    e = tables.table(spark, root, "events")
    broken = e.select(
        "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("reading"),
        F.when(F.col("event_type") == "view", "yesterday").otherwise(F.col("ts").cast("string")).alias("read_at"))
    return silver.coerce(broken, doubles=["reading"], timestamps=["read_at"])


@query("data_quality_score", "P4", T_ + """
SELECT device_id, round(((vibration_mm_s IS NOT NULL)::INT + (temperature_c IS NOT NULL)::INT
       + (power_kw IS NOT NULL)::INT) / 3.0, 10) AS data_quality_score, count(*) AS n
FROM (SELECT *, coalesce(tool_temperature_c, motor_temperature_c, air_temperature_c) AS temperature_c FROM telemetry) t
GROUP BY 1, 2""")
def _(spark, root):
    t = with_temperature(tables.telemetry(spark, root))
    return rounded(silver.with_quality_score(t)).groupBy("device_id", "data_quality_score").agg(F.count("*").alias("n"))


def with_temperature(t):
    return t.withColumn("temperature_c", F.coalesce(
        "tool_temperature_c", "motor_temperature_c", "air_temperature_c"))


@query("bronze_layout", "S3 P5", T_ + f"""
SELECT customer_id, {day('"timestamp"')} AS date, strftime("timestamp", '%H') AS hour, count(*) AS messages
FROM telemetry GROUP BY 1, 2, 3""")
def _(spark, root):
    m = sinks.with_event_partitions(bronze_messages(spark, root))
    return m.groupBy(*sinks.BRONZE_PARTITIONS).agg(F.count("*").alias("messages"))


@query("bronze_hour_scan", "S3 S5 S11", T_ + """
SELECT count(DISTINCT customer_id) > 0 AS has_files, count(*) AS records_inserted, '2024-01-14 13:00' AS execution_hour
FROM telemetry WHERE "timestamp" >= TIMESTAMP '2024-01-14 13:00:00' AND "timestamp" < TIMESTAMP '2024-01-14 14:00:00'""")
def _(spark, root):
    # Written whole under its event-time folders, then one hour is read by folder pruning.
    path = scratch_dir(spark, "bronze")
    sinks.write_bronze(bronze_messages(spark, root), path, ["date", "hour"])
    s = run_summary(read_bronze(spark, path, "2024-01-14", "13"), "2024-01-14 13:00")
    return s.select((F.col("files_processed") > 0).alias("has_files"), "records_inserted", "execution_hour")


@query("bronze_object_compaction", "S4", T_ + f"""
SELECT customer_id, device_id, {ts('"timestamp"')} AS "timestamp", message_id
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, device_id, date_trunc('second', "timestamp")
      ORDER BY "timestamp" DESC, message_id DESC) AS r FROM telemetry) t WHERE r = 1""")
def _(spark, root):
    t = tables.telemetry(spark, root)
    return silver.compact_objects(t, [F.desc("timestamp"), F.desc("message_id")]).select(
        "customer_id", "device_id", "timestamp", "message_id")


@query("silver_parquet_partitions", "S7", T_ + f"""
SELECT customer_id, {day('"timestamp"')} AS date, count(*) AS rows_written FROM telemetry GROUP BY 1, 2""")
def _(spark, root):
    path = scratch_dir(spark, "silver")
    sinks.write_silver(tables.telemetry(spark, root), path)
    return spark.read.parquet(path).groupBy("customer_id", "date").agg(F.count("*").alias("rows_written"))


@query("lateness", "P6 ST7", T_ + """
SELECT message_id, round(epoch(sent_at - "timestamp"), 6) AS latency_seconds,
       epoch(sent_at - "timestamp") > 600 AS is_late_data FROM telemetry""")
def _(spark, root):
    return rounded(silver.with_lateness(tables.telemetry(spark, root)).select(
        "message_id", "latency_seconds", "is_late_data"), 6)


LATE_HOURS = """late_hours AS (
  SELECT date_trunc('hour', "timestamp") AS hour_start, count(*) AS late_count FROM telemetry
  WHERE epoch(sent_at - "timestamp") > 600 AND sent_at > date_trunc('hour', "timestamp") + INTERVAL 1 HOUR
  GROUP BY 1)"""


@query("late_hours", "J12 ST11 A27", with_(TELEMETRY, LATE_HOURS) + f"""
SELECT {ts('hour_start')} AS hour_start, late_count FROM late_hours""")
def _(spark, root):
    return upsert.late_hours(tables.telemetry(spark, root))


@query("reprocess_late_hours", "J12 U7 ST11", with_(TELEMETRY, LATE_HOURS) + f"""
SELECT t.message_id, {ts('hour_start')} AS hour_start, 2 AS data_version,
       {ts("TIMESTAMP '2024-02-01 00:00:00'")} AS reprocessed_at
FROM telemetry t JOIN late_hours h ON date_trunc('hour', t."timestamp") = h.hour_start""")
def _(spark, root):
    t = tables.telemetry(spark, root)
    fresh = (upsert.rows_of_hours(t, upsert.late_hours(t))
             .withColumns({"data_version": F.lit(1), "reprocessed_at": F.lit(None).cast("timestamp")}))
    stored = t.select(F.date_trunc("hour", "timestamp").alias("hour_start"), F.lit(1).alias("data_version"))
    out = upsert.rebuild_partitions(fresh, stored, ["hour_start"], "2024-02-01 00:00:00")
    return out.select("message_id", "hour_start", "data_version", "reprocessed_at")


@query("rebuild_gold_dates", "U8", with_(TELEMETRY, LATE_HOURS, DAILY) + f"""
SELECT device_id, {day('date')} AS date, reading_count, round(total_energy_kwh, 8) AS total_energy_kwh
FROM daily WHERE date IN (SELECT CAST(hour_start AS DATE) FROM late_hours)""")
def _(spark, root):
    t = tables.telemetry(spark, root)
    dates = upsert.late_hours(t).select(F.to_date("hour_start").alias("date")).distinct()
    return rounded(upsert_gold(t, dates), 8)


@query("replaced_gold_dates", "U7 U8", with_(TELEMETRY, LATE_HOURS, DAILY) + f"""
SELECT device_id, {day('date')} AS date, reading_count, round(total_energy_kwh, 8) AS total_energy_kwh,
       CASE WHEN touched THEN 2 ELSE 1 END AS data_version,
       CASE WHEN touched THEN {ts("TIMESTAMP '2024-02-01 00:00:00'")} END AS reprocessed_at
FROM (SELECT *, date IN (SELECT CAST(hour_start AS DATE) FROM late_hours) AS touched FROM daily) d""")
def _(spark, root):
    # A stored table of all dates, whose touched partitions are recomputed, replaced and read back with the others.
    t, path = tables.telemetry(spark, root), scratch_dir(spark, "gold")
    columns = ["device_id", "date", "reading_count", "total_energy_kwh"]
    first = gold.device_daily_summary(t).select(*columns).withColumns(
        {"data_version": F.lit(1), "reprocessed_at": F.lit(None).cast("timestamp")})
    upsert.replace_partitions(first, path, ["date"])
    dates = upsert.late_hours(t).select(F.to_date("hour_start").alias("date")).distinct()
    stored = spark.read.schema(first.schema).parquet(path)
    fresh = upsert.rebuild_partitions(upsert_gold(t, dates), stored, ["device_id", "date"], "2024-02-01 00:00:00")
    upsert.replace_partitions(staged(fresh, "gold-fresh"), path, ["date"])
    return rounded(spark.read.schema(first.schema).parquet(path), 8)


def upsert_gold(t, dates):
    return gold.rebuild_gold(t, dates).select("device_id", "date", "reading_count", "total_energy_kwh")


REASON = """CASE WHEN status = 'signup' THEN 'missing_device_id'
       WHEN temperature_c > 500 THEN 'out_of_range_temperature_c'
       WHEN vibration_mm_s > 50 THEN 'out_of_range_vibration_mm_s'
       WHEN power_kw < 0 THEN 'out_of_range_power_kw' END"""
VALIDATED = TELEMETRY + f""",
validated AS (SELECT *, {REASON} AS reject_reason FROM (
  SELECT * REPLACE (CASE WHEN status = 'purchase' THEN -power_kw ELSE power_kw END AS power_kw),
         coalesce(tool_temperature_c, motor_temperature_c, air_temperature_c) AS temperature_c FROM telemetry) t)"""


def damaged(spark, root):
    """Telemetry with missing ids and negative power in it, one reason of each kind."""
    return with_temperature(tables.telemetry(spark, root)).withColumns({
        "device_id": F.when(F.col("status") != "signup", F.col("device_id")),
        "power_kw": F.when(F.col("status") == "purchase", -F.col("power_kw")).otherwise(F.col("power_kw"))})


@query("validated_rows", "F1 F2", with_(VALIDATED) + """
SELECT message_id, vibration_mm_s, power_kw FROM validated WHERE reject_reason IS NULL""")
def _(spark, root):
    good, _ = silver.validate(damaged(spark, root))
    return good.select("message_id", "vibration_mm_s", "power_kw")


@query("validated_rows_strict", "F2", with_(VALIDATED) + """
SELECT message_id FROM validated WHERE reject_reason IS NULL AND vibration_mm_s IS NOT NULL
  AND temperature_c IS NOT NULL AND power_kw IS NOT NULL""")
def _(spark, root):
    good, _ = silver.validate(damaged(spark, root), strict=True)
    return good.select("message_id")


@query("dead_letters", "F3 A24", with_(VALIDATED) + """
SELECT reject_reason, count(*) AS messages, round(count(*) / CAST((SELECT count(*) FROM telemetry) AS DOUBLE), 10) AS ratio
FROM validated WHERE reject_reason IS NOT NULL GROUP BY 1""")
def _(spark, root):
    marked = silver.with_reject_reason(damaged(spark, root))
    counts = marked.groupBy("reject_reason").agg(F.count("*").alias("messages"))
    total = counts.agg(F.sum("messages").cast("double").alias("t")).scalar()
    return rounded(counts.withColumn("ratio", F.col("messages") / total).where("reject_reason IS NOT NULL"))


@query("previous_hour", "F4 X3", T_ + """
SELECT message_id FROM telemetry
WHERE "timestamp" >= date_trunc('hour', TIMESTAMP '2024-01-14 17:25:00') - INTERVAL 1 HOUR
  AND "timestamp" < date_trunc('hour', TIMESTAMP '2024-01-14 17:25:00')""")
def _(spark, root):
    t = tables.telemetry(spark, root)
    return silver.between(t, silver.previous_hour("2024-01-14 17:25:00")).select("message_id")


@query("previous_day", "F5", T_ + """
SELECT device_id, count(*) AS messages FROM telemetry
WHERE "timestamp" >= TIMESTAMP '2024-01-14 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""")
def _(spark, root):
    t = silver.between(tables.telemetry(spark, root), silver.previous_day("2024-01-15 09:30:00"))
    return t.groupBy("device_id").agg(F.count("*").alias("messages"))


@query("registry_enrichment", "J2", T_ + """
SELECT t.message_id, t.device_id, c.c_mktsegment AS segment, c.c_nationkey AS site
FROM telemetry t LEFT JOIN customer c ON c.c_custkey = t.user_id""")
def _(spark, root):
    registry = tables.table(spark, root, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("site"))
    return silver.enrich(tables.telemetry(spark, root), registry, "user_id").select(
        "message_id", "device_id", "segment", "site")


@query("deduplicated", "W9 U2", T_ + f"""
SELECT device_id, {ts('"timestamp"')} AS "timestamp", min(message_id) AS message_id FROM telemetry GROUP BY 1, telemetry."timestamp" """)
def _(spark, root):
    # Every message was delivered twice.
    t = tables.telemetry(spark, root)
    both = t.withColumn("delivery", F.lit(1)).unionByName(t.withColumn("delivery", F.lit(2)))
    return silver.deduplicate(both, ["message_id", "delivery"]).select("device_id", "timestamp", "message_id")


@query("insert_if_absent", "U2 J4", T_ + f"""
SELECT t.device_id, {ts('t."timestamp"')} AS "timestamp", min(t.message_id) AS message_id
FROM telemetry t WHERE NOT EXISTS (
  SELECT 1 FROM telemetry s WHERE s.status = 'click' AND s.device_id = t.device_id AND s."timestamp" = t."timestamp")
GROUP BY t.device_id, t."timestamp" """)
def _(spark, root):
    t = tables.telemetry(spark, root)
    stored = t.where("status = 'click'")
    return upsert.insert_if_absent(stored, t, ["device_id", "timestamp"], ["message_id"]).select(
        "device_id", "timestamp", "message_id")


STATES = TELEMETRY + """,
stored AS (SELECT device_id, max(cycle_count) AS cycles, max(status) AS status, TIMESTAMP '2024-01-01' AS created_at,
                  TIMESTAMP '2024-01-01' AS updated_at
           FROM telemetry WHERE device_type <> 'hvac' GROUP BY 1),
incoming AS (SELECT device_id, min(cycle_count) AS cycles, min(status) AS status
             FROM telemetry WHERE device_type <> 'conveyor' GROUP BY 1)"""


def stored_and_incoming(spark, root):
    t = tables.telemetry(spark, root)
    then = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stored = t.where("device_type <> 'hvac'").groupBy("device_id").agg(
        F.max("cycle_count").alias("cycles"), F.max("status").alias("status")).withColumns(
        {"created_at": then, "updated_at": then})
    incoming = t.where("device_type <> 'conveyor'").groupBy("device_id").agg(
        F.min("cycle_count").alias("cycles"), F.min("status").alias("status"))
    return stored, incoming


@query("upsert_all_columns", "U3", with_(STATES) + f"""
SELECT coalesce(s.device_id, i.device_id) AS device_id, coalesce(i.cycles, s.cycles) AS cycles,
       coalesce(i.status, s.status) AS status,
       {ts("coalesce(s.created_at, TIMESTAMP '2024-02-01')")} AS created_at,
       {ts("CASE WHEN i.device_id IS NULL THEN s.updated_at ELSE TIMESTAMP '2024-02-01' END")} AS updated_at
FROM stored s FULL OUTER JOIN incoming i ON s.device_id = i.device_id""")
def _(spark, root):
    stored, incoming = stored_and_incoming(spark, root)
    return upsert.upsert(stored, incoming, ["device_id"], now="2024-02-01 00:00:00")


@query("upsert_some_columns", "U4", with_(STATES) + f"""
SELECT coalesce(s.device_id, i.device_id) AS device_id, coalesce(i.cycles, s.cycles) AS cycles,
       coalesce(s.status, i.status) AS status,
       {ts("coalesce(s.created_at, TIMESTAMP '2024-02-01')")} AS created_at,
       {ts("CASE WHEN i.device_id IS NULL THEN s.updated_at ELSE TIMESTAMP '2024-02-01' END")} AS updated_at
FROM stored s FULL OUTER JOIN incoming i ON s.device_id = i.device_id""")
def _(spark, root):
    stored, incoming = stored_and_incoming(spark, root)
    return upsert.upsert(stored, incoming, ["device_id"], update=["cycles"], now="2024-02-01 00:00:00")


def _event_sql() -> str:
    cases = []
    for r in rules.DEFAULT_RULES:
        bad = " OR ".join([f"{r.metric} < {r.low}"] * (r.low is not None) + [f"{r.metric} > {r.high}"] * (r.high is not None))
        text = r.text.replace("{low}", str(r.low)).replace("{high}", str(r.high)).replace("'", "''")
        before, after = text.split("{value}")
        both = r.low is not None and r.high is not None
        one = "NULL" if both else str(r.high if r.high is not None else r.low)
        cases.append(f"""SELECT 'evt-{r.id_prefix}-' || device_id || '-' || CAST(floor(epoch("timestamp")) AS BIGINT) AS event_id,
  device_id, customer_id, "timestamp", '{r.event_type}' AS event_type, '{r.severity}' AS severity,
  '{before}' || CAST({r.metric} AS VARCHAR) || '{after}' AS message, '{r.error_code}' AS error_code, '{r.metric}' AS metric,
  CAST({r.metric} AS DOUBLE) AS value, CAST({one} AS DOUBLE) AS threshold,
  CAST({r.low if both else 'NULL'} AS DOUBLE) AS threshold_min, CAST({r.high if both else 'NULL'} AS DOUBLE) AS threshold_max,
  '{r.action}' AS recommended_action
FROM telemetry WHERE device_type = '{r.device_type}' AND ({bad})""")
    return "threshold_events AS (\n" + "\nUNION ALL\n".join(cases) + ")"


EVENTS = _event_sql()


@query("threshold_events", "F10 F11 F12 F13 F14 F15 F16 F17 X14 UD5", with_(TELEMETRY, EVENTS) + f"""
SELECT event_id, device_id, customer_id, {ts('"timestamp"')} AS "timestamp", event_type, severity, message, error_code,
       metric, value, threshold, threshold_min, threshold_max, recommended_action FROM threshold_events""")
def _(spark, root):
    return rules.threshold_events(tables.telemetry(spark, root))


@query("threshold_event_counts", "F11 F12 F13 F14 F15 F16 F17 A28", with_(TELEMETRY, EVENTS) + """
SELECT error_code, severity, count(*) AS events, count(DISTINCT device_id) AS devices FROM threshold_events GROUP BY 1, 2""")
def _(spark, root):
    e = rules.threshold_events(tables.telemetry(spark, root))
    return e.groupBy("error_code", "severity").agg(
        F.count("*").alias("events"), F.count_distinct("device_id").alias("devices"))


BANDS_SQL = T_ + """, readings AS (
  UNPIVOT (SELECT message_id, spindle_rpm, tool_temperature_c, vibration_mm_s, power_kw FROM telemetry
           WHERE device_type = 'cnc_machine')
  ON spindle_rpm, tool_temperature_c, vibration_mm_s, power_kw INTO NAME parameter VALUE value),
bands(parameter, level, above, upto) AS (VALUES
  ('spindle_rpm', 'normal', NULL, 8200.0), ('spindle_rpm', 'critical', 8200.0, NULL),
  ('tool_temperature_c', 'normal', NULL, 75.0), ('tool_temperature_c', 'warning', 75.0, 85.0),
  ('tool_temperature_c', 'critical', 85.0, NULL),
  ('vibration_mm_s', 'normal', NULL, 1.5), ('vibration_mm_s', 'warning', 1.5, 2.0), ('vibration_mm_s', 'critical', 2.0, NULL),
  ('power_kw', 'normal', NULL, 12.0), ('power_kw', 'warning', 12.0, 14.0), ('power_kw', 'critical', 14.0, NULL))
SELECT r.parameter, b.level, count(*) AS readings FROM readings r
JOIN bands b ON b.parameter = r.parameter AND (b.above IS NULL OR r.value > b.above) AND (b.upto IS NULL OR r.value <= b.upto)
GROUP BY 1, 2"""


@query("parameter_bands", "F18", BANDS_SQL)
def _(spark, root):
    levels = rules.parameter_bands(tables.telemetry(spark, root))
    return levels.groupBy("parameter", "level").agg(F.count("*").alias("readings"))


@query("parameter_band_join", "F18 J5", BANDS_SQL)
def _(spark, root):
    names = [b[0] for b in rules.PARAMETER_BANDS]
    readings = (tables.telemetry(spark, root).where("device_type = 'cnc_machine'")
                .unpivot(["message_id"], names, "parameter", "value").where("value IS NOT NULL"))
    joined = rules.band_join(readings, rules.band_table(spark))
    return joined.groupBy("parameter", "level").agg(F.count("*").alias("readings"))


INSIGHTS = """insights AS (
  SELECT device_id, metric, current_value, avg_value, threshold,
         CASE WHEN current_value > threshold THEN 'critical' WHEN current_value > threshold * 0.8 THEN 'warning'
              ELSE 'normal' END AS status
  FROM (SELECT device_id, metric, arg_max(value, (ts, id)) AS current_value, avg(value) AS avg_value,
               any_value(threshold) AS threshold
        FROM (SELECT device_id, "timestamp" AS ts, message_id AS id, 'temperature' AS metric, 80.0 AS threshold,
                     coalesce(tool_temperature_c, motor_temperature_c, air_temperature_c) AS value FROM telemetry
              UNION ALL SELECT device_id, "timestamp", message_id, 'vibration', 2.0, vibration_mm_s FROM telemetry
              UNION ALL SELECT device_id, "timestamp", message_id, 'pressure', 100.0, compressor_pressure_psi FROM telemetry) m
        WHERE value IS NOT NULL AND ts > TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 168 HOUR
          AND ts <= TIMESTAMP '2024-01-15 00:00:00'
        GROUP BY 1, 2) g)"""


def insights(spark, root):
    return rules.device_insights(with_temperature(tables.telemetry(spark, root)), ASOF, 168, "message_id")


@query("device_insights", "A20", with_(TELEMETRY, INSIGHTS) + """
SELECT device_id, metric, current_value, round(avg_value, 8) AS avg_value, CAST(threshold AS DOUBLE) AS threshold, status
FROM insights""")
def _(spark, root):
    return insights(spark, root).withColumn("avg_value", F.round("avg_value", 8))


@query("recommendations", "A21", with_(TELEMETRY, INSIGHTS) + """
SELECT device_id, '⚠️  CRITICAL: ' || metric || ' at ' || printf('%.2f', current_value) || ' exceeds threshold '
       || CAST(CAST(threshold AS DOUBLE) AS VARCHAR) || ' - immediate action required' AS recommendation
FROM insights WHERE status = 'critical'
UNION ALL
SELECT device_id, '⚡ WARNING: ' || metric || ' at ' || printf('%.2f', current_value) || ' approaching threshold '
       || CAST(CAST(threshold AS DOUBLE) AS VARCHAR) || ' - monitor closely' FROM insights WHERE status = 'warning'
UNION ALL
SELECT device_id, '✅ All metrics within normal ranges - no action needed' FROM insights
GROUP BY 1 HAVING bool_and(status = 'normal')""")
def _(spark, root):
    return rules.recommendations(insights(spark, root))


@query("maintenance_due", "K8", T_ + f"""
SELECT device_id, customer_id, {ts('min("timestamp")')} AS due_since, max(cycle_count) AS cycle_count
FROM telemetry WHERE cycle_count >= 5000 GROUP BY 1, 2""")
def _(spark, root):
    return rules.maintenance_due(tables.telemetry(spark, root))


@query("latest_readings", "T5", T_ + f"""
SELECT device_id, {ts('"timestamp"')} AS "timestamp", message_id, r AS recency
FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY "timestamp" DESC, message_id DESC) AS r
      FROM telemetry) t WHERE r <= 5""")
def _(spark, root):
    return gold.latest_per_device(tables.telemetry(spark, root), 5, ["message_id"]).select(
        "device_id", "timestamp", "message_id", "recency")


@query("tenant_rows", "F23", T_ + """SELECT message_id, device_id FROM telemetry WHERE customer_id = 'cust-1'""")
def _(spark, root):
    return silver.tenant_view(tables.telemetry(spark, root), "cust-1").select("message_id", "device_id")
