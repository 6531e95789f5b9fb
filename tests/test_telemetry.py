import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import gold, rules, runtime, schedule, silver, state, upsert
from millrace.operators.runtime import sla_uptime
from millrace.operators.schedule import operating_periods
from millrace.schemas import BRONZE, DEVICE_STATE, SCHEDULE
from millrace.session import scratch_dir
from millrace.sources import sinks
from millrace.sources.messages import read_bronze, run_summary


def message(device="cnc-001", ts="2026-02-04T13:55:00Z", vibration=2.3, **more):
    m = {"device_id": device, "customer_id": "acme", "device_type": "cnc_machine", "timestamp": ts,
         "location": {"facility": "fab"}, "metrics": {"vibration_mm_s": vibration, "power_kw": 8.0}, "status": "operational"}
    m.update(more)
    return json.dumps(m)


def parsed(spark, texts):
    return silver.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_sample_rows_keep_only_the_good_one(spark):
    texts = [message(), message(),
             json.dumps({"customer_id": "acme", "device_id": None, "timestamp": None, "metrics": None}),
             message("cnc-002", "2026-02-04T13:55:10Z", 999)]
    good, bad = silver.bronze_to_silver(parsed(spark, texts), ["status"])
    rows = good.collect()
    assert [(r.device_id, r.vibration_mm_s) for r in rows] == [("cnc-001", 2.3)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing_device_id", "out_of_range_vibration_mm_s"]


def test_null_and_broken_objects_do_not_fail(spark):
    flat = silver.flatten_telemetry(parsed(spark, [message(metrics=None, location=None), "not json", message(ts="never")]))
    assert [r.power_kw for r in flat.collect()] == [None, None, 8.0]
    assert flat.where("timestamp IS NULL").count() == 2


def test_missing_measurement_is_kept_unless_strict(spark):
    df = spark.createDataFrame([("d", "c", dt.datetime(2024, 1, 1), 20.0, None, 1.0)],
                               "device_id string, customer_id string, timestamp timestamp, temperature_c double, "
                               "vibration_mm_s double, power_kw double")
    assert silver.validate(df)[0].count() == 1
    assert silver.validate(df, strict=True)[0].count() == 0


def test_dedup_and_insert_are_idempotent(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z")], "device_id string, timestamp long, v string")
    once = silver.deduplicate(df, ["v"])
    assert sorted(r.v for r in once.collect()) == ["x", "z"]
    assert sorted(silver.deduplicate(once, ["v"]).collect()) == sorted(once.collect())
    assert upsert.insert_if_absent(once, df, ["device_id", "timestamp"], ["v"]).count() == 0


def test_upsert_twice_equals_once_and_keeps_created_at(spark):
    old, new = dt.datetime(2024, 1, 1), "2024-02-01 00:00:00"
    t = spark.createDataFrame([(1, "a", old, old), (2, "b", old, old)], "id int, v string, created_at timestamp, updated_at timestamp")
    i = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    once = upsert.upsert(t, i, ["id"], now=new)
    got = {r.id: (r.v, r.created_at.month, r.updated_at.month) for r in once.collect()}
    assert got == {1: ("a", 1, 1), 2: ("B", 1, 2), 3: ("C", 2, 2)}
    assert sorted(upsert.upsert(once, i, ["id"], now=new).collect()) == sorted(once.collect())


def test_merge_rewrites_only_touched_partitions(spark):
    path = scratch_dir(spark, "merge-table")
    spark.createDataFrame([(1, "x", "d1"), (2, "y", "d1"), (3, "z", "d2")], "id int, v string, date string") \
        .write.partitionBy("date").parquet(path)
    upsert.merge_into(path, spark.createDataFrame([(2, "Y", "d1"), (9, "n", "d3")], "id int, v string, date string"), ["id"], ["date"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "date").collect())
    assert got == [(1, "x", "d1"), (2, "Y", "d1"), (3, "z", "d2"), (9, "n", "d3")]


def test_bronze_round_trip_prunes_and_keeps_broken_messages(spark):
    path = scratch_dir(spark, "bronze-test")
    sinks.write_bronze(parsed(spark, [message(), message(ts="2026-02-04T14:05:00Z"), message(ts="bad")]), path)
    hour = read_bronze(spark, path, "2026-02-04", "14")
    assert "PartitionFilters: [isnotnull(date" in hour._jdf.queryExecution().toString()
    assert run_summary(hour, "h").first().records_inserted == 1
    assert run_summary(read_bronze(spark, path, "2030-01-01", "00"), "h").first().asDict() == {
        "files_processed": 0, "records_inserted": 0, "execution_hour": "h"}
    assert read_bronze(spark, path).count() == 3


def test_bronze_reader_keeps_malformed_text(spark):
    path = scratch_dir(spark, "broken")
    spark.createDataFrame([(message(),), ("{broken",)], "value string").coalesce(1).write.text(path)
    rows = read_bronze(spark, path).select("device_id", "_corrupt_record").cache()
    assert sorted(r._corrupt_record or "" for r in rows.collect()) == ["", "{broken"]


def test_silver_writer_replays_a_batch_without_repeats(spark):
    path = scratch_dir(spark, "silver-batches")
    write = sinks.silver_batch_writer(path, ["device_id", "timestamp"], ["v"])
    schema = "device_id string, timestamp timestamp, v int"
    one = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1), ("a", dt.datetime(2024, 1, 1), 2)], schema)
    two = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 3), ("b", dt.datetime(2024, 1, 2), 4)], schema)
    for batch_id, df in ((0, one), (0, one), (1, two), (1, two)):
        write(df, batch_id)
    assert sorted((r.device_id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 4)]


def test_rules_fire_together_and_at_limits(spark):
    schema = ("device_id string, customer_id string, device_type string, timestamp timestamp, vibration_mm_s double, "
              "tool_temperature_c double, motor_temperature_c double, load_weight_kg double, air_temperature_c double, "
              "compressor_pressure_psi double, filter_life_pct int")
    at = dt.datetime(2024, 1, 1)
    rows = [("c", "x", "cnc_machine", at, 2.1, 85.5, None, None, None, None, None),
            ("d", "x", "cnc_machine", at, 2.0, 85.0, None, None, None, None, None),
            ("v", "x", "conveyor", at, 9.0, None, 80.5, 200.5, None, None, None),
            ("h", "x", "hvac", at, None, None, None, None, 17.9, 300.1, 19),
            ("i", "x", "hvac", at, None, None, None, None, 18.0, 200.0, 20)]
    e = rules.threshold_events(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.device_id, r.error_code) for r in e) == [
        ("c", "TEMP_HIGH_001"), ("c", "VIB_HIGH_001"), ("h", "FILTER_REPLACE_001"), ("h", "PRESSURE_ABNORMAL_001"),
        ("h", "TEMP_OUT_OF_RANGE_001"), ("v", "MOTOR_TEMP_HIGH_001"), ("v", "OVERLOAD_001")]
    vib = next(r for r in e if r.error_code == "VIB_HIGH_001")
    assert vib.message == "Vibration exceeded threshold: 2.1mm/s (limit: 2.0mm/s)"
    assert vib.event_id == "evt-vib-c-1704067200" and vib.threshold == 2.0


def test_insight_bands_of_the_sample(spark):
    start = dt.datetime(2024, 1, 1)
    values = {"temperature_c": [75.2, 76.1, 77.3, 78.5, 79.2], "vibration_mm_s": [1.8, 1.9, 2.1, 2.3, 2.5],
              "compressor_pressure_psi": [95.1, 94.8, 94.5, 94.2, 94.0]}
    rows = [("d", start + dt.timedelta(minutes=i), *[values[c][i] for c in values]) for i in range(5)]
    df = spark.createDataFrame(rows, "device_id string, timestamp timestamp, temperature_c double, vibration_mm_s double, "
                                     "compressor_pressure_psi double")
    got = {r.metric: r.status for r in rules.device_insights(df, "2024-01-01 01:00:00").collect()}
    assert got == {"temperature": "warning", "vibration": "critical", "pressure": "warning"}
    with pytest.raises(ValueError):
        rules.device_insights(df, "2024-01-01 01:00:00", hours=169)


def test_working_day_of_540_messages(spark):
    start = dt.datetime(2024, 1, 2, 8)
    rows = [("d", "c", start + dt.timedelta(minutes=i), 1.0, 1.0, i) for i in range(541)]
    df = spark.createDataFrame(rows, "device_id string, customer_id string, timestamp timestamp, power_kw double, v double, cycle_count int")
    s = runtime.runtime_summary(runtime.runtime_periods(df)).first()
    assert (s.runtime_hours, s.offline_hours, s.uptime_pct, s.offline_events) == (9.0, 0.0, 100.0, 0)


PLANS = [("facility", "f", "America/Los_Angeles", "weekly", {"tuesday": ("08:00", "17:00"), "friday": ("22:00", "06:00")},
          [dt.date(2024, 1, 9)], [(dt.datetime(2024, 1, 16, 20), dt.datetime(2024, 1, 16, 21), "belt")],
          dt.datetime(2023, 1, 1), None)]


@pytest.mark.parametrize("when,strict,reason", [
    ("2024-01-02 16:00:00", True, "in_operating_hours"), ("2024-01-03 01:00:00", True, "in_operating_hours"),
    ("2024-01-03 01:00:01", True, "outside_operating_hours"), ("2024-01-04 20:00:00", True, "not_scheduled_day"),
    ("2024-01-09 18:00:00", True, "holiday"), ("2024-01-16 20:30:00", True, "scheduled_maintenance: belt"),
    ("2024-01-06 07:00:00", True, "outside_operating_hours"), ("2024-01-06 07:00:00", False, "in_operating_hours"),
    ("2024-01-06 13:00:00", False, "in_operating_hours"), ("2024-07-02 15:00:00", True, "in_operating_hours"),
    ("2022-07-02 15:00:00", True, "24x7_operation")])
def test_expected_reasons(spark, when, strict, reason):
    df = spark.createDataFrame([("d", "f", dt.datetime.fromisoformat(when))], "device_id string, facility string, timestamp timestamp")
    got = schedule.expected_to_run(df, spark.createDataFrame(PLANS, SCHEDULE), strict=strict).first()
    assert got.reason == reason


def test_heartbeats_out_of_order_change_nothing(spark):
    schema = "device_id string, customer_id string, device_type string, facility string, timestamp timestamp, firmware_version string, uptime_seconds long"
    late = spark.createDataFrame([("d", "c", "cnc_machine", "f", dt.datetime(2024, 1, 1), "1", 10)], schema)
    new = spark.createDataFrame([("d", "c", "cnc_machine", "f", dt.datetime(2024, 1, 2), "2", 99)], schema)
    empty = spark.createDataFrame([], DEVICE_STATE)
    s = state.apply_heartbeats(state.apply_heartbeats(empty, new), late)
    assert (s.first().firmware_version, s.first().last_seen_at) == ("2", dt.datetime(2024, 1, 2))
    marked = state.mark_offline(s, spark.createDataFrame([], SCHEDULE), "2024-01-03 00:00:00").drop("changed")
    back = state.apply_heartbeats(marked, new)
    assert back.first().status == "online" and back.first().consecutive_missed_heartbeats == 0


def test_health_trend_and_retention_edges(spark):
    rows = [("d", dt.date(2024, 1, i + 1), s) for i, s in enumerate([50.0, 56.0, 51.0, 45.0])]
    t = gold.health_trend(spark.createDataFrame(rows, "device_id string, date date, health_score double"))
    assert [r.health_trend for r in t.orderBy("date").collect()] == ["stable", "improving", "stable", "degrading"]


def test_reset_aware_counter(spark):
    rows = [("d", dt.datetime(2024, 1, 1, 0, i), c) for i, c in enumerate([990, 995, 3, 10])]
    r = gold.counter_increase(spark.createDataFrame(rows, "device_id string, timestamp timestamp, cycle_count int")).first()
    assert (r.max_min_delta, r.reset_aware_delta) == (992, 12)


def _uptime(spark, zone, hours, gaps, strict=True):
    """SLA rows of a device with one weekly shift, from (start, end, type) periods in UTC."""
    week = {d: hours for d in "monday tuesday wednesday thursday friday saturday sunday".split()}
    plan = spark.createDataFrame([("device", "d", zone, "weekly", week, None, None, dt.datetime(2023, 1, 1), None)], SCHEDULE)
    devices = spark.createDataFrame([("d", "c", "f")], "device_id string, customer_id string, facility string")
    days = operating_periods(devices, plan, "2024-01-08", "2024-01-10", strict)
    rows = [("d", dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b), kind) for a, b, kind in gaps]
    periods = spark.createDataFrame(rows, "device_id string, period_start timestamp, period_end timestamp, period_type string")
    return {str(r.date): r for r in sla_uptime(periods, days).collect()}


def test_longest_downtime_is_not_cut_at_utc_midnight(spark):
    # Shift 08-20 in Los Angeles is 16-04 UTC; silent from 20 to 06 UTC, so 8 hours of it in one go.
    r = _uptime(spark, "America/Los_Angeles", ("08:00", "20:00"), [
        ("2024-01-08T16:00", "2024-01-08T20:00", "running"), ("2024-01-08T20:00", "2024-01-09T06:00", "extended_offline")])["2024-01-08"]
    assert (r.runtime_hours, r.offline_unplanned_hours, r.offline_planned_hours) == (4.0, 8.0, 2.0)
    assert (r.longest_offline_minutes, r.offline_events_unplanned, r.offline_events_planned) == (480.0, 1, 0)
    assert r.total_offline_duration_minutes == 600.0


def test_night_shifts_end_on_the_next_day(spark):
    gaps = [("2024-01-08T22:00", "2024-01-09T02:00", "running"), ("2024-01-09T02:00", "2024-01-09T05:00", "offline"),
            ("2024-01-09T05:00", "2024-01-09T06:00", "running")]
    r = _uptime(spark, "UTC", ("22:00", "06:00"), gaps, strict=False)["2024-01-08"]
    assert (r.expected_operating_hours, r.runtime_hours, r.offline_unplanned_hours) == (8.0, 5.0, 3.0)
    assert _uptime(spark, "UTC", ("22:00", "06:00"), gaps)["2024-01-08"].expected_operating_hours == 0.0


def test_reading_bronze_leaves_the_schema_alone(spark, tmp_path):
    before = BRONZE.names.copy()
    read_bronze(spark, "file://" + str(tmp_path))
    assert BRONZE.names == before
