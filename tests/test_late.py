"""Stateful steps with late rows, on literal batches."""

from datetime import datetime, timedelta

import pandas as pd
import pytest

from millrace.session import scratch_dir
from millrace.streaming import jobs, late

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def stream(spark, batches, schema):
    """One file and micro-batch per list of rows."""
    folder = scratch_dir(spark, "batches")
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)


def ran(spark, out):
    with late.keyed_state(spark):
        return jobs.run_to_files(out, "late-test")


BEATS = "device_id string, timestamp timestamp, message_id long"


def test_sessions_and_late_rows_are_the_whole_input(spark):
    batches = [[("a", at(0), 1), ("a", at(4), 2), ("b", at(1), 3)],
               [("a", at(60), 4), ("a", at(9), 5)],  # 5 is in time: nothing is behind a watermark of minute -6
               [("a", at(12), 6), ("a", at(47), 7), ("c", at(10), 8), ("a", at(65), 9)],  # watermark 50: 6 and 8 come too late
               [("b", at(200), 10)]]
    out = ran(spark, late.sessions(stream(spark, batches, BEATS)))
    sessions = {(r.device_id, r.session_start, r.last_message, r.messages) for r in late.closed_sessions(out).collect()}
    assert sessions == {("a", at(0), at(9), 3), ("b", at(1), at(1), 1), ("a", at(47), at(47), 1), ("a", at(60), at(65), 2)}
    assert sorted(r.message_id for r in late.late_rows(out, ["message_id"]).collect()) == [6, 8]


def test_first_rows_and_late_copies(spark):
    batches = [[("a", at(0), 2), ("a", at(0), 1), ("a", at(30), 3)],
               [("a", at(30), 4), ("a", at(0), 5), ("a", at(25), 6), ("b", at(100), 7)],  # watermark 20: 5 comes too late
               [("a", at(95), 8), ("a", at(30), 9), ("a", at(95), 10)]]  # watermark 90: 9 comes too late
    out = ran(spark, late.deduplicated(stream(spark, batches, BEATS), ["message_id"]))
    assert sorted((r.message_id, r.late) for r in out.collect()) == [
        (1, False), (3, False), (5, True), (6, False), (7, False), (8, False), (9, True)]


def test_first_rows_cost_their_own_frame():
    processor = late.Firsts(["device_id", "event_us", "message_id"], ["device_id", "event_day"], ["message_id"])

    class Seen(set):
        def __iter__(self):
            raise AssertionError("instants seen before are gone through for a frame")

    state = {"seen": Seen({1, 2})}
    frame = pd.DataFrame({"device_id": "a", "event_us": [2, 3, 3, 1, 4], "message_id": [1, 5, 4, 2, 3]})
    assert [(r["event_us"], r["message_id"]) for r in processor.fold(state, frame)] == [(3, 4), (4, 3)]
    assert processor.fold(state, frame) == [] and set.__len__(state["seen"]) == 4


HEALTH = ("device_id string, customer_id string, device_type string, timestamp timestamp, status string, message_id long, "
          "spindle_rpm double, vibration_mm_s double, power_kw double, cycle_count int, tool_temperature_c double, "
          "motor_temperature_c double, air_temperature_c double")


def beat(minutes, i, status="on", rpm=None, power=1.0, cycles=None):
    return ("a", "t", "cnc_machine", at(minutes), status, i, rpm, None, power, cycles, 20.0 + i, None, None)


def test_hours_and_late_rows(spark):
    batches = [[beat(0, 1, rpm=10.0, cycles=5), beat(59, 2, "off"), beat(30, 3, "off", cycles=9)],
               [beat(61, 4), beat(15, 5, None, rpm=20.0)],  # watermark 49: the first hour is open
               [beat(190, 6)],
               [beat(20, 7), beat(119, 8), beat(185, 9)]]  # watermark 180: hours before 180 are closed
    out = ran(spark, late.hourly_health(stream(spark, batches, HEALTH)))
    first, second = sorted(jobs.fold_hourly_health(late.closed_hours(out)).collect(), key=lambda r: r.hour_start)
    assert (first.hour_start, first.uptime_minutes, first.avg_spindle_rpm, first.status, first.cycle_count_delta) == (at(0), 4, 15.0, "off", 4)
    assert first.avg_temperature == pytest.approx((21 + 22 + 23 + 25) / 4) and first.max_vibration is None
    assert (second.hour_start, second.uptime_minutes, second.cycle_count_delta) == (at(60), 1, None)
    assert sorted(r.message_id for r in late.late_rows(out, ["message_id"]).collect()) == [7, 8]
