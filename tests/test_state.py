"""State intervals, state as of an instant, and devices offline per day."""

from datetime import date, datetime

from millrace.operators import gold, state

CHANGES = "device_id string, status string, changed_at timestamp"


def t(day, hour=0, minute=0):
    return datetime(2024, 1, day, hour, minute)


def intervals(spark):
    rows = [("a", "online", t(1, 8)), ("a", "offline", t(2, 23)), ("a", "offline_planned", t(2, 23, 30)), ("a", "online", t(5, 0)),
            ("a", "online", t(5, 9)), ("b", "online", t(1)), ("b", "offline", t(3, 12)), ("b", "offline", t(3, 12)),
            ("c", "offline", t(2, 1)), ("c", "online", t(2, 22)), ("d", "online", t(4))]
    return state.state_intervals(spark.createDataFrame(rows, CHANGES))


def test_intervals_open_close_and_coalesce(spark):
    got = sorted((r.device_id, r.status, r.valid_from, r.valid_to) for r in intervals(spark).collect())
    assert got == [("a", "offline", t(2, 23), t(2, 23, 30)), ("a", "offline_planned", t(2, 23, 30), t(5)), ("a", "online", t(1, 8), t(2, 23)),
                   ("a", "online", t(5), None), ("b", "offline", t(3, 12), None), ("b", "online", t(1), t(3, 12)),
                   ("c", "offline", t(2, 1), t(2, 22)), ("c", "online", t(2, 22), None), ("d", "online", t(4), None)]


def test_as_of(spark):
    at = lambda ts: {r.device_id: r.status for r in state.as_of(intervals(spark), ts).collect()}
    assert at("2024-01-02 12:00:00") == {"a": "online", "b": "online", "c": "offline"}
    assert at("2024-01-03 12:00:00") == {"a": "offline_planned", "b": "offline", "c": "online"}
    assert at("2024-01-05 00:00:00") == {"a": "online", "b": "offline", "c": "online", "d": "online"}


def test_each_day_has_its_own_count(spark):
    devices = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "device_id string, customer_id string")
    got = {(r.customer_id, r.date): r.devices_offline for r in state.offline_by_day(intervals(spark), devices, "2024-01-06").collect()}
    # a is offline at the ends of days 2 and 3 and back at the very end of day 4; b from day 3 on; c never at a day's end.
    assert got == {("x", date(2024, 1, 2)): 1, ("x", date(2024, 1, 3)): 2, ("x", date(2024, 1, 4)): 1,
                   ("x", date(2024, 1, 5)): 1, ("x", date(2024, 1, 6)): 1}


def test_rollup_takes_the_days_counts(spark):
    summary = spark.createDataFrame([("a", "x", date(2024, 1, d), 90.0, 1.0) for d in (1, 2, 3)],
                                    "device_id string, customer_id string, date date, health_score double, total_energy_kwh double")
    offline = spark.createDataFrame([("x", date(2024, 1, 2), 3)], "customer_id string, date date, devices_offline long")
    out = {r.date.day: r.devices_offline for r in gold.customer_daily_rollup(summary, offline).collect()}
    assert out == {1: 0, 2: 3, 3: 0}
    assert {r.devices_offline for r in gold.customer_daily_rollup(summary).collect()} == {0}
