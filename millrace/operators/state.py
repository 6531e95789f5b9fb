"""Device state from heartbeats: latest-wins upsert, offline marking, fleet panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ratio, seconds_between
from millrace.operators.schedule import expected_to_run
from millrace.schemas import DEVICE_STATE

OFFLINE_AFTER_S = 300


def latest_state(heartbeats: DataFrame) -> DataFrame:
    """One online row per device from its newest heartbeat; partial maxima combine before the shuffle."""
    newest = F.max_by(
        F.struct("customer_id", "device_type", "facility", "firmware_version", "uptime_seconds"),
        F.struct("timestamp", "uptime_seconds"))
    return (heartbeats.groupBy("device_id").agg(F.max("timestamp").alias("last_seen_at"), newest.alias("h"))
            .select("device_id", "h.customer_id", "h.device_type", "h.facility", "last_seen_at",
                    F.lit("online").alias("status"),
                    F.lit(None).cast("timestamp").alias("offline_since"),
                    F.lit(None).cast("string").alias("offline_reason"),
                    F.lit(0).cast("long").alias("consecutive_missed_heartbeats"),
                    "h.firmware_version", "h.uptime_seconds"))


def apply_heartbeats(state: DataFrame, heartbeats: DataFrame) -> DataFrame:
    """State after a batch; a batch older than the stored row changes nothing."""
    names = [f.name for f in DEVICE_STATE]
    new = latest_state(heartbeats).select(*names)
    both = state.select(*names).unionByName(new)
    return (both.groupBy("device_id")
            .agg(F.max_by(F.struct(*names[1:]), F.struct("last_seen_at", F.col("status") == "online")).alias("s"))
            .select("device_id", "s.*"))


def stale(state: DataFrame, asof: str, after_s: int = OFFLINE_AFTER_S) -> DataFrame:
    """Devices still shown online that have been silent too long."""
    limit = F.lit(asof).cast("timestamp") - F.make_dt_interval(secs=F.lit(after_s))
    return state.where((F.col("last_seen_at") < limit) & (F.col("status") == "online"))


def mark_offline(state: DataFrame, schedules: DataFrame, asof: str,
                 after_s: int = OFFLINE_AFTER_S) -> DataFrame:
    """State with stale devices marked planned or unplanned offline, and a ``changed`` flag."""
    now = F.lit(asof).cast("timestamp")
    limit = now - F.make_dt_interval(secs=F.lit(after_s))
    checked = expected_to_run(state.withColumn("_asof", now), schedules, "_asof")
    gone = (F.col("last_seen_at") < limit) & (F.col("status") == "online")
    return checked.withColumn("changed", gone).withColumns({
        "status": F.when(F.col("changed"), F.when(F.col("expected"), "offline_unplanned")
                         .otherwise("offline_planned")).otherwise(F.col("status")),
        "offline_since": F.when(F.col("changed"), now).otherwise(F.col("offline_since")),
        "offline_reason": F.when(F.col("changed"), F.col("reason")).otherwise(F.col("offline_reason")),
        "consecutive_missed_heartbeats": F.col("consecutive_missed_heartbeats") + F.col("changed").cast("long"),
    }).drop("_asof", "expected", "reason")


def offline_alerts(marked: DataFrame) -> DataFrame:
    """Only unplanned changes raise an alert."""
    return marked.where("changed AND status = 'offline_unplanned'").select(
        "device_id", "customer_id", "device_type", "offline_since", "offline_reason", "last_seen_at")


def critical_offline(state: DataFrame, asof: str, critical_type: str = "cnc_machine",
                     offline_s: int = 300, for_s: int = 300) -> DataFrame:
    """Offline devices of the critical type, past the limit for the whole hold time."""
    seconds = seconds_between(F.col("last_seen_at"), F.lit(asof).cast("timestamp"))
    return (state.where((F.col("device_type") == critical_type) & F.col("status").startswith("offline"))
            .withColumn("offline_seconds", seconds)
            .where(F.col("offline_seconds") > offline_s + for_s)
            .select("device_id", "customer_id", "offline_seconds"))


def state_intervals(changes: DataFrame) -> DataFrame:
    """``changes(device_id, status, changed_at)`` as intervals ``(device_id, status, valid_from, valid_to)``.

    A change opens an interval and closes the one before; repeated reports of one status are one interval; the newest
    is open (``valid_to`` null).  A device changes its status at most every few minutes, so its rows are few.
    """
    order = W.partitionBy("device_id").orderBy("changed_at", "status")
    turns = changes.select("device_id", "status", "changed_at").distinct().withColumn("_was", F.lag("status").over(order))
    opened = turns.where("_was IS NULL OR _was <> status")
    return opened.select("device_id", "status", F.col("changed_at").alias("valid_from"),
                         F.lead("changed_at").over(order).alias("valid_to"))


def as_of(intervals: DataFrame, asof: str) -> DataFrame:
    """The one status per device that holds at an instant."""
    at = F.lit(asof).cast("timestamp")
    return intervals.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def offline_by_day(intervals: DataFrame, devices: DataFrame, until: str) -> DataFrame:
    """Rows ``(customer_id, date, devices_offline)``: devices offline at the end of each day, up to the day ``until``.

    An offline interval counts for the days whose last midnight it holds, one row per such day; ``devices`` has
    ``device_id, customer_id``.
    """
    last = F.coalesce(F.date_sub(F.to_date(F.col("valid_to") - F.make_dt_interval(secs=F.lit(0.000001))), 1),
                      F.lit(until).cast("date"))
    days = (intervals.where(F.col("status").startswith("offline"))
            .select("device_id", F.to_date("valid_from").alias("_a"), F.least(last, F.lit(until).cast("date")).alias("_b"))
            .where("_a <= _b").select("device_id", F.explode(F.sequence("_a", "_b")).alias("date")))
    return days.join(devices, "device_id").groupBy("customer_id", "date").agg(F.count(F.lit(1)).alias("devices_offline"))


def fleet_outage(state: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Share of each customer's devices that are offline, and whether it is an outage."""
    offline = F.count_if(F.col("status").startswith("offline"))
    return (state.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("devices"), offline.alias("offline"))
            .withColumn("offline_ratio", ratio(F.col("offline"), F.col("devices")))
            .withColumn("outage", F.col("offline_ratio") > threshold))


def offline_matrix(state: DataFrame, types: list[str]) -> DataFrame:
    """Customers by device type: how many devices are offline."""
    return (state.where(F.col("status").startswith("offline"))
            .groupBy("customer_id").pivot("device_type", types).agg(F.count(F.lit(1)))
            .na.fill(0))


def offline_durations(periods: DataFrame) -> DataFrame:
    """Average duration of periods without messages, per device."""
    return (periods.where("period_type <> 'running'").groupBy("device_id")
            .agg(F.avg("duration_hours").alias("avg_offline_hours"),
                 F.count(F.lit(1)).alias("offline_events")))


def duration_histogram(periods: DataFrame, top_hours: float = 24.0, cells: int = 12) -> DataFrame:
    """Offline periods counted per duration cell; the last cell is open-ended."""
    cell = F.least(F.lit(cells), F.floor(F.col("duration_hours") / (top_hours / cells))).cast("int")
    return (periods.where("period_type <> 'running'").groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("periods")))


def top_offline_devices(periods: DataFrame, start: str, end: str, k: int = 10) -> DataFrame:
    """Devices with most offline events in a week, a top-k report."""
    inside = periods.where((F.col("period_type") != "running")
                           & (F.col("period_start") >= F.lit(start).cast("timestamp"))
                           & (F.col("period_start") < F.lit(end).cast("timestamp")))
    return (inside.groupBy("device_id").agg(F.count(F.lit(1)).alias("offline_events"))
            .orderBy(F.desc("offline_events"), "device_id").limit(k))
