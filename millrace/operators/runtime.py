"""Runtime from gaps between messages, connectivity events, and uptime against schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import overlap_micros, ratio, seconds_between
from millrace.functions.timewise import next_in_time
from millrace.operators.schedule import maintenance_micros

RUN_GAP_S = 300
OFF_GAP_S = 7200


def runtime_periods(silver: DataFrame, run_gap_s: int = RUN_GAP_S, off_gap_s: int = OFF_GAP_S,
                    tie: list[str] | None = None) -> DataFrame:
    """The gap after each message, classified; the last message of a device has none.

    Gaps are taken over the whole history of the device, so none is lost at midnight.
    """
    cols = silver.select("device_id", "customer_id", "timestamp", *(tie or []))
    gap = seconds_between(F.col("timestamp"), F.col("next_timestamp"))
    kind = (F.when(gap <= run_gap_s, "running").when(gap <= off_gap_s, "offline")
            .otherwise("extended_offline"))
    return (next_in_time(cols, ["device_id"], tie=tie).where("next_timestamp IS NOT NULL")
            .select("device_id", "customer_id", F.col("timestamp").alias("period_start"),
                    F.col("next_timestamp").alias("period_end"),
                    (gap / 3600.0).alias("duration_hours"), kind.alias("period_type")))


def runtime_summary(periods: DataFrame, by=("device_id", "customer_id")) -> DataFrame:
    """Totals per group; durations add up as whole microseconds, so no order of summation shows."""
    running = F.col("period_type") == "running"
    micros = F.unix_micros("period_end") - F.unix_micros("period_start")
    run = F.sum(F.when(running, micros).otherwise(0))
    off = F.sum(F.when(~running, micros).otherwise(0))
    return periods.groupBy(*by).agg(
        (run / F.lit(3.6e9)).alias("runtime_hours"),
        (off / F.lit(3.6e9)).alias("offline_hours"),
        F.count_if(~running).alias("offline_events"),
        (F.max(F.when(~running, micros)) / F.lit(6e7)).alias("longest_offline_minutes"),
        (ratio(run, run + off) * 100.0).alias("uptime_pct"))


def split_by_day(periods: DataFrame) -> DataFrame:
    """Periods cut at UTC midnights, one row per day touched."""
    first, last = F.to_date("period_start"), F.to_date("period_end")
    day = periods.withColumn("date", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("period_start"), F.col("date").cast("timestamp"))
    end = F.least(F.col("period_end"), F.date_add("date", 1).cast("timestamp"))
    cut = day.withColumns({"period_start": start, "period_end": end})
    cut = cut.where("period_start < period_end")
    return cut.withColumn("duration_hours", seconds_between(F.col("period_start"), F.col("period_end")) / 3600.0)


def connectivity_events(periods: DataFrame) -> DataFrame:
    """An offline and an online event for each period without messages."""
    off = periods.where("period_type <> 'running'")
    seconds = seconds_between(F.col("period_start"), F.col("period_end"))

    def event(kind: str, ts: str, severity: str, text, duration, missed):
        stamp = F.date_format(ts, "yyyyMMdd-HHmmss")
        return F.struct(
            F.concat_ws("-", F.lit("evt"), F.lit(kind), stamp,
                        F.regexp_replace("device_id", "-", "")).alias("event_id"),
            F.col(ts).alias("timestamp"), F.lit(f"device_{kind}").alias("event_type"),
            F.lit(severity).alias("severity"), text.alias("message"),
            F.col("period_start").alias("offline_since"),
            duration.alias("offline_duration_seconds"),
            missed.alias("consecutive_missed_heartbeats"))

    went = F.concat(F.col("device_id"), F.lit(" went offline (last seen: "),
                    F.date_format("period_start", "HH:mm:ss"), F.lit(")"))
    back = F.concat(F.col("device_id"), F.lit(" back online after "),
                    F.floor(seconds / 60).cast("string"), F.lit(" minutes"))
    none = F.lit(None)
    events = F.array(
        event("offline", "period_start", "warning", went, none.cast("double"),
              F.floor(seconds / 60).cast("long")),
        event("online", "period_end", "info", back, seconds, none.cast("long")))
    return off.select("device_id", "customer_id", F.explode(events).alias("e")).select(
        "device_id", "customer_id", "e.*")


def missed_heartbeats(state: DataFrame, asof: str, every_s: int = 60) -> DataFrame:
    gap = seconds_between(F.col("last_seen_at"), F.lit(asof).cast("timestamp"))
    return state.withColumn("missed_heartbeats",
                            F.greatest(F.lit(0), F.floor(gap / every_s)).cast("long"))


def sla_uptime(periods: DataFrame, operating: DataFrame) -> DataFrame:
    """Per device and local day: runtime and downtime, unplanned in expected hours and planned otherwise.

    Planned downtime is downtime of the local day outside the expected hours, or in a maintenance window inside
    them.  Events count the unplanned downtimes and the maintenance windows of the expected hours; the longest
    downtime is that of a whole period, however often midnight cuts it.

    Both sides are cut at UTC midnights and joined on (device, UTC day), which keeps the join an
    equi-join and spreads a busy device over its days.
    """
    pieces = split_by_day(periods.withColumn("_of", F.col("period_start"))).select(
        "device_id", "_of", F.col("date").alias("utc_date"), "period_start", "period_end", "period_type")
    first = F.to_date(F.least("day_start", "op_start"))
    last = F.to_date(F.greatest("day_end", "op_end"))
    spread = (operating.withColumn("utc_date", F.explode(F.sequence(first, last)))
              .select("device_id", "utc_date", "date", "day_start", "day_end", "op_start", "op_end",
                      "maintenance_windows"))
    both = pieces.join(spread, ["device_id", "utc_date"])
    start, end = F.greatest("period_start", "op_start"), F.least("period_end", "op_end")
    piece = F.col("period_start"), F.col("period_end")
    shared = F.greatest("day_start", "op_start"), F.least("day_end", "op_end")
    zero = F.lit(0).cast("long")
    known = F.col("op_start").isNotNull()
    both = both.withColumns({
        "_inside": overlap_micros(*piece, F.col("op_start"), F.col("op_end")),
        "_outside": overlap_micros(*piece, F.col("day_start"), F.col("day_end"))
        - F.when(known, overlap_micros(*piece, *shared)).otherwise(zero),
        "_served": F.when(known & (start < end), maintenance_micros(start, end)).otherwise(zero),
    }).where("_inside > 0 OR _outside > 0")
    running = F.col("period_type") == "running"
    whole = both.groupBy("device_id", "date", "_of").agg(
        F.sum(F.when(running, F.col("_inside")).otherwise(0)).alias("_run"),
        F.sum(F.when(~running, F.col("_inside") - F.col("_served")).otherwise(0)).alias("_unplanned"),
        F.sum(F.when(~running, F.col("_outside") + F.col("_served")).otherwise(0)).alias("_planned"))
    used = whole.groupBy("device_id", "date").agg(
        F.sum("_run").alias("_run"), F.sum("_unplanned").alias("_unplanned"), F.sum("_planned").alias("_planned"),
        F.max("_unplanned").alias("_longest"), F.count_if(F.col("_unplanned") > 0).alias("_events"))
    run, unplanned, planned = (F.coalesce(c, zero) for c in ("_run", "_unplanned", "_planned"))
    expected = F.col("expected_micros")
    served = F.filter(F.coalesce("maintenance_windows", F.array()), lambda w: overlap_micros(
        w["start"], w["end"], F.col("op_start"), F.col("op_end")) > 0)
    hour, minute = F.lit(3.6e9), F.lit(6e7)
    return (operating.join(used, ["device_id", "date"], "left").select(
        "device_id", "customer_id", "date",
        (expected / hour).alias("expected_operating_hours"),
        (run / hour).alias("runtime_hours"),
        (unplanned / hour).alias("offline_unplanned_hours"),
        (planned / hour).alias("offline_planned_hours"),
        (F.greatest(zero, expected - run - unplanned) / hour).alias("idle_hours"),
        (ratio(run, expected) * 100.0).alias("uptime_pct"),
        (ratio(run, expected - F.col("maintenance_micros")) * 100.0).alias("sla_uptime_pct"),
        F.coalesce("_events", zero).alias("offline_events_unplanned"),
        F.size(served).cast("long").alias("offline_events_planned"),
        (F.coalesce("_longest", zero) / minute).alias("longest_offline_minutes"),
        ((unplanned + planned) / minute).alias("total_offline_duration_minutes")))


def running_sessions(silver: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """Running periods as session windows: messages at most ``gap`` apart share a session."""
    return (silver.groupBy("device_id", F.session_window("timestamp", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"), F.max("timestamp").alias("last_message"))
            .select("device_id", F.col("w.start").alias("session_start"), "last_message", "messages"))
