"""Operating schedules: which one applies, whether a device should run, expected intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import MICROS, overlap_micros
from millrace.functions.timewise import in_ranges

ALWAYS = "24x7"
_FIELDS = ["timezone", "schedule_type", "weekly_schedule", "holidays", "maintenance_windows"]


def resolve_schedules(df: DataFrame, schedules: DataFrame, at: Column | None = None) -> DataFrame:
    """Adds the schedule valid for each row: its device's, else its facility's, else 24x7.

    ``at`` is the instant whose version applies (``effective_from <= at < effective_until``).  The
    schedule tables are small dimensions; Spark broadcasts them when their size allows it.
    """
    out = df
    for level, key in (("device", "device_id"), ("facility", "facility")):
        side = schedules.where(F.col("entity_type") == level).select(
            F.col("entity_id").alias(f"_{level}"),
            F.struct(*_FIELDS).alias(f"_{level}_schedule"),
            F.col("effective_from").alias("_from"), F.col("effective_until").alias("_until"))
        match = F.col(key) == F.col(f"_{level}")
        if at is not None:
            match = match & (F.col("_from") <= at) & (F.col("_until").isNull() | (at < F.col("_until")))
        out = out.join(side, match, "left").drop(f"_{level}", "_from", "_until")
    chosen = F.coalesce("_device_schedule", "_facility_schedule")
    out = out.withColumn("_s", chosen).drop("_device_schedule", "_facility_schedule")
    cols = {f: F.col(f"_s.{f}") for f in _FIELDS}
    cols["schedule_type"] = F.coalesce("_s.schedule_type", F.lit(ALWAYS))
    cols["timezone"] = F.coalesce("_s.timezone", F.lit("UTC"))
    return out.withColumns(cols).drop("_s")


def _minutes(hhmm: Column) -> Column:
    part = F.split(hhmm, ":")
    return part[0].cast("int") * 60 + part[1].cast("int")


def _second_of_day(ts: Column) -> Column:
    return F.pmod(F.unix_micros(ts), F.lit(86400 * MICROS)) / F.lit(float(MICROS))


def _weekday(day: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE"))


def maintenance_reason(ts: Column) -> Column:
    hit = F.filter("maintenance_windows", lambda w: (w["start"] <= ts) & (ts <= w["end"]))
    return F.when(F.size(hit) > 0, F.concat(F.lit("scheduled_maintenance: "), F.get(hit, F.lit(0))["reason"]))


def expected_reason(ts: Column, strict: bool = True) -> Column:
    """Why a device is, or is not, expected to run at an instant, on resolved schedule columns.

    The checks run in a fixed order: 24x7, holiday, maintenance, weekday, hours (both ends included).
    ``strict=False`` also honours maintenance for 24x7 devices and shifts that pass midnight.
    """
    local = F.from_utc_timestamp(ts, F.col("timezone"))
    hours = F.try_element_at("weekly_schedule", _weekday(local))
    start, end = _minutes(hours["start"]) * 60, _minutes(hours["end"]) * 60
    now = _second_of_day(local)
    inside = (start <= now) & (now <= end)
    not_today = F.lit("not_scheduled_day")
    late_part = F.lit(False)
    if not strict:
        yesterday = F.try_element_at("weekly_schedule", _weekday(F.date_sub(local, 1)))
        y_start, y_end = _minutes(yesterday["start"]) * 60, _minutes(yesterday["end"]) * 60
        late_part = F.coalesce((y_end < y_start) & (now <= y_end), F.lit(False))
        inside = F.when(end < start, now >= start).otherwise(inside)
    weekly = (F.when(late_part, "in_operating_hours")
              .when(hours.isNull(), not_today)
              .when(inside, "in_operating_hours").otherwise("outside_operating_hours"))
    holiday = F.coalesce(F.array_contains("holidays", F.to_date(local)), F.lit(False))
    maintenance = maintenance_reason(ts)
    always = F.lit("24x7_operation")
    if not strict:
        always = F.coalesce(maintenance, always)
    return (F.when(F.col("schedule_type") == ALWAYS, always)
            .when(holiday, "holiday")
            .when(maintenance.isNotNull(), maintenance)
            .otherwise(weekly))


def expected_to_run(df: DataFrame, schedules: DataFrame, ts_col: str = "timestamp",
                    strict: bool = True, versioned: bool = True) -> DataFrame:
    """Adds ``expected`` and ``reason`` for each row's device and instant."""
    at = F.col(ts_col) if versioned else None
    out = resolve_schedules(df, schedules, at)
    out = out.withColumn("reason", expected_reason(F.col(ts_col), strict)).drop(*_FIELDS)
    return out.withColumn("expected", F.col("reason").isin("24x7_operation", "in_operating_hours"))


def operating_periods(devices: DataFrame, schedules: DataFrame, first_day: str, last_day: str,
                      strict: bool = True) -> DataFrame:
    """One row per device and local day: the day and its expected interval in UTC, and its maintenance share.

    ``devices`` has one row per device.  Holidays and unscheduled days have zero expected seconds.  With
    ``strict=False`` a shift that ends before it starts ends on the next day; otherwise it has none.
    """
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    rows = (resolve_schedules(devices.select("device_id", "customer_id", "facility"), schedules)
            .withColumn("date", F.explode(days)))
    midnight = F.col("date").cast("timestamp")
    hours = F.try_element_at("weekly_schedule", _weekday(F.col("date")))
    always = F.col("schedule_type") == ALWAYS
    start_min = F.when(always, 0).otherwise(_minutes(hours["start"]))
    end_min = F.when(always, 1440).otherwise(_minutes(hours["end"]))
    if not strict:
        end_min = F.when(end_min < start_min, end_min + 1440).otherwise(end_min)
    off = ~always & (hours.isNull() | F.coalesce(F.array_contains("holidays", F.col("date")), F.lit(False)))

    def instant(minute: Column) -> Column:
        return F.to_utc_timestamp(midnight + F.make_dt_interval(mins=minute), F.col("timezone"))

    rows = rows.withColumns({
        "day_start": instant(F.lit(0)), "day_end": instant(F.lit(1440)),
        "op_start": F.when(~off, instant(start_min)), "op_end": F.when(~off, instant(end_min))})
    rows = rows.withColumn("maintenance_windows", F.when(
        ~always, F.col("maintenance_windows")))
    start, end = F.col("op_start"), F.col("op_end")
    return rows.select(
        "device_id", "customer_id", "date", "day_start", "day_end", "op_start", "op_end", "maintenance_windows",
        overlap_micros(start, end, start, end).alias("expected_micros"),
        maintenance_micros(start, end).alias("maintenance_micros"))


def maintenance_micros(start: Column, end: Column) -> Column:
    """Microseconds of an interval inside the row's maintenance windows (windows are disjoint)."""
    return F.aggregate(F.coalesce("maintenance_windows", F.array()), F.lit(0).cast("long"),
                       lambda acc, w: acc + overlap_micros(start, end, w["start"], w["end"]))


LEVELS = 40  # powers of two of a bucket; the last is longer than any calendar


def window_blocks(windows: DataFrame, start: str, end: str, bucket_s: int = 3600) -> DataFrame:
    """Each window as the fewest aligned blocks of ``2 ** _level`` buckets that cover it: ``_level`` and ``_block``.

    A window of n buckets has at most two blocks per level and no more than ``log2(n) + 1`` levels, so a year is some
    twenty rows and not one per hour.  Blocks of a window do not overlap: an instant lies in one of them at most.
    Windows that end before they start, or miss an end, have none.
    """
    width = bucket_s * MICROS
    first, last = (F.floor(F.unix_micros(c) / F.lit(width)).cast("long") for c in (start, end))

    def of_level(level: Column) -> Column:
        # What is left for this level once the levels below took the blocks that cannot be paired.
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        a = -F.floor(-F.col("_first") / size)
        b = F.floor((F.col("_last") + 1) / size) - 1
        odd, even = F.abs(a % 2) == 1, b % 2 == 0
        return F.when(a <= b, F.concat(
            F.when(odd, F.array(F.struct(level.alias("_level"), a.alias("_block")))).otherwise(F.array()),
            F.when(even, F.array(F.struct(level.alias("_level"), b.alias("_block")))).otherwise(F.array()))).otherwise(F.array())

    top = F.ceil(F.log2((F.col("_last") - F.col("_first") + 2).cast("double"))).cast("int")
    spans = windows.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    blocks = F.flatten(F.transform(F.sequence(F.lit(0), F.least(top, F.lit(LEVELS - 1))), of_level))
    return (spans.withColumn("_b", F.explode(blocks)).withColumns({"_level": F.col("_b._level"), "_block": F.col("_b._block")})
            .drop("_b", "_first", "_last"))


def interval_join(df: DataFrame, windows: DataFrame, key: str, ts: str, start: str, end: str,
                  bucket_s: int = 3600) -> DataFrame:
    """Rows whose instant lies in a window of the same key, both ends included.

    Windows become aligned blocks, and a row asks for its block on each level that some window has: an equi-join on
    (key, level, block), whatever the windows' lengths.  Short windows have one or two levels, so rows are not repeated
    more often than the longest window needs.
    """
    spread = window_blocks(windows, start, end, bucket_s)
    levels = sorted(r[0] for r in spread.select("_level").distinct().collect())  # at most LEVELS numbers
    bucket = F.floor(F.unix_micros(ts) / F.lit(bucket_s * MICROS)).cast("long")
    asks = F.array(*[F.struct(F.lit(v).alias("_level"), F.floor(bucket / F.lit(1 << v)).alias("_block")) for v in levels])
    if not levels:
        asks = F.array().cast("array<struct<_level: int, _block: bigint>>")
    rows = (df.where(F.col(ts).isNotNull()).withColumn("_b", F.explode(asks))
            .withColumns({"_level": F.col("_b._level"), "_block": F.col("_b._block")}).drop("_b"))
    return (rows.join(spread, [key, "_level", "_block"])
            .where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop("_level", "_block"))


def interval_totals(df: DataFrame, windows: DataFrame, key: str, ts: str, start: str, end: str,
                    ranges: int | None = None) -> DataFrame:
    """The windows that have rows, with ``rows``, ``first`` and ``last``: number, least and greatest instant of their rows.

    What ``interval_join`` grouped by the windows' columns gives, but without its pairs, of which there are as many as
    rows times windows: instants are counted up in ranges of (key, time), and a window takes the count up to its end less
    the count before its start. Of each range only its total, first and last instant are carried to the others.
    """
    kept = windows.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    window = F.struct(*[F.col(c) for c in windows.columns])
    none = F.lit(None)
    seen = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, F.col(ts).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    # At one instant starts come before rows, and ends behind them.
    points = seen.select(key, "_at", F.lit(1).alias("_side"), "_n", F.col("_at").alias("_seen"), none.cast(windows.schema).alias("_window"))
    for side, c in ((0, start), (2, end)):
        points = points.unionByName(kept.select(
            key, F.col(c).alias("_at"), F.lit(side).alias("_side"), F.lit(0).cast("long").alias("_n"),
            none.cast(seen.schema["_at"].dataType).alias("_seen"), window.alias("_window")))
    rows = in_ranges(points, [key, "_at"], ranges)
    of_range = rows.groupBy(key, "_range").agg(F.sum("_n").alias("_n"), F.min("_seen").alias("_first"), F.max("_seen").alias("_last"))
    back, ahead = W.partitionBy(key).orderBy("_range"), W.partitionBy(key).orderBy(F.desc("_range"))
    others = (W.unboundedPreceding, -1)
    carried = of_range.select(
        key, "_range", F.coalesce(F.sum("_n").over(back.rowsBetween(*others)), F.lit(0)).alias("_n_before"),
        F.last("_last", ignorenulls=True).over(back.rowsBetween(*others)).alias("_last_before"),
        F.last("_first", ignorenulls=True).over(ahead.rowsBetween(*others)).alias("_first_behind"))
    inside = W.partitionBy(key, "_range")
    upto = inside.orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    onward = inside.orderBy(F.desc("_at"), F.desc("_side")).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = rows.withColumns({"_upto": F.sum("_n").over(upto), "_last": F.last("_seen", ignorenulls=True).over(upto),
                                "_next": F.last("_seen", ignorenulls=True).over(onward)})
    ends = counted.where("_side <> 1").join(carried, [key, "_range"])
    is_end, upto_all = F.col("_side") == 2, F.col("_upto") + F.col("_n_before")
    return (ends.groupBy("_window").agg(
        F.sum(F.when(is_end, upto_all).otherwise(-upto_all)).alias("rows"),
        F.min(F.when(~is_end, F.coalesce("_next", "_first_behind"))).alias("first"),
        F.max(F.when(is_end, F.coalesce("_last", "_last_before"))).alias("last"))
        .where("rows > 0").select("_window.*", "rows", "first", "last"))


def schedule_versions(schedules: DataFrame) -> DataFrame:
    """Gives open-ended versions the start of the entity's next version as their end."""
    following = F.lead("effective_from").over(
        W.partitionBy("entity_type", "entity_id").orderBy("effective_from"))
    return schedules.withColumn("effective_until", F.coalesce("effective_until", following))
