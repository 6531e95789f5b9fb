"""Aggregates over Silver: hourly health, daily summaries, fleet rollups, rolling features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import device_temperature, ratio

# Fixed limits of the data model.
VIBRATION_LIMIT = 2.0
TEMPERATURE_LIMIT = 80.0
KWH_PRICE_USD = 0.12


def device_health_hourly(silver: DataFrame) -> DataFrame:
    """Per device hour: averages, maxima, counter delta, minutes seen, most frequent status."""
    return (silver.groupBy("device_id", "customer_id", "device_type",
                           F.date_trunc("hour", "timestamp").alias("hour_start"))
            .agg(F.avg("spindle_rpm").alias("avg_spindle_rpm"),
                 F.avg(device_temperature()).alias("avg_temperature"),
                 F.max("vibration_mm_s").alias("max_vibration"),
                 F.avg("power_kw").alias("avg_power_kw"),
                 (F.max("cycle_count") - F.min("cycle_count")).cast("long").alias("cycle_count_delta"),
                 F.count(F.lit(1)).alias("uptime_minutes"),
                 F.expr("mode() WITHIN GROUP (ORDER BY status)").alias("status")))


def counter_increase(silver: DataFrame, counter: str = "cycle_count",
                     tie: list[str] | None = None) -> DataFrame:
    """Per device hour: plain max-min delta, and the sum of increases that ignores resets."""
    keyed = silver.withColumn("hour_start", F.date_trunc("hour", "timestamp"))
    w = W.partitionBy("device_id", "hour_start").orderBy("timestamp", *(tie or []))
    step = F.col(counter) - F.lag(counter).over(w)
    return (keyed.withColumn("_step", F.greatest(step, F.lit(0)))
            .groupBy("device_id", "hour_start")
            .agg((F.max(counter) - F.min(counter)).cast("long").alias("max_min_delta"),
                 F.coalesce(F.sum("_step"), F.lit(0)).cast("long").alias("reset_aware_delta")))


def customer_metrics_daily(hourly: DataFrame) -> DataFrame:
    """Per customer day from the hourly table; anomalies count device hours, not readings."""
    return (hourly.groupBy("customer_id", F.to_date("hour_start").alias("date"))
            .agg(F.count_distinct("device_id").alias("device_count"),
                 F.sum("cycle_count_delta").alias("total_cycles"),
                 F.avg(F.col("uptime_minutes").cast("double") / 60.0 * 100.0).alias("avg_uptime_pct"),
                 F.count_if(F.col("max_vibration") > VIBRATION_LIMIT).alias("anomaly_count")))


def device_daily_summary(silver: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Per device day: runtime, health, energy, anomalies, score; error counts from events."""
    keys = ["device_id", "customer_id", "date"]
    rows = silver.withColumn("date", F.to_date("timestamp"))
    vib = F.count_if(F.col("vibration_mm_s") > VIBRATION_LIMIT)
    hot = F.count_if(F.col("tool_temperature_c") > TEMPERATURE_LIMIT)
    daily = rows.groupBy(*keys).agg(
        F.max("device_type").alias("device_type"),
        F.max("model").alias("model"),
        F.max("facility").alias("facility"),
        F.count(F.lit(1)).alias("reading_count"),
        (F.count(F.lit(1)).cast("double") / 60.0).alias("runtime_hours"),
        (F.count(F.lit(1)).cast("double") / 1440.0 * 100.0).alias("uptime_pct"),
        (F.max("cycle_count") - F.min("cycle_count")).cast("long").alias("cycle_count"),
        F.avg("vibration_mm_s").alias("avg_vibration_mm_s"),
        F.max("vibration_mm_s").alias("max_vibration_mm_s"),
        F.avg("tool_temperature_c").alias("avg_temperature_c"),
        F.max("tool_temperature_c").alias("max_temperature_c"),
        (F.sum("power_kw") / 60.0).alias("total_energy_kwh"),
        F.avg("power_kw").alias("avg_power_kw"),
        F.max("power_kw").alias("peak_power_kw"),
        vib.alias("vibration_anomalies"),
        hot.alias("temperature_anomalies"),
        # A device day is a bounded group; unbounded ones go through functions.quantiles.
        F.percentile("vibration_mm_s", F.lit(0.95)).alias("p95_vibration_mm_s"),
    )
    daily = daily.withColumn("health_score", F.greatest(
        F.lit(0.0), F.lit(100.0) - F.col("vibration_anomalies").cast("double") / 10.0
        - F.col("temperature_anomalies").cast("double") / 10.0))
    if events is None:
        return daily.withColumn("error_count", F.lit(0).cast("long"))
    errors = error_counts_daily(events)
    return (daily.join(errors, ["device_id", "date"], "left")
            .withColumn("error_count", F.coalesce("error_count", F.lit(0).cast("long"))))


def error_counts_daily(events: DataFrame) -> DataFrame:
    return (events.groupBy("device_id", F.to_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("error_count")))


def health_trend(summary: DataFrame, points: float = 5.0) -> DataFrame:
    """Compares each day's score with the device's previous day; a device has one row a day."""
    w = W.partitionBy("device_id").orderBy("date")
    change = F.col("health_score") - F.lag("health_score").over(w)
    return summary.withColumn("health_trend", F.when(change > points, "improving")
                              .when(change < -points, "degrading").otherwise("stable"))


def customer_daily_rollup(summary: DataFrame, offline: DataFrame | None = None,
                          kwh_price: float = KWH_PRICE_USD) -> DataFrame:
    """Per customer day: devices by health band, energy and its cost, devices offline at the end of that day.

    ``offline`` has ``customer_id, date, devices_offline``, as ``state.offline_by_day`` makes it.
    """
    score = F.col("health_score")
    out = summary.groupBy("customer_id", "date").agg(
        F.count(F.lit(1)).alias("total_devices"),
        F.count_if(score >= 80).alias("devices_operational"),
        F.count_if((score >= 60) & (score < 80)).alias("devices_warning"),
        F.count_if(score < 60).alias("devices_critical"),
        F.sum("total_energy_kwh").alias("total_energy_kwh"),
        (F.sum("total_energy_kwh") * kwh_price).alias("energy_cost_usd"))
    if offline is None:
        return out.withColumn("devices_offline", F.lit(0).cast("long"))
    return (out.join(offline.select("customer_id", "date", "devices_offline"), ["customer_id", "date"], "left")
            .withColumn("devices_offline", F.coalesce("devices_offline", F.lit(0).cast("long"))))


def rolling_features(daily: DataFrame, days: int = 7) -> DataFrame:
    """Rolling features over the last ``days`` calendar days of a device, today included."""
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    w = W.partitionBy("device_id").orderBy("_day").rangeBetween(-(days - 1), 0)
    rows = daily.withColumn("_day", day)
    mean, std = F.avg("avg_vibration_mm_s").over(w), F.stddev_samp("avg_vibration_mm_s").over(w)
    slope = F.expr(
        "regr_slope(avg_vibration_mm_s, _day) OVER (PARTITION BY device_id ORDER BY _day "
        f"RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW)")
    anomalies = F.sum(F.col("vibration_anomalies") + F.col("temperature_anomalies")).over(w)
    return rows.select(
        "device_id", "date",
        mean.alias("vibration_mean_7d"), std.alias("vibration_std_7d"),
        slope.alias("vibration_trend_7d"), ratio(std, mean).alias("vibration_cv_7d"),
        F.avg("avg_temperature_c").over(w).alias("temperature_mean_7d"),
        F.stddev_samp("avg_temperature_c").over(w).alias("temperature_std_7d"),
        ratio(F.sum("cycle_count").over(w), F.sum("total_energy_kwh").over(w)).alias("energy_efficiency_7d"),
        ratio(anomalies, F.sum("reading_count").over(w)).alias("anomaly_rate_7d"),
    )


def rebuild_gold(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily summaries of the touched dates only."""
    part = silver.withColumn("date", F.to_date("timestamp")).join(dates.select("date"), "date", "left_semi")
    return device_daily_summary(part.drop("date"))


def latest_per_device(silver: DataFrame, n: int = 1, tie: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows of each device; Spark keeps ``n`` per key before shuffling."""
    order = [F.desc("timestamp")] + [F.desc(c) for c in (tie or [])]
    rank = F.row_number().over(W.partitionBy("device_id").orderBy(*order))
    return silver.withColumn("recency", rank).where(F.col("recency") <= n)
