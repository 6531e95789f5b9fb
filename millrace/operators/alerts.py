"""Alert rules over minute series: a rule fires once its condition held for the whole hold time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ratio
from millrace.functions.timewise import next_in_time
from millrace.operators.slo import (
    AVAILABILITY_TARGET_PCT, LATENCY_BOUNDS, LATENCY_LIMIT_S, LATENCY_TARGET_PCT,
    dense_minutes, histogram_quantile, minute_series, rule_consumed, with_trailing)


@dataclass(frozen=True)
class AlertRule:
    name: str
    metrics: tuple[str, ...]  # fires when any of them passes the limit
    comparator: str  # one of > < ==
    threshold: float
    hold_minutes: int
    severity: str

    def condition(self) -> Column:
        out = F.lit(False)
        for m in self.metrics:
            v, t = F.col(m), F.lit(float(self.threshold))
            hit = v > t if self.comparator == ">" else v < t if self.comparator == "<" else v == t
            out = out | F.coalesce(hit, F.lit(False))
        return out


# The service's alert rules.
DEFAULT_ALERTS = (
    AlertRule("APIDown", ("requests_5m",), "==", 0, 5, "critical"),
    AlertRule("HighErrorRate", ("error_pct_5m",), ">", 5, 5, "critical"),
    AlertRule("SLOViolationLatency", ("p95_10m",), ">", 1.0, 10, "critical"),
    AlertRule("LowQuality", ("precision",), "<", 0.85, 15, "critical"),
    AlertRule("ErrorBudgetExhausted", ("availability_consumed", "latency_consumed"), ">", 100, 5, "critical"),
    AlertRule("SlowResponses", ("p95_5m",), ">", 0.8, 5, "warning"),
    AlertRule("LowCacheHitRate", ("cache_hit_ratio",), "<", 0.5, 30, "warning"),
    AlertRule("HighGuardrailsRejections", ("rejected_pct_10m",), ">", 10, 10, "warning"),
    AlertRule("GPUHighUtilization", ("gpu_pct",), ">", 95, 15, "warning"),
    AlertRule("ErrorBudgetLow", ("availability_consumed", "latency_consumed"), ">", 80, 5, "warning"),
)


def alert_metrics(log: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The rules' inputs per minute of the period, from one pass over the log."""
    n = len(LATENCY_BOUNDS) + 1
    month = 30 * 1440
    limit_at = LATENCY_BOUNDS.index(LATENCY_LIMIT_S)
    series = minute_series(log).withColumn("within_limit", F.get("latency", F.lit(limit_at)))
    sums = {"requests_5m": ("total", 5), "_failed_5m": ("failed", 5), "_total_10m": ("total", 10),
            "_total_30d": ("total", month), "_failed_30d": ("failed", month),
            "_within_30d": ("within_limit", month)}
    if "rejected" in series.columns:
        sums["_rejected_10m"] = ("rejected", 10)
    if "cache_hit" in series.columns:
        sums["_hits"] = ("cache_hit", month)
    dense = with_trailing(dense_minutes(series, start=start, end=end), sums,
                          arrays={"_h5": ("latency", n, 5), "_h10": ("latency", n, 10)})
    upto = W.partitionBy(F.lit(1)).orderBy("minute").rowsBetween(W.unboundedPreceding, W.currentRow)
    null = F.lit(None).cast("double")
    failed, total = F.col("_failed_30d"), F.col("_total_30d")

    def gauge(name: str) -> Column:
        if f"{name}_sum" not in dense.columns:
            return null
        # A gauge keeps its last value until the next sample.
        return F.last(ratio(F.col(f"{name}_sum"), F.col(f"{name}_n")), ignorenulls=True).over(upto)

    return dense.select(
        "minute", F.col("requests_5m").cast("double").alias("requests_5m"),
        (F.lit(100.0) * ratio(F.col("_failed_5m"), F.col("requests_5m"))).alias("error_pct_5m"),
        histogram_quantile(F.col("_h5"), LATENCY_BOUNDS, 0.95).alias("p95_5m"),
        histogram_quantile(F.col("_h10"), LATENCY_BOUNDS, 0.95).alias("p95_10m"),
        gauge("precision").alias("precision"),
        gauge("gpu_pct").alias("gpu_pct"),
        (ratio(F.col("_hits"), total) if "_hits" in dense.columns else null).alias("cache_hit_ratio"),
        (F.lit(100.0) * ratio(F.col("_rejected_10m"), F.col("_total_10m"))
         if "_rejected_10m" in dense.columns else null).alias("rejected_pct_10m"),
        rule_consumed(F.lit(100.0) * (F.lit(1.0) - ratio(failed, total)), AVAILABILITY_TARGET_PCT)
        .alias("availability_consumed"),
        rule_consumed(F.lit(100.0) * ratio(F.col("_within_30d"), total), LATENCY_TARGET_PCT)
        .alias("latency_consumed"))


def sustained(rows: DataFrame, series: list[str], minute: str = "minute") -> DataFrame:
    """Unbroken runs of minutes per series; ``rows`` holds the minutes on which a condition is true."""
    number = F.unix_timestamp(minute) / 60
    run = number.cast("long") - F.row_number().over(W.partitionBy(*series).orderBy(minute))
    return (rows.withColumn("_run", run).groupBy(*series, "_run")
            .agg(F.min(minute).alias("started_at"), F.max(minute).alias("last_true_at"))
            .drop("_run"))


def evaluate_alerts(metrics: DataFrame, rules=DEFAULT_ALERTS) -> DataFrame:
    """Alert rows: when the condition began, when it fired, and its last true minute."""
    cells = [F.when(r.condition(), F.struct(
        F.lit(r.name).alias("alert"), F.lit(r.severity).alias("severity"),
        F.lit(r.hold_minutes).alias("hold_minutes"))) for r in rules]
    true = metrics.select("minute", F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("r"))
    runs = sustained(true.select("minute", "r.*"), ["alert", "severity", "hold_minutes"])
    fired_at = F.col("started_at") + F.make_dt_interval(mins=F.col("hold_minutes"))
    return (runs.withColumn("fired_at", fired_at).where(F.col("last_true_at") >= F.col("fired_at"))
            .select("alert", "severity", "started_at", "fired_at", "last_true_at"))


def silent_minutes_per_day(df: DataFrame, key: str, ts: str = "timestamp") -> DataFrame:
    """Minutes per key and day, between the key's first and last message, on which it sent nothing.

    Minutes are counted from the gaps between neighbouring minutes with messages; a gap makes a row per day it
    touches, not one per minute.
    """
    seen = df.select(key, F.date_trunc("minute", ts).alias("timestamp")).distinct()
    gaps = next_in_time(seen, [key]).where("next_timestamp IS NOT NULL").select(
        key, (F.unix_seconds("timestamp") + 60).alias("_a"), F.unix_seconds("next_timestamp").alias("_b")).where("_a < _b")
    days = F.sequence(F.to_date(F.timestamp_seconds("_a")), F.to_date(F.timestamp_seconds(F.col("_b") - 60)))
    cut = gaps.withColumn("date", F.explode(days))
    midnight = F.unix_seconds(F.col("date").cast("timestamp"))
    silent = F.least("_b", midnight + 86400) - F.greatest("_a", midnight)
    return cut.groupBy(key, "date").agg((F.sum(silent) / 60).cast("long").alias("silent"))
