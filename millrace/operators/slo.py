"""Service-level indicators, latency histograms, error budgets and burn rates from a request log.

Sliding windows never expand the log: it is reduced to one row per minute first, and windows run
over minutes.  A minute row holds counts and cumulative bucket counts, so every quantile window is a
sum of minute rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import band, is_server_error, ratio

# Histogram bounds of the service metrics (the open last bucket is implied).
LATENCY_BOUNDS = [.01, .025, .05, .075, .1, .25, .5, .75, 1.0, 2.5, 5.0, 7.5, 10.0]
INFERENCE_BOUNDS = [.1, .25, .5, .75, 1.0, 2.0, 5.0, 10.0]
CITATION_BOUNDS = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 10.0]

# Objectives of the live rules.
AVAILABILITY_TARGET_PCT = 99.9
LATENCY_TARGET_PCT = 95.0
LATENCY_LIMIT_S = 1.0
PRECISION_TARGET = 0.90
CACHE_TARGET = 0.60


def minute(ts: str = "ts") -> Column:
    return F.date_trunc("minute", ts)


def bucket_counts(value: Column, bounds: list[float]) -> Column:
    """Cumulative counts per bound, then the total, as one array aggregate."""
    cells = [F.count_if(value <= F.lit(b)) for b in bounds] + [F.count(value)]
    return F.array(*cells)


def histogram_quantile(cumulative: Column, bounds: list[float], q: float) -> Column:
    """Quantile from cumulative buckets by linear interpolation inside the bucket.

    A rank in the open last bucket gives the highest finite bound; an empty histogram gives null.
    """
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    n = len(bounds)
    total = F.get(cumulative, F.lit(n)).cast("double")
    rank = total * F.lit(float(q))
    at = F.array_position(F.transform(cumulative, lambda c: c.cast("double") >= rank), True).cast("int") - 1
    upper = F.get(edges, at)
    lower = F.when(at == 0, 0.0).otherwise(F.get(edges, at - 1))
    # A first bucket with a bound at or below zero has no width to interpolate in.
    lower = F.when((at == 0) & (upper <= 0), upper).otherwise(lower)
    below = F.when(at == 0, 0.0).otherwise(F.get(cumulative, at - 1).cast("double"))
    inside = F.get(cumulative, at).cast("double") - below
    value = lower + (upper - lower) * (rank - below) / F.nullif(inside, F.lit(0.0))
    return F.when(total > 0, F.when(at >= n, F.lit(float(bounds[-1]))).otherwise(F.coalesce(value, lower)))


def histogram(df: DataFrame, value: str, bounds: list[float], by: list[str] = ()) -> DataFrame:
    """Rows ``(le, cumulative_count)`` per group; the open bucket has ``le`` null."""
    counts = df.groupBy(*by).agg(bucket_counts(F.col(value), bounds).alias("c"))
    edges = F.array(*[F.lit(float(b)) for b in bounds], F.lit(None).cast("double"))
    return (counts.select(*by, F.explode(F.arrays_zip(edges.alias("le"), F.col("c").alias("n"))).alias("z"))
            .select(*by, F.col("z.le").alias("le"), F.col("z.n").alias("cumulative_count")))


def histogram_quantiles(df: DataFrame, value: str, bounds: list[float], probs: dict[str, float],
                        by: list[str] = ()) -> DataFrame:
    counts = df.groupBy(*by).agg(bucket_counts(F.col(value), bounds).alias("c"))
    return counts.select(*by, *[histogram_quantile(F.col("c"), bounds, q).alias(n) for n, q in probs.items()])


def minute_sums(log: DataFrame, bounds: list[float] = LATENCY_BOUNDS) -> list[Column]:
    """Aggregates of a minute: totals, failures, latency buckets, gauge sums."""
    sums = [F.count(F.lit(1)).alias("total"),
            F.count_if(is_server_error(F.col("status_code"))).alias("failed"),
            bucket_counts(F.col("duration_s"), bounds).alias("latency")]
    for gauge in ("precision", "gpu_pct", "citations"):
        if gauge in log.columns:
            sums += [F.sum(gauge).alias(f"{gauge}_sum"), F.count(gauge).alias(f"{gauge}_n")]
    for flag in ("rejected", "cache_hit"):
        if flag in log.columns:
            sums.append(F.count_if(F.col(flag)).alias(flag))
    return sums


def minute_series(log: DataFrame, bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """One row per minute with requests."""
    return log.groupBy(minute().alias("minute")).agg(*minute_sums(log, bounds))


def dense_minutes(series: DataFrame, by: list[str] = (), start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Every minute from first to last (or of a given range) per group; absent minutes have null counts.

    The grid grows with time and groups, never with the number of requests.
    """
    first = F.lit(start).cast("timestamp") if start else F.min("minute")
    last = F.lit(end).cast("timestamp") if end else F.max("minute")
    bounds = series.groupBy(*by).agg(first.alias("_a"), last.alias("_b"))
    spine = bounds.select(*by, F.explode(F.sequence(
        "_a", "_b", F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    return spine.join(series, [*by, "minute"], "left")


def with_trailing(dense: DataFrame, sums: dict[str, tuple[str, int]], by: list[str] = (),
                  arrays: dict[str, tuple[str, int, int]] | None = None) -> DataFrame:
    """Adds trailing sums ``out: (column, minutes)`` on a dense minute grid.

    Each is a difference of two running totals, so the cost per row does not depend on the window.
    Arrays (``out: (column, size, minutes)``) are summed per position.
    """
    arrays = arrays or {}
    order = W.partitionBy(*by).orderBy("minute") if by else W.partitionBy(F.lit(1)).orderBy("minute")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    running = {f"_run_{c}": F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto)
               for c in {c for c, _ in sums.values()}}
    sizes = {c: size for c, size, _ in arrays.values()}
    for c, size in sizes.items():
        running[f"_run_{c}"] = F.array(*[
            F.sum(F.coalesce(F.get(F.col(c), F.lit(i)), F.lit(0))).over(upto) for i in range(size)])
    out = dense.withColumns(running)
    added = {}
    for name, (c, minutes) in sums.items():
        added[name] = F.col(f"_run_{c}") - F.coalesce(
            F.lag(f"_run_{c}", minutes).over(order), F.lit(0))
    for name, (c, size, minutes) in arrays.items():
        zeros = F.array_repeat(F.lit(0).cast("long"), size)
        added[f"_lag_{name}"] = F.coalesce(F.lag(f"_run_{c}", minutes).over(order), zeros)
    out = out.withColumns(added)
    out = out.withColumns({name: F.zip_with(f"_run_{c}", f"_lag_{name}", lambda a, b: a - b)
                           for name, (c, _, _) in arrays.items()})
    return out.drop(*running, *[f"_lag_{n}" for n in arrays])


def availability(log: DataFrame, by: list[str] = ()) -> DataFrame:
    failed = F.count_if(is_server_error(F.col("status_code")))
    total = F.count(F.lit(1))
    return log.groupBy(*by).agg(
        total.alias("total"), failed.alias("failed"),
        (F.lit(100.0) * (F.lit(1.0) - ratio(failed, total))).alias("availability_pct"))


def latency_compliance(log: DataFrame, limit_s: float = LATENCY_LIMIT_S, by: list[str] = ()) -> DataFrame:
    return log.groupBy(*by).agg(
        (F.lit(100.0) * ratio(F.count_if(F.col("duration_s") <= limit_s), F.count("duration_s")))
        .alias("compliance_pct"))


def rule_consumed(sli_pct: Column, target_pct: float) -> Column:
    """Budget use as the live rules state it: relative shortfall against the target."""
    return F.lit(100.0) * (F.lit(1.0) - sli_pct / F.lit(float(target_pct)))


def budget_used(failed: Column, total: Column, slo: float) -> Column:
    """Failed requests over the allowed number of failures."""
    return ratio(failed, total.cast("double") * F.lit(1.0 - slo))


def error_budget(log: DataFrame, slo: float = 0.995) -> DataFrame:
    """Both budget forms side by side for availability and latency."""
    failed = F.count_if(is_server_error(F.col("status_code")))
    slow = F.count_if(F.col("duration_s") > LATENCY_LIMIT_S)
    total = F.count(F.lit(1))
    row = log.agg(failed.alias("failed"), slow.alias("slow"), total.alias("total"))
    availability_pct = F.lit(100.0) * (F.lit(1.0) - ratio(F.col("failed"), F.col("total")))
    compliance_pct = F.lit(100.0) * (F.lit(1.0) - ratio(F.col("slow"), F.col("total")))
    return row.select(
        "failed", "slow", "total",
        rule_consumed(availability_pct, AVAILABILITY_TARGET_PCT).alias("availability_rule_consumed"),
        rule_consumed(compliance_pct, LATENCY_TARGET_PCT).alias("latency_rule_consumed"),
        budget_used(F.col("failed"), F.col("total"), slo).alias("availability_budget_used"),
        (F.lit(100.0) * (F.lit(1.0) - F.col("failed").cast("double") / (43.2 * 60))).alias("dashboard_remaining"))


# Fixed values: (window minutes, burn-rate limit, severity).
BURN_WINDOWS = ((60, 14.0, "critical"), (360, 7.0, "high"), (4320, 2.0, "medium"))


def burn_rate(log: DataFrame, slo: float = 0.995, windows=BURN_WINDOWS) -> DataFrame:
    """Per minute with requests: burn rate over each window and the most severe limit passed."""
    sums = {}
    for m, _, _ in windows:
        sums[f"failed_{m}"] = ("failed", m)
        sums[f"total_{m}"] = ("total", m)
    dense = with_trailing(dense_minutes(minute_series(log)), sums).where("total IS NOT NULL")
    rates = {f"burn_{m}m": ratio(F.col(f"failed_{m}"), F.col(f"total_{m}")) / F.lit(1.0 - slo)
             for m, _, _ in windows}
    severity = F.lit("none")
    for m, limit, name in reversed(windows):
        severity = F.when(F.col(f"burn_{m}m") > limit, name).otherwise(severity)
    return (dense.withColumns(rates).withColumn("severity", severity)
            .select("minute", *rates, "severity"))


def sliding_rates(log: DataFrame, label: str, minutes: int = 5) -> DataFrame:
    """Requests and failures per second of each label over the trailing window, per active minute."""
    counts = log.groupBy(label, minute().alias("minute")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_server_error(F.col("status_code"))).alias("failed"))
    out = with_trailing(dense_minutes(counts, [label]),
                        {"_t": ("total", minutes), "_f": ("failed", minutes)}, [label])
    seconds = minutes * 60.0
    return out.where("total IS NOT NULL").select(
        label, "minute", (F.col("_t").cast("double") / seconds).alias("request_rate"),
        (F.col("_f").cast("double") / seconds).alias("error_rate"))


def sliding_latency(log: DataFrame, minutes: int, q: float = 0.95,
                    bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """Histogram quantile over the trailing window, per minute with requests."""
    dense = with_trailing(dense_minutes(minute_series(log, bounds)), {},
                          arrays={"_c": ("latency", len(bounds) + 1, minutes)})
    return (dense.where("total IS NOT NULL")
            .select("minute", histogram_quantile(F.col("_c"), bounds, q).alias("quantile_s")))


def gauge_average(log: DataFrame, gauge: str, days: int) -> DataFrame:
    """Average of a gauge over the trailing days, per day; averages are rebuilt from daily sums."""
    daily = log.groupBy(F.to_date("ts").alias("date")).agg(
        F.sum(gauge).alias("s"), F.count(gauge).alias("n"))
    w = (W.partitionBy(F.lit(1)).orderBy(F.datediff("date", F.lit("1970-01-01").cast("date")))
         .rangeBetween(-(days - 1), 0))
    return daily.select("date", ratio(F.sum("s").over(w), F.sum("n").over(w)).alias("gauge_avg"))


def precision_budget(log: DataFrame, days: int = 30) -> DataFrame:
    """Per day: trailing precision, the share of its error budget used and left, and the colour of what is left."""
    average = F.col("gauge_avg")
    used = rule_consumed(F.lit(100.0) * average, 100.0 * PRECISION_TARGET)
    return gauge_average(log, "precision", days).select(
        "date", average.alias("precision_avg"), used.alias("budget_used"), (F.lit(100.0) - used).alias("budget_left"),
        band(F.lit(100.0) - used, BUDGET_STEPS, "red").alias("status"))


def cache_average(log: DataFrame, days: int = 7) -> DataFrame:
    """Per day: the trailing share of requests answered from the cache, and whether it reaches its target."""
    hits = log.withColumn("_hit", F.col("cache_hit").cast("int").cast("double"))
    return gauge_average(hits, "_hit", days).select(
        "date", F.col("gauge_avg").alias("hit_ratio"), (F.col("gauge_avg") >= CACHE_TARGET).alias("meets_target"))


def average_citations(log: DataFrame, minutes: int = 5) -> DataFrame:
    out = with_trailing(dense_minutes(minute_series(log)),
                        {"_s": ("citations_sum", minutes), "_n": ("citations_n", minutes)})
    return out.where("total IS NOT NULL").select("minute", ratio(F.col("_s"), F.col("_n")).alias("avg_citations"))


def error_counts(log: DataFrame, by: list[str]) -> DataFrame:
    return (log.where(is_server_error(F.col("status_code"))).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("errors")))


def retrieval_slis(log: DataFrame) -> DataFrame:
    """Success, empty-result and citation ratios of the retrieval log."""
    ok = ~is_server_error(F.col("status_code"))
    n = F.count(F.lit(1))
    return log.agg(ratio(F.count_if(ok), n).alias("success_ratio"),
                   ratio(F.count_if(F.col("citations") == 0), n).alias("empty_ratio"),
                   ratio(F.count_if(F.col("citations") > 0), n).alias("citation_ratio"))


def run_slis(runs: DataFrame, asof: str, probs=0.95) -> DataFrame:
    """Batch runs ``(dag, state, duration_s, finished_at)``: success ratio, p95, freshness."""
    from millrace.functions.quantiles import exact_quantiles

    now = F.lit(asof).cast("timestamp")
    good = F.col("state") == "success"
    base = runs.groupBy("dag").agg(
        F.count(F.lit(1)).alias("runs"), ratio(F.count_if(good), F.count(F.lit(1))).alias("success_ratio"),
        F.max(F.when(good, F.col("finished_at"))).alias("_last"))
    age = (F.unix_micros(now) - F.unix_micros("_last")) / F.lit(3.6e9)
    p = exact_quantiles(runs, ["dag"], "duration_s", {"p95_duration_s": probs})
    return (base.join(p, "dag", "left").withColumn("freshness_hours", age)
            .withColumns({"fresh": F.col("freshness_hours") < 24, "stuck": F.col("freshness_hours") > 2})
            .drop("_last"))


def throughput(df: DataFrame, ts: str, rejected: Column, window: str = "5 minutes") -> DataFrame:
    """Messages per second and dead-letter share per tumbling window."""
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    return (df.groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"), F.count_if(rejected).alias("rejected"))
            .select(F.col("w.start").alias("window_start"), "messages", "rejected",
                    (F.col("messages").cast("double") / seconds).alias("messages_per_s"),
                    ratio(F.col("rejected"), F.col("messages")).alias("rejected_ratio")))


def budget_trend(log: DataFrame, start: str, days: int = 30, slo: float = 0.999) -> DataFrame:
    """Per day: remaining error budget of the window so far, and the day's hourly worst availability.

    The allowance is that of all requests of the frame, so the remainder only falls.
    """
    daily = (log.groupBy(F.to_date("ts").alias("date"))
             .agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(is_server_error(F.col("status_code"))).alias("failed"))
             .where((F.col("date") >= F.lit(start).cast("date"))
                    & (F.col("date") < F.date_add(F.lit(start).cast("date"), days))))
    run = W.partitionBy(F.lit(1)).orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    frame = W.partitionBy(F.lit(1))
    week = W.partitionBy(F.lit(1)).orderBy("date").rowsBetween(-6, 0)
    used = ratio(F.sum("failed").over(run), F.sum("total").over(frame).cast("double") * F.lit(1.0 - slo))
    return daily.select(
        "date", (F.lit(100.0) * (F.lit(1.0) - used)).alias("budget_remaining_pct"),
        (F.lit(100.0) * (F.lit(1.0) - ratio(F.sum("failed").over(week), F.sum("total").over(week))))
        .alias("availability_7d_pct"))


# Dashboard steps (lower bound, colour).
AVAILABILITY_STEPS = [(0.0, "red"), (99.5, "yellow"), (99.9, "green")]
LATENCY_STEPS = [(0.0, "green"), (0.8, "yellow"), (1.0, "red")]
PRECISION_STEPS = [(0.0, "red"), (0.85, "yellow"), (0.90, "green")]
BUDGET_STEPS = [(0.0, "red"), (20.0, "yellow"), (50.0, "green")]
