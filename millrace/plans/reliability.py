"""Request-log queries: indicators, histograms, budgets, alerts, cache replay, text screening."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import band, cache_key, is_server_error
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.text import tokens
from millrace.operators import alerts, guardrails, replay, slo
from millrace.plans.base import REQUESTS, day, query, rounded, ts, with_
from millrace.sources import tables

R_ = with_(REQUESTS)


def log(spark, root):
    return tables.requests(spark, root)


@query("availability", "A9", R_ + """
SELECT endpoint, count(*) AS total, count(*) FILTER (status_code LIKE '5%') AS failed,
       round(100.0 * (1 - count(*) FILTER (status_code LIKE '5%') / CAST(count(*) AS DOUBLE)), 10) AS availability_pct
FROM requests GROUP BY 1""")
def _(spark, root):
    return rounded(slo.availability(log(spark, root), ["endpoint"]))


@query("availability_30d", "A9 K5", R_ + """
SELECT total, failed, round(a, 10) AS availability_pct,
       CASE WHEN a >= 99.9 THEN 'green' WHEN a >= 99.5 THEN 'yellow' WHEN a >= 0 THEN 'red' ELSE 'red' END AS colour
FROM (SELECT count(*) AS total, count(*) FILTER (status_code LIKE '5%') AS failed,
             100.0 * (1 - count(*) FILTER (status_code LIKE '5%') / CAST(count(*) AS DOUBLE)) AS a
      FROM requests WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND ts <= TIMESTAMP '2024-01-31') x""")
def _(spark, root):
    end = F.lit("2024-01-31 00:00:00").cast("timestamp")
    inside = log(spark, root).where((F.col("ts") > end - F.expr("INTERVAL 30 DAYS")) & (F.col("ts") <= end))
    a = slo.availability(inside)
    return rounded(a.withColumn("colour", band(F.col("availability_pct"), slo.AVAILABILITY_STEPS, "red")))


@query("service_status_daily", "K5", R_ + f"""
SELECT {day('ts')} AS date, CASE WHEN max(p) IS NULL THEN NULL WHEN avg("precision") >= 0.90 THEN 'green'
       WHEN avg("precision") >= 0.85 THEN 'yellow' ELSE 'red' END AS precision_colour,
       CASE WHEN avg(duration_s) >= 1.0 THEN 'red' WHEN avg(duration_s) >= 0.8 THEN 'yellow' ELSE 'green' END AS latency_colour
FROM (SELECT *, "precision" AS p FROM requests) r GROUP BY 1""")
def _(spark, root):
    d = log(spark, root).groupBy(F.to_date("ts").alias("date")).agg(
        F.avg("precision").alias("p"), F.avg("duration_s").alias("d"))
    return d.select("date", band(F.col("p"), slo.PRECISION_STEPS, "red").alias("precision_colour"),
                    band(F.col("d"), slo.LATENCY_STEPS, "green").alias("latency_colour"))


def _histogram_sql(value: str, bounds: list[float], by: str, source: str) -> str:
    cells = ",\n".join(f"SELECT {by}, {b}::DOUBLE AS le, count(*) FILTER ({value} <= {b}) AS cumulative_count FROM {source} GROUP BY 1"
                       for b in bounds)
    return "\nUNION ALL\n".join(cells.split(",\nSELECT ")[:1] + ["SELECT " + c for c in cells.split(",\nSELECT ")[1:]]
                                + [f"SELECT {by}, NULL, count({value}) FROM {source} GROUP BY 1"])


@query("latency_histogram", "A10", R_ + _histogram_sql("duration_s", slo.LATENCY_BOUNDS, "endpoint", "requests"))
def _(spark, root):
    return slo.histogram(log(spark, root), "duration_s", slo.LATENCY_BOUNDS, ["endpoint"])


@query("citation_histogram", "A10", R_ + _histogram_sql("citations", slo.CITATION_BOUNDS, "endpoint", "requests"))
def _(spark, root):
    return slo.histogram(log(spark, root), "citations", slo.CITATION_BOUNDS, ["endpoint"])


def quantile_sql(cells: list[str], bounds: list[float], q: float) -> str:
    """SQL of a histogram quantile over cumulative cell expressions, the last being the total."""
    total, rank = cells[-1], f"({q} * {cells[-1]})"
    out = [f"CASE WHEN {total} = 0 OR {total} IS NULL THEN NULL"]
    for i, b in enumerate(bounds):
        below, low = (cells[i - 1], bounds[i - 1]) if i else ("0", 0.0)
        out.append(f"WHEN {cells[i]} >= {rank} THEN {low}::DOUBLE + ({b}::DOUBLE - {low}::DOUBLE) * ({rank} - {below}) "
                   f"/ nullif(CAST({cells[i]} - {below} AS DOUBLE), 0)")
    return " ".join(out) + f" ELSE {bounds[-1]}::DOUBLE END"


def _counts(value: str, bounds: list[float]) -> str:
    return ", ".join(f"count(*) FILTER ({value} <= {b}) AS c{i}" for i, b in enumerate(bounds)) \
        + f", count({value}) AS c{len(bounds)}"


N = len(slo.LATENCY_BOUNDS)
CELLS = [f"c{i}" for i in range(N + 1)]


@query("latency_quantiles", "A11", R_ + f"""
SELECT endpoint, round({quantile_sql(CELLS, slo.LATENCY_BOUNDS, 0.5)}, 8) AS p50,
       round({quantile_sql(CELLS, slo.LATENCY_BOUNDS, 0.95)}, 8) AS p95,
       round({quantile_sql(CELLS, slo.LATENCY_BOUNDS, 0.99)}, 8) AS p99
FROM (SELECT endpoint, {_counts('duration_s', slo.LATENCY_BOUNDS)} FROM requests GROUP BY 1) h""")
def _(spark, root):
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return rounded(slo.histogram_quantiles(log(spark, root), "duration_s", slo.LATENCY_BOUNDS, probs, ["endpoint"]), 8)


@query("latency_quantiles_exact", "A11 A6", R_ + """
SELECT endpoint, round(quantile_cont(duration_s, 0.5), 8) AS p50, round(quantile_cont(duration_s, 0.95), 8) AS p95,
       round(quantile_cont(duration_s, 0.99), 8) AS p99 FROM requests GROUP BY 1""")
def _(spark, root):
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return rounded(exact_quantiles(log(spark, root), ["endpoint"], "duration_s", probs), 8)


@query("inference_p95", "A29", R_ + f"""
SELECT round({quantile_sql([f'c{i}' for i in range(len(slo.INFERENCE_BOUNDS) + 1)], slo.INFERENCE_BOUNDS, 0.95)}, 8) AS p95
FROM (SELECT {_counts('duration_s', slo.INFERENCE_BOUNDS)} FROM requests WHERE endpoint = 'ask') h""")
def _(spark, root):
    ask = log(spark, root).where("endpoint = 'ask'")
    return rounded(slo.histogram_quantiles(ask, "duration_s", slo.INFERENCE_BOUNDS, {"p95": 0.95}), 8)


@query("latency_compliance", "A12", R_ + """
SELECT endpoint, round(100.0 * count(*) FILTER (duration_s <= 1.0) / CAST(count(duration_s) AS DOUBLE), 10) AS compliance_pct
FROM requests GROUP BY 1""")
def _(spark, root):
    return rounded(slo.latency_compliance(log(spark, root), by=["endpoint"]))


@query("error_budget", "A13", R_ + """
SELECT failed, slow, total, round(100 * (1 - (100 * (1 - failed / total::DOUBLE)) / 99.9), 8) AS availability_rule_consumed,
       round(100 * (1 - (100 * (1 - slow / total::DOUBLE)) / 95.0), 8) AS latency_rule_consumed,
       round(failed / (total * (1 - 0.995)), 6) AS availability_budget_used,
       round(100 * (1 - failed / (43.2 * 60)::DOUBLE), 8) AS dashboard_remaining
FROM (SELECT count(*) FILTER (status_code LIKE '5%') AS failed, count(*) FILTER (duration_s > 1.0) AS slow,
             count(*) AS total FROM requests) x""")
def _(spark, root):
    return rounded(slo.error_budget(log(spark, root)), 8, availability_budget_used=6)


MINUTES = f"""per_minute AS (
  SELECT date_trunc('minute', ts) AS minute, count(*) AS total, count(*) FILTER (status_code LIKE '5%') AS failed,
         sum("precision") AS p_sum, count("precision") AS p_n, sum(gpu_pct) AS g_sum, count(gpu_pct) AS g_n,
         sum(citations) AS cit_sum, count(citations) AS cit_n,
         count(*) FILTER (rejected) AS rejected, count(*) FILTER (cache_hit) AS cache_hit,
         {_counts('duration_s', slo.LATENCY_BOUNDS)}
  FROM requests GROUP BY 1)"""


def _trailing(column: str, minutes: int) -> str:
    return (f"sum({column}) OVER (ORDER BY minute RANGE BETWEEN INTERVAL {minutes - 1} MINUTE PRECEDING AND CURRENT ROW)")


@query("burn_rate", "A14", with_(REQUESTS, MINUTES) + f"""
SELECT {ts('minute')} AS minute, round(b60, 6) AS burn_60m, round(b360, 6) AS burn_360m, round(b4320, 6) AS burn_4320m,
       CASE WHEN b60 > 14.0 THEN 'critical' WHEN b360 > 7.0 THEN 'high' WHEN b4320 > 2.0 THEN 'medium' ELSE 'none' END AS severity
FROM (SELECT minute, {', '.join(f"{_trailing('failed', m)} / {_trailing('total', m)}::DOUBLE / (1 - 0.995::DOUBLE) AS b{m}" for m in (60, 360, 4320))}
      FROM per_minute) x""")
def _(spark, root):
    return rounded(slo.burn_rate(log(spark, root)), 6)


@query("request_rates", "A15 ST5", R_ + f"""
SELECT endpoint, {ts('minute')} AS minute, round(sum(total) OVER w / 300.0, 10) AS request_rate,
       round(sum(failed) OVER w / 300.0, 10) AS error_rate
FROM (SELECT endpoint, date_trunc('minute', ts) AS minute, count(*) AS total,
             count(*) FILTER (status_code LIKE '5%') AS failed FROM requests GROUP BY 1, 2) x
WINDOW w AS (PARTITION BY endpoint ORDER BY minute RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW)""")
def _(spark, root):
    return rounded(slo.sliding_rates(log(spark, root), "endpoint"))


@query("sliding_p95", "A11 ST5", with_(REQUESTS, MINUTES) + f"""
SELECT {ts('minute')} AS minute, round({quantile_sql(CELLS, slo.LATENCY_BOUNDS, 0.95)}, 8) AS quantile_s
FROM (SELECT minute, {', '.join(f"{_trailing(c, 10)} AS {c}" for c in CELLS)} FROM per_minute) x""")
def _(spark, root):
    return rounded(slo.sliding_latency(log(spark, root), 10), 8)


@query("precision_average_30d", "A16", R_ + f"""
SELECT {day('date')} AS date, round(sum(s) OVER w / sum(n) OVER w, 10) AS gauge_avg
FROM (SELECT CAST(ts AS DATE) AS date, sum("precision") AS s, count("precision") AS n FROM requests GROUP BY 1) x
WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""")
def _(spark, root):
    return rounded(slo.gauge_average(log(spark, root), "precision", 30))


@query("precision_budget", "A13 A16 K5", R_ + f"""
, daily AS (SELECT CAST(ts AS DATE) AS date, sum("precision") AS s, count("precision") AS n FROM requests GROUP BY 1),
trail AS (SELECT date, sum(s) OVER w / sum(n) OVER w AS p FROM daily
             WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)),
used AS (SELECT date, p, 100 * (1 - 100 * p / 90.0::DOUBLE) AS u FROM trail)
SELECT {day('date')} AS date, round(p, 10) AS precision_avg, round(u, 8) AS budget_used, round(100 - u, 8) AS budget_left,
       CASE WHEN 100 - u >= 50 THEN 'green' WHEN 100 - u >= 20 THEN 'yellow' ELSE 'red' END AS status FROM used""")
def _(spark, root):
    return rounded(slo.precision_budget(log(spark, root)), budget_used=8, budget_left=8)


@query("cache_average_7d", "A16", R_ + f"""
, daily AS (SELECT CAST(ts AS DATE) AS date, count(*) FILTER (cache_hit) AS s, count(*) AS n FROM requests GROUP BY 1)
SELECT {day('date')} AS date, round(sum(s) OVER w / CAST(sum(n) OVER w AS DOUBLE), 10) AS hit_ratio,
       sum(s) OVER w / CAST(sum(n) OVER w AS DOUBLE) >= 0.6 AS meets_target FROM daily
WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def _(spark, root):
    return rounded(slo.cache_average(log(spark, root)))


@query("average_citations", "A17", with_(REQUESTS, MINUTES) + f"""
SELECT {ts('minute')} AS minute, round({_trailing('cit_sum', 5)} / {_trailing('cit_n', 5)}::DOUBLE, 10) AS avg_citations
FROM per_minute""")
def _(spark, root):
    return rounded(slo.average_citations(log(spark, root)))


@query("error_counts", "A28", R_ + """
SELECT endpoint, status_code, count(*) AS errors FROM requests WHERE status_code LIKE '5%' GROUP BY 1, 2""")
def _(spark, root):
    return slo.error_counts(log(spark, root), ["endpoint", "status_code"])


@query("retrieval_slis", "A22", R_ + """
SELECT round(count(*) FILTER (status_code NOT LIKE '5%') / count(*)::DOUBLE, 10) AS success_ratio,
       round(count(*) FILTER (citations = 0) / count(*)::DOUBLE, 10) AS empty_ratio,
       round(count(*) FILTER (citations > 0) / count(*)::DOUBLE, 10) AS citation_ratio FROM requests""")
def _(spark, root):
    return rounded(slo.retrieval_slis(log(spark, root)))


@query("batch_run_slis", "A23", """
SELECT dag, count(*) AS runs, round(count(*) FILTER (state = 'success') / count(*)::DOUBLE, 10) AS success_ratio,
       round(quantile_cont(duration_s, 0.95), 6) AS p95_duration_s,
       round(any_value(age), 10) AS freshness_hours, any_value(age) < 24 AS fresh, any_value(age) > 2 AS stuck
FROM (SELECT *, (epoch_us(TIMESTAMP '2001-08-01 12:00:00')
                 - epoch_us(max(CASE WHEN state = 'success' THEN finished_at END) OVER (PARTITION BY dag))) / 3.6e9 AS age
      FROM (SELECT o_orderpriority AS dag, CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS state,
                   o_totalprice / 1024.0 AS duration_s, o_orderdate AS finished_at FROM orders) r) x
GROUP BY 1""")
def _(spark, root):
    # Orders stand for batch runs: priority as job, status as outcome.
    runs = tables.table(spark, root, "orders").select(
        F.col("o_orderpriority").alias("dag"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("state"),
        (F.col("o_totalprice") / 1024.0).alias("duration_s"),
        F.col("o_orderdate").cast("timestamp").alias("finished_at"))
    return rounded(slo.run_slis(runs, "2001-08-01 12:00:00"), p95_duration_s=6)


@query("ingestion_throughput", "A24", R_ + f"""
SELECT {ts("time_bucket(INTERVAL 5 MINUTE, ts)")} AS window_start, count(*) AS messages,
       count(*) FILTER (rejected) AS rejected, round(count(*) / 300.0, 10) AS messages_per_s,
       round(count(*) FILTER (rejected) / count(*)::DOUBLE, 10) AS rejected_ratio FROM requests GROUP BY 1""")
def _(spark, root):
    return rounded(slo.throughput(log(spark, root), "ts", F.col("rejected")))


@query("budget_trend", "K6", R_ + f"""
, d AS (SELECT CAST(ts AS DATE) AS date, count(*) AS total, count(*) FILTER (status_code LIKE '5%') AS failed
        FROM requests WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1)
SELECT {day('date')} AS date,
       round(100 * (1 - sum(failed) OVER (ORDER BY date) / (sum(total) OVER () * (1 - 0.999::DOUBLE))), 4) AS budget_remaining_pct,
       round(100 * (1 - sum(failed) OVER w / (sum(total) OVER w)::DOUBLE), 10) AS availability_7d_pct
FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(spark, root):
    return rounded(slo.budget_trend(log(spark, root), "2024-01-01"), budget_remaining_pct=4)


METRICS_SQL = MINUTES + f""",
dense AS (SELECT unnest(generate_series(min(minute), max(minute), INTERVAL 1 MINUTE)) AS minute FROM per_minute),
wide AS (
  SELECT d.minute, {_trailing('coalesce(total, 0)', 5)} AS t5, {_trailing('coalesce(failed, 0)', 5)} AS f5,
         {_trailing('coalesce(total, 0)', 10)} AS t10, {_trailing('coalesce(rejected, 0)', 10)} AS r10,
         {_trailing('coalesce(total, 0)', 43200)} AS t30, {_trailing('coalesce(failed, 0)', 43200)} AS f30,
         {_trailing('coalesce(c8, 0)', 43200)} AS w30, {_trailing('coalesce(cache_hit, 0)', 43200)} AS h30,
         last_value(p_sum / p_n IGNORE NULLS) OVER (ORDER BY minute) AS prec,
         last_value(g_sum / g_n IGNORE NULLS) OVER (ORDER BY minute) AS gpu,
         {', '.join(f"{_trailing(f'coalesce({c}, 0)', 5)} AS a{c}, {_trailing(f'coalesce({c}, 0)', 10)} AS b{c}" for c in CELLS)}
  FROM dense d LEFT JOIN per_minute p USING (minute)),
metrics AS (
  SELECT minute, t5::DOUBLE AS requests_5m, 100.0 * f5 / nullif(t5::DOUBLE, 0) AS error_pct_5m,
         {quantile_sql(['a' + c for c in CELLS], slo.LATENCY_BOUNDS, 0.95)} AS p95_5m,
         {quantile_sql(['b' + c for c in CELLS], slo.LATENCY_BOUNDS, 0.95)} AS p95_10m,
         prec AS "precision", gpu AS gpu_pct, h30 / nullif(t30::DOUBLE, 0) AS cache_hit_ratio,
         100.0 * r10 / nullif(t10::DOUBLE, 0) AS rejected_pct_10m,
         100 * (1 - (100 * (1 - f30 / nullif(t30::DOUBLE, 0))) / 99.9) AS availability_consumed,
         100 * (1 - (100 * (w30 / nullif(t30::DOUBLE, 0))) / 95.0) AS latency_consumed
  FROM wide)"""
METRIC_NAMES = ["requests_5m", "error_pct_5m", "p95_5m", "p95_10m", "precision", "gpu_pct", "cache_hit_ratio",
                "rejected_pct_10m", "availability_consumed", "latency_consumed"]


@query("alert_metrics", "A9 A11 A12 A13 A16", with_(REQUESTS, METRICS_SQL) + f"""
SELECT {ts('minute')} AS minute, {', '.join(f'round("{m}", 7) AS "{m}"' for m in METRIC_NAMES)} FROM metrics""")
def _(spark, root):
    return rounded(alerts.alert_metrics(log(spark, root)), 7)


def alert_sql() -> str:
    rules = []
    for r in alerts.DEFAULT_ALERTS:
        op = "=" if r.comparator == "==" else r.comparator
        cond = " OR ".join(f'"{m}" {op} {r.threshold}' for m in r.metrics)
        rules.append(f"SELECT '{r.name}' AS alert, '{r.severity}' AS severity, {r.hold_minutes} AS hold, minute FROM metrics WHERE {cond}")
    return f""", firing AS ({' UNION ALL '.join(rules)}),
runs AS (SELECT alert, severity, hold, min(minute) AS a, max(minute) AS b FROM (
  SELECT *, epoch_us(minute) // 60000000 - row_number() OVER (PARTITION BY alert ORDER BY minute) AS g FROM firing) x
  GROUP BY alert, severity, hold, g)
SELECT alert, severity, {ts('a')} AS started_at, {ts('a + to_minutes(hold)')} AS fired_at, {ts('b')} AS last_true_at
FROM runs WHERE b >= a + to_minutes(hold)"""


@query("alerts", "K4 W8", with_(REQUESTS, METRICS_SQL) + alert_sql())
def _(spark, root):
    return alerts.evaluate_alerts(alerts.alert_metrics(log(spark, root)))


REPLAY = """, walk(cache_key, ts) AS (
  SELECT cache_key, min(ts) FROM requests GROUP BY 1
  UNION ALL
  SELECT w.cache_key, min(r.ts) FROM walk w JOIN requests r ON r.cache_key = w.cache_key AND r.ts > w.ts + INTERVAL 1 HOUR
  GROUP BY w.cache_key),
replayed AS (
  SELECT r.request_id, r.cache_key, r.endpoint, r.ts, NOT (w.ts IS NOT NULL AND r.request_id = min(r.request_id) OVER (PARTITION BY r.cache_key, r.ts)) AS hit
  FROM requests r LEFT JOIN walk w ON w.cache_key = r.cache_key AND w.ts = r.ts)
"""
REPLAY_ = R_.replace("WITH ", "WITH RECURSIVE ", 1) + REPLAY
HOT_ = R_.replace("WITH ", "WITH RECURSIVE ", 1).replace("requests AS (", "requests0 AS (", 1) \
    + ", requests AS (SELECT * REPLACE (endpoint AS cache_key) FROM requests0)" + REPLAY


@query("cache_keys", "X7", R_ + """
SELECT sha256(endpoint || ':acme:' || cache_key) AS key, count(*) AS requests FROM requests GROUP BY 1""")
def _(spark, root):
    key = cache_key(F.col("endpoint"), F.lit("acme"), F.col("cache_key"))
    return log(spark, root).groupBy(key.alias("key")).agg(F.count("*").alias("requests"))


@query("cache_replay", "R14", REPLAY_ + "SELECT request_id, cache_key, hit FROM replayed")
def _(spark, root):
    return replay.replay_cache(log(spark, root)).select("request_id", "cache_key", "hit")


@query("cache_hit_ratio_hot", "R14 A16", HOT_ + """
SELECT endpoint, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses,
       round(count(*) FILTER (hit) / count(*)::DOUBLE, 10) AS hit_ratio FROM replayed GROUP BY 1""")
def _(spark, root):
    # One key per endpoint: few keys with very many requests each.
    few = log(spark, root).withColumn("cache_key", F.col("endpoint"))
    return rounded(replay.hit_ratio(replay.replay_cache(few), ["endpoint"]))


@query("cache_stats", "R14", REPLAY_ + """
SELECT count(*) AS total_entries, count(*) FILTER (TIMESTAMP '2024-01-31' - stored > INTERVAL 1 HOUR) AS expired_entries,
       count(*) FILTER (TIMESTAMP '2024-01-31' - stored <= INTERVAL 1 HOUR) AS active_entries
FROM (SELECT cache_key, max(ts) AS stored FROM replayed WHERE NOT hit GROUP BY 1) x""")
def _(spark, root):
    return replay.cache_stats(replay.replay_cache(log(spark, root)), "2024-01-31 00:00:00")


def _matches(column: str, patterns) -> str:
    cells = ", ".join("CASE WHEN regexp_matches({}, '{}') THEN '{}' END".format(
        column, p.replace("'", "''"), label.replace("'", "''")) for label, p in patterns)
    return f"concat_ws('|', {cells})"


SCREEN = f"""screened AS (
  SELECT *, {_matches('lower(text)', [(p, p) for p in guardrails.INJECTION_PATTERNS])} AS injection_patterns,
         {_matches('text', list(guardrails.PII_PATTERNS.items()))} AS pii_types FROM source_texts)"""
SCREENED = """injection_patterns, pii_types, injection_patterns = '' AND pii_types = '' AS safe,
       concat_ws('|', CASE WHEN injection_patterns <> '' THEN 'Potential prompt injection detected' END,
         CASE WHEN pii_types <> '' THEN 'PII detected in input' END) AS warnings"""
SCREEN_COLUMNS = ["injection_patterns", "pii_types", "safe", "warnings"]


@query("screened_turns", "F19 F20 F21 X8 X9", with_("source_texts AS (SELECT * FROM conversations)", SCREEN) + f"""
SELECT conv_id, turn, {SCREENED} FROM screened""")
def _(spark, root):
    return guardrails.screen(tables.table(spark, root, "conversations")).select("conv_id", "turn", *SCREEN_COLUMNS)


@query("screened_documents", "F19 F20 F21", with_("source_texts AS (SELECT * FROM documents)", SCREEN) + f"""
SELECT doc_id, {SCREENED} FROM screened""")
def _(spark, root):
    return guardrails.screen(tables.table(spark, root, "documents")).select("doc_id", *SCREEN_COLUMNS)


@query("rejection_rate", "A18", with_("source_texts AS (SELECT * FROM documents)", SCREEN) + """
SELECT source, count(*) AS total, count(*) FILTER (injection_patterns <> '') AS prompt_injection,
       count(*) FILTER (pii_types <> '') AS pii, count(*) FILTER (injection_patterns <> '' OR pii_types <> '') AS rejected,
       round(100.0 * count(*) FILTER (injection_patterns <> '' OR pii_types <> '') / count(*), 10) AS rejected_pct,
       100.0 * count(*) FILTER (injection_patterns <> '' OR pii_types <> '') / count(*) > 10 AS alert
FROM screened GROUP BY 1""")
def _(spark, root):
    screened = guardrails.screen(tables.table(spark, root, "documents"))
    return rounded(guardrails.rejections(screened, ["source"]))


def _scrub_sql(column: str) -> str:
    out = column
    for kind, p in guardrails.PII_PATTERNS.items():
        out = f"regexp_replace({out}, '{p}', '[{kind.upper()}]', 'g')"
    return out


@query("scrubbed_documents", "F22", f"""
SELECT doc_id, sha256({_scrub_sql('text')}) AS scrubbed_hash, {_scrub_sql('text')} <> text AS changed FROM documents""")
def _(spark, root):
    d = tables.table(spark, root, "documents").withColumn("scrubbed", guardrails.scrub(F.col("text")))
    return d.select("doc_id", F.sha2("scrubbed", 256).alias("scrubbed_hash"),
                    (F.col("scrubbed") != F.col("text")).alias("changed"))


@query("token_totals", "A29", r"""
SELECT CASE WHEN role = 'assistant' THEN 'completion' ELSE 'prompt' END AS token_type,
       CAST(sum(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) AS BIGINT) AS tokens
FROM conversations GROUP BY 1""")
def _(spark, root):
    c = tables.table(spark, root, "conversations")
    kind = F.when(F.col("role") == "assistant", "completion").otherwise("prompt")
    return c.groupBy(kind.alias("token_type")).agg(F.sum(F.size(tokens(F.col("text")))).alias("tokens"))


@query("failed_by_hour", "A28 X1", R_ + f"""
SELECT {ts("date_trunc('hour', ts)")} AS hour_start, endpoint, count(*) AS errors FROM requests
WHERE status_code LIKE '5%' GROUP BY 1, 2""")
def _(spark, root):
    bad = log(spark, root).where(is_server_error(F.col("status_code")))
    return bad.groupBy(F.date_trunc("hour", "ts").alias("hour_start"), "endpoint").agg(F.count("*").alias("errors"))
