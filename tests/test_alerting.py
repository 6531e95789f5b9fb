"""Alerts of a stream against the same rules on a batch."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import alerts, slo
from millrace.streaming import alerting, jobs, late
from tests.test_late import stream

LOG = ("ts timestamp, status_code string, duration_s double, precision double, gpu_pct double, rejected boolean, "
       "cache_hit boolean, citations int")


def log_rows(n=900, seed=3):
    """Requests of two days with a bad hour, a silent hour, and gauges that are sometimes missing."""
    rng = np.random.default_rng(seed)
    out = []
    for at in np.sort(rng.uniform(0, 2880, n)):
        if 300 < at < 380:
            continue
        bad = 1000 < at < 1100
        out.append((datetime(2024, 1, 1) + timedelta(minutes=float(at)), "500" if rng.random() < (0.5 if bad else 0.02) else "200",
                    float(rng.gamma(2, 1.2 if bad else 0.2)), None if rng.random() < 0.3 else float(rng.uniform(0.7, 1.0)),
                    float(rng.uniform(80, 100)), bool(rng.random() < 0.1), bool(rng.random() < 0.5), 2))
    return out


def test_stream_alerts_equal_batch_alerts_whatever_the_batches(spark):
    rows = log_rows()
    mark = max(r[0] for r in rows) - timedelta(minutes=10)
    stop = mark.replace(second=0, microsecond=0)
    closed = spark.createDataFrame([r for r in rows if r[0] < stop], LOG)
    metrics = alerts.alert_metrics(closed, start=str(min(r[0] for r in rows).replace(second=0, microsecond=0)),
                                   end=str(stop - timedelta(minutes=1)))
    want = {(r.alert, r.severity, r.started_at, r.fired_at, r.last_true_at) for r in alerts.evaluate_alerts(metrics).collect()}
    assert len({w[0] for w in want}) >= 5
    for cuts in ([], [150, 151, 500, 700]):
        batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        with late.keyed_state(spark):
            out = jobs.run_to_files(alerting.alert_changes(stream(spark, batches, LOG)), "alert-test").collect()
        fired = {(r.alert, r.severity, r.started_at, r.at) for r in out if r.state == "firing"}
        assert fired == {w[:4] for w in want}
        ended = {(r.alert, r.started_at, r.at) for r in out if r.state == "resolved"}
        assert ended == {(a, s, e) for a, _, s, _, e in want if e < stop - timedelta(minutes=1)}
        pending = [(r.alert, r.started_at) for r in out if r.state == "pending"]
        assert len(pending) == len(set(pending)) and {(a, s) for a, _, s, _ in fired} <= set(pending)


def test_quantiles_of_rows_equal_the_column_form(spark):
    rng = np.random.default_rng(1)
    cells = np.cumsum(rng.integers(0, 3, (200, len(slo.LATENCY_BOUNDS) + 1)) * (rng.random((200, 1)) < 0.9), axis=1)
    df = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(cells)], "i int, c array<long>")
    want = [r.q for r in df.select("i", slo.histogram_quantile(F.col("c"), slo.LATENCY_BOUNDS, 0.95).alias("q")).orderBy("i").collect()]
    got = alerting.quantile(cells, 0.95)
    assert [None if np.isnan(v) else pytest.approx(v, abs=1e-12) for v in got] == want


def test_trailing_sums_and_gauges():
    v = np.arange(1, 8)
    assert alerting.trailing(v, 3, 4).tolist() == [9, 12, 15, 18]
    assert alerting.trailing(v, 100, 2).tolist() == [21, 28]
    nan = np.nan
    assert np.array_equal(alerting.filled(np.array([nan, 2, nan, 3, nan]), 1.0), [1, 2, 2, 3, 3])
    assert np.array_equal(alerting.filled(np.array([nan, 2.0]), nan), [nan, 2], equal_nan=True)


def test_services_are_judged_apart(spark):
    rows = [(*r, "a" if i % 2 else "b") for i, r in enumerate(log_rows(400))]
    with late.keyed_state(spark):
        out = jobs.run_to_files(alerting.alert_changes(stream(spark, [rows], LOG + ", service string")), "service-test").collect()
    assert {r.service for r in out} == {"a", "b"}
