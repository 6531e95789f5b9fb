"""Alerts of a running request stream: pending, firing and resolved, as the batch rules of ``operators.alerts`` have them.

Requests become one row per closed minute (a built-in aggregate, combined before the shuffle), whatever their number.
A state machine walks over the minutes behind the watermark, keeps the trailing windows of the rules, and tells each
change of an alert once. Minutes without requests count, so silence is noticed by timers.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.alerts import DEFAULT_ALERTS, AlertRule
from millrace.operators.slo import (
    AVAILABILITY_TARGET_PCT, LATENCY_BOUNDS, LATENCY_LIMIT_S, LATENCY_TARGET_PCT, minute_sums)

LATE = "10 minutes"
MONTH = 30 * 1440  # minutes of the longest window
STRETCH = 50_000  # minutes worked on at once, which bounds memory after a long silence
OUTPUT = "service string, alert string, severity string, state string, started_at timestamp, at timestamp"

GAUGES = ("precision", "gpu_pct")
FLAGS = ("rejected", "cache_hit")
CELLS = [f"latency_{i}" for i in range(len(LATENCY_BOUNDS) + 1)]
COUNTS = ["total", "failed", *FLAGS, *CELLS]
WITHIN = CELLS[LATENCY_BOUNDS.index(LATENCY_LIMIT_S)]


def minutes(requests: DataFrame, late: str = LATE, service: str = "service") -> DataFrame:
    """Closed minutes (service, minute_us, counts, gauge sums) of a request stream; gauges and flags may be absent.

    Requests behind the watermark are not counted; take them out with ``jobs.split_late`` where they matter.
    """
    named = requests if service in requests.columns else requests.withColumn(service, F.lit("all"))
    sums = minute_sums(named)
    closed = named.withWatermark("ts", late).groupBy(F.window("ts", "1 minute").alias("w"), service).agg(*sums)
    have = set(closed.columns)
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    return closed.select(
        F.col(service).alias("service"), F.unix_micros("w.start").alias("minute_us"), "total", "failed",
        *[(F.col(c) if c in have else zero).alias(c) for c in FLAGS],
        *[F.get("latency", F.lit(i)).alias(c) for i, c in enumerate(CELLS)],
        *[(F.coalesce(f"{g}_sum", none) if f"{g}_sum" in have else none).alias(f"{g}_sum") for g in GAUGES],
        *[(F.col(f"{g}_n") if f"{g}_n" in have else zero).alias(f"{g}_n") for g in GAUGES])


def trailing(values: np.ndarray, width: int, keep: int) -> np.ndarray:
    """Sums over ``width`` minutes up to each of the last ``keep`` rows."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    end = np.arange(len(values) - keep, len(values)) + 1
    return total[end] - total[np.maximum(end - width, 0)]


def quantile(cumulative: np.ndarray, q: float) -> np.ndarray:
    """``slo.histogram_quantile`` of rows of cumulative buckets."""
    edges = np.array(LATENCY_BOUNDS)
    n, rows = len(edges), np.arange(len(cumulative))
    total = cumulative[:, -1].astype(float)
    rank = total * q
    at = (cumulative >= rank[:, None]).argmax(axis=1)
    inner = np.minimum(at, n - 1)
    upper, lower = edges[inner], np.where(at == 0, 0.0, edges[np.maximum(inner - 1, 0)])
    below = np.where(at == 0, 0, cumulative[rows, np.maximum(at - 1, 0)]).astype(float)
    inside = cumulative[rows, at] - below
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.where(inside > 0, lower + (upper - lower) * (rank - below) / inside, lower)
    return np.where(total > 0, np.where(at >= n, edges[-1], value), np.nan)


def filled(values: np.ndarray, before: float) -> np.ndarray:
    """Each missing value replaced by the last known one."""
    own = np.concatenate([[before], values])
    known = np.where(np.isnan(own), 0, np.arange(len(own)))
    return own[np.maximum.accumulate(known)][1:]


class Alerting(StatefulProcessor):
    """Walks over the closed minutes of one service."""

    def __init__(self, rules: tuple[AlertRule, ...] = DEFAULT_ALERTS):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "told string, counts binary, ahead binary")

    def close(self) -> None:
        pass

    def _load(self) -> tuple[dict, pd.DataFrame, pd.DataFrame]:
        if not self.state.exists():
            return {}, pd.DataFrame(columns=COUNTS, dtype=np.int64), pd.DataFrame()
        told, counts, ahead = self.state.get()
        table = lambda data: pd.read_parquet(io.BytesIO(bytes(data)))
        return json.loads(told), table(counts), table(ahead)

    def _keep(self, told: dict, counts: pd.DataFrame, ahead: pd.DataFrame) -> None:
        def data(frame):
            out = io.BytesIO()
            frame.to_parquet(out, index=False)
            return out.getvalue()

        self.state.update((json.dumps(told), data(counts), data(ahead)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told, counts, ahead = self._load()
        parts = [p for p in (ahead, *rows) if len(p)]
        yield from self._advance(key[0], told, counts, pd.concat(parts, ignore_index=True) if parts else ahead, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key[0], *self._load(), timerValues)

    def _advance(self, service, told, counts, ahead, timers) -> Iterator[pd.DataFrame]:
        end = timers.getCurrentWatermarkInMs() // 60_000  # the first minute that is still open
        if "next" not in told and len(ahead):
            told["next"] = int(ahead["minute_us"].min() // 60_000_000)
        events: list[tuple] = []
        while told.get("next", end) < end:
            stop = min(end, told["next"] + STRETCH)
            number = ahead["minute_us"] // 60_000_000 if len(ahead) else pd.Series(dtype=np.int64)
            counts = self._stretch(service, told, counts, ahead[number < stop] if len(ahead) else ahead, stop, events)
            ahead = ahead[number >= stop] if len(ahead) else ahead
        self._keep(told, counts, ahead)
        # The watermark must close the next minute.
        self.handle.registerTimer((max(end, told.get("next", end)) + 1) * 60_000)
        if events:
            frame = pd.DataFrame(events, columns=["service", "alert", "severity", "state", "started_at", "at"])
            for c in ("started_at", "at"):
                frame[c] = pd.to_datetime(frame[c] * 60, unit="s")
            yield frame

    def _stretch(self, service, told, counts, rows, stop, events) -> pd.DataFrame:
        """Judges the minutes up to ``stop`` and gives the counts that later windows need."""
        first = told["next"]
        n = stop - first
        new = {c: np.zeros(n, dtype=np.int64) for c in COUNTS}
        gauges = {g: np.full(n, np.nan) for g in GAUGES}
        if len(rows):
            # Minutes from before the first one that was judged have come too late.
            rows = rows[rows["minute_us"] // 60_000_000 >= first]
            at = (rows["minute_us"] // 60_000_000 - first).to_numpy(dtype=np.int64)
            for c in COUNTS:
                np.add.at(new[c], at, rows[c].to_numpy(dtype=np.int64))
            for g in GAUGES:
                size = rows[f"{g}_n"].to_numpy(dtype=float)
                gauges[g][at] = np.divide(rows[f"{g}_sum"].to_numpy(dtype=float), size, out=np.full(len(at), np.nan), where=size > 0)
        whole = pd.concat([counts, pd.DataFrame(new)], ignore_index=True) if len(counts) else pd.DataFrame(new)
        metrics = self._metrics(whole, gauges, told, n)
        for rule in self.rules:
            self._follow(service, rule, metrics, told, first, events)
        told["next"] = stop
        return whole.iloc[-(MONTH - 1):]

    @staticmethod
    def _metrics(whole: pd.DataFrame, gauges: dict, told: dict, n: int) -> dict[str, np.ndarray]:
        sums = lambda name, width: trailing(whole[name].to_numpy(dtype=np.int64), width, n).astype(float)
        cells = whole[CELLS].to_numpy(dtype=np.int64)
        out = {}
        for g in GAUGES:
            out[g] = filled(gauges[g], told.get(g) if told.get(g) is not None else np.nan)
            told[g] = None if np.isnan(out[g][-1]) else float(out[g][-1])
        with np.errstate(invalid="ignore", divide="ignore"):
            share = lambda a, b: np.where(b > 0, a / b, np.nan)
            total = sums("total", MONTH)
            consumed = lambda pct, target: 100.0 * (1.0 - pct / target)
            return out | {
                "requests_5m": sums("total", 5), "error_pct_5m": 100.0 * share(sums("failed", 5), sums("total", 5)),
                "p95_5m": quantile(trailing(cells, 5, n), 0.95), "p95_10m": quantile(trailing(cells, 10, n), 0.95),
                "cache_hit_ratio": share(sums("cache_hit", MONTH), total),
                "rejected_pct_10m": 100.0 * share(sums("rejected", 10), sums("total", 10)),
                "availability_consumed": consumed(100.0 * (1.0 - share(sums("failed", MONTH), total)), AVAILABILITY_TARGET_PCT),
                "latency_consumed": consumed(100.0 * share(sums(WITHIN, MONTH), total), LATENCY_TARGET_PCT)}

    @staticmethod
    def _follow(service, rule: AlertRule, metrics, told, first, events) -> None:
        """Changes of one alert over the minutes; a run of true minutes may have begun in an earlier stretch."""
        true = np.zeros(len(metrics["requests_5m"]), dtype=bool)
        for name in rule.metrics:
            v = metrics[name]
            true |= v > rule.threshold if rule.comparator == ">" else v < rule.threshold if rule.comparator == "<" else v == rule.threshold
        open_runs = told.setdefault("open", {})
        edge = np.flatnonzero(np.diff(np.concatenate([[False], true, [False]]).astype(np.int8)))
        runs = [(first + int(a), first + int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]
        carried = open_runs.pop(rule.name, None)
        last = first + len(true) - 1
        tell = lambda state, started, at: events.append((service, rule.name, rule.severity, state, started, at))
        if carried is not None:
            if runs and runs[0][0] == first:
                runs[0] = (carried, runs[0][1])
            elif carried + rule.hold_minutes <= first - 1:
                tell("resolved", carried, first - 1)
        for started, until in runs:
            fires = started + rule.hold_minutes
            if started >= first:
                tell("pending", started, started)
            if max(first, started) <= fires <= until:
                tell("firing", started, fires)
            if until == last:
                open_runs[rule.name] = started
            elif fires <= until:
                tell("resolved", started, until)


def alert_changes(requests: DataFrame, rules: tuple[AlertRule, ...] = DEFAULT_ALERTS, late: str = LATE) -> DataFrame:
    """Rows (service, alert, severity, state, started_at, at) of a stream of requests.

    ``pending``: the condition began at ``at``. ``firing``: it has held for the rule's time, as of ``at``. ``resolved``:
    a firing alert's last true minute was ``at``. What a batch over the closed minutes gives as one alert row is a
    firing row here, and a resolved one once it is over. Run with ``late.keyed_state``.
    """
    return minutes(requests, late).groupBy("service").transformWithStateInPandas(Alerting(rules), OUTPUT, "append", "EventTime")
