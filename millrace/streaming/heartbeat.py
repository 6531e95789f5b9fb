"""Stateful heartbeat tracker: a device goes offline after silence and online on return."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "device_id string, status string, changed_at timestamp, last_seen_at timestamp"
STATE = "last_seen_us long, online boolean"


def _track(offline_after_s: int):
    limit = offline_after_s * 1_000_000

    def rows(changes: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(changes, columns=["device_id", "status", "changed_at", "last_seen_at"])
        for c in ("changed_at", "last_seen_at"):
            frame[c] = pd.to_datetime(frame[c], unit="us")
        return frame

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        device = key[0]
        changes = []
        if state.hasTimedOut:
            last, online = state.get
            if online:
                changes.append((device, "offline", last + limit, last))
            state.update((last, False))
            yield rows(changes)
            return
        last, online = state.get if state.exists else (None, False)
        # Batches of one device arrive in pieces; only their times are held, sorted once.
        seen = sorted(t for part in parts for t in part["seen_us"].tolist())
        for t in seen:
            if last is not None and t <= last:
                continue
            if last is not None and online and t - last > limit:
                changes.append((device, "offline", last + limit, last))
                online = False
            if not online:
                changes.append((device, "online", t, t))
                online = True
            last = t
        state.update((last, online))
        due = (last + limit) // 1000 + 1
        watermark = state.getCurrentWatermarkMs()
        if online and due > watermark:
            state.setTimeoutTimestamp(due)
        elif online:
            changes.append((device, "offline", last + limit, last))
            state.update((last, False))
        yield rows(changes)

    return update


def thinned(heartbeats: DataFrame, every_s: int = 60) -> DataFrame:
    """First and last heartbeat per device and interval within each Arrow batch, without a shuffle.

    Intervals are shorter than the silence that counts as offline, so no status change can hide
    between the two; a backlog of a busy device reaches its state as two times per interval.
    """
    step = every_s * 1_000_000

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell = part["seen_us"] // step
            grouped = part.groupby(["device_id", cell])["seen_us"]
            keep = part["seen_us"].eq(grouped.transform("min")) | part["seen_us"].eq(grouped.transform("max"))
            yield part[keep]

    return heartbeats.mapInPandas(ends, heartbeats.schema)


def track(heartbeats: DataFrame, offline_after_s: int = 300, late: str = "1 minute") -> DataFrame:
    """Status changes of every device from a stream of heartbeats.

    ``heartbeats`` needs ``device_id`` and ``timestamp``.  Offline is reported when the watermark passes
    the last heartbeat by the limit, at the instant the limit was reached.
    """
    stamped = thinned(heartbeats.select("device_id", "timestamp", F.unix_micros("timestamp").alias("seen_us")))
    return (stamped.withWatermark("timestamp", late).groupBy("device_id").applyInPandasWithState(
        _track(offline_after_s), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout))


def changes_batch(heartbeats: DataFrame, asof: str, offline_after_s: int = 300) -> DataFrame:
    """The same status changes from stored heartbeats up to an as-of instant."""
    from millrace.functions.timewise import next_in_time

    limit = F.make_dt_interval(secs=F.lit(offline_after_s))
    times = heartbeats.select("device_id", "timestamp").distinct()
    nexts = next_in_time(times, ["device_id"])
    first = times.groupBy("device_id").agg(F.min("timestamp").alias("timestamp"))
    silent = nexts.where(F.coalesce("next_timestamp", F.lit(asof).cast("timestamp")) > F.col("timestamp") + limit)
    offline = silent.select("device_id", F.lit("offline").alias("status"),
                            (F.col("timestamp") + limit).alias("changed_at"), F.col("timestamp").alias("last_seen_at"))
    back = silent.where("next_timestamp IS NOT NULL").select(F.col("device_id"), F.col("next_timestamp").alias("timestamp"))
    online = first.unionByName(back).select(
        "device_id", F.lit("online").alias("status"), F.col("timestamp").alias("changed_at"),
        F.col("timestamp").alias("last_seen_at"))
    return offline.unionByName(online)
