"""Stateful steps that lose nothing: what is behind the watermark leaves as tagged rows beside the results.

Built-in stateful operators drop rows behind their watermark. The processors here get every row, fold those in time
into their state, and emit a late row as it came, so that results and late rows together account for the whole input.
State is kept per key and day (sessions: per key), as text, and is cleared by event-time timers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.columns import device_temperature

LATE = "10 minutes"
HOUR = 3600 * 1_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Arbitrary state needs the RocksDB store; a query keeps the store that it was started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def watched(stream: DataFrame, event_time: str, late: str) -> DataFrame:
    """The stream with a watermark on ``event_time`` that no step filters by.

    The column is made anew behind the watermark, so rows behind it go on; ``event_us`` holds it in microseconds. (Names
    that begin with an underscore do not reach Python state.)
    """
    marked = stream.withWatermark(event_time, late).withColumn("event_us", F.unix_micros(event_time))
    return marked.withColumn(event_time, F.timestamp_micros("event_us"))


class Closing(StatefulProcessor):
    """Folds rows in time into a JSON state and emits what the watermark has closed; late rows leave as they came.

    Subclasses say which rows are late, fold frames, and close. The result has all input columns (null in results)
    and the result columns (null in late rows).
    """

    def __init__(self, columns: list[str], results: list[str]):
        self.columns, self.results = columns, results

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", "held string")

    def close(self) -> None:
        pass

    def late(self, frame: pd.DataFrame, watermark: int) -> pd.Series:
        raise NotImplementedError

    def fold(self, state: dict, frame: pd.DataFrame) -> list[dict]:
        """Takes rows into the state; may give results at once."""
        raise NotImplementedError

    def finish(self, state: dict, watermark: int) -> list[dict]:
        """Takes closed parts out of the state and gives their results."""
        raise NotImplementedError

    def due(self, state: dict) -> list[int]:
        """Instants at which something closes."""
        raise NotImplementedError

    def _state(self) -> dict:
        return json.loads(self.held.get()[0]) if self.held.exists() else {}

    def _keep(self, state: dict) -> None:
        if state:
            self.held.update((json.dumps(state),))
        elif self.held.exists():
            self.held.clear()

    def _frame(self, rows: list[dict], key: tuple, keys: list[str]) -> pd.DataFrame:
        out = pd.DataFrame([dict(zip(keys, key)) | r for r in rows], columns=[*self.columns, *self.results, "late"], dtype=object)
        out["late"] = False
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        state, results, before = self._state(), [], set()
        before = set(self.due(state))
        for frame in rows:
            behind = self.late(frame, watermark)
            if behind.any():
                out = frame[behind].reindex(columns=[*self.columns, *self.results])
                yield out.assign(late=True)
            if not behind.all():
                results += self.fold(state, frame[~behind])
        for instant in set(self.due(state)) - before:
            # Closed are ends that the watermark has reached, in whole milliseconds.
            self.handle.registerTimer(-(-instant // 1000))
        self._keep(state)
        if results:
            yield self._frame(results, (), [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._state()
        results = self.finish(state, timerValues.getCurrentWatermarkInMs() * 1000)
        self._keep(state)
        if results:
            yield self._frame(results, key, self.keys)


class Hours(Closing):
    """Totals per key, status and hour: sums, counts, and extremes of the measures."""

    def __init__(self, columns, keys, status, sums, most, least):
        self.sums, self.most, self.least, self.keys, self.status = sums, most, least, keys, status
        named = ["hour_us", "n", *(f"{c}_{p}" for c in sums for p in ("sum", "n")), *(f"max_{c}" for c in most),
                 *(f"min_{c}" for c in least)]
        super().__init__(columns, named)

    def late(self, frame, watermark):
        return frame["event_us"] // HOUR * HOUR + HOUR <= watermark

    def fold(self, state, frame):
        grouped = frame.groupby([frame["event_us"] // HOUR, frame[self.status].fillna("")], sort=False)
        parts = pd.concat([grouped.size().rename("n"), grouped[self.sums].sum().add_suffix("_sum"),
                           grouped[self.sums].count().add_suffix("_n"), grouped[self.most].max().add_prefix("max_"),
                           grouped[self.least].min().add_prefix("min_")], axis=1)
        for (hour, status), row in parts.to_dict("index").items():
            own = state.setdefault(str(hour), {}).setdefault(status, {})
            for name, value in row.items():
                value = None if pd.isna(value) else float(value) if name.endswith("_sum") or "." in str(value) else int(value)
                old = own.get(name)
                if old is None or value is None:
                    own[name] = value if old is None else old
                else:
                    own[name] = max(old, value) if name.startswith("max_") else min(old, value) if name.startswith("min_") else old + value
        return []

    def due(self, state):
        return [(int(h) + 1) * HOUR for h in state]

    def finish(self, state, watermark):
        closed = [h for h in state if (int(h) + 1) * HOUR <= watermark]
        return [{"hour_us": int(h) * HOUR, self.status: status, **row} for h in closed for status, row in state.pop(h).items()]


class Sessions(Closing):
    """Sessions of one key: rows at most ``gap`` apart belong together."""

    def __init__(self, columns, keys, gap: int):
        super().__init__(columns, ["start_us", "last_us", "messages"])
        self.keys, self.gap = keys, gap

    def late(self, frame, watermark):
        return frame["event_us"] + self.gap <= watermark

    def fold(self, state, frame):
        # Rows of the frame become stretches first, then stretches join the open sessions.
        times = frame["event_us"].sort_values()
        number = (times.diff() > self.gap).cumsum()
        parts = times.groupby(number).agg(["min", "max", "size"]).to_numpy().tolist()
        merged: list[list[int]] = []
        for start, last, n in sorted(parts + state.get("open", [])):
            if merged and start - merged[-1][1] <= self.gap:
                merged[-1][1] = max(merged[-1][1], last)
                merged[-1][2] += n
            else:
                merged.append([start, last, n])
        state["open"] = merged
        return []

    def due(self, state):
        return [last + self.gap for _, last, _ in state.get("open", [])]

    def finish(self, state, watermark):
        closed = [s for s in state.get("open", []) if s[1] + self.gap <= watermark]
        left = [s for s in state.get("open", []) if s[1] + self.gap > watermark]
        state.clear()
        if left:
            state["open"] = left
        return [dict(zip(self.results, s)) for s in closed]


class Firsts(Closing):
    """First row per event time of a key, the least by ``order`` within a batch; state keeps times ahead of the watermark."""

    def __init__(self, columns, keys, order: list[str]):
        super().__init__(columns, [])
        self.keys, self.order = keys, order

    def late(self, frame, watermark):
        return frame["event_us"] <= watermark

    def _state(self) -> dict:
        return {"seen": set(super()._state().get("seen", []))}

    def _keep(self, state: dict) -> None:
        super()._keep({"seen": sorted(state["seen"])} if state.get("seen") else {})

    def fold(self, state, frame):
        # The set stays one for all frames of a key, and a frame costs its own rows only.
        new = [t not in state["seen"] for t in frame["event_us"]]
        first = frame[new].sort_values(["event_us", *self.order]).drop_duplicates("event_us")
        state["seen"].update(first["event_us"].tolist())
        return first.astype(object).where(first.notna(), None).to_dict("records")

    def due(self, state):
        return [max(state["seen"])] if state.get("seen") else []

    def finish(self, state, watermark):
        state["seen"] = {t for t in state["seen"] if t > watermark}
        return []


def _run(stream: DataFrame, keys: list[str], processor: Closing, results: dict[str, str]) -> DataFrame:
    out = T.StructType([*stream.schema.fields, *(T.StructField(n, T._parse_datatype_string(results[n])) for n in processor.results),
                        T.StructField("late", T.BooleanType())])
    # The deal by key before the state is stated, so that a hot device is spread over its days.
    return stream.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "EventTime")


SUMS, MOST, LEAST = ["spindle_rpm", "temperature_c", "power_kw"], ["vibration_mm_s", "cycle_count"], ["cycle_count"]
DEVICE = ["device_id", "customer_id", "device_type"]


def hourly_health(silver: DataFrame, late: str = LATE) -> DataFrame:
    """Device hours per status as ``jobs.hourly_health`` has them, and late rows: hours that were closed when they came.

    Split the output with ``closed_hours`` and ``late_rows``.
    """
    slim = silver.select(*DEVICE, "timestamp", "status", "message_id", "spindle_rpm", "vibration_mm_s", "power_kw", "cycle_count",
                         device_temperature().alias("temperature_c"))
    rows = watched(slim, "timestamp", late).withColumn("event_day", F.to_date("timestamp"))
    keys = [*DEVICE, "event_day"]
    processor = Hours(rows.columns, keys, "status", SUMS, MOST, LEAST)
    doubles = {f"{c}_sum": "double" for c in SUMS} | {"max_vibration_mm_s": "double"}
    return _run(rows, keys, processor, {n: doubles.get(n, "long") for n in processor.results})


def closed_hours(out: DataFrame) -> DataFrame:
    """The closed hours of ``hourly_health``, in the form that ``jobs.fold_hourly_health`` folds."""
    hour = F.timestamp_micros("hour_us")
    return out.where("not late").select(
        hour.alias("hour_start"), (hour + F.make_dt_interval(hours=F.lit(1))).alias("hour_end"), *DEVICE,
        F.nullif("status", F.lit("")).alias("status"), "n", F.col("spindle_rpm_sum").alias("rpm_sum"), F.col("spindle_rpm_n").alias("rpm_n"),
        F.col("temperature_c_sum").alias("temp_sum"), F.col("temperature_c_n").alias("temp_n"),
        F.col("max_vibration_mm_s").alias("max_vibration"), F.col("power_kw_sum").alias("power_sum"), F.col("power_kw_n").alias("power_n"),
        F.col("max_cycle_count").alias("max_cycle"), F.col("min_cycle_count").alias("min_cycle"))


def late_rows(out: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that came too late, as they came."""
    return out.where("late").select(*columns)


def sessions(silver: DataFrame, gap_s: int = 300, late: str = LATE) -> DataFrame:
    """Sessions (start_us, last_us, messages) of each device, and late rows: those whose own session was over."""
    rows = watched(silver.select("device_id", "timestamp", "message_id"), "timestamp", late)
    processor = Sessions(rows.columns, ["device_id"], gap_s * 1_000_000)
    return _run(rows, ["device_id"], processor, dict.fromkeys(processor.results, "long"))


def closed_sessions(out: DataFrame) -> DataFrame:
    return out.where("not late").select("device_id", F.timestamp_micros("start_us").alias("session_start"),
                                        F.timestamp_micros("last_us").alias("last_message"), "messages")


def deduplicated(silver: DataFrame, order: list[str], late: str = LATE) -> DataFrame:
    """First row per device and event time, and late rows: behind the watermark, where a copy may be forgotten.

    Late rows are not compared; ``upsert.insert_if_absent`` takes them into a stored table without copies. All columns of
    ``silver`` go through Python, so leave out those that are not wanted.
    """
    rows = watched(silver, "timestamp", late).withColumn("event_day", F.to_date("timestamp"))
    return _run(rows, ["device_id", "event_day"], Firsts(rows.columns, ["device_id", "event_day"], order), {})
