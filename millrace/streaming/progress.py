"""Counters, lag and batch progress of running jobs as DataFrames."""

from __future__ import annotations

import json
import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.sources.topics import HEADS

PROGRESS = ("run_id string, batch_id long, input_rows long, rows_per_s double, duration_ms long, "
            "source string, end_offset string, latest_offset string")
LAG = "partition string, lag long"


def counted(df: DataFrame, rejected: Column) -> tuple[DataFrame, Observation]:
    """Counts consumed, inserted and rejected rows while the frame is written, without another pass."""
    seen = Observation("job")
    return df.observe(seen, F.count(F.lit(1)).alias("consumed"), F.count_if(rejected).alias("rejected"),
                      F.count_if(~rejected).alias("inserted")), seen


class ProgressLog(StreamingQueryListener):
    """Appends every progress event of all queries of the session to a table, batch after batch.

    A query itself remembers only its newest events; the table has them all.  Events are written when ``every`` of
    them are held and when a query ends.  Use ``with ProgressLog(spark, path) as log`` and read ``log.rows()``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.held += rows_of(json.loads(event.progress.json))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended[str(event.runId)].set()

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, query: StreamingQuery, seconds: float = 120.0) -> None:
        """Events arrive a little after a query's end."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the end of the query was not reported")

    def rows(self) -> DataFrame:
        """One row per finished micro-batch and source."""
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def rows_of(event: dict) -> list[tuple]:
    return [(event["runId"], event["batchId"], s["numInputRows"], float(s.get("processedRowsPerSecond") or 0.0),
             event["durationMs"].get("triggerExecution", 0), s["description"], *_offsets(s)) for s in event["sources"]]


def _offsets(source: dict) -> tuple[str | None, str | None]:
    """End and latest offsets of a source; topics in files carry the heads of their partitions inside the end."""
    end, latest = source.get("endOffset"), source.get("latestOffset")
    told = json.loads(end) if isinstance(end, str) and end.startswith("{") else end
    if isinstance(told, dict) and HEADS in told:
        topics = {t: parts for t, parts in told.items() if t != HEADS}
        return json.dumps(topics), json.dumps({t: told[HEADS] for t in topics})
    return _text(end), _text(latest)


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)


def lag_samples(progress: DataFrame) -> DataFrame:
    """Rows ``(source, batch_id, partition, lag)``: newest known minus consumed offset per batch and topic partition.

    Offsets are JSON maps ``{topic: {partition: next offset}}``.  Both ends are next offsets, so a
    fully consumed partition has lag zero.
    """
    kind = "map<string,map<string,bigint>>"
    each = (progress.select("source", "batch_id", F.from_json("end_offset", kind).alias("e"),
                            F.from_json("latest_offset", kind).alias("l"))
            .select("source", "batch_id", "e", F.explode("l").alias("topic", "parts"))
            .select("source", "batch_id", "e", "topic", F.explode("parts").alias("p", "latest")))
    done = F.coalesce(F.try_element_at(F.try_element_at("e", F.col("topic")), F.col("p")), F.lit(0))
    return each.select("source", "batch_id", F.concat_ws("-", "topic", "p").alias("partition"), (F.col("latest") - done).alias("lag"))


def lag_per_partition(progress: DataFrame) -> DataFrame:
    """Lag of each partition after the last batch of each source."""
    last = F.max_by(F.struct("end_offset", "latest_offset"), "batch_id")
    ends = progress.groupBy("source").agg(last.alias("o"), F.max("batch_id").alias("batch_id"))
    return lag_samples(ends.select("source", "batch_id", "o.*")).select("partition", "lag")


# Lag limits of the warning and the critical alert.
LAG_WARNING, LAG_CRITICAL = 1000, 10_000
# Seconds for which a lag must stay above its limit.
WARNING_HOLD_S, CRITICAL_HOLD_S = 300, 120


def lag_alerts(lag: DataFrame) -> DataFrame:
    level = F.when(F.col("lag") > LAG_CRITICAL, "critical").when(F.col("lag") > LAG_WARNING, "warning").otherwise("ok")
    return lag.withColumn("level", level)


def held_lag_alerts(samples: DataFrame, at: str = "at", warning: int = LAG_WARNING, critical: int = LAG_CRITICAL,
                    warning_s: int = WARNING_HOLD_S, critical_s: int = CRITICAL_HOLD_S) -> DataFrame:
    """``samples(partition, at, lag)`` with the level that holds at each of them.

    A level counts once the lag has stayed above its limit, without a sample at or below it, for the level's time.
    Samples of a partition are one per batch, so their windows grow with time and not with messages.
    """
    upto = W.partitionBy("partition").orderBy(at).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = samples
    for name, limit, hold in (("warning", warning, warning_s), ("critical", critical, critical_s)):
        # The last sample that was not above the limit, or none; the run began at the sample after it.
        out = out.withColumn(f"_low_{name}", F.max(F.when(F.col("lag") <= limit, F.col(at))).over(upto))
        run = W.partitionBy("partition", f"_low_{name}").orderBy(at).rowsBetween(W.unboundedPreceding, W.currentRow)
        began = F.min(F.when(F.col("lag") > limit, F.col(at))).over(run)
        out = out.withColumn(f"_held_{name}", F.coalesce(
            (F.col("lag") > limit) & (F.unix_micros(at) - F.unix_micros(began) >= hold * 1_000_000), F.lit(False)))
    level = F.when(F.col("_held_critical"), "critical").when(F.col("_held_warning"), "warning").otherwise("ok")
    return out.withColumn("level", level).drop("_low_warning", "_low_critical", "_held_warning", "_held_critical")
