"""Continuous jobs: raw capture, cleaning, windowed health, rates, sessions, events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import device_temperature, is_server_error
from millrace.functions.quantiles import sketches
from millrace.operators.rules import threshold_events
from millrace.operators.silver import (LATE_SECONDS, flatten_telemetry, parse_messages, with_lateness, with_quality_score,
                                       with_reject_reason)
from millrace.session import scratch_dir
from millrace.sources.sinks import BRONZE_PARTITIONS, rejecting_batch_writer, silver_batch_writer, with_event_partitions

LATE = "10 minutes"


def to_bronze(raw: DataFrame, path: str, checkpoint: str, trigger: dict,
              by: list[str] = BRONZE_PARTITIONS) -> StreamingQuery:
    """Appends parsed messages as JSON; file commits and offsets share one checkpoint.

    Each batch is grouped by folder first, so that a batch adds one file per folder and not one per
    task and folder.
    """
    messages = with_event_partitions(parse_messages(raw.select("value"))).repartition(*by)
    return (messages.writeStream.format("json").option("compression", "gzip")
            .partitionBy(*by).option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def rejected_path(path: str) -> str:
    """Where ``to_silver`` keeps the rejected messages of the table at ``path``."""
    return f"{path.rstrip('/')}_rejected"


def repeated_path(path: str) -> str:
    """Where ``to_silver`` keeps the valid messages whose device and instant the table at ``path`` has already."""
    return f"{path.rstrip('/')}_repeated"


def to_silver(raw: DataFrame, path: str, checkpoint: str, trigger: dict, order: list[str]) -> StreamingQuery:
    """Flattens, validates and inserts new keys batch by batch; every other row goes to a table beside.

    Rejected rows are in the dead-letter table, and valid rows whose key is taken in the one of repeated messages.
    """
    flat = flatten_telemetry(parse_messages(raw.select("value"))).withColumn("temperature_c", device_temperature())
    marked = with_reject_reason(with_quality_score(flat))
    inserts = silver_batch_writer(path, ["device_id", "timestamp"], order, repeated_path=repeated_path(path))
    writer = rejecting_batch_writer(inserts, rejected_path(path))
    return (marked.writeStream.foreachBatch(writer)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def split_late(silver: DataFrame, late_s: int = LATE_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Rows sent in time, and late ones tagged with their latency.

    Stateful steps drop what arrives behind their watermark.  Fed with the first part they lose nothing that was
    sent in order; the second part goes to a table, whose hours ``late_hours`` picks for reprocessing.
    """
    tagged = with_lateness(silver, late_s=late_s)
    return tagged.where(~F.col("is_late_data")).drop("latency_seconds", "is_late_data"), tagged.where("is_late_data")


def deduplicated(silver: DataFrame, keys=("device_id", "timestamp"), late: str = LATE) -> DataFrame:
    """First arrival per key; state is dropped once the watermark has passed."""
    return silver.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(list(keys))


def hourly_health(silver: DataFrame, late: str = LATE) -> DataFrame:
    """Tumbling device hours, counted per status so that the most frequent one can be picked later."""
    return (silver.withWatermark("timestamp", late)
            .groupBy(F.window("timestamp", "1 hour").alias("w"), "device_id", "customer_id", "device_type", "status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("spindle_rpm").alias("rpm_sum"),
                 F.count("spindle_rpm").alias("rpm_n"), F.sum(device_temperature()).alias("temp_sum"),
                 F.count(device_temperature()).alias("temp_n"), F.max("vibration_mm_s").alias("max_vibration"),
                 F.sum("power_kw").alias("power_sum"), F.count("power_kw").alias("power_n"),
                 F.max("cycle_count").alias("max_cycle"), F.min("cycle_count").alias("min_cycle"))
            .select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    "device_id", "customer_id", "device_type", "status", "n", "rpm_sum", "rpm_n", "temp_sum",
                    "temp_n", "max_vibration", "power_sum", "power_n", "max_cycle", "min_cycle"))


def fold_hourly_health(parts: DataFrame) -> DataFrame:
    """The per-status rows of closed hours folded to the hourly table."""
    from millrace.functions.columns import ratio

    return (parts.groupBy("device_id", "customer_id", "device_type", "hour_start").agg(
        ratio(F.sum("rpm_sum"), F.sum("rpm_n")).alias("avg_spindle_rpm"),
        ratio(F.sum("temp_sum"), F.sum("temp_n")).alias("avg_temperature"),
        F.max("max_vibration").alias("max_vibration"),
        ratio(F.sum("power_sum"), F.sum("power_n")).alias("avg_power_kw"),
        (F.max("max_cycle") - F.min("min_cycle")).cast("long").alias("cycle_count_delta"),
        F.sum("n").alias("uptime_minutes"),
        # Highest count first, then the alphabetically first status.
        F.min(F.struct((-F.col("n")).alias("c"), "status")).alias("_m"),
    ).withColumn("status", F.col("_m.status")).drop("_m"))


def sliding_requests(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                     late: str = LATE) -> DataFrame:
    return (log.withWatermark("ts", late)
            .groupBy(F.window("ts", window, slide).alias("w"), "endpoint")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(is_server_error(F.col("status_code"))).alias("failed"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "endpoint", "requests", "failed"))


def minute_sketches(log: DataFrame, by: list[str], value: str = "duration_s", late: str = LATE) -> DataFrame:
    """Quantile sketches of closed minutes: stored, they answer for any window of minutes by merging."""
    parts = sketches(log.withWatermark("ts", late), [F.window("ts", "1 minute").alias("w"), *by], value)
    return parts.select(F.col("w.start").alias("minute"), *by, "sketch")


def sessions(silver: DataFrame, gap: str = "5 minutes", late: str = LATE) -> DataFrame:
    return (silver.withWatermark("timestamp", late)
            .groupBy(F.session_window("timestamp", gap).alias("w"), "device_id")
            .agg(F.count(F.lit(1)).alias("messages"), F.max("timestamp").alias("last_message"))
            .select("device_id", F.col("w.start").alias("session_start"), "last_message", "messages"))


def events(silver: DataFrame) -> DataFrame:
    """Threshold events are a projection, the same on a stream as on a batch."""
    return threshold_events(silver)


def enriched(silver: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Stream joined to a static registry, read anew for each batch."""
    return silver.join(registry, key, "left")


def run_to_files(stream: DataFrame, name: str, trigger: dict | None = None) -> DataFrame:
    """Runs a stream over what is available now into files, and reads the result back."""
    spark = stream.sparkSession
    out, checkpoint = scratch_dir(spark, f"{name}-out"), scratch_dir(spark, f"{name}-state")
    query = (stream.writeStream.format("parquet").option("path", out).outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_writer(start, name: str, spark) -> tuple[str, StreamingQuery]:
    """Starts ``start(path, checkpoint)`` on new scratch folders and waits for its end."""
    path, checkpoint = scratch_dir(spark, f"{name}-out"), scratch_dir(spark, f"{name}-state")
    query = start(path, checkpoint)
    query.awaitTermination()
    return path, query
