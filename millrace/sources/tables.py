"""Domain views over the stored test tables: fleet messages, request log, corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import pin_utc


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{root}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer splits than two per core, spread over the cores; for costly work on texts.

    A small table is often a single row group, so one of its splits holds all rows and the other cores stay idle. A
    table with more splits is not moved. The rows are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def as_telemetry(events: DataFrame) -> DataFrame:
    """Event rows seen as Silver telemetry of a fleet of three device types.

    All scalings are powers of two so that values stay exact in binary.
    """
    d = F.col("user_id") % 12
    kind = d % 3
    k = F.from_json("props", "k int")["k"]
    cnc, conveyor, hvac = kind == 0, kind == 1, kind == 2
    value = F.col("value")
    sent_delay = F.make_dt_interval(mins=(F.col("event_id") % 20).cast("int"))
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("dev-"), d).alias("device_id"),
        F.concat(F.lit("cust-"), d % 4).alias("customer_id"),
        F.when(cnc, "cnc_machine").when(conveyor, "conveyor").otherwise("hvac").alias("device_type"),
        F.concat(F.lit("model-"), kind).alias("model"),
        F.concat(F.lit("1."), d % 2).alias("firmware_version"),
        ts.alias("timestamp"),
        F.concat(F.lit("fac-"), d % 5).alias("facility"),
        F.concat(F.lit("zone-"), d % 2).alias("zone"),
        F.when(cnc, value * 16.0).alias("spindle_rpm"),
        F.when(cnc, k.cast("double") + 40.0).alias("tool_temperature_c"),
        F.when(~hvac, value / 4.0).alias("vibration_mm_s"),
        (value / 16.0).alias("power_kw"),
        F.col("event_id").cast("int").alias("cycle_count"),
        F.when(cnc, k * 2).alias("feed_rate_mm_min"),
        F.when(cnc, k).alias("coolant_level_pct"),
        F.when(conveyor, value / 128.0).alias("belt_speed_m_s"),
        F.when(conveyor, k.cast("double") + 40.0).alias("motor_temperature_c"),
        F.when(conveyor, value * 2.0).alias("load_weight_kg"),
        F.when(conveyor, value / 8.0).alias("runtime_hours"),
        F.when(hvac, k.cast("double") / 2.0).alias("air_temperature_c"),
        F.when(hvac, k.cast("double")).alias("humidity_pct"),
        F.when(hvac, value * 4.0).alias("compressor_pressure_psi"),
        F.when(hvac, k * 8).alias("fan_speed_rpm"),
        F.when(hvac, k).alias("filter_life_pct"),
        F.col("event_type").alias("status"),
        (ts + sent_delay).alias("sent_at"),
        F.col("event_id").alias("message_id"),
        F.col("user_id"),
    )


def telemetry(spark: SparkSession, root: str) -> DataFrame:
    return as_telemetry(table(spark, root, "events"))


def as_messages(silver: DataFrame) -> DataFrame:
    """Silver rows turned back into keyed JSON messages, as devices send them."""
    from millrace.schemas import METRICS

    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    body = F.struct(
        F.lit("telemetry").alias("message_type"), "device_id", "customer_id",
        F.col("customer_id").alias("tenant_id"), "device_type", "model", "firmware_version",
        F.date_format("timestamp", iso).alias("timestamp"),
        F.struct("facility", "zone").alias("location"),
        F.struct(*METRICS).alias("metrics"), "status",
        F.date_format("timestamp", iso).alias("device_timestamp"),
        F.date_format("sent_at", iso).alias("sent_at"),
    )
    return silver.select(F.col("customer_id").alias("key"), F.to_json(body).alias("value"))


def heartbeats(spark: SparkSession, root: str) -> DataFrame:
    """View events stand for heartbeats."""
    return telemetry(spark, root).where("status = 'view'").select(
        "device_id", "customer_id", "device_type", "facility", "timestamp",
        F.lit("online").alias("status"), "firmware_version",
        F.col("message_id").alias("uptime_seconds"))


def as_requests(events: DataFrame) -> DataFrame:
    """Event rows seen as the request log of the question service."""
    k = F.from_json("props", "k int")["k"]
    endpoint = (F.when(F.col("event_type") == "click", "insights")
                .when(F.col("event_type") == "purchase", "troubleshoot")
                .when(F.col("event_type") == "signup", "health").otherwise("ask"))
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        endpoint.alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status_code"),
        (F.col("value") / 64.0).alias("duration_s"),
        F.concat_ws(":", endpoint, F.col("user_id").cast("string")).alias("cache_key"),
        (k % 6).alias("citations"),
        (k.cast("double") / 128.0).alias("precision"),
        k.cast("double").alias("gpu_pct"),
        (k < 12).alias("rejected"),
        (k >= 50).alias("cache_hit"),
    )


def requests(spark: SparkSession, root: str) -> DataFrame:
    return as_requests(table(spark, root, "events"))


DOC_TYPES = ["manual", "runbook", "kb_article", "ADR"]


def as_corpus(documents: DataFrame) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(t) for t in DOC_TYPES]), (F.col("doc_id") % 4 + 1).cast("int"))
    return documents.select(
        "doc_id",
        F.concat(F.lit("tenant-"), F.col("doc_id") % 4).alias("tenant_id"),
        kind.alias("doc_type"),
        F.concat(F.lit("doc-"), "doc_id").alias("title"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_path"),
        F.col("source"),
        F.lit("1.0").alias("version"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("last_updated"),
        F.col("text").alias("content"),
    )


def corpus(spark: SparkSession, root: str) -> DataFrame:
    return as_corpus(spread(table(spark, root, "documents")))
