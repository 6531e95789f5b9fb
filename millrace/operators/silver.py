"""Raw messages to typed, validated, deduplicated Silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, quality_score, seconds_between
from millrace.schemas import METRICS, TELEMETRY

# Physical limits of the data model (fixed values): column -> (lowest, highest) allowed.
PHYSICAL_BOUNDS = {
    "temperature_c": (None, 500.0),
    "vibration_mm_s": (None, 50.0),
    "power_kw": (0.0, None),
}
REQUIRED = ("device_id", "customer_id", "timestamp")
LATE_SECONDS = 600


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to the nested message; unparsable text gives null fields, never an error."""
    return raw.withColumn("_m", F.from_json(F.col(value).cast("string"), TELEMETRY)).select(
        *[c for c in raw.columns if c != value], "_m.*")


def flatten_telemetry(messages: DataFrame) -> DataFrame:
    """Nested message to the wide sparse row; absent objects and fields become null."""
    return messages.select(
        "device_id", "customer_id", "device_type", "model", "firmware_version",
        F.expr("try_cast(timestamp AS timestamp)").alias("timestamp"),
        F.col("location.facility").alias("facility"),
        F.col("location.zone").alias("zone"),
        *[F.col(f"metrics.{m}").alias(m) for m in METRICS],
        "status",
        F.expr("try_cast(coalesce(device_timestamp, timestamp) AS timestamp)").alias("device_timestamp"),
        F.expr("try_cast(sent_at AS timestamp)").alias("sent_at"),
    )


def coerce(df: DataFrame, doubles: list[str] = (), timestamps: list[str] = ()) -> DataFrame:
    """Text columns to numbers and instants; what does not parse becomes null."""
    changed = {c: F.col(c).try_cast("double") for c in doubles}
    changed.update({c: F.col(c).try_cast("timestamp") for c in timestamps})
    return df.withColumns(changed)


def partition_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns({"date": F.to_date(ts), "hour": F.date_format(ts, "HH")})


def with_lateness(df: DataFrame, device_ts: str = "timestamp", sent: str = "sent_at",
                  late_s: int = LATE_SECONDS) -> DataFrame:
    latency = seconds_between(F.col(device_ts), F.col(sent))
    return df.withColumns({"latency_seconds": latency,
                           "is_late_data": F.coalesce(latency > late_s, F.lit(False))})


def with_quality_score(df: DataFrame, names=("vibration_mm_s", "temperature_c", "power_kw")) -> DataFrame:
    return df.withColumn("data_quality_score", quality_score(names))


def _bound_failures(bounds: dict, strict: bool) -> list[tuple[str, Column]]:
    out = []
    for name, (low, high) in bounds.items():
        c = F.col(name)
        bad = F.lit(False)
        if low is not None:
            bad = bad | (c < F.lit(low))
        if high is not None:
            bad = bad | (c > F.lit(high))
        # Strict mode drops missing measurements as well; by default a device without the
        # sensor is kept.
        out.append((f"out_of_range_{name}", F.coalesce(bad, F.lit(strict))))
    return out


def with_reject_reason(df: DataFrame, required=REQUIRED, bounds=None, strict: bool = False) -> DataFrame:
    """Adds the first failed rule of each row, null for a valid row."""
    rules = [(f"missing_{c}", F.col(c).isNull()) for c in required]
    rules += _bound_failures(PHYSICAL_BOUNDS if bounds is None else bounds, strict)
    return df.withColumn("reject_reason", F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules]))


def validate(df: DataFrame, required=REQUIRED, bounds=None,
             strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reason for the dead-letter table."""
    marked = with_reject_reason(df, required, bounds, strict)
    good = marked.where("reject_reason IS NULL").drop("reject_reason")
    return good, marked.where("reject_reason IS NOT NULL")


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in a stated order.

    The rank filter lets Spark keep one row per key in each map task before the shuffle, so a key
    with very many copies does not travel whole.
    """
    return ranked_per_key(df, keys, order).where("_rank = 1").drop("_rank")


def ranked_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """All rows with their place in a stated order among the rows of their key in ``_rank``."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def deduplicate(df: DataFrame, order: list[str | Column], keys=("device_id", "timestamp")) -> DataFrame:
    return first_per_key(df, list(keys), order)


def compact_objects(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Last message of a customer, device and second, as one-second object names leave it."""
    second = F.date_trunc("second", "timestamp")
    keyed = df.withColumn("_second", second)
    return first_per_key(keyed, ["customer_id", "device_id", "_second"], order).drop("_second")



def previous_hour(asof: str) -> tuple[Column, Column]:
    hour = F.date_trunc("hour", F.lit(asof).cast("timestamp"))
    return hour - F.expr("INTERVAL 1 HOUR"), hour


def previous_day(asof: str) -> tuple[Column, Column]:
    day = F.date_trunc("day", F.lit(asof).cast("timestamp"))
    return day - F.expr("INTERVAL 1 DAY"), day


def between(df: DataFrame, bounds: tuple[Column, Column], ts: str = "timestamp") -> DataFrame:
    return df.where((F.col(ts) >= bounds[0]) & (F.col(ts) < bounds[1]))


def enrich(df: DataFrame, registry: DataFrame, key: str = "device_id") -> DataFrame:
    """Left join to the registry. Spark broadcasts it when its size allows, else splits hot keys."""
    return df.join(registry, key, "left")


def bronze_to_silver(messages: DataFrame, order: list[str | Column],
                     date: str | None = None, hour: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One Bronze slice to deduplicated Silver rows and rejected rows."""
    part = messages
    if date is not None:
        part = part.where(F.col("date") == F.lit(date).cast("date"))
    if hour is not None:
        part = part.where(F.col("hour") == F.lit(hour))
    flat = flatten_telemetry(part).withColumn("temperature_c", F.coalesce(
        "tool_temperature_c", "motor_temperature_c", "air_temperature_c"))
    good, bad = validate(flat)
    return deduplicate(with_quality_score(good), order), bad



def tenant_view(df: DataFrame, tenant: str) -> DataFrame:
    """The only way a tenant's readers see a table: its own rows."""
    if not tenant:
        raise ValueError("a tenant is required")
    column = "tenant_id" if "tenant_id" in df.columns else "customer_id"
    return df.where(F.col(column) == F.lit(tenant))
