"""Routing keys, hot-partition and tenant-skew reports, retention tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ratio

LARGE_CUSTOMER_DEVICES = 10_000


def routing_key(df: DataFrame, limit: int = LARGE_CUSTOMER_DEVICES) -> DataFrame:
    """Customer as key, split by facility for customers with more devices than the limit."""
    sizes = df.groupBy("customer_id").agg(F.count_distinct("device_id").alias("_devices"))
    key = F.when(F.col("_devices") > limit, F.concat_ws(":", "customer_id", "facility")).otherwise(
        F.col("customer_id"))
    return df.join(sizes, "customer_id", "left").withColumn("routing_key", key).drop("_devices")


def partition_of(key: Column, partitions: int) -> Column:
    """The number of the key's first eight SHA-256 digits modulo the partitions: the same in every producer."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(partitions)).cast("int")


def with_partition(df: DataFrame, partitions: int = 100, limit: int = LARGE_CUSTOMER_DEVICES) -> DataFrame:
    return routing_key(df, limit).withColumn("partition", partition_of(F.col("routing_key"), partitions))


def hot_keys(df: DataFrame, key: str, times: float = 10.0, share_limit: float = 0.2) -> DataFrame:
    """Rows per key, share of all rows, and flags for hot keys.

    Counts combine before the shuffle; total and mean are scalar subqueries over the counts.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("messages"))
    total = counts.agg(F.sum("messages").alias("t")).scalar()
    mean = counts.agg(F.avg("messages").alias("m")).scalar()
    return counts.select(
        key, "messages", ratio(F.col("messages"), total).alias("traffic_share"),
        (F.col("messages") > F.lit(times) * mean).alias("hot"),
    ).withColumn("over_share", F.col("traffic_share") > share_limit)


# Days a layer keeps its rows, and the age in days up to which a tier holds them.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 1095}
TIERS = ((7, "hot"), (30, "warm"), (365, "cold"))


def storage_tier(date: Column, asof: str) -> Column:
    age = F.datediff(F.lit(asof).cast("date"), date)
    out = F.lit("expired")
    for days, name in reversed(TIERS):
        out = F.when(age <= days, name).otherwise(out)
    return out


def retained(df: DataFrame, asof: str, layer: str | None = None, days: int | None = None,
             date: str = "date") -> DataFrame:
    """Rows within the retention; a partition column prunes the scan to whole days."""
    keep = days if days is not None else RETENTION_DAYS[layer]
    return df.where(F.col(date) >= F.date_sub(F.lit(asof).cast("date"), keep))
