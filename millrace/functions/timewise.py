"""Next-row and as-of lookups that stay balanced when one key holds most rows.

A plain ``lead`` over a key sends all rows of that key to one task.  Here the window runs
over (key, time bucket), and only one summary row per bucket travels to the per-key
window that links neighbouring buckets.  A hot key is thereby spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import time_bucket
from millrace.session import staged


def next_in_time(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: list[str] | None = None,
                 out: str = "next_timestamp", bucket_s: int = 3600) -> DataFrame:
    """Adds the following timestamp of the same key; null on the key's last row."""
    bucketed = df.withColumn("_bucket", time_bucket(F.col(ts), bucket_s))
    heads = bucketed.groupBy(*keys, "_bucket").agg(F.min(ts).alias("_head"))
    heads = heads.select(
        *keys, "_bucket",
        F.lead("_head").over(W.partitionBy(*keys).orderBy("_bucket")).alias("_next_head"))
    inside = W.partitionBy(*keys, "_bucket").orderBy(ts, *(tie or []))
    return (bucketed.withColumn("_inside", F.lead(ts).over(inside))
            .join(heads, [*keys, "_bucket"], "left")
            .withColumn(out, F.coalesce("_inside", "_next_head"))
            .drop("_bucket", "_inside", "_next_head"))


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
               take: list[str], right_tie: list[str] | None = None,
               bucket_s: int = 86400) -> DataFrame:
    """Left rows with the columns ``take`` of the latest right row at or before them.

    Equal instants match.  Left rows without an earlier right row keep nulls.
    """
    found = F.struct(F.col(right_ts).alias("_at"), *[F.col(c).alias(c) for c in take])
    order = F.struct(F.col(right_ts), *[F.col(c) for c in (right_tie or [])])
    right_rows = right.select(
        *keys, F.col(right_ts).alias("_ts"), order.alias("_order"), found.alias("_found"),
        time_bucket(F.col(right_ts), bucket_s).alias("_bucket"))
    # One row per (key, bucket): the last right row inside it.
    lasts = (right_rows.groupBy(*keys, "_bucket")
             .agg(F.max_by("_found", "_order").alias("_last")))
    lefts = left.withColumn("_bucket", time_bucket(F.col(left_ts), bucket_s))
    buckets = lefts.select(*keys, "_bucket").distinct()
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = (buckets.join(lasts, [*keys, "_bucket"], "full_outer")
               .select(*keys, "_bucket",
                       F.last("_last", ignorenulls=True).over(before).alias("_carried")))
    payload = F.struct(*[F.col(c) for c in left.columns])
    merged = lefts.select(
        *keys, "_bucket", F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"),
        F.lit(None).cast(right_rows.schema["_order"].dataType).alias("_order"),
        payload.alias("_row"), F.lit(None).cast(right_rows.schema["_found"].dataType).alias("_found"),
    ).unionByName(right_rows.select(
        *keys, "_bucket", "_ts", F.lit(0).alias("_side"), "_order",
        F.lit(None).cast(left.schema).alias("_row"), "_found"))
    upto = (W.partitionBy(*keys, "_bucket").orderBy("_ts", "_side", "_order")
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    hit = (merged.withColumn("_hit", F.last("_found", ignorenulls=True).over(upto))
           .where("_side = 1")
           .join(carried, [*keys, "_bucket"], "left")
           .withColumn("_hit", F.coalesce("_hit", "_carried")))
    return hit.select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in take])


def in_ranges(rows: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """``rows`` written in ranges of ``order`` of about equal size, with the number of each row's range in ``_range``.

    Spark takes the splitters from a bounded sample of each partition.  The numbers are stored with the rows, so they
    stay what they are whatever is computed anew.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    return staged(dealt, "ranges")


def as_of_join_ranged(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                      take: list[str], right_tie: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``as_of_join`` for any span of time and any skew: no bucket length has to fit the data.

    Rows of both sides lie in ranges of (key, time); a hot key's day, or hour, is as many ranges as it needs.  Inside a
    range the latest right row is found by a window; from each range of a key only its last right row is carried to
    the ranges behind it, so the window over a key sees one row per range.  Rows of one key and instant are one range.
    """
    found = F.struct(F.col(right_ts).alias("_at"), *[F.col(c).alias(c) for c in take])
    order = F.struct(F.col(right_ts), *[F.col(c) for c in (right_tie or [])])
    rights = right.where(F.col(right_ts).isNotNull()).select(
        *keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), order.alias("_order"), found.alias("_found"))
    lefts = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"),
                        F.lit(None).cast(rights.schema["_order"].dataType).alias("_order"),
                        F.lit(None).cast(rights.schema["_found"].dataType).alias("_found"),
                        F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    rows = in_ranges(lefts.unionByName(rights.withColumn("_row", F.lit(None).cast(left.schema))), [*keys, "_ts"], ranges)
    lasts = rows.where("_side = 0").groupBy(*keys, "_range").agg(F.max_by("_found", "_order").alias("_last"))
    touched = rows.select(*keys, "_range").distinct().join(lasts, [*keys, "_range"], "left")
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = touched.select(*keys, "_range", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    upto = W.partitionBy(*keys, "_range").orderBy("_ts", "_side", "_order").rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = (rows.withColumn("_hit", F.last("_found", ignorenulls=True).over(upto)).where("_side = 1")
           .join(carried, [*keys, "_range"], "left").withColumn("_hit", F.coalesce("_hit", "_carried")))
    # A left row without an instant, or without a key, has nothing before it.
    known = F.col("_ts").isNotNull()
    return hit.select("_row.*", *[F.when(known, F.col(f"_hit.{c}")).alias(c) for c in take])
