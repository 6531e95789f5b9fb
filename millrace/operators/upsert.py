"""Keyed writes expressed as joins, and partition-wise table replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.silver import first_per_key
from millrace.session import staged


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str],
                     order: list[str | Column]) -> DataFrame:
    """Incoming rows to append: first per key, key not yet in the target."""
    return first_per_key(incoming, keys, order).join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], update: list[str] | None = None,
           now: str | None = None) -> DataFrame:
    """Target after the merge; incoming rows must be unique per key.

    Without ``update`` every non-key column is taken from the incoming row; with it only those are,
    and the others keep their stored value on a match.  ``created_at`` always survives a match and
    ``updated_at`` is set on inserted and changed rows when the target has these columns.
    """
    cols = target.columns
    change = set(update if update is not None else [c for c in cols if c not in keys])
    change -= {"created_at"}
    # Two union-and-aggregate sides would need the whole row twice; one full outer join shuffles
    # each row once on the key.
    t = target.select(F.struct(*cols).alias("t"), *keys)
    have = [c for c in cols if c in incoming.columns]
    i = incoming.select(F.struct(*have).alias("i"), *keys)
    joined = t.join(i, keys, "full_outer")
    new, hit = F.col("t").isNull(), F.col("i").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c == "updated_at" and now is not None:
            out.append(F.when(hit, F.lit(now).cast("timestamp")).otherwise(F.col("t.updated_at")).alias(c))
        elif c == "created_at" and now is not None:
            out.append(F.when(new, F.lit(now).cast("timestamp")).otherwise(F.col("t.created_at")).alias(c))
        elif c not in have:
            out.append(F.col(f"t.{c}").alias(c))
        elif c in change:
            out.append(F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(new, F.col(f"i.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return joined.select(*out)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrites only the partitions present in ``df``; others stay as they are.

    The rebalance hint splits a hot partition over several files and joins small ones.  Results
    that read the table they replace must be staged first (see ``rebuild_partitions``).
    """
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def merge_into(path: str, incoming: DataFrame, keys: list[str], by: list[str],
               update: list[str] | None = None, now: str | None = None) -> None:
    """Upserts into a partitioned Parquet table; only touched partitions are read and rewritten.

    A row's partition columns must be a function of its key, so a match is in the same partition.
    """
    spark = incoming.sparkSession
    target = spark.read.parquet(path)
    touched = incoming.select(*by).distinct()
    part = target.join(touched, by, "left_semi")
    replace_partitions(staged(upsert(part, incoming, keys, update, now), "merge"), path, by)


def rebuild_partitions(fresh: DataFrame, stored: DataFrame, keys: list[str], reprocessed_at: str) -> DataFrame:
    """Replacement rows of the rebuilt partitions, versioned one above what they replace.

    Partitions that are new start at version 1 with no reprocessing time.
    """
    versions = stored.groupBy(*keys).agg(F.max("data_version").alias("_old"))
    return (fresh.drop("data_version", "reprocessed_at").join(versions, keys, "left")
            .withColumns({
                "data_version": F.coalesce(F.col("_old") + 1, F.lit(1)),
                "reprocessed_at": F.when(F.col("_old").isNotNull(),
                                         F.lit(reprocessed_at).cast("timestamp")),
            }).drop("_old"))


def touched(late: DataFrame, by: list[str]) -> DataFrame:
    return late.select(*by).distinct()


def late_hours(bronze: DataFrame, late_s: int = 600) -> DataFrame:
    """Device hours that got rows sent after the hour closed and flagged late."""
    from millrace.operators.silver import with_lateness

    hour = F.date_trunc("hour", "timestamp")
    late = with_lateness(bronze, late_s=late_s).withColumn("hour_start", hour).where(
        F.col("is_late_data") & (F.col("sent_at") > F.col("hour_start") + F.expr("INTERVAL 1 HOUR")))
    return late.groupBy("hour_start").agg(F.count(F.lit(1)).alias("late_count"))


def rows_of_hours(bronze: DataFrame, hours: DataFrame) -> DataFrame:
    """All rows of the hours to reprocess, on-time rows included."""
    return (bronze.withColumn("hour_start", F.date_trunc("hour", "timestamp"))
            .join(hours.select("hour_start"), "hour_start", "left_semi"))
