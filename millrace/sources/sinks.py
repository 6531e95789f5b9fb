"""Batch and micro-batch writers of the layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.silver import partition_columns

BRONZE_PARTITIONS = ["customer_id", "date", "hour"]
SILVER_PARTITIONS = ["customer_id", "date"]


def with_event_partitions(messages: DataFrame) -> DataFrame:
    """Partition columns from the event time in UTC; messages without one go to a null partition."""
    stamped = messages.withColumn("_ts", F.expr(
        "try_cast(coalesce(device_timestamp, timestamp) AS timestamp)"))
    return partition_columns(stamped, "_ts").drop("_ts")


def write_bronze(messages: DataFrame, path: str, by: list[str] = BRONZE_PARTITIONS) -> None:
    """Appends raw messages as compressed JSON under customer, date and hour, or coarser folders.

    The rebalance hint gives each partition few files and splits a hot customer over several tasks.
    """
    rows = with_event_partitions(messages).hint("rebalance", *[F.col(c) for c in by])
    (rows.write.mode("append").partitionBy(*by)
     .option("compression", "gzip").json(path))


def write_silver(silver: DataFrame, path: str) -> None:
    """Replaces the customer days present in ``silver``; a rerun leaves the same table."""
    rows = silver if "date" in silver.columns else silver.withColumn("date", F.to_date("timestamp"))
    (rows.hint("rebalance", *[F.col(c) for c in SILVER_PARTITIONS]).sortWithinPartitions("device_id", "timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*SILVER_PARTITIONS).parquet(path))


def keyed_messages(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows as ``key, value`` messages for a keyed sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publishes keyed messages with full acknowledgement. Needs the Kafka connector."""
    return (keyed_messages(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all").option("topic", topic).option("checkpointLocation", checkpoint))


def silver_batch_writer(path: str, keys: list[str], order: list[str],
                        rows_per_file: int = 1_000_000, repeated_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that inserts rows whose key is not stored yet.

    Each batch owns the folder ``batch=<id>`` and overwrites it, so a batch replayed after a failure
    neither loses nor repeats rows.  Stored rows are looked up only on the days of the batch.  A day of a
    batch is spread by key over as many tasks as its rows need, since adaptive rebalancing is off in streams.

    With ``repeated_path`` the rows that are not inserted, because their key is taken, go to a folder there.
    """
    from millrace.operators.silver import first_per_key, ranked_per_key

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The batch is used for its days and for its rows; without the cache its source is read twice.
        dated = batch.withColumn("date", F.to_date("timestamp"))
        if repeated_path is None:
            held = rows = first_per_key(dated, keys, order).persist()
        else:
            held = ranked_per_key(dated, keys, order).persist()
            rows, repeats = held.where("_rank = 1").drop("_rank"), held.where("_rank > 1").drop("_rank")
        fresh = rows
        if _exists(spark, path):
            stored = spark.read.parquet(path).where(F.col("batch") < batch_id)
            days = rows.select("date").distinct()
            seen = stored.join(days, "date", "left_semi").select(*keys)
            fresh = rows.join(seen, keys, "left_anti")
            if repeated_path is not None:
                repeats = repeats.unionByName(rows.join(seen, keys, "left_semi").select(*repeats.columns))
        sizes = rows.groupBy("date").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_shares"))
        share = F.pmod(F.xxhash64(*keys), F.col("_shares"))
        (fresh.join(sizes, "date").repartition("date", share).drop("_shares")
         .withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "date").parquet(path))
        if repeated_path is not None:
            (repeats.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(repeated_path))
        held.unpersist()

    return write


def rejecting_batch_writer(write: Callable[[DataFrame, int], None], rejected_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that passes valid rows to ``write`` and keeps the others, with their reason.

    Rows carry ``reject_reason``.  The rejected rows of a batch own a folder, like its valid ones.
    """
    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        write(batch.where("reject_reason IS NULL").drop("reject_reason"), batch_id)
        (batch.where("reject_reason IS NOT NULL").withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(rejected_path))
        batch.unpersist()

    return both


def _exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str], batch: int = 10_000) -> None:
    """Appends to a database table. Needs the driver on the class path."""
    df.write.option("batchsize", str(batch)).jdbc(url, name, mode="append", properties=properties)
