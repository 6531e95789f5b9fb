"""Message sources: Kafka topics, folders of files, stored Bronze objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from millrace.operators.silver import parse_messages
from millrace.schemas import BRONZE, CORRUPT
from millrace.session import pin_utc


def kafka_stream(spark: SparkSession, servers: str, topic: str = "telemetry",
                 per_trigger: int | None = None) -> DataFrame:
    """Keyed JSON messages of a topic from the earliest offset on.

    Offsets live in the query's checkpoint, so a restart goes on where the last commit ended.  Needs
    the Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(per_trigger))
    return reader.load()


def telemetry_stream(raw: DataFrame) -> DataFrame:
    return parse_messages(raw.select("value"))


def table_stream(spark: SparkSession, root: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stored table as a stream of its files. The glob also matches a single-file table."""
    path = f"{root}/{name}.parque[t]"
    schema = pin_utc(spark).read.parquet(f"{root}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def read_bronze(spark: SparkSession, path: str, date: str | None = None, hour: str | None = None) -> DataFrame:
    """Bronze messages of a slice; ``date`` and ``hour`` prune folders before any file is read.

    Malformed objects come back with the raw text in the corrupt-record column.
    """
    schema = StructType([*BRONZE.fields, StructField("date", DateType()), StructField("hour", StringType())])
    out = (pin_utc(spark).read.schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    if date is not None:
        out = out.where(F.col("date") == F.lit(date).cast("date"))
    if hour is not None:
        out = out.where(F.col("hour") == F.lit(hour))
    return out


def run_summary(slice_: DataFrame, label: str) -> DataFrame:
    """Files and records of a slice; an empty slice gives zeros."""
    return slice_.select(F.col("_metadata.file_path").alias("f")).agg(
        F.count_distinct("f").alias("files_processed"), F.count(F.lit(1)).alias("records_inserted"),
    ).withColumn("execution_hour", F.lit(label))
