"""Whole text files as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import DOC_TYPES


def read_documents(spark: SparkSession, path: str, metadata: DataFrame | None = None) -> DataFrame:
    """One row per UTF-8 file with its path; ``metadata`` adds title, type, tenant and version by path."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("content"),
        F.to_date("_metadata.file_modification_time").alias("last_updated"))
    if metadata is None:
        name = F.element_at(F.split("source_path", "/"), -1)
        return files.select("*", name.alias("title"), F.lit("manual").alias("doc_type"),
                            F.lit("default").alias("tenant_id"), F.lit("1.0").alias("version"))
    known = metadata.where(F.col("doc_type").isin(DOC_TYPES)).withColumn(
        "version", F.coalesce("version", F.lit("1.0")))
    return files.join(known, "source_path")
