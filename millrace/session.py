"""Session set-up for local runs and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def local_session(cores: str | int = "*", app: str = "millrace", memory: str = "8g",
                  partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hours, days and schedules are all defined on UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint root that every executor can reach.

    Local masters may fall back to a temporary folder; a cluster without
    ``spark.checkpoint.dir`` is a configuration error, since executors could not
    read back what another machine wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOT:
            _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="millrace-")
        root = _LOCAL_ROOT[app]
    return os.path.join(root, "millrace", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a result to scratch and read it back: cuts lineage and survives executor loss."""
    path = scratch_dir(df.sparkSession, name)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables. Whatever reads them must have been written before.

    Stores that only Spark reaches keep theirs until the scratch folder is cleared.
    """
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs

    for t in tables:
        path = t.scratch_path
        try:
            store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
            store.delete_dir(root)
        except (ArrowInvalid, ArrowNotImplementedError, FileNotFoundError, ImportError):
            continue
