"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import discard, staged

# The word definition of the contracts, runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

Run = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


BATCH_ROWS = 500  # of texts that travel to Python at once; the default of 10,000 holds gigabytes of long ones


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session set to send ``BATCH_ROWS`` rows at a time to Python."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, limit: int = 8 << 20):
    """Row slices of a batch that hold about ``limit`` bytes of text each (one row at least): bounds task memory."""
    sizes = pc.binary_length(batch.column(text)).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def connected_components(edges: DataFrame, name: str, max_rounds: int = 64) -> DataFrame:
    """Components of an undirected graph: edges (a, b) of longs to rows (node, component), component the least node.

    Alternates large-star and small-star steps until nothing changes. Each step is a group-wise minimum (combined
    before the shuffle) and one join with it; both inputs of the joins are written tables, so Spark can split the
    rows of a hub over several tasks. Nulls and loops are dropped; nodes without an edge are not returned.
    """
    stars = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), f"{name}-edges")
    seen = None
    for _ in range(max_rounds):
        before = stars
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        top = staged(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a")), f"{name}-large")
        large = staged(both.where("b > a").join(top, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), f"{name}-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-small")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = staged(least.select("a", F.col("m").alias("b")).unionByName(moved).distinct(), f"{name}-edges")
        discard(before, top, large, least)
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    tops = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


class Labels:
    """Connected components inside one task: pairs are folded in block by block and never kept."""

    def __init__(self, nodes: np.ndarray):
        self.nodes = np.unique(nodes)
        self.label = np.arange(len(self.nodes))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the nodes a[i] and b[i]."""
        i, j = np.searchsorted(self.nodes, a), np.searchsorted(self.nodes, b)
        while True:
            x, y = self.label[i], self.label[j]
            if (x == y).all():
                return
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label != self.label[self.label]).any():
                self.label = self.label[self.label]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """One edge per node that is not the first of its component, to the first."""
        moved = self.label != np.arange(len(self.nodes))
        return self.nodes[moved], self.nodes[self.label[moved]]
