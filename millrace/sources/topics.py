"""A partitioned topic kept in files, and a streaming source that reads it with one offset per partition.

A topic is a folder with ``partition=<n>`` folders of Parquet files (offset, key, value); offsets of a partition rise
without gaps from 0. The source works like a consumer of a message broker: its offsets name the next message per
partition and, beside them, the heads of the partitions at that time, so that every progress event tells the lag.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "partition int, offset long, key string, value string"
HEADS = "heads"


def append_topic(messages: DataFrame, path: str, partitions: int, order: list[str]) -> None:
    """Appends ``messages(key, value, *order)`` in the stated order behind what a partition has.

    Messages are dealt by a ``partition`` column if they have one, else by key.

    As with a broker, a partition's messages are in one row and are numbered by one task; their number, not their
    size, bounds how many tasks write.
    """
    heads = dict(enumerate(head_offsets(path, partitions)))
    number = F.col("partition") if "partition" in messages.columns else F.pmod(F.xxhash64("key"), F.lit(partitions))
    number = number.cast("int")
    base = F.try_element_at(F.lit([heads[i] for i in range(partitions)]), number + 1).cast("long")
    place = F.row_number().over(W.partitionBy("partition").orderBy(*order)) - 1
    rows = (messages.select(number.alias("partition"), base.alias("_base"), "key", "value", *order)
            .withColumn("offset", F.col("_base") + place).select("partition", "offset", "key", "value"))
    rows.repartition("partition").sortWithinPartitions("partition", "offset").write.partitionBy("partition").mode("append").parquet(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _files(path: str, partition: int) -> ds.Dataset | None:
    store, root = _store(path)
    folder = f"{root.rstrip('/')}/partition={partition}"
    if store.get_file_info(folder).type == fs.FileType.NotFound:
        return None
    return ds.dataset(folder, filesystem=store, format="parquet", exclude_invalid_files=False)


def head_offsets(path: str, partitions: int) -> list[int]:
    """The next offset of each partition, from the files' footers."""
    found = [_files(path, p) for p in range(partitions)]
    return [f.count_rows() if f is not None else 0 for f in found]


@dataclass
class Span(InputPartition):
    partition: int
    start: int
    end: int


class TopicReader(DataSourceStreamReader):
    """Plans at most ``per_trigger`` messages of each partition for a batch; offsets live in the query's checkpoint.

    Spark asks for the latest offset without saying how far the query is. As a broker does for its consumer groups, the
    reader keeps the end of the last planned batch in a small file of the topic. A batch is in the query's offset log
    before it is planned, and planned again after a failure before new offsets are asked for, so that end is never
    ahead of the log or behind it.
    """

    def __init__(self, path: str, topic: str, partitions: int, per_trigger: int | None, group: str):
        self.path, self.topic, self.n, self.per_trigger, self.group = path, topic, partitions, per_trigger, group
        self.planned: list[int] | None = None

    def _group_file(self) -> tuple[fs.FileSystem, str]:
        store, root = _store(self.path)
        return store, f"{root.rstrip('/')}/_groups/{self.group}.json"

    def _remembered(self) -> list[int]:
        store, name = self._group_file()
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return [0] * self.n
        with store.open_input_stream(name) as f:
            return self._ends(json.loads(f.read()))

    def _remember(self, end: dict) -> None:
        store, name = self._group_file()
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(name) as f:
            f.write(json.dumps(end).encode())

    def _offset(self, ends: list[int], heads: list[int]) -> dict:
        named = lambda values: {str(p): v for p, v in enumerate(values)}
        return {self.topic: named(ends), HEADS: named(heads)}

    def _ends(self, offset: dict) -> list[int]:
        return [int(offset[self.topic].get(str(p), 0)) for p in range(self.n)]

    def initialOffset(self) -> dict:
        return self._offset([0] * self.n, [0] * self.n)

    def latestOffset(self) -> dict:
        heads = head_offsets(self.path, self.n)
        if not self.per_trigger:
            return self._offset(heads, heads)
        if self.planned is None:
            self.planned = self._remembered()
        return self._offset([min(h, p + self.per_trigger) for h, p in zip(heads, self.planned)], heads)

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.planned = self._ends(end)
        if self.per_trigger:
            self._remember(end)
        return [Span(p, a, b) for p, (a, b) in enumerate(zip(self._ends(start), self.planned)) if a < b]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        own = (ds.field("offset") >= partition.start) & (ds.field("offset") < partition.end)
        for batch in _files(self.path, partition.partition).to_batches(columns=["offset", "key", "value"], filter=own):
            number = pa.array([partition.partition] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([number, *(batch.column(c).cast(t) for c, t in
                                                        (("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())))],
                                             ["partition", "offset", "key", "value"])

    def commit(self, end: dict) -> None:
        pass


class Topic(DataSource):
    """``spark.readStream.format("topic")`` with options path, topic, partitions, and, to bound batches,
    maxOffsetsPerPartition with a group name that no other query uses."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        limit = self.options.get("maxOffsetsPerPartition")
        return TopicReader(self.options["path"], self.options.get("topic", "topic"), int(self.options["partitions"]),
                           int(limit) if limit else None, self.options.get("group", ""))


def topic_stream(spark: SparkSession, path: str, partitions: int, topic: str = "topic", per_partition: int | None = None,
                 group: str | None = None) -> DataFrame:
    """Messages (partition, offset, key, value) of a topic in files as a stream, in batches of bounded size if
    ``per_partition`` and the ``group`` of the query are given."""
    if per_partition and not group:
        raise ValueError("bounded batches need the group of the query")
    spark.dataSource.register(Topic)
    options = {"path": path, "partitions": str(partitions), "topic": topic}
    if per_partition:
        options |= {"maxOffsetsPerPartition": str(per_partition), "group": group}
    return spark.readStream.format("topic").options(**options).load()
