"""Topics in files, their streaming source, and lag with hold times."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sources import topics
from millrace.streaming import progress


def topic(spark, n, path, partitions=3):
    rows = spark.createDataFrame([(f"k{i % 7}", f"v{i}", i) for i in range(n)], "key string, value string, i int")
    topics.append_topic(rows, path, partitions, ["i"])


def consumed(spark, path, checkpoint, out, log, per_partition=None):
    stream = topics.topic_stream(spark, path, 3, per_partition=per_partition, group="test")
    query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(processingTime="0 seconds").start())
    query.processAllAvailable()
    query.stop()
    log.wait(query)
    return spark.read.parquet(out)


def test_offsets_have_no_gaps_and_keys_keep_their_order(spark):
    path = scratch_dir(spark, "topic")
    topic(spark, 50, path)
    topic(spark, 30, path)
    rows = spark.read.parquet(path).orderBy("partition", "offset").collect()
    heads = topics.head_offsets(path, 3)
    assert sum(heads) == 80
    for p in range(3):
        own = [r for r in rows if r.partition == p]
        assert [r.offset for r in own] == list(range(heads[p]))
    assert len({(r.key, r.partition) for r in rows}) == 7


def test_every_message_is_read_once_over_batches_and_restarts(spark):
    path, checkpoint, out = (scratch_dir(spark, n) for n in ("topic", "state", "out"))
    topic(spark, 100, path)
    with progress.ProgressLog(spark, scratch_dir(spark, "log")) as log:
        got = consumed(spark, path, checkpoint, out, log, per_partition=9)
    assert got.count() == got.select("partition", "offset").distinct().count() == 100
    samples = progress.lag_samples(log.rows().where("input_rows > 0"))
    heads = topics.head_offsets(path, 3)
    want = {(f"topic-{p}", b): max(0, h - 9 * (b + 1)) for p, h in enumerate(heads) for b in range(-(-max(heads) // 9))}
    assert {(r.partition, r.batch_id): r.lag for r in samples.collect()} == want
    assert {r.lag for r in progress.lag_per_partition(log.rows()).collect()} == {0}
    # Going on from the checkpoint reads what came since, and nothing twice.
    topic(spark, 40, path)
    with progress.ProgressLog(spark, scratch_dir(spark, "log")) as log:
        got = consumed(spark, path, checkpoint, out, log, per_partition=9)
    assert got.count() == got.select("partition", "offset").distinct().count() == 140
    batches = log.rows().where("input_rows > 0").count()
    assert batches >= 2  # the bound holds after the restart, too


def test_empty_topic(spark):
    path, checkpoint = (scratch_dir(spark, n) for n in ("topic", "state"))
    assert topics.head_offsets(path, 3) == [0, 0, 0]
    topic(spark, 0, path)
    query = (topics.topic_stream(spark, path, 3).writeStream.format("noop").option("checkpointLocation", checkpoint)
             .trigger(processingTime="0 seconds").start())
    query.processAllAvailable()
    query.stop()


def test_hold_times(spark):
    start = datetime(2024, 1, 1)
    lags = {"a": [500, 1500, 1500, 900, 1500, 1500, 1500, 1500, 1500, 1500, 1500], "b": [20_000, 20_000, 20_000, 11_000, 5_000, 0]}
    rows = [(p, start + timedelta(minutes=i), lag) for p, own in lags.items() for i, lag in enumerate(own)]
    out = progress.held_lag_alerts(spark.createDataFrame(rows, "partition string, at timestamp, lag long"))
    level = {}
    for r in out.orderBy("at").collect():
        level.setdefault(r.partition, []).append(r.level)
    # Five minutes above 1,000 warn, counted anew after the dip; two minutes above 10,000 are critical.
    assert level["a"] == ["ok"] * 9 + ["warning"] * 2
    assert level["b"] == ["ok", "ok", "critical", "critical", "ok", "ok"]
    assert out.where(F.col("level").isNull()).count() == 0
