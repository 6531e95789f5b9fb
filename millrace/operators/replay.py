"""Replay of a time-to-live cache over a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ratio, seconds_between
from millrace.functions.timewise import as_of_join, next_in_time
from millrace.session import staged


def replay_cache(log: DataFrame, ttl_s: int = 3600, key: str = "cache_key", ts: str = "ts",
                 tie: str = "request_id") -> DataFrame:
    """Adds ``hit``: a request hits while the stored entry is at most ``ttl_s`` old.

    A miss stores the entry anew and a hit does not extend it, so stores form a chain: each is the first
    request later than its predecessor plus the limit.  A request after a longer silence is a store
    in any case.  The chains inside the unbroken stretches are followed by doubling: round i
    reaches every store within 2^i steps, so even a key with most of the log needs a
    logarithmic number of joins on (key, time), all evenly spread.
    """
    times = log.select(key, ts).distinct()
    nexts = staged(next_in_time(times, [key], ts, out="_next"), "replay-nodes")
    gap = seconds_between(F.col(ts), F.col("_next"))
    # Heads: the first request of a key, and each one after a silence longer than the limit.
    first = times.groupBy(key).agg(F.min(ts).alias(ts))
    after = nexts.where(gap > ttl_s).select(key, F.col("_next").alias(ts))
    heads = first.unionByName(after)
    limit = F.col(ts) + F.make_dt_interval(secs=F.lit(ttl_s))
    # The store after a node is the successor of the last request not later than node + limit.
    probes = nexts.select(key, ts, limit.alias("_probe"))
    steps = as_of_join(probes, nexts.select(key, F.col(ts).alias("_t"), "_next"), [key], "_probe", "_t", ["_next"])
    # A successor that is itself a head needs no chain.
    steps = (steps.where("_next IS NOT NULL")
             .join(heads.select(key, F.col(ts).alias("_next")), [key, "_next"], "left_anti")
             .select(key, ts, "_next"))
    # A stretch has one head and one chain, so every round reaches stores not reached before.
    jump, parts = staged(steps, "replay-steps"), [staged(heads, "replay-heads")]
    while True:
        reached = _together(parts)
        new = staged(reached.join(jump, [key, ts]).select(key, F.col("_next").alias(ts)), "replay-new")
        if new.isEmpty():
            break
        parts.append(new)
        onward = jump.select(key, F.col(ts).alias("_next"), F.col("_next").alias("_far"))
        jump = staged(jump.join(onward, [key, "_next"]).select(key, ts, F.col("_far").alias("_next")),
                      "replay-steps")
    marked = log.join(reached.withColumn("_store", F.lit(True)), [key, ts], "left")
    # Of several requests at the instant of a store only the first is the miss.
    w = W.partitionBy(key, ts).orderBy(tie)
    return (marked.withColumn("_first", F.row_number().over(w) == 1)
            .withColumn("hit", ~(F.coalesce("_store", F.lit(False)) & F.col("_first")))
            .drop("_store", "_first"))


def _together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def hit_ratio(replayed: DataFrame, by: list[str] = ()) -> DataFrame:
    return replayed.groupBy(*by).agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"),
        ratio(F.count_if("hit"), F.count(F.lit(1))).alias("hit_ratio"))


def cache_stats(replayed: DataFrame, asof: str, ttl_s: int = 3600, key: str = "cache_key",
                ts: str = "ts") -> DataFrame:
    """Entries held at an instant: one per key with a store, expired or active."""
    last = replayed.where(~F.col("hit")).groupBy(key).agg(F.max(ts).alias("stored"))
    expired = seconds_between(F.col("stored"), F.lit(asof).cast("timestamp")) > ttl_s
    return last.agg(F.count(F.lit(1)).alias("total_entries"), F.count_if(expired).alias("expired_entries"),
                    F.count_if(~expired).alias("active_entries"))
