"""Hot tenants of a running stream: decayed space-saving summaries in state, and the key split that they feed.

Rows are dealt over lanes by a hash of the row, not of the tenant, so a tenant with a third of all rows is spread
evenly. A lane keeps at most ``capacity`` tenants with their weights; a tenant's weight over all lanes is too high by
no more than the total divided by the capacity, and never too low.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CAPACITY = 64
LANES = 8
HALF_LIFE_S = 7 * 86_400
# Tenants above this share of the traffic are hot; the share that must be found lies above it by the summary's error.
HOT_SHARE = 0.15

OUTPUT = "lane int, tenant string, weight double, error double, total double, at timestamp"


class Summary:
    """Space-saving: a newcomer takes the place of the lightest tenant and inherits its weight as error."""

    def __init__(self, capacity: int = CAPACITY, held: dict | None = None):
        held = held or {"weights": {}, "total": 0.0, "at": None}
        self.capacity, self.total, self.at = capacity, held["total"], held["at"]
        self.weights: dict[str, list[float]] = held["weights"]

    def told(self) -> dict:
        return {"weights": self.weights, "total": self.total, "at": self.at}

    def decay(self, at: float, half_life_s: float) -> None:
        """Halves everything once per half-life of event time; time does not run backwards."""
        if self.at is not None and at > self.at:
            factor = 0.5 ** ((at - self.at) / half_life_s)
            self.total *= factor
            self.weights = {t: [w * factor, e * factor] for t, (w, e) in self.weights.items()}
        self.at = at if self.at is None else max(self.at, at)

    def add(self, tenant: str, n: float) -> None:
        self.total += n
        if tenant in self.weights:
            self.weights[tenant][0] += n
        elif len(self.weights) < self.capacity:
            self.weights[tenant] = [n, 0.0]
        else:
            lightest = min(self.weights, key=lambda t: (self.weights[t][0], t))
            weight, _ = self.weights.pop(lightest)
            self.weights[tenant] = [weight + n, weight]


class Counting(StatefulProcessor):
    """Folds the batches of one lane into its summary and tells it after each."""

    def __init__(self, capacity: int, half_life_s: float):
        self.capacity, self.half_life_s = capacity, half_life_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("summary", "held string")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        summary = Summary(self.capacity, json.loads(self.held.get()[0]) if self.held.exists() else None)
        counts: dict[str, int] = {}
        latest = None
        for frame in rows:
            for tenant, n in frame["tenant"].value_counts().items():
                counts[tenant] = counts.get(tenant, 0) + int(n)
            newest = frame["seconds"].max()
            latest = newest if latest is None or newest > latest else latest
        if latest is None or not counts:
            return
        summary.decay(float(latest), self.half_life_s)
        # Heavier first, so that a batch's rare tenants do not push out its common ones.
        for tenant, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
            summary.add(tenant, n)
        self.held.update((json.dumps(summary.told()),))
        out = pd.DataFrame([(key[0], t, w, e, summary.total) for t, (w, e) in summary.weights.items()],
                           columns=["lane", "tenant", "weight", "error", "total"])
        yield out.assign(at=pd.to_datetime(summary.at, unit="s"))


def summaries(stream: DataFrame, tenant: str = "customer_id", ts: str = "timestamp", row_key: str = "message_id",
              lanes: int = LANES, capacity: int = CAPACITY, half_life_s: float = HALF_LIFE_S) -> DataFrame:
    """Rows (lane, tenant, weight, error, total, at) after each batch; run with ``late.keyed_state``.

    Rows without a tenant or a time are not counted.  Only tenant and time travel to the state.
    """
    slim = stream.where(F.col(tenant).isNotNull() & F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(row_key), F.lit(lanes)).cast("int").alias("lane"), F.col(tenant).alias("tenant"),
        F.unix_seconds(ts).alias("seconds"))
    return slim.groupBy("lane").transformWithStateInPandas(Counting(capacity, half_life_s), OUTPUT, "append", "None")


def hot_tenants(told: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Tenants (tenant, traffic_share) above ``share`` by the newest summary of each lane; at most ``1 / share`` rows."""
    newest = W.partitionBy("lane").orderBy(F.desc("at"), F.desc("total"))
    last = told.withColumn("_r", F.dense_rank().over(newest)).where("_r = 1")
    total = last.select("lane", "total").distinct().agg(F.sum("total").alias("t")).scalar()
    return (last.groupBy("tenant").agg((F.sum("weight") / total).alias("traffic_share"))
            .where(F.col("traffic_share") > share))


def split_keys(df: DataFrame, hot: DataFrame, tenant: str = "customer_id", by: str = "facility") -> DataFrame:
    """Adds ``routing_key``: the tenant, or tenant and ``by`` for hot tenants.

    ``hot`` has a handful of rows at most, as shares add up to one; read it anew for each batch to follow the stream.
    """
    marked = df.join(F.broadcast(hot.select(F.col("tenant").alias(tenant), F.lit(True).alias("_hot"))), tenant, "left")
    return marked.withColumn("routing_key", F.when(F.col("_hot"), F.concat_ws(":", tenant, by)).otherwise(F.col(tenant))).drop("_hot")
