"""Quantiles per group without sending a group to one task: exact ones, and mergeable sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    bins: int = 1024) -> DataFrame:
    """Linearly interpolated quantiles (``percentile_cont``), one row per group.

    Copies of a value collapse before the first shuffle.  A histogram of at most ``bins``
    cells per group then shows which cells hold the wanted ranks, and only the values of those
    cells are ordered.  No step orders or holds a whole group.
    """
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    spans = counts.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    cell = F.when(F.col("_hi") > F.col("_lo"), F.least(
        F.lit(bins - 1),
        F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)))
    binned = counts.join(spans, keys).select(
        *keys, "_v", "_n", F.coalesce(cell, F.lit(0)).cast("int").alias("_bin"))
    ordered = W.partitionBy(*keys).orderBy("_bin")
    per_bin = (binned.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_m"))
               .withColumn("_upto", F.sum("_m").over(
                   ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
               .withColumn("_total", F.sum("_m").over(W.partitionBy(*keys))))
    wanted = []
    for name, q in probs.items():
        at = F.lit(float(q)) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            wanted.append(F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"),
                                   at.alias("at"), rank.alias("rank")))
    targets = (per_bin.withColumn("_before", F.col("_upto") - F.col("_m"))
               .withColumn("_t", F.explode(F.array(*wanted)))
               .where("_before <= _t.rank AND _t.rank < _upto")
               .select(*keys, "_bin", "_before", "_t.*"))
    inside = (W.partitionBy(*keys, "_bin", "name", "side").orderBy("_v")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    picked = (binned.join(targets, [*keys, "_bin"])
              .withColumn("_cum", F.col("_before") + F.sum("_n").over(inside))
              .where("rank < _cum AND rank >= _cum - _n"))
    out = []
    for name in probs:
        low = F.max(F.when((F.col("name") == name) & (F.col("side") == "lo"), F.col("_v")))
        high = F.max(F.when((F.col("name") == name) & (F.col("side") == "hi"), F.col("_v")))
        part = F.max(F.when(F.col("name") == name, F.col("at") - F.floor("at")))
        out.append((low + (high - low) * part).alias(name))
    return picked.groupBy(*keys).agg(*out)


SKETCH_K = 800  # size of a sketch: ranks are off by about 0.4 %, well under one


def sketches(df: DataFrame, keys: list[str | Column], value: str, k: int = SKETCH_K) -> DataFrame:
    """One mergeable quantile sketch per group, of bounded size however large the group; nulls are left out.

    Sketches are filled map-side and merged after the shuffle, so a hot group is no single task.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_quantiles(parts: DataFrame, keys: list[str | Column], probs: dict[str, float], k: int = SKETCH_K) -> DataFrame:
    """Quantiles and the number of values (``n``) of every group of stored sketches."""
    merged = parts.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select(
        *[c for c in merged.columns if c != "sketch"], F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(name) for name, q in probs.items()])


def rank_errors(df: DataFrame, found: DataFrame, keys: list[str], value: str, name: str, q: float) -> DataFrame:
    """Per group how far the rank of an estimated quantile is from ``q``: 0 where values equal to it hold that rank."""
    both = df.join(found.select(*keys, F.col(name).alias("_est")), keys)
    n = F.count(value)
    below, upto = (F.count_if(c) / n for c in (F.col(value) < F.col("_est"), F.col(value) <= F.col("_est")))
    return both.groupBy(*keys).agg(F.greatest(F.lit(0.0), below - F.lit(q), F.lit(q) - upto).alias("rank_error"))
