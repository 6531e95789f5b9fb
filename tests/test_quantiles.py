"""Mergeable quantile sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.quantiles import merged_quantiles, rank_errors, sketches


def frame(spark, n=60_000, seed=2):
    rng = np.random.default_rng(seed)
    # One group holds two thirds of the rows; another has a single value.
    group = np.where(rng.random(n) < 0.66, 0, rng.integers(1, 6, n))
    value = np.where(group == 5, 1.0, rng.lognormal(0, 2, n))
    rows = [(int(g), int(i % 50), float(v)) for i, (g, v) in enumerate(zip(group, value))]
    return spark.createDataFrame(rows + [(9, 0, None)], "g int, part int, v double").repartition(6)


@pytest.mark.parametrize("q", [0.01, 0.5, 0.95, 0.99])
def test_merged_sketches_keep_their_rank(spark, q):
    df = frame(spark)
    found = merged_quantiles(sketches(df, ["g", "part"], "v"), ["g"], {"est": q})
    got = {r.g: r.n for r in found.collect()}
    assert got == {r.g: r["count"] for r in df.where("v IS NOT NULL").groupBy("g").count().collect()}
    errors = rank_errors(df, found, ["g"], "v", "est", q).collect()
    assert len(errors) == len(got) and max(r.rank_error for r in errors) <= 0.01


def test_a_wrong_estimate_has_a_rank_error(spark):
    df = spark.createDataFrame([(1, float(i)) for i in range(100)], "g int, v double")
    wrong = spark.createDataFrame([(1, 49.0)], "g int, est double")
    assert rank_errors(df, wrong, ["g"], "v", "est", 0.95).first().rank_error == pytest.approx(0.45)


def test_size_of_a_sketch_does_not_grow_with_its_group(spark):
    df = frame(spark)
    size = sketches(df, ["g"], "v").select(F.max(F.length("sketch"))).first()[0]
    assert size < 40_000
