import datetime as dt
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.columns import fixed_point
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.timewise import as_of_join, as_of_join_ranged, in_ranges, next_in_time

START = dt.datetime(2024, 1, 1)


def skewed_times(n=3000, seed=3):
    """A third of the rows belong to one key."""
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", START + dt.timedelta(seconds=rnd.randrange(200_000)), i)
            for i in range(n)]


def test_next_in_time_equals_plain_lead(spark):
    rows = skewed_times()
    df = spark.createDataFrame(rows, "key string, timestamp timestamp, id int")
    got = {r.id: r.next_timestamp for r in next_in_time(df, ["key"], tie=["id"], bucket_s=900).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((t, i) for k, t, i in rows if k == key)
        for (_, i), following in zip(mine, mine[1:] + [(None, None)]):
            want[i] = following[0]
    assert got == want


def test_as_of_join_equals_brute_force(spark):
    rows, marks = skewed_times(600), skewed_times(300, seed=8)
    left = spark.createDataFrame(rows, "key string, at timestamp, id int")
    right = spark.createDataFrame(marks, "key string, since timestamp, mark int")
    out = as_of_join(left, right, ["key"], "at", "since", ["mark"], ["mark"], bucket_s=3600)
    want = {i: max(((t, m) for k2, t, m in marks if k2 == k and t <= at), default=(None, None))[1] for k, at, i in rows}
    assert {r.id: r.mark for r in out.collect()} == want


def test_ranged_as_of_join_equals_brute_force(spark):
    rows, marks = skewed_times(900), skewed_times(400, seed=8)
    # Ties, a key without right rows, times before all right rows, and rows without a time or a key.
    rows += [("alone", START, 9001), ("hot", START - dt.timedelta(days=400), 9002), ("hot", None, 9003), (None, START, 9004)]
    rows += [("hot", START + dt.timedelta(days=4000), 9005), *[("hot", t, 9100 + m) for _, t, m in marks[:20]]]
    marks += [("hot", marks[0][1], 777), ("hot", None, 778)]
    left = spark.createDataFrame(rows, "key string, at timestamp, id int")
    right = spark.createDataFrame(marks, "key string, since timestamp, mark int")
    want = {i: max(((t, m) for k2, t, m in marks if k2 == k and t and at and t <= at), default=(None, None))[1] for k, at, i in rows}
    for ranges in (1, 7, 40):
        out = as_of_join_ranged(left, right, ["key"], "at", "since", ["mark"], ["mark"], ranges).collect()
        assert len(out) == len(rows) and {r.id: r.mark for r in out} == want
    none = as_of_join_ranged(left, right.where("mark < 0"), ["key"], "at", "since", ["mark"]).collect()
    assert len(none) == len(rows) and all(r.mark is None for r in none)


def test_ranges_spread_a_hot_key(spark):
    df = spark.createDataFrame(skewed_times(30_000), "key string, timestamp timestamp, id int").repartition(4)
    sizes = sorted(r["count"] for r in in_ranges(df, ["key", "timestamp"], 16).groupBy("_range").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]


def test_exact_quantiles_equal_numpy(spark):
    rnd = random.Random(5)
    groups = {"copies": [1.5] * 500 + [9.0], "wide": [rnd.lognormvariate(0, 3) for _ in range(700)], "one": [4.0],
              "two": [1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95, "c": 0.0, "d": 1.0}, bins=16).collect()}
    for g, vs in groups.items():
        np.testing.assert_allclose([got[g].a, got[g].b, got[g].c, got[g].d], np.quantile(vs, [0.5, 0.95, 0, 1]), rtol=1e-12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6), min_size=200, max_size=200))
def test_fixed_point_formats_like_printf(spark, values):
    values += [2.735, 0.125, 0.375, 1.005, 9.995, 99.999, -0.5, 0.0163]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fixed_point(F.col("v"), 2).alias("two"), fixed_point(F.col("v"), 4).alias("four"))
    for r in df.collect():
        if abs(r.v) >= 0.005:
            assert (r.two, r.four) == (f"{r.v:.2f}", f"{r.v:.4f}")
