"""Interval joins with windows of any length."""

import math
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators import schedule

WINDOW = "k string, id int, a timestamp, b timestamp"
START = datetime(2023, 1, 1)


def hours(h):
    return START + timedelta(hours=h)


def test_interval_join_equals_brute_force(spark):
    rnd = random.Random(4)
    windows = [("k" + str(i % 3), i, hours(s := rnd.uniform(-2000, 9000)), hours(s + 2 ** rnd.uniform(-8, 14))) for i in range(120)]
    windows += [("k0", 900, hours(5), hours(4)), ("k0", 901, None, hours(4)), ("k0", 902, hours(4), None), ("k1", 903, hours(7), hours(7)),
                (None, 904, hours(0), hours(9000))]
    points = [("k" + str(rnd.randrange(4)), hours(rnd.uniform(-3000, 12_000))) for _ in range(800)] + [("k1", hours(7)), ("k0", None)]
    points += [(w[0], w[2]) for w in windows[:20]] + [(w[0], w[3]) for w in windows[:20]]  # ends belong to a window
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "p int, k string, t timestamp")
    w = spark.createDataFrame(windows, WINDOW)
    want = sorted((i, x[1]) for i, (k, t) in enumerate(points) for x in windows
                  if k == x[0] and t and x[2] and x[3] and x[2] <= t <= x[3])
    for bucket_s in (3600, 60):
        got = schedule.interval_join(df, w, "k", "t", "a", "b", bucket_s)
        assert sorted((r.p, r.id) for r in got.collect()) == want
    assert got.columns == ["k", "p", "t", "id", "a", "b"]
    assert schedule.interval_join(df, w.where("id = 900"), "k", "t", "a", "b").collect() == []


def test_long_windows_are_a_few_blocks(spark):
    lengths = [0.01, 1, 5, 24, 24 * 30, 8760, 87_600]
    w = spark.createDataFrame([("k", i, hours(13.3), hours(13.3 + n)) for i, n in enumerate(lengths)], WINDOW)
    blocks = {r.id: r.n for r in schedule.window_blocks(w, "a", "b").groupBy("id").agg(F.count("*").alias("n")).collect()}
    for i, n in enumerate(lengths):
        assert blocks[i] <= 2 * (math.log2(n + 2) + 1)
    assert blocks[6] < 40 and blocks[1] <= 2
    # Together they cover the window's buckets, once each.
    spans = schedule.window_blocks(w.where("id = 4"), "a", "b").select("_level", "_block").collect()
    buckets = [x for s in spans for x in range(s._block << s._level, (s._block + 1) << s._level)]
    first = int((hours(13.3) - datetime(1970, 1, 1)).total_seconds() // 3600)
    assert sorted(buckets) == list(range(first, first + 721))


def test_interval_totals_are_those_of_the_join(spark):
    rnd = random.Random(9)
    windows = [("k" + str(i % 3), i, hours(s := rnd.uniform(-2000, 9000)), hours(s + 2 ** rnd.uniform(-8, 14))) for i in range(150)]
    windows += [("k0", 900, hours(5), hours(4)), ("k0", 901, None, hours(4)), ("k0", 902, hours(4), None), ("k1", 903, hours(7), hours(7)),
                (None, 904, hours(0), hours(9000)), ("k2", 905, hours(0), hours(9000)), ("k2", 905, hours(0), hours(9000))]
    points = [("k" + str(rnd.randrange(4)), hours(rnd.uniform(-3000, 12_000))) for _ in range(800)]
    points += [("k1", hours(7))] * 5 + [("k0", None), (None, hours(7))]
    points += [(w[0], w[2]) for w in windows[:20]] + [(w[0], w[3]) for w in windows[:20]]
    df, w = spark.createDataFrame(points, "k string, t timestamp"), spark.createDataFrame(windows, WINDOW)
    want = schedule.interval_join(df, w, "k", "t", "a", "b").groupBy("k", "id", "a", "b").agg(
        F.count("*").alias("rows"), F.min("t").alias("first"), F.max("t").alias("last")).collect()
    for ranges in (None, 1, 37):
        got = schedule.interval_totals(df, w, "k", "t", "a", "b", ranges).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 50
    assert schedule.interval_totals(df, w.where("id = 900"), "k", "t", "a", "b").collect() == []
    assert schedule.interval_totals(df.where("k = 'k9'"), w, "k", "t", "a", "b").collect() == []
