"""Hot tenants of a stream."""

import random
from collections import Counter
from datetime import timedelta

from millrace.streaming import hot, jobs, late
from tests.test_late import START, stream

ROWS = "customer_id string, timestamp timestamp, message_id long, facility string"


def skewed(rnd, n, busy, start_h=0.0):
    """A busy tenant with a third of the rows, one with 9 %, and many small ones."""
    out = []
    for i in range(n):
        r = rnd.random()
        name = busy if r < 0.33 else "middle" if r < 0.42 else f"small-{rnd.randrange(300)}"
        out.append((name, START + timedelta(hours=start_h + i / n), rnd.randrange(1 << 40), f"f{rnd.randrange(3)}"))
    return out


def found(spark, batches, **options):
    with late.keyed_state(spark):
        told = jobs.run_to_files(hot.summaries(stream(spark, batches, ROWS), **options), "hot-test")
    return told, {r.tenant: r.traffic_share for r in hot.hot_tenants(told).collect()}


def test_busy_tenants_are_found_and_others_are_not(spark):
    rnd = random.Random(1)
    batches = [skewed(rnd, 1500, "busy", h) for h in range(3)]
    told, shares = found(spark, batches)
    assert set(shares) == {"busy"} and 0.31 < shares["busy"] < 0.37
    assert told.groupBy("lane", "at", "total").count().agg({"count": "max"}).first()[0] <= hot.CAPACITY
    rows = spark.createDataFrame(batches[0] + [(None, START, 1, "f0")], ROWS)
    keys = {r.routing_key for r in hot.split_keys(rows, hot.hot_tenants(told)).collect()}
    assert {"busy:f0", "busy:f1", "busy:f2", "middle"} <= keys and "busy" not in keys and None in keys


def test_old_traffic_decays(spark):
    rnd = random.Random(2)
    batches = [skewed(rnd, 1500, "past"), skewed(rnd, 600, "now", 72.0)]
    assert set(found(spark, batches, half_life_s=12 * 3600)[1]) == {"now"}
    assert "past" in found(spark, batches, half_life_s=10_000 * 3600)[1]


def test_summary_bounds():
    rnd = random.Random(3)
    names = [f"t{min(int(rnd.expovariate(0.05)), 400)}" for _ in range(20_000)]
    summary, exact = hot.Summary(32), Counter(names)
    for name in names:
        summary.add(name, 1)
    for name, (weight, error) in summary.weights.items():
        assert weight - error <= exact[name] <= weight <= exact[name] + summary.total / 32
    assert all(name in summary.weights for name, n in exact.items() if n > summary.total / 32)
