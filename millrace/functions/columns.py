"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds (with fraction) from one instant to another."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS))


def time_bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * MICROS))


def overlap_micros(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Length of the intersection of two intervals in whole microseconds, zero when disjoint or unknown."""
    start = F.unix_micros(F.greatest(start_a, start_b))
    end = F.unix_micros(F.least(end_a, end_b))
    known = start_a.isNotNull() & end_a.isNotNull() & start_b.isNotNull() & end_b.isNotNull()
    return F.when(known, F.greatest(F.lit(0).cast("long"), end - start)).otherwise(F.lit(0).cast("long"))


def ratio(num: Column, den: Column) -> Column:
    """Division as doubles with a null instead of an error for an empty denominator."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def share(condition: Column) -> Column:
    """Fraction of rows of a group on which a condition holds."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def is_server_error(status: Column) -> Column:
    return status.startswith("5")


def device_temperature() -> Column:
    """One temperature per row whatever the device type."""
    return F.coalesce("tool_temperature_c", "motor_temperature_c", "air_temperature_c")


def quality_score(names=("vibration_mm_s", "temperature_c", "power_kw")) -> Column:
    """Share of the key measurements that are present."""
    present = [F.col(n).isNotNull().cast("int") for n in names]
    return reduce(lambda a, b: a + b, present).cast("double") / F.lit(float(len(names)))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def document_key(source_path: Column, version: Column) -> Column:
    """Stable 16-character document id of a path and its version."""
    joined = F.concat_ws(":", source_path, F.coalesce(version, F.lit("1.0")))
    return F.substring(F.sha2(joined, 256), 1, 16)


def cache_key(query: Column, tenant: Column, *params: Column) -> Column:
    """Digest of a request; parameters are passed in a fixed order."""
    return F.sha2(F.concat_ws(":", query, tenant, *params), 256)


def band(value: Column, steps: list[tuple[float, str]], below: str) -> Column:
    """Label of the highest step whose lower bound the value reaches."""
    out = F.lit(below)
    for bound, label in steps:
        out = F.when(value >= F.lit(float(bound)), F.lit(label)).otherwise(out)
    return F.when(value.isNotNull(), out)


def fixed_point(value: Column, digits: int) -> Column:
    """Decimal text of a double with ``digits`` places, rounded from its exact binary value.

    ``format_string`` rounds the shortest decimal form of a double instead, which differs on values
    such as 2.735.  The fraction is taken as an integer number of 2^-60 steps, exactly.
    """
    size = F.abs(value)
    whole = F.floor(size)
    steps = F.floor((size - whole) * F.lit(float(2 ** 60))).cast("decimal(20,0)")
    scaled = steps * F.lit(10 ** digits).cast("decimal(10,0)")
    unit = F.lit(2 ** 60).cast("decimal(20,0)")
    quotient = F.call_function("div", scaled, unit)
    rest = scaled - quotient.cast("decimal(20,0)") * unit
    half = F.lit(2 ** 59).cast("decimal(20,0)")
    up = (rest > half) | ((rest == half) & (quotient % 2 == 1))
    number = quotient + up.cast("long")
    carry = number == 10 ** digits
    text = F.concat(
        (whole + carry.cast("long")).cast("string"), F.lit("."),
        F.lpad(F.when(carry, 0).otherwise(number).cast("string"), digits, "0"))
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)
