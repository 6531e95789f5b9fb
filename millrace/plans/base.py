"""Registration of queries and the plain output types both engines share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import pin_utc


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates, instants, arrays and decimals as text, bigint or double, for comparison by value."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType
        if isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        elif isinstance(kind, (T.ShortType, T.IntegerType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 10, **special: int) -> DataFrame:
    """Doubles rounded, so that summation order does not show in the last digits."""
    return df.withColumns({
        f.name: F.round(F.col(f.name), special.get(f.name, digits))
        for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)})


def query(name: str, covers: str, sql: str | None = None):
    """Registers ``fn(spark, root)`` under a name with the inventory items it covers."""
    def add(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return plain(fn(pin_utc(spark), root))

        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql, covers)
        return fn

    return add


def ts(expr: str) -> str:
    """SQL text of an instant in the shared format."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


TELEMETRY = r"""telemetry AS (
  SELECT 'dev-' || d AS device_id, 'cust-' || (d % 4) AS customer_id,
         CASE d % 3 WHEN 0 THEN 'cnc_machine' WHEN 1 THEN 'conveyor' ELSE 'hvac' END AS device_type,
         'model-' || (d % 3) AS model, '1.' || (d % 2) AS firmware_version, ts AS "timestamp",
         'fac-' || (d % 5) AS facility, 'zone-' || (d % 2) AS zone,
         CASE WHEN d % 3 = 0 THEN value * 16.0 END AS spindle_rpm,
         CASE WHEN d % 3 = 0 THEN CAST(k AS DOUBLE) + 40.0 END AS tool_temperature_c,
         CASE WHEN d % 3 <> 2 THEN value / 4.0 END AS vibration_mm_s,
         value / 16.0 AS power_kw,
         CAST(event_id AS INT) AS cycle_count,
         CASE WHEN d % 3 = 0 THEN k * 2 END AS feed_rate_mm_min,
         CASE WHEN d % 3 = 0 THEN k END AS coolant_level_pct,
         CASE WHEN d % 3 = 1 THEN value / 128.0 END AS belt_speed_m_s,
         CASE WHEN d % 3 = 1 THEN CAST(k AS DOUBLE) + 40.0 END AS motor_temperature_c,
         CASE WHEN d % 3 = 1 THEN value * 2.0 END AS load_weight_kg,
         CASE WHEN d % 3 = 1 THEN value / 8.0 END AS runtime_hours,
         CASE WHEN d % 3 = 2 THEN CAST(k AS DOUBLE) / 2.0 END AS air_temperature_c,
         CASE WHEN d % 3 = 2 THEN CAST(k AS DOUBLE) END AS humidity_pct,
         CASE WHEN d % 3 = 2 THEN value * 4.0 END AS compressor_pressure_psi,
         CASE WHEN d % 3 = 2 THEN k * 8 END AS fan_speed_rpm,
         CASE WHEN d % 3 = 2 THEN k END AS filter_life_pct,
         event_type AS status,
         ts + to_minutes(CAST(event_id % 20 AS INT)) AS sent_at,
         event_id AS message_id, user_id
  FROM (SELECT *, user_id % 12 AS d,
               CAST(regexp_extract(props, '(\d+)', 1) AS INT) AS k FROM events) e)"""

REQUESTS = r"""requests AS (
  SELECT event_id AS request_id, ts,
         CASE event_type WHEN 'click' THEN 'insights' WHEN 'purchase' THEN 'troubleshoot'
              WHEN 'signup' THEN 'health' ELSE 'ask' END AS endpoint,
         CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status_code,
         value / 64.0 AS duration_s,
         (CASE event_type WHEN 'click' THEN 'insights' WHEN 'purchase' THEN 'troubleshoot'
              WHEN 'signup' THEN 'health' ELSE 'ask' END) || ':' || user_id AS cache_key,
         k % 6 AS citations, CAST(k AS DOUBLE) / 128.0 AS "precision", CAST(k AS DOUBLE) AS gpu_pct,
         k < 12 AS rejected, k >= 50 AS cache_hit
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INT) AS k FROM events) e)"""

CORPUS = """corpus AS (
  SELECT doc_id, 'tenant-' || (doc_id % 4) AS tenant_id,
         CASE doc_id % 4 WHEN 0 THEN 'manual' WHEN 1 THEN 'runbook' WHEN 2 THEN 'kb_article' ELSE 'ADR' END AS doc_type,
         'doc-' || doc_id AS title, source || '/' || doc_id AS source_path, source, '1.0' AS version,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS last_updated, text AS content
  FROM documents)"""

CHUNKS = """chunks AS (
  SELECT doc_id AS document_id, i AS chunk_index, tenant_id, doc_type, title, source_path, source, version,
         last_updated, substring(content, CAST(462 * i + 1 AS BIGINT), 512) AS content
  FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil((length(content) - 50) / 462.0) AS BIGINT)))) AS i
        FROM corpus) c)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
