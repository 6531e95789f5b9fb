"""Explicit schemas of messages and tables; nothing is inferred from data."""

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("facility", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("coordinates", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ])),
])

# Metric columns of any device type, in Silver order (fixed names and types of the data model).
METRICS = {
    "spindle_rpm": "double",
    "tool_temperature_c": "double",
    "vibration_mm_s": "double",
    "power_kw": "double",
    "cycle_count": "int",
    "feed_rate_mm_min": "int",
    "coolant_level_pct": "int",
    "belt_speed_m_s": "double",
    "motor_temperature_c": "double",
    "load_weight_kg": "double",
    "runtime_hours": "double",
    "air_temperature_c": "double",
    "humidity_pct": "double",
    "compressor_pressure_psi": "double",
    "fan_speed_rpm": "int",
    "filter_life_pct": "int",
}

_TYPES = {"double": T.DoubleType(), "int": T.IntegerType()}

TELEMETRY = T.StructType([
    T.StructField("message_type", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("metrics", T.StructType(
        [T.StructField(name, _TYPES[kind]) for name, kind in METRICS.items()])),
    T.StructField("status", T.StringType()),
    T.StructField("device_timestamp", T.StringType()),
    T.StructField("sent_at", T.StringType()),
    T.StructField("is_backfill", T.BooleanType()),
])

# Column that holds a message the schema could not parse; kept so that Bronze loses nothing.
CORRUPT = "_corrupt_record"
BRONZE = T.StructType(TELEMETRY.fields + [T.StructField(CORRUPT, T.StringType())])

HEARTBEAT = T.StructType([
    T.StructField("message_type", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("uptime_seconds", T.LongType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("network_quality", T.StructType([
        T.StructField("signal_strength_dbm", T.IntegerType()),
        T.StructField("packet_loss_pct", T.DoubleType()),
    ])),
])

DEVICE_STATE = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("facility", T.StringType()),
    T.StructField("last_seen_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("offline_since", T.TimestampType()),
    T.StructField("offline_reason", T.StringType()),
    T.StructField("consecutive_missed_heartbeats", T.LongType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("uptime_seconds", T.LongType()),
])

HOURS = T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())])

SCHEDULE = T.StructType([
    T.StructField("entity_type", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("schedule_type", T.StringType()),
    T.StructField("weekly_schedule", T.MapType(T.StringType(), HOURS)),
    T.StructField("holidays", T.ArrayType(T.DateType())),
    T.StructField("maintenance_windows", T.ArrayType(T.StructType([
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("reason", T.StringType()),
    ]))),
    T.StructField("effective_from", T.TimestampType()),
    T.StructField("effective_until", T.TimestampType()),
])
