"""Threshold rules over telemetry, as data: one pass over Silver fires any number of rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import fixed_point


@dataclass(frozen=True)
class Rule:
    device_type: str
    metric: str
    low: float | None
    high: float | None
    event_type: str
    severity: str
    error_code: str
    id_prefix: str
    text: str  # {value}, {low} and {high} are filled in
    action: str

    def breached(self) -> Column:
        v = F.col(self.metric).cast("double")
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | (v < self.low)
        if self.high is not None:
            bad = bad | (v > self.high)
        return (F.col("device_type") == self.device_type) & bad

    def message(self) -> Column:
        text = self.text.replace("{low}", str(self.low)).replace("{high}", str(self.high))
        before, after = text.split("{value}")
        return F.concat(F.lit(before), F.col(self.metric).cast("string"), F.lit(after))


# Thresholds, codes and texts of the device rules.
DEFAULT_RULES = (
    Rule("cnc_machine", "vibration_mm_s", None, 2.0, "threshold_breach", "warning",
         "VIB_HIGH_001", "vib", "Vibration exceeded threshold: {value}mm/s (limit: {high}mm/s)",
         "Inspect tool balance, check spindle bearings"),
    Rule("cnc_machine", "tool_temperature_c", None, 85.0, "threshold_breach", "warning",
         "TEMP_HIGH_001", "temp", "Tool temperature exceeded threshold: {value}°C (limit: {high}°C)",
         "Check coolant flow, reduce cutting speed"),
    Rule("conveyor", "motor_temperature_c", None, 80.0, "threshold_breach", "warning",
         "MOTOR_TEMP_HIGH_001", "temp", "Motor temperature high: {value}°C (limit: {high}°C)",
         "Reduce belt speed, check motor ventilation"),
    Rule("conveyor", "load_weight_kg", None, 200.0, "overload", "warning",
         "OVERLOAD_001", "overload", "Conveyor overloaded: {value}kg (limit: {high}kg)",
         "Remove excess load, check belt tension"),
    Rule("hvac", "air_temperature_c", 18.0, 26.0, "threshold_breach", "warning",
         "TEMP_OUT_OF_RANGE_001", "temp", "Air temperature out of range: {value}°C (target: {low}-{high}°C)",
         "Check thermostat settings, inspect air flow"),
    Rule("hvac", "compressor_pressure_psi", 200.0, 300.0, "threshold_breach", "warning",
         "PRESSURE_ABNORMAL_001", "pressure",
         "Compressor pressure abnormal: {value} PSI (normal: {low}-{high} PSI)",
         "Check refrigerant levels, inspect compressor"),
    Rule("hvac", "filter_life_pct", 20.0, None, "maintenance_required", "info",
         "FILTER_REPLACE_001", "filter", "Air filter replacement needed: {value}% remaining",
         "Schedule filter replacement"),
)


def threshold_events(silver: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """One event row per breached rule and reading; works on batches and streams alike."""
    null = F.lit(None).cast("double")
    fired = []
    for r in rules:
        two_sided = r.low is not None and r.high is not None
        single = null if two_sided else F.lit(r.high if r.high is not None else r.low)
        fired.append(F.when(r.breached(), F.struct(
            F.lit(r.id_prefix).alias("id_prefix"),
            F.lit(r.event_type).alias("event_type"),
            F.lit(r.severity).alias("severity"),
            r.message().alias("message"),
            F.lit(r.error_code).alias("error_code"),
            F.lit(r.metric).alias("metric"),
            F.col(r.metric).cast("double").alias("value"),
            single.alias("threshold"),
            (F.lit(r.low) if two_sided else null).alias("threshold_min"),
            (F.lit(r.high) if two_sided else null).alias("threshold_max"),
            F.lit(r.action).alias("recommended_action"))))
    hits = F.filter(F.array(*fired), lambda x: x.isNotNull())
    one = silver.select("device_id", "customer_id", "timestamp", F.explode(hits).alias("e"))
    # Ids use the event time, so a replay gives the same ids.
    event_id = F.concat_ws("-", F.lit("evt"), "e.id_prefix", "device_id",
                           F.unix_timestamp("timestamp").cast("string"))
    return one.select(event_id.alias("event_id"), "device_id", "customer_id", "timestamp",
                      "e.event_type", "e.severity", "e.message", "e.error_code", "e.metric", "e.value",
                      "e.threshold", "e.threshold_min", "e.threshold_max", "e.recommended_action")


# Fixed values: (parameter, warning above, critical above) of the machine manual.
PARAMETER_BANDS = (
    ("spindle_rpm", None, 8200.0),
    ("tool_temperature_c", 75.0, 85.0),
    ("vibration_mm_s", 1.5, 2.0),
    ("power_kw", 12.0, 14.0),
)


def parameter_bands(silver: DataFrame, bands=PARAMETER_BANDS) -> DataFrame:
    """Long form of the banded parameters of CNC rows: normal, warning or critical each."""
    cells = []
    for name, warn, crit in bands:
        v = F.col(name)
        level = F.when(v > crit, "critical")
        if warn is not None:
            level = level.when(v > warn, "warning")
        cells.append(F.struct(F.lit(name).alias("parameter"), v.alias("value"),
                              level.otherwise("normal").alias("level")))
    return (silver.where("device_type = 'cnc_machine'")
            .select("device_id", "timestamp", F.explode(F.array(*cells)).alias("c"))
            .select("device_id", "timestamp", "c.*").where("value IS NOT NULL"))


def band_table(spark: SparkSession, bands=PARAMETER_BANDS) -> DataFrame:
    """The same bands as rows ``(parameter, level, above, upto)`` for a range join."""
    rows = []
    for name, warn, crit in bands:
        rows.append((name, "normal", None, warn if warn is not None else crit))
        if warn is not None:
            rows.append((name, "warning", warn, crit))
        rows.append((name, "critical", crit, None))
    return spark.createDataFrame(rows, "parameter string, level string, above double, upto double")


def band_join(readings: DataFrame, bands: DataFrame) -> DataFrame:
    """Readings ``(parameter, value, ...)`` matched to the interval that holds the value."""
    inside = ((F.col("b.above").isNull() | (F.col("value") > F.col("b.above")))
              & (F.col("b.upto").isNull() | (F.col("value") <= F.col("b.upto"))))
    return (readings.alias("r").join(bands.alias("b"), (F.col("r.parameter") == F.col("b.parameter")) & inside)
            .select("r.*", "b.level"))


MAINTENANCE_CYCLES = 5000


def maintenance_due(silver: DataFrame, cycles: int = MAINTENANCE_CYCLES) -> DataFrame:
    """First reading per device at or over the cycle limit."""
    due = silver.where(F.col("cycle_count") >= cycles)
    return (due.groupBy("device_id", "customer_id")
            .agg(F.min("timestamp").alias("due_since"), F.max("cycle_count").alias("cycle_count")))


# Metric -> alert threshold of the device insights.
INSIGHT_THRESHOLDS = {"temperature": 80.0, "vibration": 2.0, "pressure": 100.0}
INSIGHT_COLUMNS = {"temperature": "temperature_c", "vibration": "vibration_mm_s",
                   "pressure": "compressor_pressure_psi"}


def device_insights(silver: DataFrame, asof: str, hours: int = 24, tie: str | None = None,
                    thresholds: dict = INSIGHT_THRESHOLDS, columns: dict = INSIGHT_COLUMNS) -> DataFrame:
    """Current and average value per device and metric in the look-back, with a status."""
    if not 1 <= hours <= 168:
        raise ValueError("look-back must be 1 to 168 hours")
    end = F.lit(asof).cast("timestamp")
    recent = silver.where((F.col("timestamp") > end - F.make_dt_interval(hours=F.lit(hours)))
                          & (F.col("timestamp") <= end))
    order = F.struct("timestamp", tie) if tie else F.struct("timestamp")
    aggs = []
    for metric, column in columns.items():
        seen = F.col(column).isNotNull()
        aggs += [F.max_by(F.when(seen, F.col(column)), F.when(seen, order)).alias(f"{metric}_current"),
                 F.avg(column).alias(f"{metric}_avg")]
    wide = recent.groupBy("device_id").agg(*aggs)
    cells = [F.struct(F.lit(m).alias("metric"), F.col(f"{m}_current").alias("current_value"),
                      F.col(f"{m}_avg").alias("avg_value"), F.lit(float(thresholds[m])).alias("threshold"))
             for m in columns]
    long = (wide.select("device_id", F.explode(F.array(*cells)).alias("c")).select("device_id", "c.*")
            .where("current_value IS NOT NULL"))
    status = (F.when(F.col("current_value") > F.col("threshold"), "critical")
              .when(F.col("current_value") > F.col("threshold") * 0.8, "warning").otherwise("normal"))
    return long.withColumn("status", status)


# Texts of the advice.
CRITICAL_ADVICE = ("⚠️  CRITICAL: ", " at ", " exceeds threshold ", " - immediate action required")
WARNING_ADVICE = ("⚡ WARNING: ", " at ", " approaching threshold ", " - monitor closely")
NORMAL_ADVICE = "✅ All metrics within normal ranges - no action needed"


def recommendations(insights: DataFrame) -> DataFrame:
    """One advice per abnormal metric, or a single all-normal row per device."""
    current = fixed_point(F.col("current_value"), 2)
    limit = F.col("threshold").cast("string")

    def advice(texts: tuple[str, str, str, str]) -> Column:
        lead, at, over, end = map(F.lit, texts)
        return F.concat(lead, "metric", at, current, over, limit, end)

    text = (F.when(F.col("status") == "critical", advice(CRITICAL_ADVICE))
            .when(F.col("status") == "warning", advice(WARNING_ADVICE)))
    normal = F.array(F.lit(NORMAL_ADVICE))
    texts = F.array_sort(F.collect_list(text))
    grouped = insights.groupBy("device_id").agg(texts.alias("texts"))
    return grouped.select("device_id", F.explode(
        F.when(F.size("texts") > 0, F.col("texts")).otherwise(normal)).alias("recommendation"))
