"""Screening of text for instruction injection and personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns searched in the lower-cased text.
INJECTION_PATTERNS = [
    r"ignore\s+(previous|all|the)\s+(instructions?|rules?|prompts?)",
    r"disregard\s+(previous|all|the)",
    r"forget\s+(everything|all|previous)",
    r"new\s+instructions?:",
    r"system\s*:\s*you\s+are",
    r"<\s*\/?system\s*>",
    r"sudo\s+mode",
    r"developer\s+mode",
    r"jailbreak",
    r"pretend\s+(you|to)\s+(are|be)",
]

# Kind of personal data -> pattern.
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b",
    "phone": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
}

# Warnings and severities.
INJECTION_WARNING = "Potential prompt injection detected"
PII_WARNING = "PII detected in input"
FOUND, NOT_FOUND = "high", "none"

# Word characters, digits and word edges follow Unicode.
UNICODE = "(?U)"


def matching(text: Column, patterns: dict[str, str]) -> Column:
    """Labels of the patterns found; each pattern is a literal, compiled once per task."""
    found = [F.when(text.rlike(UNICODE + p), F.lit(label)) for label, p in patterns.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def screen(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds matched patterns, personal data kinds, severities, the verdict and its warnings."""
    lowered = df.withColumn("_lower", F.lower(text_col))
    injection = matching(F.col("_lower"), {p: p for p in INJECTION_PATTERNS})
    out = lowered.withColumns({
        "injection_patterns": F.coalesce(injection, F.array().cast("array<string>")),
        "pii_types": F.coalesce(matching(F.col(text_col), PII_PATTERNS), F.array().cast("array<string>")),
    }).drop("_lower")
    has_injection, has_pii = F.size("injection_patterns") > 0, F.size("pii_types") > 0
    warnings = F.filter(F.array(
        F.when(has_injection, INJECTION_WARNING),
        F.when(has_pii, PII_WARNING)), lambda w: w.isNotNull())
    return out.withColumns({
        "injection_severity": F.when(has_injection, FOUND).otherwise(F.lit(NOT_FOUND)),
        "pii_severity": F.when(has_pii, FOUND).otherwise(F.lit(NOT_FOUND)),
        "safe": ~(has_injection | has_pii),
        "warnings": warnings,
    })


def scrub(text: Column, patterns: dict[str, str] = PII_PATTERNS) -> Column:
    """Replaces personal data by its kind in brackets, kinds in their listed order."""
    out = text
    for kind, pattern in patterns.items():
        out = F.regexp_replace(out, UNICODE + pattern, f"[{kind.upper()}]")
    return out


def rejections(screened: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rejected rows by type over all rows, and whether their share calls for an alert."""
    injected = F.count_if(F.size("injection_patterns") > 0)
    personal = F.count_if(F.size("pii_types") > 0)
    rejected = F.count_if(~F.col("safe"))
    counts = screened.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), injected.alias("prompt_injection"),
        personal.alias("pii"), rejected.alias("rejected"))
    pct = F.lit(100.0) * F.col("rejected").cast("double") / F.nullif(F.col("total").cast("double"), F.lit(0.0))
    return counts.withColumn("rejected_pct", pct).withColumn("alert", pct > 10.0)
