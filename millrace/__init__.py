"""Telemetry lakehouse, service-level and retrieval analytics as Spark jobs."""
