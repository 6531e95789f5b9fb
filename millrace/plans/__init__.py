"""Registered queries: each runs over whole stored tables, most with an equivalent SQL text."""

from __future__ import annotations

from millrace.plans.base import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    from millrace.plans import devices, reliability, retrieval, streams, telemetry  # noqa: F401

    return dict(REGISTRY)
