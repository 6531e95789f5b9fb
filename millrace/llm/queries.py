"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

from millrace.llm.common import Run
from millrace.session import pin_utc

MODULES = {
    "op1_warc": "warc",
    "op2_quality": "quality",
    "op3_substring": "substrings",
    "op4_packing": "packing",
    "op5_outliers": "outliers",
    "op6_urls": "urls",
    "op7_simhash": "simhash",
    "op8_bpe": "bpe",
    "op9_pii": "pii",
    "op10_embeddings": "embeddings",
    "op11_periodic": "periodic",
    "op12_alignment": "alignment",
    "op13_language": "languages",
}


def _module(name: str):
    return importlib.import_module(f"millrace.llm.{MODULES[name]}")


def _run(name: str) -> Run:
    run = _module(name).query
    return lambda spark, root: run(pin_utc(spark), root)


def queries() -> dict[str, Run]:
    return {name: _run(name) for name in MODULES}


def oracle_sql() -> dict[str, str]:
    return {name: _module(name).SQL for name in MODULES if getattr(_module(name), "SQL", None)}
