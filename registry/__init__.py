"""Wiring of the operators to the driver tables: one registered query per operator."""

from __future__ import annotations

import importlib

from registry.core import ORACLE, QUERIES

MODULES = (
    "calendar_queries",
    "reference_queries",
    "index_queries",
    "source_queries",
    "quality_queries",
    "api_queries",
    "validation_queries",
    "optical_queries",
    "landcover_queries",
    "radar_queries",
    "spatial_queries",
    "study_queries",
)


def load() -> tuple[dict, dict]:
    for name in MODULES:
        importlib.import_module(f"registry.{name}")
    return QUERIES, ORACLE
