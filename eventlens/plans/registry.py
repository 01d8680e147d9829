"""Collects every registered query and its DuckDB oracle."""

from __future__ import annotations

import importlib

PLAN_MODULES = ("ingest", "prep", "groups", "scoring", "vectors", "summaries", "entities", "io")


def _modules():
    return [importlib.import_module(f"eventlens.plans.{m}") for m in PLAN_MODULES]


def queries():
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracles():
    out = {}
    for m in _modules():
        out.update(m.ORACLES)
    return out
