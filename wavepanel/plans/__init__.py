"""Named queries over the test tables (one per operator of the survey)."""

from __future__ import annotations

import importlib

_MODULES = ["crosswalk", "panel_core", "diagnostics", "scalars", "extracts", "importer"]


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(importlib.import_module(f"wavepanel.plans.{m}").QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(importlib.import_module(f"wavepanel.plans.{m}").SQL)
    return out
