"""All named queries."""

from __future__ import annotations

from quarryline.plans import catalogue, coverage, evidence, lifecycle, measures, mining, resolution, shelving, texts

MODULES = [coverage, texts, measures, evidence, catalogue, shelving, lifecycle, resolution, mining]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.R.queries.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.R.oracles.items()}
