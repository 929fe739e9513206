"""Registered queries and their SQL oracles, one module per family."""

from __future__ import annotations

import importlib

FAMILIES = (
    "sources",
    "projections",
    "joins",
    "aggregations",
    "windows",
    "ranking",
    "sets",
    "temporal",
    "contracts",
    "governance",
    "models",
    "streams",
)


def _collect(name: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        part = getattr(importlib.import_module(f"queries.{family}"), name)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
