"""Registered queries: each pairs a DataFrame plan with the SQL that states its result."""

from __future__ import annotations

from importlib import import_module

SECTIONS = (
    "bar_queries", "feature_queries", "profile_queries", "monitor_queries",
    "incremental_queries", "split_queries", "ensemble_queries", "model_queries", "tree_queries", "stream_queries",
)


def collect(attribute: str) -> dict:
    out: dict = {}
    for section in SECTIONS:
        for name, value in getattr(import_module(f"{__name__}.{section}"), attribute).items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = value
    return out
