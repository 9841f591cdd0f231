"""All queries of the core, gathered from the modules that define them."""

from __future__ import annotations

import importlib

MODULES = ("keys", "documents", "trees", "graphs", "streams")


def _gather(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        got = getattr(importlib.import_module(f"normspark.plans.{m}"), name)
        if clash := out.keys() & got.keys():
            raise ValueError(f"two queries named {sorted(clash)}")
        out |= got
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracles() -> dict:
    return _gather("ORACLES")
