"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

import importlib

AREAS = ("reco", "cart", "feeds", "content")


def _merged(name: str) -> dict:
    out: dict = {}
    for area in AREAS:
        part = getattr(importlib.import_module(f"registry.{area}"), name)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracles() -> dict:
    return _merged("ORACLES")
