"""Registered queries with the SQL each one has to agree with."""

from __future__ import annotations

from . import ingest, merge, profiles, quality, reports, rules, storage, streams, velocity, warehouse
from .base import Entry

_MODULES = (ingest, velocity, rules, profiles, reports, merge, warehouse, quality, streams, storage)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in _MODULES:
        for name, entry in module.ENTRIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
