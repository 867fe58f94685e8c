"""All registered queries and their checking SQL."""

from __future__ import annotations

from importlib import import_module

AREAS = ("files", "rules", "convert", "intake", "export", "history", "deadlines", "views", "streams")

QUERIES, ORACLES = {}, {}
for _area in AREAS:
    _module = import_module(f"ferrybook.queries.{_area}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
