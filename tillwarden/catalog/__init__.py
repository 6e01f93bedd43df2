"""Named queries over the driver's tables, each with its checking SQL where SQL can say it."""

from __future__ import annotations

import importlib

_AREAS = ("warehouse", "detection", "ledger", "lifecycle", "quality", "streams")


def load():
    for area in _AREAS:
        importlib.import_module(f"{__name__}.{area}")
    from .base import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
