"""The operators bound to the test tables, each with an equivalent SQL statement."""

import importlib

from corpusprep.catalog.base import ORACLES, QUERIES

for section in ("documents", "events", "joins", "reports", "rewriting", "streams"):
    importlib.import_module(f"{__name__}.{section}")

__all__ = ["ORACLES", "QUERIES"]
