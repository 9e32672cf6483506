"""Queries and SQL of this subpackage, gathered from its modules."""

from __future__ import annotations

import importlib
import pkgutil

import siltworks.llm as _package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _found in sorted(m.name for m in pkgutil.iter_modules(_package.__path__) if m.name.startswith("p0")):
    _module = importlib.import_module(f"siltworks.llm.{_found}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
