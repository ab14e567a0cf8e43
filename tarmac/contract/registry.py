"""All registered queries."""

from __future__ import annotations

from tarmac.contract import modelled, prepare, profiled, sampled, tested

_MODULES = [prepare, sampled, profiled, tested, modelled]
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
