from __future__ import annotations

from tidemark.plans import asof, events, models, monitoring, snapshots, stores, vectors, windows

FAMILIES = (windows, asof, snapshots, stores, vectors, monitoring, events, models)

QUERIES = {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}
ORACLE = {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
