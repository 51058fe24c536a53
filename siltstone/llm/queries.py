"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, jaccard, lm_scoring, nearest, packing, pii, quality, sharding, warc

MODULES = [pii, warc, packing, sharding, jaccard, lm_scoring, decontaminate, nearest, quality, chat]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
