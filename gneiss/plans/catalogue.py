"""All registered queries outside the llm subpackage, with their SQL twins."""

from __future__ import annotations

from gneiss.plans import corpus, registry_queries, structure_queries

_LISTED = (corpus.LISTED, registry_queries.LISTED, structure_queries.LISTED)
QUERIES = {name: f for listed in _LISTED for name, f in listed.queries.items()}
ORACLES = {name: sql for listed in _LISTED for name, sql in listed.oracles.items()}
