"""All queries of this package and their SQL."""

from __future__ import annotations

import importlib

MODULES = ["q_tables", "q_jaccard", "q_models", "q_search", "q_pieces", "q_phrases", "q_vectors"]

QUERIES, ORACLE = {}, {}
for _name in MODULES:
    _module = importlib.import_module(f"logwarden.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
