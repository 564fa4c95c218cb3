"""The same queries as SQL for an independent engine, over the same generated tables."""

from __future__ import annotations

from oracle.relations import RELATIONS, with_relations
from oracle.queries import QUERIES

__all__ = ["RELATIONS", "QUERIES", "statements", "with_relations"]


def statements() -> dict[str, str]:
    """Query name -> one self-contained SQL statement."""
    return {name: with_relations(sql) for name, sql in QUERIES.items()}
