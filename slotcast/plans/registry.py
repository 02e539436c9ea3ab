"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; the oracle is
an ANSI/DuckDB SQL string over the same tables (registered as views by the checker).
Queries without an exact SQL form (iterative fits, numeric solves) register no oracle
and are covered by unit tests against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(name: str, ids: str = "", oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = ids
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from . import daily, forecast, hier, learn, lookup, slots, trees  # noqa: F401
