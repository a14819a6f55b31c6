"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers the function under its name; ``sql`` is the DuckDB twin."""

    def register(run: Callable) -> Callable:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register
