"""All registered queries of the relational and text operators."""

from __future__ import annotations

from dictaspark.plans import benches, composite, corpus, pairs, relational, scoring  # noqa: F401
from dictaspark.plans.corpus import unit_funnel  # noqa: F401
from dictaspark.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
