"""The registry of queries and of the SQL that each must equal."""

from __future__ import annotations

from tramline.plans import q_build, q_fares, q_feed, q_joins, q_rail, q_scalars, q_schedule, q_sets, q_sources

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _module in (q_schedule, q_joins, q_fares, q_sets, q_scalars, q_feed, q_build, q_rail, q_sources):
    QUERIES.update(_module.REGISTRY.queries)
    SQL.update(_module.REGISTRY.sql)
