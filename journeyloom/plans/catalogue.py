"""All registered queries: what each computes on a data folder and the SQL to match."""

from __future__ import annotations

from journeyloom.plans.registry import Query, parse

QUERIES: dict[str, Query] = {}


def register(name: str, columns: str, build, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    QUERIES[name] = Query(parse(columns), build, sql)


from journeyloom.plans import (  # noqa: E402
    analysis_queries,
    attribution_queries,
    journey_queries,
)

for _module in (journey_queries, attribution_queries, analysis_queries):
    _module.register_all(register)
