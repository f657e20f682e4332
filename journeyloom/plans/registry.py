"""Registration of queries together with the SQL they are checked against.

One column list per query drives both sides: names, result types and the number of
decimals doubles are rounded to (sums arrive in another order in another engine).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Tables:
    """The inputs of a query: lazily built tables of one data folder."""

    spark: SparkSession
    folder: str
    _built: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    @property
    def touches(self) -> DataFrame:
        from journeyloom.sources.touchpoints import events_to_touchpoints

        return self._once("touches", lambda: events_to_touchpoints(self.raw("events")))

    @property
    def unnumbered(self) -> DataFrame:
        """Touches without positions, for what reads none: no pass to number them."""
        from journeyloom.sources.touchpoints import events_to_touchpoints

        return self._once("unnumbered", lambda: events_to_touchpoints(self.raw("events"), numbered=False))

    @property
    def sessions(self) -> DataFrame:
        from journeyloom.sources.touchpoints import events_to_ga_sessions

        return self._once("sessions", lambda: events_to_ga_sessions(self.raw("events")))

    @property
    def ga_touches(self) -> DataFrame:
        from journeyloom.sources.touchpoints import ga_sessions_to_touchpoints

        return self._once("ga", lambda: ga_sessions_to_touchpoints(self.sessions))

    @property
    def attributed(self) -> DataFrame:
        from journeyloom.operators.compare import attribute_all

        return self._once("attributed", lambda: attribute_all(self.touches))


@dataclass
class Query:
    columns: list[tuple[str, str]]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder)).select(*[_spark(n, t) for n, t in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return f"SELECT {', '.join(_sql(n, t) for n, t in self.columns)} FROM ({self.sql.strip()})"


def parse(columns: str) -> list[tuple[str, str]]:
    """'channel, touches:i, cost:4' -> names with type s, i, a or a number of decimals."""
    return [tuple((c.strip() + ":s").split(":")[:2]) for c in columns.split(",")]


def _spark(name: str, kind: str):
    column = F.col(name)
    if kind == "i":
        return column.cast("long").alias(name)
    if kind == "a":
        return F.array_join(column, ">").alias(name)
    if kind == "s":
        return column.cast("string").alias(name)
    return F.round(column.cast("double") + _nudge(kind), int(kind)).alias(name)


def _sql(name: str, kind: str) -> str:
    if kind == "i":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind == "a":
        return f"array_to_string({name}, '>') AS {name}"
    if kind == "s":
        return f"CAST({name} AS VARCHAR) AS {name}"
    return f"round(CAST({name} AS DOUBLE) + {_nudge(kind)!r}, {kind}) AS {name}"


def _nudge(kind: str) -> float:
    """Lifts values that end in an exact 5 clear of the rounding edge, on both sides alike."""
    return float(f"1e-{int(kind) + 3}")
