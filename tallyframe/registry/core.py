"""The table of queries: name -> (function over the bound tables, checking SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe.registry.tables import SQL_VIEWS, Tables


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Entry] = {}


def query(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None, views: str = "") -> None:
    """Register a query. ``views`` names the SQL views its check reads, parted by blanks."""
    if name in REGISTRY:
        raise ValueError(f"{name} is registered twice")
    REGISTRY[name] = Entry(build, None if sql is None else with_views(sql, views.split()))


def with_views(sql: str, names: list[str]) -> str:
    """Put the definitions of the named views, and of those they read, in front of the SQL."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name not in needed:
            for other in SQL_VIEWS[name][0]:
                need(other)
            needed.append(name)

    for name in names:
        need(name)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS ({SQL_VIEWS[name][1]})" for name in needed)
    body = sql.strip()
    return f"WITH {parts}{',' + body[4:] if body.upper().startswith('WITH ') else ' ' + body}"


def half_up(total: str, count: str, scale: int) -> str:
    """SQL for ``total / count`` with ``total`` in units of 1, rounded half away from zero, exactly."""
    unit = 10**scale
    return f"CAST(sign({total}) * ((abs({total}) * {2 * unit} + {count}) // (2 * ({count}))) AS DOUBLE) / {unit}"


def mean_cents(amount: str, scale: int = 2) -> str:
    """SQL for the mean of a two-decimal amount, rounded to ``scale`` decimals exactly."""
    cents = f"CAST(sum({amount}) * 100 AS HUGEINT)"
    return half_up(cents, f"(count({amount}) * 100)", scale)
