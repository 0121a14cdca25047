"""Registry of named queries: a Spark callable and (where SQL can say it) a DuckDB oracle.

Every Spark query reads the whole fixture tables of ``sf_dir``; doubles are rounded to 6
decimals on both sides so the two engines' last-bit differences do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import round_doubles


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: tuple[str, ...] = field(default_factory=tuple)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.build(spark, sf_dir), 6)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in self.doubles)
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) oracle_q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, tuple(doubles))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module so its ``@register`` calls run."""
    from . import q_hot, q_pool, q_i2i, q_boot, q_stream, q_recall, q_io  # noqa: F401

    return REGISTRY
