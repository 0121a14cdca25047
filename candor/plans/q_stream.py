"""Registered Structured Streaming queries (file source, availableNow)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures as X
from ..streaming.boot_stream import stream_boot
from ..streaming.counters_stream import COUNTERS, GENDERS, SPLIT, stream_counters, with_gender
from .fixture_sql import AS_OF, EVENTS_AS_OF, VIEWS, with_views
from .params import BOOT_DAYS
from .q_boot import _TRANSITION_BODY, _TRANSITION_CTES
from .registry import register

_SUMS = ", ".join(f"CAST(sum(CASE WHEN counter = '{c}' THEN amount ELSE 0 END) AS BIGINT) AS \"{c}\"" for c in COUNTERS)
_SUMS += ", " + ", ".join(f"CAST(sum(CASE WHEN counter = '{c}' AND gender = {g} THEN amount ELSE 0 END) AS BIGINT) AS \"s{g}_{c}\""
                          for g in GENDERS for c in COUNTERS)
_LIVE_CTE = "live AS (SELECT e.*, coalesce(u.gender, 0) AS gender FROM exposures e LEFT JOIN users u ON u.mid = e.mid)"
_COUNTERS_SQL = with_views(f"""
SELECT pid, CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS start, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, {_SUMS}
FROM live GROUP BY pid, CAST(ts AS DATE)""", "exposures", "users", extra=[_LIVE_CTE])


def live_events(spark: SparkSession, d: str) -> DataFrame:
    return with_gender(X.exposure_stream(spark, d), X.users(spark, d))


@register("stream_counters", _COUNTERS_SQL)
def q_stream_counters(spark: SparkSession, d: str) -> DataFrame:
    return stream_counters(spark, live_events(spark, d))


# every event twice, as an at-least-once source would deliver it: the sums are those of one delivery
@register("stream_counters_once", _COUNTERS_SQL)
def q_stream_counters_once(spark: SparkSession, d: str) -> DataFrame:
    events = live_events(spark, d)
    return stream_counters(spark, events.unionByName(live_events(spark, d)), dedup=True)


# ---------------------------------------------------------------- ladder rounds over the stream
ROUND_DAYS = 15
ROUND_ENDS = (1704240000, 1705536000, 1706832000)  # 2024-01-03, -18 and -02-02: windows of 15 days


def _at(sql: str, as_of: int) -> str:
    """SQL of the batch fixtures or round, at another moment."""
    old, since = str(AS_OF), str(AS_OF - BOOT_DAYS * 86400)
    return sql.replace(since, str(as_of - BOOT_DAYS * 86400)).replace(old, str(as_of))


def _ladder_sql() -> str:
    fields = [f'"{c}"' for c in (*COUNTERS, *SPLIT)]
    zero = lambda a: f"coalesce({a}, 0)"
    ctes = [
        _LIVE_CTE,
        f"pool_1 AS ({_at(VIEWS['pool'][1], EVENTS_AS_OF)})",
        f"override_1 AS ({_at(VIEWS['step_override'][1], EVENTS_AS_OF)})",
        "serving_1 AS (SELECT * FROM serving)",
        f"win AS (SELECT pid, CAST(epoch(ts) AS BIGINT) // {ROUND_DAYS * 86400} * {ROUND_DAYS * 86400} AS start, {_SUMS} FROM live GROUP BY 1, 2)",
    ]
    parts = []
    for r, end in enumerate(ROUND_ENDS, 1):
        sums = ", ".join(f"CAST({zero('c.' + f)} + {zero('w.' + f)} AS BIGINT) AS {f}" for f in fields)
        totals = ", ".join(f"sum({f}) AS {f}" for f in fields)
        ctes.append(f"""counters_{r} AS (
SELECT coalesce(c.pid, w.pid) AS pid, {sums}
FROM counters c FULL OUTER JOIN (SELECT pid, {totals} FROM win WHERE start < {end} GROUP BY pid) w ON w.pid = c.pid)""")
        own = [f"{name} AS (SELECT * FROM {src}_{r})" for name, src in (
            ("pool", "pool"), ("step_override", "override"), ("serving", "serving"), ("counters", "counters"))]
        ctes.append(f"t_{r} AS (WITH {', '.join(own + [_at(c, end) for c in _TRANSITION_CTES])} {_at(_TRANSITION_BODY, end)})")
        n = r + 1
        pick = lambda f: f"CASE WHEN u.pid IS NOT NULL THEN u.{f} ELSE p.{f} END AS {f}"
        ctes.append(f"""pool_{n} AS (
SELECT p.* REPLACE ({', '.join(map(pick, ('step_boot', 'step_boot_t', 'mover_support')))})
FROM pool_{r} p LEFT JOIN (SELECT * FROM t_{r} WHERE output = 'pool') u ON u.pid = p.pid)""")
        ctes.append(f"""override_{n} AS (
SELECT coalesce(p.pid, u.pid) AS pid, {', '.join(map(pick, ('step_boot', 'step_boot_t', 'mover_support', 'real_step')))}
FROM override_{r} p FULL OUTER JOIN (SELECT * FROM t_{r} WHERE output = 'override') u ON u.pid = p.pid)""")
        ctes.append(f"serving_{n} AS (SELECT pid, remaining, weight FROM t_{r} WHERE output = 'serving')")
        parts.append(f"SELECT *, CAST({end} AS BIGINT) AS round FROM t_{r}")
    return with_views(" UNION ALL ".join(parts), "post_agg", "tax", "counters", "serving", "exposures", "users", extra=ctes)


@register("stream_boot", _ladder_sql())
def q_stream_boot(spark: SparkSession, d: str) -> DataFrame:
    return stream_boot(
        spark, live_events(spark, d), X.pool_docs(spark, d, EVENTS_AS_OF), X.step_override(spark, d, EVENTS_AS_OF),
        X.taxonomy(spark, d), X.serving_budget(spark, d), X.counters(spark, d), ROUND_ENDS,
        round_length=f"{ROUND_DAYS} days", days=BOOT_DAYS)
