"""The cold-start ladder over a stream of exposure events.

The stream itself only counts: events become per-post counters in event-time windows of one round
(``counters_stream``), whatever files and micro-batches they come in. A round is due when its time
has come; it applies the very operators of the batch ladder (``operators.boot``) to the counters up
to its time and to the state that the round before left, so a rule means the same in both, a
post gets at most one step a round, and the result depends on event times alone. Posts leave by
the candidates' own window (three days by default), so nothing is kept for posts of the past
but the step fields that rounds changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boot as B
from ..session import set_down
from .counters_stream import COUNTERS, SPLIT, stream_counters


def round_ends(first: int, last: int, length: int) -> list[int]:
    """Ends of the rounds of ``length`` seconds that cover the events from ``first`` to ``last``."""
    return list(range(first // length * length + length, last + length + 1, length))


def counters_through(start: DataFrame, windows: DataFrame, as_of: int) -> DataFrame:
    """Counters at ``as_of``: those at the start plus all windows that began before it, in total and by gender.

    Windows are summed by post first; columns that ``windows`` lacks stay as they are at the start.
    """
    live = [c for c in (*COUNTERS, *SPLIT) if c in windows.columns]
    w = windows.filter(F.col("start") < as_of).groupBy("pid").agg(*[F.sum(c).alias(f"w_{c}") for c in live])
    j = start.join(w.withColumnRenamed("pid", "w_pid"), F.col("pid") == F.col("w_pid"), "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    out = [F.coalesce("pid", "w_pid").alias("pid")]
    for c in start.columns:
        if c in live:
            out.append((zero(c) + zero(f"w_{c}")).alias(c))
        elif c != "pid":
            out.append(F.col(c))
    return j.select(*out)


def ladder_rounds(
    docs: DataFrame, step_override: DataFrame, taxonomy: DataFrame, serving: DataFrame, start: DataFrame,
    windows: DataFrame, ends: Sequence[int], *, rules: B.Rules | None = None, days: int = 3,
) -> DataFrame:
    """Rounds at ``ends`` (epoch seconds, ascending) -> the transitions of all of them, with ``round``.

    ``start``: counters before the first window; ``windows``: ``counter_aggregate`` rows. Each round
    reads the documents, overrides and serving state as the round before left them. Only changed
    step fields are carried from round to round, set down each time.
    """
    rules = rules or B.load_rules()
    # every round reads them, some steps more than once
    docs, step_override = set_down(B.step_documents(docs)), set_down(step_override)
    serving, start = set_down(serving), set_down(start)
    changed, done = None, []
    for as_of in ends:
        now = docs if changed is None else B.next_documents(docs, changed)
        counters = set_down(counters_through(start, windows, as_of))  # several steps of a round read it
        cands = set_down(B.boot_candidates(now, step_override, taxonomy, as_of=as_of, days=days))
        t = set_down(B.boot_transition(cands, counters, serving, now, step_override, rules, as_of=as_of))
        done.append(t.withColumn("round", F.lit(as_of).cast("bigint")))
        step_override = set_down(B.next_overrides(step_override, t))
        serving = B.next_serving(t)
        pool = t.filter("output = 'pool'")
        if changed is None:
            changed = pool
        else:
            kept = changed.join(pool.select("pid"), "pid", "left_anti")
            changed = set_down(kept.unionByName(pool))
    out = done[0]
    for t in done[1:]:
        out = out.unionByName(t)
    return out


def stream_boot(
    spark: SparkSession, events: DataFrame, docs: DataFrame, step_override: DataFrame, taxonomy: DataFrame,
    serving: DataFrame, start: DataFrame, ends: Sequence[int], *, round_length: str, rules: B.Rules | None = None,
    days: int = 3, timeout_s: float | None = None,
) -> DataFrame:
    """Count what is available now and run the rounds at ``ends``; returns their transitions."""
    windows = set_down(stream_counters(spark, events, window=round_length, timeout_s=timeout_s))
    return ladder_rounds(docs, step_override, taxonomy, serving, start, windows, ends, rules=rules, days=days)
