"""Behaviour sequences for item embedding training."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import skew_safe_row_number


def training_days(as_of: int, *, max_day: int = 30, mode: str = "full") -> tuple[str, str]:
    """Inclusive [first, last] 'yyyy-MM-dd' day window of the training input.

    ``full``: yesterday and the ``max_day`` days before it (older daily files age out);
    ``incremental``: today only; ``no_increment``: today only (``max_day`` forced to 0).
    """
    today = dt.datetime.fromtimestamp(as_of, dt.timezone.utc).date()
    if mode == "full":
        last = today - dt.timedelta(days=1)
        first = last - dt.timedelta(days=max_day)
    elif mode in ("incremental", "no_increment"):
        first = last = today
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return first.isoformat(), last.isoformat()


def behaviour_sequences(
    actions: DataFrame,
    *,
    as_of: int,
    max_day: int = 30,
    mode: str = "full",
    max_len: int = 1000,
    overlap: int = 5,
) -> DataFrame:
    """(mid, pid, ts, event_id) -> (mid, day, part, items array<string>, ahead array<string>) ordered
    by (ts, event_id).

    One sentence per user-day; a user-day longer than ``max_len`` comes in consecutive parts of
    ``max_len`` items, so no single row grows with a hot user, and is numbered over range partitions, so no
    task holds it whole. ``ahead`` repeats the first ``overlap`` items of the next part: whoever
    pairs items within a window of that width loses none at the edges. The day window is a filter
    on the event date.
    """
    first, last = training_days(as_of, max_day=max_day, mode=mode)
    a = actions.withColumn("day", F.to_date("ts")).filter(
        (F.col("day") >= F.lit(first).cast("date")) & (F.col("day") <= F.lit(last).cast("date"))
        & F.col("pid").isNotNull()
    ).select("mid", "day", "pid", "ts", "event_id")
    a = skew_safe_row_number(a, ["mid", "day"], [F.col("ts").asc(), F.col("event_id").asc()], name="__pos")
    pos = F.col("__pos") - 1
    part = F.floor(pos / max_len).cast("bigint")
    own = F.struct(part.alias("part"), F.lit(False).alias("ahead"))
    again = F.when((part > 0) & (pos % max_len < overlap), F.struct((part - 1).alias("part"), F.lit(True).alias("ahead")))
    a = a.select("mid", "day", "__pos", F.col("pid").cast("string").alias("tok"),
                 F.explode(F.filter(F.array(own, again), lambda x: x.isNotNull())).alias("__at"))
    tok = F.struct("__pos", "tok")
    g = a.groupBy("mid", "day", F.col("__at.part").alias("part")).agg(
        F.sort_array(F.collect_list(F.when(~F.col("__at.ahead"), tok))).alias("__s"),
        F.sort_array(F.collect_list(F.when(F.col("__at.ahead"), tok))).alias("__a"),
    )
    return g.select("mid", F.date_format("day", "yyyy-MM-dd").alias("day"), "part",
                    F.transform("__s", lambda x: x["tok"]).alias("items"),
                    F.transform("__a", lambda x: x["tok"]).alias("ahead"))


def choose_mode(as_of: int, *, full_done_today: bool, full_hour: int = 3) -> str:
    """Schedule choice: one full retrain per day at or after ``full_hour`` (UTC), otherwise
    an incremental run on today's actions."""
    hour = dt.datetime.fromtimestamp(as_of, dt.timezone.utc).hour
    return "full" if hour >= full_hour and not full_done_today else "incremental"
