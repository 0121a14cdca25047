"""Live per-post counters from an exposure-event stream (Structured Streaming).

Events ``(pid, ts, counter[, amount][, gender][, event_id])`` are summed per post and event-time window, in total and,
where they carry a gender (``with_gender``: a stream-static join to the users), by gender in the same aggregate. Deliveries
come at least once: ``once_each`` keeps the first of those with one event id. A live stream has a
watermark, so state for windows older than it is dropped; a backfill over what is there
(``availableNow``) has none, because its files may come in any order and every event counts. Each micro-batch's updated rows
(``update`` mode) are appended by ``foreachBatch`` to a changelog folder under the shared
checkpoint directory; ``latest_counters`` reads that folder and keeps the newest version of
each (pid, day) -- a distributed upsert without a table format, and one the next job can
read while the stream keeps running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir

COUNTERS = ("rec", "sume", "gsume", "detail", "share", "like", "download", "review", "play_video", "play_dur")
GENDERS = (0, 1, 2)
SPLIT = tuple(f"s{g}_{c}" for g in GENDERS for c in COUNTERS)  # counters by gender, beside the totals


def with_gender(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events with their user's ``gender`` (unknown users and genders: 0). ``users`` (mid, gender) is static."""
    u = users.select(F.col("mid").alias("u_mid"), F.col("gender").cast("int").alias("gender"))
    j = events.join(u, F.col("mid") == F.col("u_mid"), "left").drop("u_mid")
    return j.withColumn("gender", F.coalesce("gender", F.lit(0)))


def once_each(events: DataFrame, *, watermark: str | None = None) -> DataFrame:
    """The first delivery of every (event_id, counter).

    With a watermark an id is remembered until the watermark passes its first delivery's time by the delay (later
    replays of it are late rows); a backfill without one remembers the ids of the whole run.
    """
    key = ["event_id", "counter"]
    if not (events.isStreaming and watermark):
        return events.dropDuplicates(key)
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(key)


def counter_aggregate(events: DataFrame, *, watermark: str | None = None, window: str = "1 day", dedup: bool = False) -> DataFrame:
    """(pid, ts, counter[, amount][, gender]) -> (pid, start, day, one column a counter) per event-time window.

    Works on a streaming or a batch frame. An event without ``amount`` counts 1. Events with ``gender`` give the
    columns of ``SPLIT`` too. ``dedup``: repeated deliveries of an event_id count once.
    """
    if dedup:
        e = once_each(events, watermark=watermark)
    else:
        e = events.withWatermark("ts", watermark) if events.isStreaming and watermark else events
    amount = F.col("amount") if "amount" in events.columns else F.lit(1)
    g = e.groupBy("pid", F.window("ts", window).alias("w"))
    aggs = [F.sum(F.when(F.col("counter") == c, amount).otherwise(0)).cast("bigint").alias(c) for c in COUNTERS]
    split = SPLIT if "gender" in events.columns else ()
    if split:
        own = lambda c, n: (F.col("counter") == c) & (F.col("gender") == n)
        aggs += [F.sum(F.when(own(c, n), amount).otherwise(0)).cast("bigint").alias(f"s{n}_{c}") for n in GENDERS for c in COUNTERS]
    return g.agg(*aggs).select("pid", F.unix_timestamp(F.col("w.start").cast("timestamp")).alias("start"),
                               F.date_format(F.col("w.start"), "yyyy-MM-dd").alias("day"), *COUNTERS, *split)


def start_counter_stream(
    spark: SparkSession,
    events: DataFrame,
    *,
    out_dir: str | None = None,
    checkpoint: str | None = None,
    watermark: str | None = None,
    window: str = "1 day",
    dedup: bool = False,
    available_now: bool = True,
    processing_time: str | None = None,
) -> tuple[StreamingQuery, str]:
    """Start the counter stream; returns (query, changelog folder).

    Give a ``watermark`` to a stream that runs on; rows later than it are then dropped, and its
    windows' state with them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream_counters-{uuid.uuid4().hex[:12]}"
    out_dir = out_dir or base + "/changelog"
    checkpoint = checkpoint or base + "/checkpoint"
    agg = counter_aggregate(events, watermark=watermark, window=window, dedup=dedup)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(out_dir)

    w = agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(), out_dir


# a changelog without genders reads as nulls in the columns of SPLIT
CHANGELOG_SCHEMA = "pid long, start long, day string, " + ", ".join(f"`{c}` long" for c in (*COUNTERS, *SPLIT)) + ", batch_id long"


def _newest(changelog: DataFrame) -> DataFrame:
    w = Window.partitionBy("pid", "start").orderBy(F.col("batch_id").desc())
    return changelog.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_counters(spark: SparkSession, changelog: str) -> DataFrame:
    """Newest version of each (pid, window) in the changelog; a missing folder is an error."""
    return _newest(spark.read.schema(CHANGELOG_SCHEMA).parquet(changelog)).drop("batch_id")


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until ``query`` has ended. If a limit is given and passes first, stop it and raise: what
    it has written so far is not the result."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()


def stream_counters(spark: SparkSession, events: DataFrame, *, timeout_s: float | None = None, **kw) -> DataFrame:
    """Run the stream over what is available now and return the resulting counters, all events in them."""
    q, out = start_counter_stream(spark, events, available_now=True, **kw)
    finish(q, timeout_s)
    return latest_counters(spark, out)


def compact_changelog(spark: SparkSession, changelog: str, base: str, version: str) -> str:
    """Publish the latest counters as a new version of ``base``, stamped with the last batch in them.

    A long-running stream keeps appending update rows; compacting on a schedule bounds what
    readers scan (``current_counters``). The changelog is listed once, so a batch that lands
    meanwhile is neither counted nor claimed.
    """
    from ..sinks.writers import publish_version

    log = spark.read.schema(CHANGELOG_SCHEMA).parquet(changelog)
    last_batch = log.agg(F.max("batch_id")).first()[0]
    return publish_version(_newest(log).withColumn("through_batch", F.lit(last_batch).cast("bigint")), base, version)


def current_counters(spark: SparkSession, changelog: str, base: str) -> DataFrame:
    """The newest compacted version brought up to date by the batches after it."""
    from ..sinks.writers import read_latest

    done = read_latest(spark, base)
    through = done.agg(F.max("through_batch")).first()[0]
    log = spark.read.schema(CHANGELOG_SCHEMA).parquet(changelog)
    newer = log.filter(F.col("batch_id") > through) if through is not None else log
    return _newest(done.drop("through_batch").unionByName(newer)).drop("batch_id")
