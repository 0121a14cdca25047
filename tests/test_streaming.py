"""Structured Streaming: restart from the checkpoint, late rows, backfills, ladder rounds."""

import datetime as dt
import os
import tempfile

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from candor.sources import fixtures as X
from candor.streaming.boot_stream import ladder_rounds, round_ends, stream_boot
from candor.streaming.counters_stream import COUNTERS, current_counters, latest_counters, start_counter_stream, stream_counters
from core_data import SF001

EVENT_SCHEMA = "pid long, ts timestamp, counter string"


def _drop(src, name, rows):
    df = pd.DataFrame(rows, columns=["pid", "ts", "counter"])
    df["ts"] = pd.to_datetime(df["ts"], utc=True).astype("datetime64[us, UTC]")
    df.to_parquet(os.path.join(src, name), index=False)


def test_counter_stream_restart_and_late_rows(spark):
    base = tempfile.mkdtemp(prefix="candor-stream-", dir="/tmp")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    os.makedirs(src)

    def run():
        q, _ = start_counter_stream(spark, spark.readStream.schema(EVENT_SCHEMA).parquet(src), out_dir=out,
                                    checkpoint=ck, watermark="1 hour", window="1 day")
        q.awaitTermination()
        assert q.exception() is None

    _drop(src, "b1.parquet", [(1, "2024-01-10 10:00", "rec"), (1, "2024-01-10 10:05", "rec"), (2, "2024-01-10 11:00", "sume")])
    run()
    _drop(src, "b2.parquet", [(1, "2024-01-12 10:00", "rec")])          # watermark moves to 01-12 09:00
    run()
    _drop(src, "b3.parquet", [(1, "2024-01-10 12:00", "rec"),            # late: its day closed before the watermark
                              (1, "2024-01-12 11:00", "rec")])           # on time
    run()
    got = {(r["pid"], r["day"]): (r["rec"], r["sume"]) for r in latest_counters(spark, out).collect()}
    assert got == {(1, "2024-01-10"): (2, 0), (2, "2024-01-10"): (0, 1), (1, "2024-01-12"): (2, 0)}


def test_backfill_counts_all_events_whatever_the_files(spark):
    # three files in reverse time order: with a watermark most would be late
    base = tempfile.mkdtemp(prefix="candor-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    os.makedirs(src)
    for i, day in enumerate(("2024-01-20", "2024-01-10", "2024-01-01")):
        _drop(src, f"b{i}.parquet", [(1, f"{day} 10:00", "rec"), (2, f"{day} 11:00", "like")])
        os.utime(os.path.join(src, f"b{i}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))
    ev = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    got = stream_counters(spark, ev)
    assert got.count() == 6 and got.agg(F.sum("rec"), F.sum("like")).first()[:] == (3, 3)


def test_wait_limit_raises_and_stops(spark):
    base = tempfile.mkdtemp(prefix="candor-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    os.makedirs(src)
    for i in range(40):
        _drop(src, f"b{i}.parquet", [(i, "2024-01-10 10:00", "rec")])
    ev = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    with pytest.raises(TimeoutError):
        stream_counters(spark, ev, timeout_s=1)
    assert not spark.streams.active


def test_missing_changelog_is_an_error(spark):
    with pytest.raises(AnalysisException):
        latest_counters(spark, "/tmp/candor-no-such-changelog-xyz")


T0 = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc).timestamp())
HOUR = 3600
WINDOWS = "pid long, start long, day string, " + ", ".join(f"`{c}` long" for c in COUNTERS)


def _ladder(spark, posts, windows, rounds, rules=None):
    """Rounds over posts (pid, ptype, step, mover_level) and window counts (pid, start, {counter: n})."""
    docs = X.pool_docs(spark, SF001, T0).limit(0)
    start = X.counters(spark, SF001).limit(0)
    rows = [(pid, 1, 0, 1, ptype, 2, T0 - 100, T0 - 50, 30, step, T0, level) for pid, ptype, step, level in posts]
    own = spark.createDataFrame(rows, "pid long, tid long, mid long, gid long, ptype long, status long, ct long, rec_t long, "
                                      "vdur long, step_boot long, step_boot_t long, level long")
    own = own.withColumn("gid", F.col("pid")).withColumn(
        "author", F.struct(F.lit(0).cast("long").alias("fans"), F.lit(0).cast("long").alias("atts"), F.col("level").alias("mover_level"),
                           F.lit(1).cast("long").alias("mover_part_id"))).drop("level")
    docs = docs.unionByName(own, allowMissingColumns=True)
    w = spark.createDataFrame([(p, s, "", *[n.get(c, 0) for c in COUNTERS]) for p, s, n in windows], WINDOWS)
    t = ladder_rounds(docs, X.step_override(spark, SF001).limit(0), X.taxonomy(spark, SF001), X.serving_budget(spark, SF001).limit(0),
                      start, w, rounds, rules=rules)
    return t.filter("output = 'pool'").orderBy("round", "pid").collect(), t


def test_ladder_rounds(spark):
    windows = [(7, T0, {"rec": 10}), (7, T0 + HOUR, {"rec": 95}), (7, T0 + 2 * HOUR, {"like": 1})]
    got, t = _ladder(spark, [(7, 2, 0, 0)], windows, [T0 + HOUR, T0 + 2 * HOUR, T0 + 3 * HOUR])
    # empty rule: starts; 105 of 100 reached: finishes, waiting at step 1; its rule passes: starts
    assert [(r["reason"], r["step_boot"]) for r in got] == [("start", 5), ("finish", 10), ("start", 15)]
    left = [r["remaining"] for r in t.filter("output = 'serving'").orderBy("round").collect()]
    assert left == [90, 95]


def test_ladder_rescues_movers_and_lets_posts_expire(spark):
    late = T0 + 8100
    got, _ = _ladder(spark, [(8, 2, 10, 1), (9, 2, 10, 0)], [(8, T0, {"rec": 1}), (9, T0, {"rec": 1})], [late])
    assert [(r["pid"], r["reason"], r["mover_support"]) for r in got] == [(8, "start", 1)]
    got, _ = _ladder(spark, [(7, 2, 0, 0)], [(7, T0, {"rec": 1})], [T0 + 4 * 86400])
    assert got == []  # older than three days


def test_ladder_same_result_for_one_file_and_twenty(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    base = tempfile.mkdtemp(prefix="candor-stream-", dir="/tmp")
    out = []
    for n in (1, 20):
        events.repartition(n, F.rand(3)).write.parquet(f"{base}/{n}")
        src = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/{n}")
        at = 1706659200
        out.append(stream_boot(
            spark, X._counter_events(src), X.pool_docs(spark, SF001, at), X.step_override(spark, SF001, at), X.taxonomy(spark, SF001),
            X.serving_budget(spark, SF001), X.counters(spark, SF001), round_ends(1704067200, 1706659199, 15 * 86400)[-2:],
            round_length="15 days", days=30))
    assert out[0].count() > 0
    assert out[0].exceptAll(out[1]).count() == 0 and out[1].exceptAll(out[0]).count() == 0


def test_compact_changelog(spark):
    from candor.sinks.writers import read_latest
    from candor.streaming.counters_stream import compact_changelog

    base = tempfile.mkdtemp(prefix="candor-compact-", dir="/tmp")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    _drop(src, "b1.parquet", [(1, "2024-01-10 10:00", "rec")])
    q, _ = start_counter_stream(spark, spark.readStream.schema(EVENT_SCHEMA).parquet(src), out_dir=out, checkpoint=ck)
    q.awaitTermination()
    _drop(src, "b2.parquet", [(1, "2024-01-10 11:00", "rec")])
    q, _ = start_counter_stream(spark, spark.readStream.schema(EVENT_SCHEMA).parquet(src), out_dir=out, checkpoint=ck)
    q.awaitTermination()
    compact_changelog(spark, out, os.path.join(base, "snap"), "1")
    r = read_latest(spark, os.path.join(base, "snap")).collect()
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]     # includes no-data watermark batches
    assert [(x["pid"], x["rec"], x["through_batch"]) for x in r] == [(1, 2, last)] and last >= 1
    _drop(src, "b3.parquet", [(1, "2024-01-10 12:00", "rec"), (2, "2024-01-11 12:00", "like")])
    q, _ = start_counter_stream(spark, spark.readStream.schema(EVENT_SCHEMA).parquet(src), out_dir=out, checkpoint=ck)
    q.awaitTermination()
    now = current_counters(spark, out, os.path.join(base, "snap"))
    assert sorted((x["pid"], x["rec"], x["like"]) for x in now.collect()) == [(1, 3, 0), (2, 0, 1)]


def _drop_events(src, name, rows):
    df = pd.DataFrame(rows, columns=["event_id", "pid", "mid", "ts", "counter", "amount"])
    df["ts"] = pd.to_datetime(df["ts"], utc=True).astype("datetime64[us, UTC]")
    df.to_parquet(os.path.join(src, name), index=False)


def test_replayed_files_change_no_counter_and_genders_split(spark):
    """Restarts over replayed deliveries: first deliveries count, replays within the watermark don't, later ones are late rows."""
    from candor.streaming.counters_stream import with_gender

    base = tempfile.mkdtemp(prefix="candor-once-", dir="/tmp")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    users = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "mid long, gender long")

    def run():
        ev = spark.readStream.schema("event_id long, pid long, mid long, ts timestamp, counter string, amount long").parquet(src)
        q, _ = start_counter_stream(spark, with_gender(ev, users), out_dir=out, checkpoint=ck, watermark="2 hours", window="1 day", dedup=True)
        q.awaitTermination()
        assert q.exception() is None

    first = [(100, 7, 1, "2024-01-10 10:00", "rec", 1), (100, 7, 1, "2024-01-10 10:00", "play_dur", 700), (101, 7, 2, "2024-01-10 10:01", "rec", 1),
             (102, 7, 3, "2024-01-10 10:02", "rec", 1), (103, 7, 9, "2024-01-10 10:03", "like", 1), (101, 7, 2, "2024-01-10 10:01", "rec", 1)]
    _drop_events(src, "b1.parquet", first)
    run()
    _drop_events(src, "b2.parquet", first)  # the whole file again
    run()
    _drop_events(src, "b3.parquet", [(100, 7, 1, "2024-01-10 10:20", "rec", 1), (104, 7, 1, "2024-01-10 11:00", "rec", 1)])  # a replay with another time
    run()
    _drop_events(src, "b4.parquet", [(105, 7, 1, "2024-01-12 10:00", "rec", 1)])  # closes the first day
    run()
    _drop_events(src, "b5.parquet", first)  # late now
    run()
    got = {r["day"]: r for r in latest_counters(spark, out).collect()}
    day = got["2024-01-10"]
    assert (day["rec"], day["s0_rec"], day["s1_rec"], day["s2_rec"], day["play_dur"], day["s1_play_dur"], day["s0_like"]) == (4, 1, 2, 1, 700, 700, 1)
    assert got["2024-01-12"]["rec"] == 1


def test_live_genders_reach_the_weights(spark):
    from candor.operators.boot import boot_gender_weight
    from candor.streaming.boot_stream import counters_through
    from candor.streaming.counters_stream import counter_aggregate

    ev = spark.createDataFrame([(7, "2024-01-10 10:00:00", "rec", 10, 1), (7, "2024-01-10 10:00:00", "rec", 10, 2), (7, "2024-01-10 10:00:00", "sume", 6, 1),
                                (7, "2024-01-10 11:00:00", "sume", 3, 2)], "pid long, ts string, counter string, amount long, gender int")
    w = counter_aggregate(ev.withColumn("ts", F.col("ts").cast("timestamp")), window="1 hour")
    start = X.counters(spark, SF001).limit(0)
    ptypes = spark.createDataFrame([(7, 2)], "pid long, ptype long")
    at = int(dt.datetime(2024, 1, 10, 12, tzinfo=dt.timezone.utc).timestamp())
    assert boot_gender_weight(counters_through(start, w, at), ptypes).first()["weight"] == "2.0000:0.5000"
    assert boot_gender_weight(counters_through(start, w, at - HOUR), ptypes).first()["weight"] == "1.2:1.0"  # the second hour hasn't begun
