"""End-to-end jobs write their sinks from the fixture inputs."""

import tempfile

from pyspark.sql import functions as F

from candor.plans import jobs as J
from candor.plans.params import AS_OF
from candor.sources import fixtures as X
from core_data import SF001


def test_hot_and_boot_jobs(spark):
    out = tempfile.mkdtemp(prefix="candor-job-", dir="/tmp")
    d = SF001
    inp = J.HotInputs(X.behaviour(spark, d), X.pool(spark, d), X.posts(spark, d), X.users(spark, d), X.taxonomy(spark, d))
    paths = J.hot_job(spark, inp, out + "/hot", as_of=AS_OF, days=90)
    assert spark.read.parquet(paths["video_index"]).count() > 0
    r = J.boot_round_job(spark, X.pool_docs(spark, d), X.step_override(spark, d), X.taxonomy(spark, d),
                         X.counters(spark, d), X.serving_budget(spark, d), out + "/boot", as_of=AS_OF, days=30)
    t = spark.read.parquet(r["transition"])
    assert t.count() > 0
    # the next round starts from what this one published: posts that started are in flight now
    W = J.W
    docs, over, serving = (W.read_latest(spark, f"{out}/boot/{n}") for n in ("docs", "override", "serving"))
    started = t.filter("output = 'pool' AND reason LIKE '%start%'").select("pid", "step_boot")
    assert started.count() > 0 and started.join(docs.select("pid", "step_boot"), ["pid", "step_boot"]).count() == started.count()
    assert docs.count() == X.pool_docs(spark, d).count() and docs.columns == X.pool_docs(spark, d).columns
    later = AS_OF + 600
    r2 = J.boot_round_job(spark, docs, over, X.taxonomy(spark, d), X.counters(spark, d), serving, out + "/boot", as_of=later, days=30)
    t2 = spark.read.parquet(r2["transition"])
    again = t2.filter("output = 'pool' AND reason = 'start'").join(started.select("pid"), "pid")
    assert again.count() == 0  # nobody starts twice
    two = W.read_latest(spark, f"{out}/boot/docs").select("pid", F.col("step_boot").alias("now"))
    assert two.join(docs, "pid").filter("now < step_boot").count() == 0
    v = J.pool_export_job(X.pool_docs(spark, d), X.step_override(spark, d), out + "/pool", as_of=AS_OF, version="1")
    assert len(spark.read.parquet(v).columns) == 45


def test_i2i_and_community_jobs(spark):
    out = tempfile.mkdtemp(prefix="candor-job-", dir="/tmp")
    d = "/root/testdata/sf0.01"
    from candor.operators.counters import counters_from_columns
    from candor.plans.params import EVENTS_AS_OF

    J.i2i_job(spark, X.event_actions(spark, d), X.pool_docs(spark, d), counters_from_columns(X.counters(spark, d)),
              X.taxonomy(spark, d), X.post_standard(spark, d), out + "/i2i", as_of=EVENTS_AS_OF, day="20240131",
              min_score=0.0)
    first = spark.read.parquet(out + "/i2i/index/video")
    lists = {r["index_key"] for r in first.filter("n_items > 0").collect()}
    assert first.count() > 0
    # an incremental run with a single user's actions of today keeps the lists of items not seen today
    today = spark.createDataFrame([(1, 3, EVENTS_AS_OF + 60, 1), (1, 6, EVENTS_AS_OF + 61, 2)], "mid long, pid long, s long, event_id long")
    today = today.select("mid", "pid", F.timestamp_seconds("s").alias("ts"), "event_id", F.lit("click").alias("event_type"))
    J.i2i_job(spark, today, X.pool_docs(spark, d), counters_from_columns(X.counters(spark, d)), X.taxonomy(spark, d),
              X.post_standard(spark, d), out + "/i2i", as_of=EVENTS_AS_OF, day="20240201", mode="incremental", min_score=0.0)
    kept = {r["index_key"] for r in spark.read.parquet(out + "/i2i/index/video").collect()}
    assert len(lists & kept) >= 0.9 * len(lists)
    J.i2i_job(spark, X.event_actions(spark, d), X.pool_docs(spark, d), counters_from_columns(X.counters(spark, d)),
              X.taxonomy(spark, d), X.post_standard(spark, d), out + "/w2v", as_of=EVENTS_AS_OF, day="20240131",
              method="word2vec", min_score=0.0)
    from pyspark.ml.feature import Word2VecModel
    assert Word2VecModel.load(out + "/w2v/models/review/20240131").getVectors().count() > 0
    m = J.community_job(spark, X.pool_docs(spark, d), X.counters(spark, d), X.taxonomy(spark, d), out + "/community",
                        as_of=AS_OF)
    assert m["index_keys"] == 50


def test_stream_jobs_run_once(spark):
    import os

    import pandas as pd

    from candor.streaming.counters_stream import latest_counters

    base = tempfile.mkdtemp(prefix="candor-streamjob-", dir="/tmp")
    src = os.path.join(base, "src")
    os.makedirs(src)
    df = pd.DataFrame({"pid": [1, 1, 2], "ts": pd.to_datetime(["2024-01-10 10:00"] * 3, utc=True).astype("datetime64[us, UTC]"),
                       "counter": ["rec", "rec", "like"]})
    df.to_parquet(os.path.join(src, "e.parquet"), index=False)
    schema = "pid long, ts timestamp, counter string"
    q = J.counter_stream_job(spark, src, schema, base + "/cl", base + "/ck1", processing_time=None)
    q.awaitTermination()
    assert {(r["pid"], r["rec"]) for r in latest_counters(spark, base + "/cl").collect()} == {(1, 2), (2, 0)}
    t = J.boot_stream_job(
        spark, base + "/cl", X.pool_docs(spark, SF001, 1704967200), X.step_override(spark, SF001), X.taxonomy(spark, SF001),
        X.serving_budget(spark, SF001), X.counters(spark, SF001), base + "/tr", ends=[1704967200], days=30)
    assert spark.read.parquet(t).filter("output = 'pool'").count() > 0


def test_hot_job_enforce_min(spark):
    out = tempfile.mkdtemp(prefix="candor-job-", dir="/tmp")
    d = SF001
    inp = J.HotInputs(X.behaviour(spark, d), X.pool(spark, d), X.posts(spark, d), X.users(spark, d), X.taxonomy(spark, d))
    paths = J.hot_job(spark, inp, out, as_of=AS_OF, days=90, min_limit=2, enforce_min=True)
    idx = spark.read.parquet(paths["video_index"])
    short = spark.read.parquet(out + "/video_short_groups")
    assert short.count() > 0
    assert idx.join(short, "index_key", "left_semi").count() == 0      # short groups are not written
    assert idx.filter("n_items < 2").count() == 0
