"""Daily partial sums, retention of versions, observed counts."""

import os
import tempfile

from pyspark.sql import functions as F

from candor.operators import daily as D
from candor.operators.engagement import engagement_cells
from candor.plans import q_hot as Q
from candor.plans.params import HOT_SINCE_DAY
from candor.sinks import retention as R
from candor.sinks import writers as W
from candor.sources import fixtures as X
from core_data import SF001


def _same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def test_merged_days_equal_the_rescanned_window(spark):
    behaviour, pool, posts, users, tax = (f(spark, SF001) for f in (X.behaviour, X.pool, X.posts, X.users, X.taxonomy))
    path = tempfile.mkdtemp(prefix="candor-daily-", dir="/tmp") + "/partials"
    month = "substr(ymd, 1, 6)"
    D.write_partials(D.daily_partials(behaviour, posts, users, tax), path, period=month)
    cells = lambda: D.cells_from_partials(spark.read.parquet(path), pool, since_day=HOT_SINCE_DAY, behaviour_since_day=Q.BEHAVIOUR_SINCE_DAY)
    want = engagement_cells(behaviour, pool, posts, users, tax, since_day=HOT_SINCE_DAY, behaviour_since_day=Q.BEHAVIOUR_SINCE_DAY)
    assert want.count() > 0 and _same(cells(), want)
    # a period that is reduced again replaces its own rows and no others
    part = behaviour.where("substr(ymd, 1, 6) = '199806'")
    assert part.count() > 0
    D.write_partials(D.daily_partials(part.limit(0).unionByName(part).unionByName(part), posts, users, tax), path, period=month)
    assert not _same(cells(), want)
    D.write_partials(D.daily_partials(part, posts, users, tax), path, period=month)
    assert _same(cells(), want)
    assert D.cells_from_partials(spark.read.parquet(path), pool, since_day="20990101", behaviour_since_day="20990101").count() == 0


def test_days_are_read_by_partition(spark):
    path = tempfile.mkdtemp(prefix="candor-daily-", dir="/tmp") + "/partials"
    days = X.behaviour(spark, SF001).where("ymd like '199806%'")
    D.write_partials(D.daily_partials(days, X.posts(spark, SF001), X.users(spark, SF001), X.taxonomy(spark, SF001)), path)
    assert {d for d in os.listdir(path) if d.startswith("period=")} == {f"period={r['ymd']}" for r in days.where("expose >= 1").select("ymd").distinct().collect()}


def test_retention_keeps_the_newest_and_what_is_held(spark):
    base = tempfile.mkdtemp(prefix="candor-keep-", dir="/tmp") + "/models"
    frame = lambda n: spark.range(n)
    paths = {v: W.publish_version(frame(k + 1), base, v) for k, v in enumerate(("20240101", "20240105", "20240120", "20240125", "named"))}
    held = spark.createDataFrame([("20240105",)], "version string")
    assert R.retire(spark, base, as_of="20240131", max_age_days=10, held=held, now=1000) == 2  # 1 and 20 January
    left = {r["version"] for r in R.current_versions(spark, base).collect()}
    assert left == {"20240105", "20240125", "named"}
    reader = spark.read.parquet(paths["20240101"])  # chosen before it was retired
    assert R.sweep(spark, base, grace=100, now=1050) == [] and reader.count() == 1
    assert sorted(R.sweep(spark, base, grace=100, now=1100)) == sorted([paths["20240101"], paths["20240120"]])
    assert R.sweep(spark, base, grace=100, now=1200) == [] and spark.read.parquet(paths["20240105"]).count() == 2
    assert R.retire(spark, base, as_of="20240131", max_age_days=10, held=held, now=1300) == 0
    # everything is old: the newest stays
    old = tempfile.mkdtemp(prefix="candor-keep-", dir="/tmp") + "/m"
    for v in ("20200101", "20200102"):
        W.publish_version(frame(3), old, v)
    assert R.retire(spark, old, as_of="20240131", max_age_days=10) == 1
    assert W.read_latest(spark, old).count() == 3


def test_reads_choose_no_retired_version(spark):
    base = tempfile.mkdtemp(prefix="candor-keep-", dir="/tmp") + "/v"
    W.publish_version(spark.range(1), base, "20240101")
    W.publish_version(spark.range(2), base, "20240102")
    again = W.publish_version(spark.range(5), base, "20240103")
    spark.createDataFrame([(again, 1)], R.RETIRED).write.mode("append").parquet(base + "/retired")
    assert W.read_latest(spark, base).count() == 2


def test_counts_are_observed_during_the_write(spark):
    from candor.plans import jobs as J
    from candor.plans.params import AS_OF

    out = tempfile.mkdtemp(prefix="candor-seen-", dir="/tmp")
    m = J.community_job(spark, X.pool_docs(spark, SF001), X.counters(spark, SF001), X.taxonomy(spark, SF001), out + "/c", as_of=AS_OF)
    t = spark.read.parquet(out + "/c").agg(F.sum("n_items").alias("n"), F.count(F.when(F.col("chunk") < 0, 1)).alias("k")).first()
    assert m == {"community_post_cnt": t["n"] or 0, "index_keys": t["k"]}
    none = J.community_job(spark, X.pool_docs(spark, SF001).limit(0), X.counters(spark, SF001), X.taxonomy(spark, SF001), out + "/e", as_of=AS_OF)
    assert none["community_post_cnt"] == 0 and none["index_keys"] == 50
