"""Physical-plan checks: filters reach the scans, columns are pruned, top-k is map-side."""

import tempfile

from candor.operators.engagement import day_start_epoch, engagement_cells
from candor.operators.index import topn_index
from candor.operators.review import review_board
from candor.plans.params import AS_OF
from candor.sources import fixtures as X
from core_data import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _materialise(spark):
    """Write the fixture views as Parquet tables, the way a warehouse would hold them."""
    base = tempfile.mkdtemp(prefix="candor-plan-", dir="/tmp")
    X.behaviour(spark, SF001).write.partitionBy("ymd").parquet(f"{base}/ups")
    X.pool(spark, SF001).write.parquet(f"{base}/pool")
    X.users(spark, SF001).write.parquet(f"{base}/users")
    X.taxonomy(spark, SF001).write.parquet(f"{base}/tax")
    return base


def test_hot_filters_reach_the_scans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # print whole filter lists
    base = _materialise(spark)
    ups = spark.read.parquet(f"{base}/ups")
    pool = spark.read.parquet(f"{base}/pool")
    cells = engagement_cells(ups, pool, pool.select("pid", "tid", "vdur", "ct"), spark.read.parquet(f"{base}/users"),
                             spark.read.parquet(f"{base}/tax"), since_day="20010807", behaviour_since_day="19980101")
    plan = _plan(cells)
    assert "PartitionFilters: [isnotnull(ymd" in plan and "(ymd#" in plan           # day window prunes partitions
    assert f"GreaterThanOrEqual(ct,{day_start_epoch('20010807')})" in plan            # create-day window pushed down
    assert "GreaterThanOrEqual(review_cnt,20)" in plan and "GreaterThanOrEqual(rec,1000)" in plan
    assert "Or(GreaterThanOrEqual(ctr,0.3),GreaterThanOrEqual(ctr,0.4))" in plan      # one-sided part of the OR
    pool_schemas = [l for l in plan.split("ReadSchema: ")[1:] if l.startswith("struct<pid:bigint,ct:bigint")]
    assert pool_schemas and all("mover_level" not in l.split(">")[0] for l in pool_schemas)   # columns pruned


def test_review_board_outer_join_planned_inner(spark):
    spark.catalog.clearCache()   # a cached fixture plan (with its own left join) would be substituted in
    rb = review_board(X.behaviour(spark, SF001), X.posts(spark, SF001), since_day="20000101")
    plan = _plan(rb)
    assert "LeftOuter" not in plan


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    import re

    from candor.operators import boot as B
    from candor.operators.evaluate import recall_partition_share

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = _materialise(spark)
        ups, pool = spark.read.parquet(f"{base}/ups"), spark.read.parquet(f"{base}/pool")
        # behaviour and log are summed by post before anything is joined
        for df in (review_board(ups, pool, since_day="20000101"),
                   recall_partition_share(X.recall_log(spark, SF001), pool, X.taxonomy(spark, SF001))):
            plan = _plan(df)
            scan = plan[:plan.rindex("ups" if "ups" in plan else "events")]
            assert "partial_sum" in scan.split("Join")[-1]
        # a gid's posts are cut to two a task ahead of the shuffle
        cands = B.boot_candidates(X.pool_docs(spark, SF001), X.step_override(spark, SF001), X.taxonomy(spark, SF001), as_of=AS_OF, days=30)
        assert re.search(r"WindowGroupLimit.*row_number\(\), 2, Partial", _plan(cands))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_topn_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "id AS pid", "cast(id * 13 % 101 AS double) AS score")
    idx = topn_index(df, keys=["g"], score_col="score", top=5, as_of=AS_OF)
    plan = idx._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        static = topn_index(df, keys=["g"], score_col="score", top=5, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in static or "WindowGroupLimit" in plan


def test_hot_path_stays_in_the_jvm(spark):
    from candor.plans.registry import load_all

    reg = load_all()
    for name in ("engagement_cells", "pool_clean", "review_board", "boot_features"):
        df = reg[name].run(spark, SF001)
        df.collect()                                   # AQE shows codegen stages in the final plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan, name
        assert "isFinalPlan=true" in plan and "*(" in plan, name   # whole-stage codegen stages
