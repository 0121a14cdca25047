"""The best of several lists for each user (``operators.lists``), and the quota merge: right rows, and what they shuffle."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from core_data import SF001
from candor.operators import lists as L
from candor.operators.recall import quota_merge, recent_actions, recent_i2i_recall
from candor.plans import q_recall

ACTIONS = "mid long, pid long, ts timestamp, event_id long"
NEIGHBOURS = "pid long, near_pid long, score double"


def by_joins(actions, neighbours, last_n, k):
    """The definition, join by join."""
    r = recent_actions(actions, last_n=last_n).select("mid", F.col("pid").alias("src")).distinct()
    n = neighbours.select(F.col("pid").alias("src"), F.col("near_pid").alias("pid"), "score")
    c = r.join(n, "src").groupBy("mid", "pid").agg(F.max("score").alias("score"))
    c = c.join(r.select("mid", F.col("src").alias("pid")), ["mid", "pid"], "left_anti")
    w = Window.partitionBy("mid").orderBy(F.col("score").desc(), F.col("pid").asc())
    return c.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def rows(df):
    return sorted(repr(tuple(x + 0.0 if isinstance(x, float) else x for x in r)) for r in df.collect())  # -0.0 equals 0.0


def made(spark, users, items, acts, near, seed, odd):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    some = lambda x: None if odd and rng.random() < 0.05 else x
    a = [(some(u), some(rng.randrange(-3, items)), start + timedelta(seconds=rng.randrange(1000)), i)
         for i, u in enumerate(u for u in range(users) for _ in range(acts))]
    score = lambda: some(rng.choice([0.25, 0.5, 0.5, 0.75, round(rng.random(), 2), float("nan") if odd else 1.0, -0.0, 0.0]))
    n = [(some(s), some(rng.randrange(-3, items + 10)), score()) for s in range(-3, items, 1 if not odd else 2) for _ in range(near)]
    return spark.createDataFrame(a, ACTIONS), spark.createDataFrame(n, NEIGHBOURS)


def shuffled(plan):
    """Rows written to shuffles by a plan that ran, stages of its adaptive parts included."""
    kind = plan.getClass().getSimpleName()
    if kind == "ReusedExchangeExec":
        return 0
    own = plan.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    kids = plan.children()
    return own + sum(shuffled(kids.apply(i)) for i in range(kids.size()))


def test_rows_are_those_of_the_joins(spark):
    for odd in (False, True):
        a, n = made(spark, 40, 30, 25, 12, 1, odd)
        for last_n, k in ((100, 50), (8, 5), (3, 1)):
            assert rows(recent_i2i_recall(a, n, last_n=last_n, k=k)) == rows(by_joins(a, n, last_n, k)), (odd, last_n, k)


def test_many_blocks_and_small_pieces_give_the_same_rows(spark, monkeypatch):
    a, n = made(spark, 60, 50, 20, 10, 2, True)
    want = rows(by_joins(a, n, 15, 7))
    for held, few, at_once in ((10**6, 40, 10**6), (100, 2048, 60), (1, 1, 1)):
        monkeypatch.setattr(L, "HELD", held)
        monkeypatch.setattr(L, "FEW", few)
        monkeypatch.setattr(L, "AT_ONCE", at_once)
        assert rows(recent_i2i_recall(a, n, last_n=15, k=7)) == want


def test_no_lists_no_users(spark):
    a, n = made(spark, 5, 8, 6, 3, 3, False)
    none = spark.createDataFrame([], NEIGHBOURS)
    assert rows(recent_i2i_recall(a, none)) == [] == rows(recent_i2i_recall(a.where("mid < 0"), n))
    far = n.selectExpr("pid + 1000 AS pid", "near_pid", "score")
    assert rows(recent_i2i_recall(a, far)) == []
    assert recent_i2i_recall(a, n).schema.simpleString() == "struct<mid:bigint,pid:bigint,score:double>"


def test_blocks_grow_with_sources_and_with_lists():
    assert L.block_count(0, 0, 1) == 1 == L.block_count(L.FEW, 10, 5)
    assert L.block_count(10**6, 10, 5) == L.BLOCKS
    assert L.block_count(100 * L.BLOCK_SOURCES, L.HELD, 150) == 100
    assert L.block_count(10**6, L.HELD + 1, 150) == -(-10**6 // (L.HELD // 150))


def test_entries_of_lists_are_not_shuffled_by_user(spark):
    users, sources, near = 200, 20, 100
    a = spark.range(users * sources).selectExpr("id div 20 AS mid", "id % 40 AS pid", "timestamp_seconds(id) AS ts", "id AS event_id")
    n = spark.range(40 * near).selectExpr("id div 100 AS pid", "1000 + id AS near_pid", "(id * 7 % 101) / 101.0D AS score")
    got = recent_i2i_recall(a, n)
    assert len(got.collect()) == users * 50
    assert shuffled(got._jdf.queryExecution().executedPlan()) < users * sources


def test_recalled_rows_are_shuffled_once(spark):
    r = spark.range(9000).selectExpr("id div 90 AS mid", "id % 70 AS pid", "element_at(array('a', 'b', 'c'), cast(id % 3 + 1 AS int)) AS source",
                                     "id * 7 % 101 / 101.0D AS score")
    forced = spark.range(100).selectExpr("id AS mid", "id % 70 AS pid")
    got = quota_merge(r, {"a": (5, 30), "b": (5, 20), "c": (5, 20)}, forced, k=60)
    assert got.collect()
    assert shuffled(got._jdf.queryExecution().executedPlan()) <= 9100


def test_topics_and_neighbours_read_one_pool_that_is_set_down(spark, monkeypatch):
    seen, neighbours, topic_recall = [], q_recall.neighbours, q_recall.topic_recall
    monkeypatch.setattr(q_recall, "neighbours", lambda s, d, *pool: seen.extend(pool) or neighbours(s, d, *pool))
    monkeypatch.setattr(q_recall, "topic_recall", lambda s, d, *pool: seen.extend(pool) or topic_recall(s, d, *pool))
    q_recall.q_quota_merge(spark, SF001)
    assert len(seen) == 2 and seen[0] is seen[1]
    assert "l_orderkey" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert rows(neighbours(spark, SF001, seen[0])) == rows(neighbours(spark, SF001))
    assert rows(topic_recall(spark, SF001, seen[0])) == rows(topic_recall(spark, SF001))
