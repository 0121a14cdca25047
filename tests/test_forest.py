"""The neighbour forest: recall and pruning, bounded leaves, searches of others, lists brought up to date."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.operators import forest, meet
from candor.operators.delta import forest_search, updated_neighbours
from candor.operators.forest import knn_forest, routed
from candor.operators.knn import knn_exact, knn_recall, unit_vectors

SCHEMA = "pid long, vector array<double>"


def clustered(spark, n, clusters, spread, dims=32, seed=1):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(clusters, dims))
    x = c[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dims))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)


def test_recall_and_pruning_on_clustered_vectors(spark):
    v = clustered(spark, 6000, 120, 0.5)
    got = knn_forest(v, k=50, min_score=0.5, leaf=96)
    recall = knn_recall(got, knn_exact(v, k=50), min_score=0.5).first()
    assert recall["exact_pairs"] > 100_000 and recall["recall"] >= 0.9
    r = routed(unit_vectors(v, "pid", "vector").withColumn("item", F.lit(True)), leaf=96)
    sizes = r.select(F.posexplode("groups").alias("t", "g")).groupBy("t", "g").count()
    assert sizes.agg(F.max("count")).first()[0] <= 192
    assert sizes.agg(F.sum(F.col("count") * F.col("count"))).first()[0] <= 0.12 * 6000**2  # pairs that meet, of all trees
    assert got.groupBy("pid", "near_pid").count().where("count > 1").count() == 0 and got.where("pid = near_pid").count() == 0


def test_registered_parameters_reach_the_floor(spark):
    """At the larger test scale, where the trees prune, the vectors without structure."""
    from candor.plans.params import I2I_MIN_SCORE, KNN_K
    from candor.sources import fixtures as X

    v = X.item_vectors(spark, "/root/testdata/sf0.1")
    recall = knn_recall(knn_forest(v, k=KNN_K, min_score=I2I_MIN_SCORE), knn_exact(v, k=KNN_K), min_score=I2I_MIN_SCORE).first()
    assert v.count() > 2 * forest.LEAF and recall["recall"] >= 0.9


def test_copies_and_deep_leaves_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(forest, "MAX_DEPTH", 2)  # the rest of the cuts are Spark's
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(700)] + [(1000 + i, [float(np.cos(i)), float(np.sin(i)), 0.3]) for i in range(900)]
    v = spark.createDataFrame(rows, SCHEMA)
    r = routed(unit_vectors(v, "pid", "vector").withColumn("item", F.lit(True)), leaf=50, trees=3)
    assert r.count() == 1600 and r.where("size(groups) != 3").count() == 0
    assert r.select(F.posexplode("groups").alias("t", "g")).groupBy("t", "g").count().agg(F.max("count")).first()[0] <= 100
    got = knn_forest(v, k=10, min_score=0.99, leaf=50, trees=3)
    assert got.select("pid").distinct().count() == 1600


def test_others_and_odd_rows(spark, monkeypatch):
    v = clustered(spark, 900, 30, 0.4)
    users = clustered(spark, 400, 30, 0.4, seed=5).select((F.col("pid") + 5000).alias("pid"), "vector")
    exact = knn_exact(users, k=10, others=v)
    assert knn_forest(users, k=10, min_score=-1.0, others=v).exceptAll(exact.select("pid", "near_pid", "score")).count() < 0.05 * 4000  # last digits
    monkeypatch.setattr(meet, "PART", 100)  # groups in parts
    small = knn_forest(users, k=10, min_score=-1.0, others=v, leaf=1000)
    same = small.select("pid", "near_pid").exceptAll(exact.select("pid", "near_pid")).count()
    assert same == 0 and small.count() == 4000
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0])], SCHEMA)
    got = {(r["pid"], r["near_pid"]) for r in knn_forest(odd, k=5, min_score=0.5).collect()}
    assert got == {(1, 4), (4, 1)}
    assert knn_forest(v.limit(0), k=5).count() == 0 and knn_forest(users, k=5, others=v.limit(0)).count() == 0


def test_same_trees_whatever_the_partitions(spark):
    v = clustered(spark, 2000, 20, 0.6)
    a = knn_forest(v.repartition(1), k=20, leaf=100).select("pid", "near_pid")
    b = knn_forest(v.repartition(7), k=20, leaf=100).select("pid", "near_pid")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("k", [5, 40])
def test_lists_brought_up_to_date_equal_a_full_run(spark, k):
    before = clustered(spark, 600, 12, 0.6, dims=8)
    now = before.where("pid % 19 != 0").withColumn("vector", F.when(F.col("pid") % 13 == 0, F.reverse("vector")).otherwise(F.col("vector")))
    now = now.unionByName(clustered(spark, 40, 12, 0.6, dims=8, seed=1).select((F.col("pid") + 9000).alias("pid"), F.transform("vector", lambda x: x * 1.1).alias("vector")))
    search = lambda v: knn_exact(v, k=k).where("score >= 0.4")
    want = search(now).select("pid", "near_pid")
    got = updated_neighbours(now, before, search(before), k=k, min_score=0.4).select("pid", "near_pid")
    assert want.count() > 1000 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    near = updated_neighbours(now, before, search(before), k=k, min_score=0.4, search=forest_search(k, 0.4)).select("pid", "near_pid")
    assert near.exceptAll(want).count() <= 0.02 * want.count()
    none = updated_neighbours(now.limit(0), before, search(before), k=k, min_score=0.4)
    assert none.count() == 0
