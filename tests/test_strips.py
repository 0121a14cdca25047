"""Searches of all pairs in strips, groups that meet once, cuts of repeated ids."""

import numpy as np
from pyspark.sql import functions as F

from core_data import SF01
from candor.operators import meet
from candor.operators.forest import knn_forest, routed
from candor.operators.knn import knn_exact, knn_lsh, knn_recall, unit_vectors
from candor.operators.strips import STRIP_ROWS, STRIPS, strip_count

SCHEMA = "pid long, vector array<double>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some(spark, n, dims=8, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, dims))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)


def test_exact_search_moves_one_copy_a_strip_and_merges_nothing(spark):
    p = plan(knn_exact(some(spark, 50), k=5))
    assert p.count("Exchange") == 1 and "Window" not in p
    assert strip_count(100, 2048) == 1 and strip_count(10_000, 2048) == strip_count(600_000, 2048) == STRIPS
    assert strip_count(100 * STRIP_ROWS, 2048) == 100


def test_exact_search_of_odd_rows_equals_brute_force(spark):
    rows = [(i % 90, [float(np.cos(i)), float(np.sin(i)), i % 7 / 7]) for i in range(100)]  # ten ids twice
    rows += [(200, None), (201, [float("nan"), 1.0, 0.0]), (202, [0.0, 0.0, 0.0])]
    v = spark.createDataFrame(rows, SCHEMA)
    x = {}
    for i, (pid, a) in enumerate(rows):
        if a is not None and np.isfinite(a).all():
            x[i] = (pid, np.array(a) / (np.linalg.norm(a) or 1))
    want = []
    for pid in {p for p, _ in x.values()}:
        near = sorted((-round(float(a @ b), 9), q) for p, a in x.values() if p == pid for q, b in x.values() if q != pid)[:7]
        want += [(pid, s) for s, _ in near]
    for n in (1, 5):
        got = [(r["pid"], -round(r["score"], 9)) for r in knn_exact(v, k=7, n_blocks=n).collect()]
        assert sorted(got) == sorted(want)


def test_vectors_of_one_part_travel_once_and_parts_meet_both_ways(spark, monkeypatch):
    v = some(spark, 200)
    got = knn_lsh(v, k=20, min_score=0.3, tables=2, bits=3)
    assert "CoGroup" not in plan(got)
    monkeypatch.setattr(meet, "PART", 12)
    parted = knn_lsh(v, k=20, min_score=0.3, tables=2, bits=3).select("pid", "near_pid")
    assert got.count() > 500 and got.select("pid", "near_pid").exceptAll(parted).count() == 0 and parted.count() == got.count()


def test_groups_with_more_pairs_than_the_table_give_the_pairs_that_share_one(spark):
    v = some(spark, 300)
    got = knn_lsh(v, k=300, min_score=0.0, tables=6, bits=2)  # 1.5 times all pairs
    from candor.operators.knn import bands
    keys = unit_vectors(v, "pid", "vector").select("pid", F.posexplode(bands(F.col("vec"), 8, 6, 2)).alias("t", "key"))
    share = keys.join(keys.withColumnRenamed("pid", "near_pid"), ["t", "key"]).where("pid <> near_pid").select("pid", "near_pid").distinct()
    want = knn_exact(v, k=300).where("score >= 0").join(share, ["pid", "near_pid"]).select("pid", "near_pid")
    assert "Window" not in plan(got) and got.count() == want.count() and got.select("pid", "near_pid").exceptAll(want).count() == 0


def test_the_registered_hash_search_finds_the_registered_scores(spark):
    from candor.plans import q_i2i
    from candor.plans.params import I2I_MIN_SCORE, KNN_K
    from candor.sources import fixtures as X

    exact = knn_exact(X.item_vectors(spark, SF01), k=KNN_K)
    assert knn_recall(q_i2i.q_knn_lsh(spark, SF01), exact, min_score=I2I_MIN_SCORE).first()["recall"] >= 0.9


def test_cut_leaves_keep_one_group_a_tree_for_repeated_ids(spark, monkeypatch):
    from candor.operators import forest

    monkeypatch.setattr(forest, "MAX_DEPTH", 1)
    v = some(spark, 300).unionByName(some(spark, 300, seed=4))
    r = routed(unit_vectors(v, "pid", "vector").withColumn("item", F.lit(True)), leaf=40, trees=3)
    assert r.count() == 600 and r.where("size(groups) <> 3").count() == 0
    assert r.select(F.posexplode("groups").alias("t", "g")).groupBy("t", "g").count().agg(F.max("count")).first()[0] <= 80
    assert knn_forest(v, k=5, leaf=40, trees=3).count() > 0
