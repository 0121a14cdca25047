"""Branch and invariant tests for the non-cold-start operators."""

import pytest
from pyspark.sql import functions as F

from candor.functions.scalars import clip01, play_rate_denominator
from candor.operators.counters import post_standard_gate
from candor.operators.index import short_groups, topn_index
from candor.operators.knn import knn_exact, knn_lsh, knn_recall
from candor.operators.neighbours import parse_neighbour_lines
from candor.operators.pool import POOL_COLUMNS
from candor.plans.registry import load_all
from core_data import SF001, SF01

REG = load_all()


def test_play_rate_denominator_and_clip(spark):
    df = spark.createDataFrame([(0,), (5,), (9,), (10,), (30,), (None,)], "v long")
    got = [r[0] for r in df.select(play_rate_denominator("v")).collect()]
    assert got == [900, 10, 10, 10, 30, 900]
    c = spark.createDataFrame([(-0.5,), (0.3,), (1.7,), (None,)], "x double").select(clip01("x")).collect()
    assert [r[0] for r in c] == [0.0, 0.3, 1.0, None]


def test_standard_gate(spark):
    rates = spark.createDataFrame(
        [(1, 5, 70, 6.0, 10.0), (2, 5, 71, 9.0, 9.0), (3, 2, 70, 9.0, 0.0), (4, 5, 72, 8.0, 19.0),
         (5, 5, 73, 5.0, 5.0), (6, 5, 73, 9.0, 8.9)],
        "pid long, ptype long, part2_id long, download_rate double, like_rate double")
    std = spark.createDataFrame(
        [("video_70", 50, 6.7, 9.9), ("video_72", 10, 25.0, 30.0), ("video_73", 9, 1.0, 1.0), ("img", 50, 6.5, 8.5)],
        "key string, pcnt long, dl double, lk double",
    ).select("key", "pcnt", F.struct(F.struct(F.col("dl").alias("download_rate"), F.col("lk").alias("like_rate")).alias("a"))
             .alias("gender_standard"))
    got = {r["pid"]: r["meets_standard"] for r in post_standard_gate(rates, std).collect()}
    assert got[1] is True        # floor(6.7)=6, floor(9.9)=9
    assert got[2] is True        # no standard for video_71 -> 9/9
    assert got[3] is True        # image with download >= 9
    assert got[4] is False       # thresholds capped at 20 (from 25/30); 8 and 19 reach neither clause
    assert got[5] is False       # pcnt < 10 ignored -> 9/9 not reached
    assert got[6] is False


def test_topn_index_order_limit_and_chunks(spark):
    df = spark.createDataFrame([("a", i, float(i % 3)) for i in range(10)] + [("b", 1, 0.5)], "g string, pid long, score double")
    top = {r["index_key"]: r for r in topn_index(df, keys=["g"], score_col="score", top=4, prefix="k_", as_of=0, ttl=5).collect()}
    assert top["k_a"]["value"] == "2:2.000000,5:2.000000,8:2.000000,1:1.000000"
    assert top["k_a"]["n_items"] == 4 and top["k_a"]["expires_at"] == 5
    allr = topn_index(df, keys=["g"], score_col="score", top=0, prefix="k_", as_of=0, chunk=3).collect()
    a = sorted((r["chunk"], r["n_items"]) for r in allr if r["index_key"].startswith("k_a#"))
    assert a == [(0, 3), (1, 3), (2, 3), (3, 1)]
    s = short_groups(df, keys=["g"], min_limit=5, prefix="k_").collect()
    assert [(r["index_key"], r["n"]) for r in s] == [("k_b", 1)]


def test_parse_neighbour_lines(spark):
    lines = spark.createDataFrame(
        [("1\x012:0.5,3:0.25",), ("4 5:0.9",), ("bad line here",), ("6",), ("7 x:0.1,8:0.2",)], "value string")
    got = sorted((r["pid"], r["pos"], r["near_pid"], r["score"]) for r in parse_neighbour_lines(lines).collect())
    assert got == [(1, 0, 2, 0.5), (1, 1, 3, 0.25), (4, 0, 5, 0.9), (7, 1, 8, 0.2)]


def test_pool_clean_has_45_columns_and_strict_age(spark):
    out = REG["pool_clean"].run(spark, SF01)
    assert tuple(out.columns) == POOL_COLUMNS and len(POOL_COLUMNS) == 45


def test_norms_in_unit_interval_and_dense_ranks(spark):
    for name in ("hot_video_rank", "hot_img_rank"):
        df = REG[name].run(spark, SF01)
        norms = [c for c in df.columns if c.endswith("_norm")]
        bad = df.filter(" OR ".join(f"{c} < 0 OR {c} > 1" for c in norms)).count()
        assert bad == 0
        g = df.groupBy("group_gender", "group_age", "part2_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("reviewed_rank").alias("lo"), F.max("reviewed_rank").alias("hi"),
            F.countDistinct("reviewed_rank").alias("d"))
        assert g.filter("lo != 1 OR hi != n OR d != n").count() == 0


def test_no_self_neighbours_and_list_limits(spark):
    n = REG["i2i_neighbours"].run(spark, SF01)
    assert n.filter("pid = near_pid").count() == 0
    for name in ("i2i_index", "i2i_quality_index"):
        assert REG[name].run(spark, SF01).filter("n_items > 100").count() == 0


def test_lsh_recall_floor(spark):
    from candor.sources import fixtures as X

    v = X.item_vectors(spark, SF01)
    exact = knn_exact(v, k=200)
    approx = knn_lsh(v, k=200, min_score=0.2, tables=32, bits=3)   # nearly orthogonal vectors: few bits, many tables
    r = knn_recall(approx, exact, min_score=0.2).collect()[0]
    assert r["exact_pairs"] > 0 and r["recall"] >= 0.9


def test_stream_equals_batch(spark):
    from candor.sources import fixtures as X
    from candor.streaming.counters_stream import counter_aggregate, with_gender

    stream = REG["stream_counters"].run(spark, SF01)
    batch = counter_aggregate(with_gender(X.exposure_events(spark, SF01), X.users(spark, SF01)))
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_stream_boot_transitions_are_ladder_moves(spark):
    t = REG["stream_boot"].run(spark, SF01)
    assert t.count() > 0
    assert t.filter("output = 'pool' AND step_boot % 5 != 0").count() == 0


def test_skew_safe_row_number_splits_hot_group(spark):
    from pyspark.sql import Window

    from candor.operators.skew import skew_safe_row_number

    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.col("id").alias("pid"), ((F.col("id") * 7919) % 1000).cast("double").alias("score"))
    order = [F.col("score").desc(), F.col("pid").asc()]
    got = skew_safe_row_number(df, ["g"], order, name="rn", num_partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.select("g", "pid", "rn").exceptAll(want.select("g", "pid", "rn")).count() == 0
    assert got.count() == 20000
    parts = got.filter("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1   # the hot group was numbered across several partitions


def test_knn_exact_independent_of_blocks_and_shuffle_partitions(spark):
    from candor.sources import fixtures as X

    v = X.item_vectors(spark, SF01)
    one = knn_exact(v, k=50, n_blocks=1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        three = knn_exact(v, k=50, n_blocks=3)
        assert three.count() == 500 * 50
        a = one.select("pid", "near_pid", F.round("score", 9).alias("s"))
        b = three.select("pid", "near_pid", F.round("score", 9).alias("s"))
        assert a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_training_window_and_schedule():
    from candor.operators.sequences import choose_mode, training_days

    as_of = 1706659200 + 4 * 3600   # 2024-01-31 04:00 UTC
    assert training_days(as_of, max_day=30, mode="full") == ("2023-12-31", "2024-01-30")
    assert training_days(as_of, max_day=7, mode="incremental") == ("2024-01-31", "2024-01-31")
    assert choose_mode(as_of, full_done_today=False) == "full"
    assert choose_mode(as_of, full_done_today=True) == "incremental"
    assert choose_mode(1706659200 + 3600, full_done_today=False) == "incremental"


def test_bounds_are_exact_percentiles(spark):
    from candor.operators import engagement as E
    from candor.plans import q_hot

    c = q_hot.cells(spark, SF001).filter("ptype = 5")
    same = spark.createDataFrame([(5, 1, 1, 1, 1 / 201)] * 3, "ptype long, part2_id long, group_age long, group_gender long, ctr double")
    r = E.robust_bounds(same, {"ctr": (1.5, 1.5)}).first()   # equal values: the range is exactly zero
    assert r["ctr_min"] == r["ctr_max"] == 1 / 201
    got = E.exact_quantiles(c, E.CELL_KEYS, ["ctr", "dur"], (0.15, 0.95), scale=1e5)
    want = c.groupBy(*E.CELL_KEYS).agg(*[F.percentile(F.col(m) * 1e5, F.array(F.lit(0.15), F.lit(0.95))).alias(f"__q_{m}") for m in ("ctr", "dur")])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0     # bit-identical
    both = q_hot.cells(spark, SF001)
    one = E.robust_bounds(both, q_hot.IMG_ALL, video_fences=q_hot.VIDEO_ALL).filter("ptype = 5")
    assert one.exceptAll(E.robust_bounds(both.filter("ptype = 5"), q_hot.VIDEO_ALL).select(*one.columns)).count() == 0


def test_no_pair_is_lost_at_the_edges_of_long_sentences(spark):
    from candor.operators.embed import cooccurrence
    from candor.operators.sequences import behaviour_sequences

    n = 1203
    a = spark.range(n).selectExpr("1 AS mid", "id * 7919 % 50 AS pid", "timestamp_seconds(1706572800 + id) AS ts", "id AS event_id")
    seq = behaviour_sequences(a, as_of=1706659200)
    assert [r["n"] for r in seq.orderBy("part").selectExpr("size(items) AS n").collect()] == [1000, 203]
    items = [str(i * 7919 % 50) for i in range(n)]
    want = {}
    for i in range(n):
        for j in range(i + 1, min(n, i + 6)):
            if items[i] != items[j]:
                for p in ((items[i], items[j]), (items[j], items[i])):
                    want[p] = want.get(p, 0) + 1
    got = {(r["item"], r["ctx"]): r["n"] for r in cooccurrence(seq, min_count=1).collect()}
    assert got == want


def test_cooccurrence_counts_add_up_over_days(spark):
    from candor.operators.embed import cooccurrence, cooccurrence_vectors, sign_bits, signs_of, summed
    from candor.plans.q_i2i import sequences

    seq = sequences(spark, SF01)
    one, two = seq.filter("day < '2024-01-15'"), seq.filter("day >= '2024-01-15'")
    parts = cooccurrence(one, min_count=1).unionByName(cooccurrence(two, min_count=1))
    whole = cooccurrence(seq, min_count=1)
    assert summed(parts).exceptAll(whole).count() == 0
    v = cooccurrence_vectors(whole, size=130)
    assert v.filter("size(vector) != 130").count() == 0 and v.count() == 100
    signs = spark.range(1).select(sign_bits(F.lit("abc"), 130).alias("s")).first()["s"]
    assert [int(x) for x in signs] == signs_of("abc", 130)


def test_lsh_prunes_and_finds_near_vectors(spark):
    import numpy as np

    from candor.operators.knn import bands, knn_lsh, knn_recall, unit_vectors

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 64))
    rows = [(i, (centres[i % 40] + 0.35 * rng.normal(size=64)).tolist()) for i in range(800)]
    v = spark.createDataFrame(rows, "pid long, vector array<double>")
    keys = unit_vectors(v, "pid", "vector").select("pid", F.posexplode(bands(F.col("vec"), 64, 8, 6)).alias("t", "key"))
    other = keys.withColumnRenamed("pid", "near")
    candidates = keys.join(other, ["t", "key"]).filter("pid != near").select("pid", "near").distinct().count()
    assert candidates < 0.2 * 800 * 799
    got = knn_lsh(v, k=50, min_score=0.8)
    recall = knn_recall(got, knn_exact(v, k=50), min_score=0.8).first()
    assert recall["exact_pairs"] > 5000 and recall["recall"] >= 0.85
    assert got.groupBy("pid", "near_pid").count().filter("count > 1").count() == 0


def test_division_by_zero_matches_nothing_and_ends_nothing(spark):
    from candor.operators.boot import safe_division

    assert safe_division("download/rec > 0.008 and (like+2*review)/ (rec + 1) >= 1") == \
        "download/ nullif(rec, 0) > 0.008 and (like+2*review)/ nullif((rec + 1), 0) >= 1"
    assert safe_division("a/b/c + d/greatest(e/f, 1)") == "a/ nullif(b, 0)/ nullif(c, 0) + d/ nullif(greatest(e/ nullif(f, 0), 1), 0)"
    for bad in ("a/", "a / + b"):
        with pytest.raises(ValueError):
            safe_division(bad)


def test_item2vec_als_path(spark):
    from candor.operators.embed import cooccurrence, item2vec
    from candor.plans.q_i2i import sequences

    seq = sequences(spark, SF01)
    co = cooccurrence(seq, window=2, min_count=1)
    # symmetric counts, never an item with itself
    assert co.filter("item = ctx").count() == 0
    assert co.alias("x").join(co.alias("y"), (F.col("x.item") == F.col("y.ctx")) & (F.col("x.ctx") == F.col("y.item"))
                              & (F.col("x.n") == F.col("y.n"))).count() == co.count()
    v = item2vec(seq, method="als", size=8, epochs=3)
    w = item2vec(seq, size=8, epochs=1, method="word2vec")
    assert v.count() == w.count() == item2vec(seq, size=8).count() == 100     # same vocabulary (all 100 items reach min_count)
    assert v.filter(F.size("vector") != 8).count() == 0


def test_hot_weights_as_table_equal_dict(spark):
    from candor import constants as C
    from candor.operators import ranking as R
    from candor.plans import q_hot

    cells = q_hot.cells(spark, SF01)
    rows = [(g, a, *C.VIDEO_WEIGHTS.values()) for g in C.WEIGHT_GENDERS for a in C.WEIGHT_AGES if (g, a) != (1, 3)]
    wt = spark.createDataFrame(rows, ["group_gender", "group_age", *C.VIDEO_WEIGHTS.keys()])
    table = R.hot_video_rank(cells, weights=wt)
    default = R.hot_video_rank(cells)
    cmp = table.alias("t").join(default.alias("d"), ["group_gender", "group_age", "part2_id", "pid"])
    same = cmp.filter("NOT (group_gender = 1 AND group_age = 3)").filter("t.recall_score <=> d.recall_score").count()
    assert same == default.filter("NOT (group_gender = 1 AND group_age = 3)").count()
    assert table.filter("group_gender = 1 AND group_age = 3 AND recall_score IS NOT NULL").count() == 0


def test_top_per_group_with_hot_group(spark):
    from pyspark.sql import Window

    from candor.operators.skew import top_per_group

    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id") % 5).alias("g"),
                                  F.col("id").alias("pid"), ((F.col("id") * 7) % 113).cast("double").alias("s"))
    order = [F.col("s").desc(), F.col("pid").asc()]
    got = top_per_group(df, ["g"], order, 10, name="rn", salts=7)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order))).filter("rn <= 10")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and want.count() == got.count()


def test_user_vector_recall_lsh_close_to_exact(spark):
    from candor.operators.recall import user_vector_recall
    from candor.sources import fixtures as X

    acts, vecs = X.event_actions(spark, SF01), X.item_vectors(spark, SF01)
    ex = user_vector_recall(acts, vecs, k=20, method="exact")
    ap = user_vector_recall(acts, vecs, k=20, method="lsh", tables=32, bits=4)
    ex_pairs = ex.filter("score >= 0.3").select("mid", "pid")
    found = ex_pairs.join(ap.select("mid", "pid"), ["mid", "pid"], "left_semi").count()
    assert ex_pairs.count() > 0 and found / ex_pairs.count() >= 0.9


def test_empty_inputs_do_not_fail(spark):
    from candor.operators import boot as B
    from candor.operators.community import community_review_index
    from candor.operators.engagement import engagement_cells
    from candor.operators.index import topn_index
    from candor.operators.ranking import hot_img_rank, hot_video_rank
    from candor.sources import fixtures as X

    d = "/root/testdata/sf0.001"
    cells = engagement_cells(X.behaviour(spark, d), X.pool(spark, d), X.posts(spark, d), X.users(spark, d),
                             X.taxonomy(spark, d), since_day="20990101")          # nothing in the window
    assert cells.count() == 0
    assert hot_video_rank(cells).count() == 0 and hot_img_rank(cells).count() == 0
    assert topn_index(hot_video_rank(cells), keys=["part2_id"], score_col="recall_score", top=0, as_of=0).count() == 0
    assert knn_exact(X.item_vectors(spark, d).limit(0), k=5).count() == 0
    docs = X.pool_docs(spark, d)
    idx = community_review_index(docs.limit(0), X.counters(spark, d), X.taxonomy(spark, d), as_of=X.AS_OF)
    assert idx.filter("chunk < 0").count() == 50 and idx.filter("chunk >= 0 AND value != ''").count() == 0   # every partition, empty lists
    cands = B.boot_candidates(docs, X.step_override(spark, d), X.taxonomy(spark, d), as_of=X.AS_OF + 400 * 86400)
    t = B.boot_transition(cands, X.counters(spark, d), X.serving_budget(spark, d).limit(0), docs,
                          X.step_override(spark, d), B.load_rules(), as_of=X.AS_OF)
    assert cands.count() == 0 and t.count() == 0


def test_recall_of_the_registered_neighbour_queries(spark):
    from candor.operators.recall import user_vector_recall
    from candor.plans import q_i2i, q_recall
    from candor.plans.params import I2I_MIN_SCORE, KNN_K
    from candor.sources import fixtures as X

    acts, vecs = X.event_actions(spark, SF01), X.item_vectors(spark, SF01)
    items = knn_recall(q_i2i.q_knn_forest(spark, SF01), knn_exact(vecs, k=KNN_K), min_score=I2I_MIN_SCORE).first()
    exact = user_vector_recall(acts, vecs, last_n=q_recall.U2I_LAST_N, k=q_recall.K_U2I, method="exact")
    users = knn_recall(q_recall.q_user_vector_recall(spark, SF01).withColumnsRenamed({"pid": "near_pid", "mid": "pid"}),
                       exact.withColumnsRenamed({"pid": "near_pid", "mid": "pid"}), min_score=0.0).first()
    print("items", items, "users", users)
    assert items["exact_pairs"] > 1000 and users["exact_pairs"] > 1000
    assert items["recall"] >= 0.9 and users["recall"] >= 0.9


def test_knn_exact_blocks_follow_the_number_of_vectors(spark, monkeypatch):
    from candor.operators import knn
    from candor.sources import fixtures as X

    v = X.item_vectors(spark, SF01)
    want = {(r["pid"], r["near_pid"]) for r in knn_exact(v, k=5, n_blocks=1).collect()}
    plain = knn._block_topk

    def bounded(k, exclude_self=True):
        topk = plain(k, exclude_self)

        def run(left, right):
            assert max(len(left), len(right)) <= 64, "a block grows with the table"
            return topk(left, right)

        return run

    monkeypatch.setattr(knn, "_block_topk", bounded)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 32, raising=False)
    assert {(r["pid"], r["near_pid"]) for r in knn_exact(v, k=5).collect()} == want
    users = v.limit(40)
    assert knn_exact(users, k=5, others=v).count() == 40 * 5
