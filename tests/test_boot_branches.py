"""Hand-made rows for every branch of the cold-start ladder (rules, rescue, exposure, weights)."""

from pyspark.sql import functions as F

from candor.operators import boot as B

RULES = B.load_rules()
T0 = 1_000_000_000
CAND_SCHEMA = ("pid long, ptype long, ct long, rec_t long, tid long, gid long, vdur long, source string, "
               "step_boot long, step_boot_t long, rec long, mid long, is_mover long, mover_support long, "
               "part1_id long, part2_id long")
CNT_FIELDS = ("rec", "sume", "gsume", "download", "like", "share", "review", "detail", "play_video", "play_dur")


def cand(pid, ptype=2, step_boot=0, age=100, vdur=30, is_mover=0, mover_support=0, part1=13, rec=0):
    return (pid, ptype, T0 - 1000, T0 - 900, 1, 7, vdur, "", step_boot, T0 - age, rec, 0, is_mover, mover_support,
            part1, 70)


def counters(spark, rows):
    full = []
    for r in rows:
        d = {f: 0 for f in CNT_FIELDS}
        d.update(r)
        full.append(tuple([d["pid"]] + [d[f] for f in CNT_FIELDS]))
    return spark.createDataFrame(full, "pid long, " + ", ".join(f"{f} long" for f in CNT_FIELDS))


def matched(spark, cands, cnts):
    c = spark.createDataFrame(cands, CAND_SCHEMA)
    f = B.boot_features(c, counters(spark, cnts), as_of=T0)
    return {r["pid"]: r for r in B.boot_rule_match(f, RULES).collect()}


def test_step0_empty_rule_passes_and_missing_counters_read_zero(spark):
    m = matched(spark, [cand(1, step_boot=0)], [])
    assert m[1]["matched"] is True and m[1]["rec"] == 0 and m[1]["ctr"] == 0.0


def test_in_flight_posts_are_not_evaluated(spark):
    m = matched(spark, [cand(1, step_boot=5), cand(2, step_boot=15)], [])
    assert m == {}


def test_img_step1_age_edge(spark):
    cs = [cand(1, step_boot=10, age=7800), cand(2, step_boot=10, age=7801), cand(3, step_boot=10, age=10)]
    m = matched(spark, cs, [{"pid": 1, "like": 1}, {"pid": 2, "like": 1}, {"pid": 3}])
    assert m[1]["matched"] and not m[2]["matched"] and not m[3]["matched"]


def test_img_step2_guarded_division_at_rec_zero(spark):
    m = matched(spark, [cand(1, step_boot=20, age=10)], [{"pid": 1, "rec": 0, "review": 1}])
    assert m[1]["matched"] is False
    m = matched(spark, [cand(2, step_boot=20, age=10)], [{"pid": 2, "rec": 300, "review": 1}])
    assert m[2]["matched"] is True


def test_step_past_ladder_fails(spark):
    m = matched(spark, [cand(1, step_boot=30), cand(2, ptype=5, step_boot=40)], [])
    assert not m[1]["matched"] and not m[2]["matched"]


def test_video_step1_partition_dependent_threshold(spark):
    # part1 15/17 need 4 engagements (+ play score), others 3; ctr must exceed 0.35
    base = {"rec": 10, "sume": 5, "like": 4}   # no plays: video_play_score = -1, so the sum is 3
    cs = [cand(1, ptype=5, step_boot=10, age=10, part1=15), cand(2, ptype=5, step_boot=10, age=10, part1=14)]
    m = matched(spark, cs, [dict(base, pid=1), dict(base, pid=2)])
    assert not m[1]["matched"] and m[2]["matched"]


def test_video_play_score(spark):
    c = spark.createDataFrame([cand(1, ptype=5, vdur=20), cand(2, ptype=5, vdur=100), cand(3, ptype=2)], CAND_SCHEMA)
    cnt = counters(spark, [{"pid": 1, "play_video": 2, "play_dur": 2 * 12000}, {"pid": 2, "play_video": 1, "play_dur": 5000},
                           {"pid": 3, "play_video": 1, "play_dur": 5000}])
    f = {r["pid"]: r for r in B.boot_features(c, cnt, as_of=T0).collect()}
    assert f[1]["video_play_score"] == 1 and f[1]["avg_play_dur"] == 12.0 and f[1]["play_rate"] == 0.6
    assert f[2]["video_play_score"] == -1
    assert f[3]["video_play_score"] == 0 and f[3]["avg_play_dur"] == 0.0


def test_mover_rescue_edges(spark):
    cs = [cand(i, step_boot=10, age=a, is_mover=1) for i, a in enumerate([7800, 7801, 8100, 8101], start=1)]
    cs += [cand(5, step_boot=20, age=43200, is_mover=1), cand(6, step_boot=20, age=43201, is_mover=1),
           cand(7, step_boot=20, age=43201, is_mover=1, mover_support=1), cand(8, step_boot=10, age=7900, is_mover=0)]
    m = matched(spark, cs, [])   # no engagement: every rule beyond step 0 fails
    got = {p: r["rescued"] for p, r in m.items()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True, 7: False, 8: False}


def left(spark, rows):
    df = spark.createDataFrame(rows, "pid long, ptype long, rec long, pool_rec long, step long, matched boolean, rescued boolean")
    return {r["pid"]: (r["level"], r["left_expose"], r["jump_to"]) for r in B.boot_left_expose(df, RULES).collect()}


def test_ladder_edges_video(spark):
    got = left(spark, [(1, 5, 199, 0, 0, True, False), (2, 5, 200, 0, 0, True, False), (3, 5, 0, 499, 1, True, False),
                       (4, 5, 500, 0, 1, True, False), (5, 5, 999, 0, 2, True, False), (6, 5, 1000, 0, 2, True, False)])
    assert got[1] == (0, 1, None)
    assert got[2] == (1, 0, 10)          # already past step 0's threshold: skip ahead
    assert got[3] == (1, 1, None)        # pool rec counts: 500 - max(499, 200)
    assert got[4] == (2, 0, 20)
    assert got[5] == (2, 1, None)
    assert got[6] == (3, 0, 30)


def test_ladder_edges_img_and_previous_threshold_clamp(spark):
    got = left(spark, [(1, 2, 50, 0, 1, False, True), (2, 2, 150, 0, 1, True, False), (3, 3, 99, 0, 0, True, False),
                       (4, 2, 100, 0, 0, True, False), (5, 2, 10, 0, 2, True, False)])
    assert got[1] == (0, 100, None)      # 200 - max(50, 100)
    assert got[2] == (1, 50, None)
    assert got[3] == (0, 1, None)
    assert got[4] == (1, 0, 10)
    assert got[5] == (0, 300, None)      # 500 - max(10, 200)


def weights(spark, rows, ptypes):
    w = B.boot_gender_weight(
        spark.createDataFrame(rows, "pid long, " + ", ".join(f"s{g}_{f} long" for g in (1, 2) for f in
                                                            ("rec", "download", "like", "sume", "play_video", "play_dur"))),
        spark.createDataFrame(ptypes, "pid long, ptype long"),
    )
    return {r["pid"]: r["weight"] for r in w.collect()}


def test_gender_weight_branches(spark):
    z = (0,) * 6
    rows = [
        (1, 10, 1, 1, 0, 0, 0) + z,                       # only group 1 scored
        (2, 25, 0, 0, 0, 0, 0) + (10, 1, 1, 1, 0, 0),      # both exposed -> sume/rec; only group 2 scores, group 1 >= 20
        (3, 5, 0, 0, 0, 0, 0) + (10, 1, 1, 1, 0, 0),       # same, group 1 has < 20 exposures
        (4, 100, 0, 0, 1, 0, 0) + (100, 0, 0, 160, 0, 0),  # image: sume/rec both sides
        (5, 10, 0, 0, 0, 2, 3000) + (10, 0, 0, 0, 3, 3000),  # video: play_dur / play_video
        (6,) + z + z,
    ]
    got = weights(spark, rows, [(1, 2), (2, 2), (3, 2), (4, 2), (5, 5), (6, 3), (7, 2)])
    assert got[1] == "1.2:1.0" and got[2] == "0.8:1.5" and got[3] == "1.0:1.5" and got[6] == "1.0:1.0"
    s1, s2 = 1 / 100, 160 / 100
    assert got[4] == "%.4f:%.4f" % (s1 / s2, s2 / s1)    # exact-binary rounding of the 1/160 tie
    assert got[5] == "%.4f:%.4f" % (1500 / 1000, 1000 / 1500)
    assert got[7] == "1.0:1.0"                           # missing counters


def test_candidates_sibling_suppression_and_movers(spark):
    from candor.sources import fixtures as X

    docs = X.pool_docs(spark, "/root/testdata/sf0.001")
    # hand rows: gid 900 holds a 12000-exposure post (pid 9001) and two new posts
    extra = spark.sql(f"""
      SELECT * FROM VALUES
        (9001L, 12000L, 10L, 40L, 1L), (9002L, 10L, 10L, 0L, 58L), (9003L, 10L, 0L, 0L, 1L), (9004L, 10L, 0L, 1L, 58L)
      AS t(pid, rec, step_boot, mover_level, mover_part_id)""")
    given = {"pid", "gid", "step_boot", "author", "score_values", "ct", "rec_t", "status", "resource_status",
             "subarea_status", "tid", "rec", "mover_level", "mover_part_id"}
    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields if f.name not in given]
    rows = extra.select("*", *fill).select(
        "*", F.lit(900).cast("bigint").alias("gid"), F.lit(T0 - 100).cast("bigint").alias("ct"),
        F.lit(0).cast("bigint").alias("resource_status"), F.lit(0).cast("bigint").alias("subarea_status"),
        F.lit(1).cast("bigint").alias("tid"),
        F.lit(T0 - 50).cast("bigint").alias("rec_t"), F.lit(2).cast("bigint").alias("status"),
        F.struct(F.lit(0).cast("bigint").alias("fans"), F.lit(0).cast("bigint").alias("atts"), "mover_level",
                 "mover_part_id").alias("author"),
        F.struct(F.col("rec"), *[F.lit(None).cast(t).alias(n) for n, t in
                                 [("download", "bigint"), ("like", "bigint"), ("review", "bigint"), ("share", "bigint"),
                                  ("qscore", "double"), ("real_sume", "bigint"), ("ctr", "double"), ("play_rate", "double"),
                                  ("dtr", "double"), ("detail", "bigint")]]).alias("score_values"),
    ).select(*docs.columns)
    ov = X.step_override(spark, "/root/testdata/sf0.001").limit(0)
    tax = X.taxonomy(spark, "/root/testdata/sf0.001")
    c = {r["pid"]: r for r in B.boot_candidates(rows, ov, tax, as_of=T0, days=1).collect()}
    assert 9001 in c                       # its siblings are small
    assert 9002 not in c                   # step 1 with a 12000 sibling
    assert 9003 in c                       # step 0 is never suppressed
    assert c[9001]["is_mover"] == 1       # mover level > 0, partition not excluded
    assert c[9003]["is_mover"] == 0       # no mover level
    assert c[9004]["is_mover"] == 0       # partition 58 is excluded


def test_transition_states_are_ladder_states(spark):
    from candor.plans.registry import load_all

    out = load_all()["boot_transition"].run(spark, "/root/testdata/sf0.01")
    bad = out.filter((F.col("output") != "serving") & ~((F.col("step_boot") % 10).isin(0, 5))).count()
    assert bad == 0
    assert out.filter((F.col("output") == "serving") & (F.col("remaining") < 0)).count() == 0


def test_rule_config_validation():
    import pytest

    bad_order = "video:\n  - {step: 0, expose_to: 200, rule: ''}\n  - {step: 1, expose_to: 100, rule: ''}\nimg:\n  - {step: 0, expose_to: 1, rule: ''}\n"
    with pytest.raises(ValueError):
        B.load_rules(bad_order)
    gap = "video:\n  - {step: 0, expose_to: 200, rule: ''}\n  - {step: 2, expose_to: 300, rule: ''}\nimg:\n  - {step: 0, expose_to: 1, rule: ''}\n"
    with pytest.raises(ValueError):
        B.load_rules(gap)
    assert B.load_rules()["video"][2]["expose_to"] == 1000
