"""Boundary rows for the pool clean, community index and review board filters."""

from pyspark.sql import functions as F

from candor.operators.community import community_review_index
from candor.operators.pool import pool_clean
from candor.operators.review import review_board
from candor.sources import fixtures as X
from core_data import SF001

T0 = 1_000_000_000
DAY = 86400


def _docs(spark, rows):
    """rows: (pid, ct, rec, download, like, choice_status, gid, ptype, status, tid, tag)."""
    schema = X.pool_docs(spark, SF001).schema
    d = spark.createDataFrame(rows, "pid long, ct long, rec long, download long, like long, choice_status long, "
                                    "gid long, ptype long, status long, tid long, community_tag long")
    sv = F.struct(F.col("rec"), F.col("download"), F.col("like"), F.lit(0).cast("bigint").alias("review"),
                  F.lit(0).cast("bigint").alias("share"), F.lit(0.0).alias("qscore"), F.lit(0).cast("bigint").alias("real_sume"),
                  F.lit(0.0).alias("ctr"), F.lit(0.0).alias("play_rate"), F.lit(0.0).alias("dtr"),
                  F.lit(0).cast("bigint").alias("detail")).alias("score_values")
    cols = [F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields if f.name != "score_values"]
    return d.select(*cols, sv)


def test_pool_clean_age_and_rate_edges(spark):
    ok = dict(rec=5000, download=100, like=100, choice=30, gid=1, ptype=2, status=2, tid=1, tag=0)

    def row(pid, age, **kw):
        v = dict(ok, **kw)
        return (pid, T0 - age, v["rec"], v["download"], v["like"], v["choice"], v["gid"], v["ptype"], v["status"],
                v["tid"], v["tag"])

    rows = [
        row(1, 30 * DAY, rec=999),                    # exactly 30 days: kept (strict >)
        row(2, 30 * DAY + 1, rec=999),                # older and rec < 1000: dropped
        row(3, 120 * DAY + 1, choice=0),              # older than 120 days outside the choice pool: dropped
        row(4, 120 * DAY, choice=0),                  # exactly 120 days: kept
        row(5, 31 * DAY, rec=1000, download=3, like=3),   # 3/1010 < 0.003 both: dropped
        row(6, 31 * DAY, rec=1000, download=4, like=0),   # 4/1010 >= 0.003: kept
        row(7, DAY, gid=0), row(8, DAY, ptype=1), row(9, DAY, status=1), row(0, DAY),   # id / type / status drops
    ]
    docs = _docs(spark, rows)
    ov = X.step_override(spark, SF001).limit(0)
    kept = sorted(r["pid"] for r in pool_clean(docs, ov, as_of=T0).select("pid").collect())
    assert kept == [1, 4, 6]


def test_community_edges(spark):
    rows = [(p, T0 - DAY, 0, 0, 0, 0, 1, 5 if p % 2 else 2, 2, 1, 1040) for p in range(1, 7)]
    docs = _docs(spark, rows)
    cnt = spark.createDataFrame(
        [(1, 100, 19), (2, 100, 20), (3, 9999, 1), (4, 10000, 1), (5, 0, 0), (6, 160, 1)],
        "pid long, rec long, review long")
    tax = spark.createDataFrame([(1, 70, 13), (2, 71, 13)], "tid long, part2_id long, part1_id long")
    out = {r["index_key"]: r["value"] for r in community_review_index(docs, cnt, tax, as_of=T0, days=7).collect()}
    assert out["index_part2_community_review_video_70#0"] == "1:0.19,3:0.0001,5:0"
    assert out["index_part2_community_review_img_70#0"] == "6:0.0063"      # 1/160, rounded as '%.4f' does
    assert out["index_part2_community_review_video_71#0"] == "" and out["index_part2_community_review_img_71#0"] == ""


def test_review_board_having_edges(spark):
    b = spark.createDataFrame(
        [(1, "20240101", 1, 2, 1)] * 2 + [(1, "20240101", 1, 1, 0)] * 1 +      # pid 1: reviews 2+2+1 = 5
        [(2, "20240101", 1, 2, 0)] * 2 +                                       # pid 2: reviews 4 -> dropped
        [(3, "20240101", 1, 0, 0)] * 300 + [(3, "20240101", 1, 5, 0)] * 3,      # pid 3: 6/303 >= 0.004? yes (0.0198)
        "pid long, ymd string, expose long, create_review long, reply_review long")
    posts = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], "pid long, ct long")
    got = {r["pid"]: (r["review_cnt"], r["expose"]) for r in review_board(b, posts, since_day="20010101").collect()}
    assert got == {1: (5, 3), 3: (6, 303)}
    got2 = review_board(b, posts, since_day="20010101", min_rate=0.02).select("pid").collect()
    assert [r["pid"] for r in got2] == [1]


def test_pool_clean_step_override_branch(spark):
    t1 = 1_600_000_000                    # after the override epoch (1595174400)
    rows = [(1, t1 - DAY, 5000, 100, 100, 30, 1, 2, 2, 1, 0),     # step 0, recent, override exists -> taken
            (2, t1 - DAY, 5000, 100, 100, 30, 1, 2, 2, 1, 0),     # step 0, no override row -> kept as is
            (3, 1_500_000_000, 5000, 100, 100, 30, 1, 2, 2, 1, 0)]  # created before the epoch -> not looked up
    docs = _docs(spark, rows).withColumn("step_boot", F.lit(0).cast("bigint")).withColumn("step_boot_t", F.lit(7).cast("bigint"))
    ov = spark.createDataFrame([(1, 20, 123, 0, None), (3, 30, 456, 0, None)],
                               "pid long, step_boot long, step_boot_t long, mover_support long, real_step long")
    got = {r["pid"]: (r["step_boot"], r["step_boot_t"]) for r in pool_clean(docs, ov, as_of=t1).collect()}
    assert got == {1: (20, 123), 2: (0, 7), 3: (0, 7)}


def test_community_zero_reviews_text(spark):
    docs = _docs(spark, [(1, T0 - DAY, 0, 0, 0, 0, 1, 2, 2, 1, 1050)])
    cnt = spark.createDataFrame([(1, 50, 0)], "pid long, rec long, review long")
    tax = spark.createDataFrame([(1, 70, 13)], "tid long, part2_id long, part1_id long")
    out = {r["index_key"]: r["value"] for r in community_review_index(docs, cnt, tax, as_of=T0, days=7).collect()}
    assert out["index_part2_community_review_img_70#0"] == "1:0.0"   # float zero, as str(0.0)
