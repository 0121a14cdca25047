"""Reference-shaped inputs derived from the TPC-H-like test tables.

The upstream jobs read a behaviour fact table, a candidate pool, post/user metadata, a
topic taxonomy, per-post counters and a few small state tables. The test folders carry
none of these, so each is derived here from the raw tables by a fixed rule (documented
in FIXTURES.md section 2). The oracle SQL (``candor.plans.fixture_sql``) derives the
same views with the same rules, so Spark and DuckDB see identical inputs.

All derivations are plain projections, joins and group-bys: they scale with the raw
tables and keep Parquet column pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# FIXED VALUES of the fixture mapping
AS_OF = 1004918400             # 2001-11-05 UTC, the day after the last ship date
EVENTS_AS_OF = 1706659200      # 2024-01-31 UTC, the day after the last event
STEP_BOOT_T_AGES = (300, 1000, 5000, 7900, 8200, 50000)


def _k(name: str = "k") -> Column:
    return F.col(name)


def ptype_of(k: Column) -> Column:
    """k%3=0 -> video (5), otherwise 2 + k%3."""
    return F.when(k % 3 == 0, F.lit(5)).otherwise(F.lit(2) + k % 3).cast("bigint")


def behaviour(spark: SparkSession, d: str, orders: DataFrame | None = None) -> DataFrame:
    """user_post_score: one row per (order line) = one user-post-day score row.

    ``orders`` (o_orderkey, o_custkey) may carry more columns, which follow the others.
    """
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey") if orders is None else orders
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    k = F.col("l_partkey")
    ln = F.col("l_linenumber").cast("bigint")
    q = F.col("l_quantity")
    return j.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("ymd"),
        F.col("o_custkey").alias("mid"),
        k.alias("pid"),
        ptype_of(k).alias("ptype"),
        F.lit(0).cast("bigint").alias("vdur"),
        (ln % 7 != 0).cast("bigint").alias("expose"),
        (ln % 4 == 0).cast("bigint").alias("share"),
        (F.col("l_tax") > 0.04).cast("bigint").alias("download"),
        (F.col("l_discount") > 0.05).cast("bigint").alias("like"),
        (ln % 2).alias("view_img"),
        (F.col("l_linestatus") == "O").cast("bigint").alias("detail_post"),
        (ln % 3).alias("create_review"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("reply_review"),
        (ln % 2).alias("reviews_review"),
        (ln % 5 == 0).cast("bigint").alias("like_review"),
        (F.col("l_extendedprice") / 200).alias("stay_time"),
        (q * 8).alias("play_video_dur"),
        (ln % 4).cast("double").alias("stay_img_dur"),
        (q * 10).alias("view_img_dur"),
        (q * 20).alias("detail_post_dur"),
        (q * 15).alias("view_comment_dur"),
        *[c for c in o.columns if c not in ("o_orderkey", "o_custkey")],
    )


def users(spark: SparkSession, d: str) -> DataFrame:
    """usermetadata: every customer; age = key%5, gender = nation%4 with 3 meaning unknown (null)."""
    c = table(spark, d, "customer")
    g = (F.col("c_nationkey") % 4).cast("bigint")
    return c.select(
        F.col("c_custkey").alias("mid"),
        (F.col("c_custkey") % 5).cast("bigint").alias("age"),
        F.when(g != 3, g).alias("gender"),
    )


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """tid -> (part2_id, part1_id) from nation/region."""
    n = table(spark, d, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("tid"),
        (F.col("n_nationkey") + 70).cast("bigint").alias("part2_id"),
        (F.col("n_regionkey") + 13).cast("bigint").alias("part1_id"),
    )


def _node(i: Column, ct: Column, status: Column) -> Column:
    return F.struct(i.cast("bigint").alias("_id"), F.col("n_name").alias("name"), ct.cast("bigint").alias("ct"),
                    status.cast("bigint").alias("status"))


def taxonomy_raw(spark: SparkSession, d: str) -> DataFrame:
    """Nested tree as the taxonomy service returns it: part1 nodes with child part2 nodes.

    One row per part1 node: (_id, name, ct, status, child_list array<struct>). Beside the regions'
    own nodes there are a second node for each region that lists every third partition again, with
    an older or newer ``ct``, and nodes to be dropped: a negative id, negative statuses on both
    levels. The partition-to-topic listing is ``part_tids`` below.
    """
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    k = F.col("n_nationkey")
    own = _node(k + 70, k, F.when(k % 8 == 7, -1).otherwise(100))
    again = _node(k + 70, k + (k % 2) * 10 - 5, F.lit(None))
    lost = _node(k + 270, k, F.lit(100))
    kids = n.groupBy("n_regionkey").agg(
        F.collect_list(own).alias("own"), F.collect_list(F.when(k % 3 == 0, again)).alias("again"), F.collect_list(lost).alias("lost"))
    j = r.join(kids, r["r_regionkey"] == kids["n_regionkey"], "left")
    i = F.col("r_regionkey")
    nodes = F.array(
        F.struct((i + 13).cast("bigint").alias("_id"), F.lit(100).cast("bigint").alias("status"), F.col("own").alias("child_list")),
        F.struct((i + 113).cast("bigint").alias("_id"), F.when(i == 1, F.lit(-5)).otherwise(F.lit(100)).cast("bigint").alias("status"),
                 F.col("again").alias("child_list")),
        F.struct((-i - 1).cast("bigint").alias("_id"), F.lit(100).cast("bigint").alias("status"), F.col("lost").alias("child_list")),
    )
    j = j.select(F.col("r_name").alias("name"), F.explode(nodes).alias("x"))
    return j.select("x._id", "name", F.lit(0).cast("bigint").alias("ct"), "x.status", "x.child_list")


def part_tids(spark: SparkSession, d: str) -> DataFrame:
    """(part2_id, tid) listing of the topics in each partition; every fourth partition lists its
    neighbour's topic too."""
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    part = (k + 70).cast("bigint").alias("part2_id")
    both = n.select(part, k.cast("bigint").alias("tid"))
    return both.unionByName(n.filter(k % 4 == 0).select(part, ((k + 1) % 25).cast("bigint").alias("tid")))


def post_aggregates(b: DataFrame) -> DataFrame:
    """Per-post sums of behaviour used by the pool and counter fixtures."""
    return b.groupBy("pid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("download").alias("dl"),
        F.sum("like").alias("lk"),
        F.sum("share").alias("sh"),
        F.sum(F.col("create_review") + F.col("reply_review")).alias("rv"),
        F.sum((F.col("play_video_dur") >= 160).cast("bigint")).alias("hits"),
        F.sum("play_video_dur").alias("play_sum"),
    )


def _pool_base(spark: SparkSession, d: str, as_of: int = AS_OF, b: DataFrame | None = None) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size")
    a = post_aggregates(b if b is not None else behaviour(spark, d))
    j = p.join(a, p["k"] == a["pid"], "left")
    k = _k()
    n = F.coalesce(F.col("n"), F.lit(0))
    ct = F.lit(as_of) - (k % 200) * 86400 - 3600
    ages = F.array(*[F.lit(x) for x in STEP_BOOT_T_AGES])
    return j.select(
        k.alias("pid"),
        (k % 1009 + 1).cast("bigint").alias("mid"),
        (k % 27).alias("tid"),
        F.expr("k div 4").alias("gid"),
        ptype_of(k).alias("ptype"),
        F.when(k % 13 == 0, 1).otherwise(2).cast("bigint").alias("status"),
        ct.cast("bigint").alias("ct"),
        (ct + (k % 3) * 2400).cast("bigint").alias("rec_t"),
        F.when(k % 11 == 0, 0).otherwise(F.col("p_size")).cast("bigint").alias("vdur"),
        (F.expr("((k div 2) % 4) * 10") + F.when(k % 7 == 0, 5).otherwise(0)).cast("bigint").alias("step_boot"),
        (F.lit(as_of) - F.element_at(ages, F.expr("cast((k div 8) % 6 as int)") + 1)).cast("bigint").alias("step_boot_t"),
        F.when(k % 5 == 0, 1040).when(k % 5 == 1, 1050).otherwise(0).cast("bigint").alias("community_tag"),
        F.when(k % 10 < 3, 30).otherwise(0).cast("bigint").alias("choice_status"),
        F.when((k % 31 != 0) & (F.expr("(k div 5) % 3") == 1), 1).otherwise(0).cast("bigint").alias("mover_level"),
        F.when(k % 31 != 0, k % 20 + 50).otherwise(0).cast("bigint").alias("mover_part_id"),
        F.when(k % 17 == 0, -20).otherwise(0).cast("bigint").alias("resource_status"),
        (k % 2).cast("bigint").alias("subarea_status"),
        F.when(k % 23 == 1, F.array(F.lit(3).cast("bigint"))).otherwise(F.array().cast("array<bigint>")).alias("subarea_types"),
        F.when(k % 29 == 0, F.lit(12000)).when(k % 200 < 30, n * 2).otherwise(n * 50).cast("bigint").alias("rec"),
        F.coalesce(F.col("dl"), F.lit(0)).cast("bigint").alias("download"),
        F.coalesce(F.col("lk"), F.lit(0)).cast("bigint").alias("like"),
        F.coalesce(F.col("rv"), F.lit(0)).cast("bigint").alias("review_cnt"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("n")), F.lit(0.0)).cast("double").alias("ctr"),
        F.lit(0).cast("bigint").alias("mover_support"),
    )


def pool(spark: SparkSession, d: str, as_of: int = AS_OF, behaviour_df: DataFrame | None = None) -> DataFrame:
    """recpool (flat): the columns the SQL jobs read (``behaviour_df`` reuses a derived behaviour view)."""
    return _pool_base(spark, d, as_of, behaviour_df)


def posts(spark: SparkSession, d: str, as_of: int = AS_OF) -> DataFrame:
    """postmetadata: pid, tid, vdur, ct."""
    return _pool_base(spark, d, as_of).select("pid", "tid", "vdur", "ct")


def pool_docs(spark: SparkSession, d: str, as_of: int = AS_OF) -> DataFrame:
    """recpool documents (nested), the shape the document store holds.

    Every field that no rule of the upstream jobs fixes gets values of its own, different from
    the others', so that a column in the wrong place shows; censor tags cover every
    combination and null, every 31st post has no author, every fifth no source.
    """
    b = _pool_base(spark, d, as_of)
    k = F.col("pid")
    n = lambda m, f=1: ((k % m) * f).cast("bigint")
    x = lambda m, q: ((k % m) / F.lit(float(q))).cast("double")
    longs = lambda *v: F.array(*[F.lit(i).cast("bigint") for i in v]) if v else F.array().cast("array<bigint>")
    tags = (F.when(k % 12 == 0, longs(2)).when(k % 12 == 1, longs(1)).when(k % 12 == 2, longs(1, 2))
            .when(k % 12 == 3, F.lit(None).cast("array<bigint>")).otherwise(longs()))
    return b.select(
        "pid", "mid", "tid", "gid", "ptype", "status", "ct", "rec_t", "vdur", "step_boot",
        "step_boot_t", "community_tag", n(6, 7).alias("community_tag_new"), n(7, 11).alias("community_tag_high"),
        n(9, 13).alias("community_pre_tag"), n(10, 17).alias("community_tag_godrev"), "choice_status",
        F.when(k % 4 == 0, F.array(n(3), n(5))).otherwise(longs()).alias("choice_types"), "resource_status", "subarea_status",
        "subarea_types", (k * 3).cast("bigint").alias("subarea_time"), "mover_support", (F.col("ct") - k % 1000).cast("bigint").alias("gid_ct"),
        x(37, 8).alias("score_mix"), x(41, 16).alias("age_tgi"), n(43).alias("like_bait"),
        F.when(k % 5 != 0, F.concat(F.lit("src"), (k % 5).cast("string"))).alias("source"),
        n(47).alias("original"), n(53).alias("assist_status"), n(59).alias("official_template_id"),
        n(61).alias("community_hashtag_post"), tags.alias("censor_tags"),
        F.when(k % 31 != 0, F.struct(n(67).alias("fans"), n(71).alias("atts"), F.col("mover_level"), F.col("mover_part_id"))).alias("author"),
        F.struct(
            F.col("rec"), F.col("download"), F.col("like"), F.col("review_cnt").alias("review"),
            n(73).alias("share"), x(79, 4).alias("qscore"), n(83).alias("real_sume"), F.col("ctr"),
            x(89, 128).alias("play_rate"), x(97, 64).alias("dtr"), n(101).alias("detail"),
        ).alias("score_values"),
    )


COUNTER_FIELDS = ("rec", "sume", "gsume", "detail", "share", "like", "download", "review", "play_video", "play_dur")


def counters(spark: SparkSession, d: str) -> DataFrame:
    """post_counters: totals plus s0_/s1_/s2_ columns split by the viewer's gender.

    Posts without behaviour are absent (no counters yet). Users of unknown gender count as 0.
    """
    # the gender joins the orders, not their many lines; a line's sums travel once, not once a gender
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    o = o.join(users(spark, d).select("mid", "gender"), F.col("o_custkey") == F.col("mid"), "left")
    o = o.select("o_orderkey", "o_custkey", F.coalesce(F.col("gender"), F.lit(0)).alias("g"))
    sums = {
        "n": F.count(F.lit(1)), "dl": F.sum("download"), "lk": F.sum("like"), "sh": F.sum("share"),
        "rv": F.sum(F.col("create_review") + F.col("reply_review")),
        "hits": F.sum((F.col("play_video_dur") >= 160).cast("bigint")), "play_sum": F.sum("play_video_dur"),
    }
    split = behaviour(spark, d, o).groupBy("pid", "g").agg(*[x.alias(c) for c, x in sums.items()])
    a = split.groupBy("pid").agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.sum(F.when(F.col("g") == g, F.col(c))).alias(f"{c}{g}") for g in (0, 1, 2) for c in sums])
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    j = p.join(a, p["k"] == a["pid"], "inner")
    j = j.withColumn("m", F.expr("1 + (k div 12) % 40")).withColumn("dlm", F.expr("(k div 7) % 3"))

    def block(prefix: str, sfx: str) -> list[Column]:
        def z(c: str) -> str:
            return f"coalesce({c}{sfx}, 0)"

        return [
            F.expr(f"cast(m * {z('n')} as bigint)").alias(prefix + "rec"),
            F.expr(f"cast(m * {z('hits')} * 7 as bigint) div 10").alias(prefix + "sume"),
            F.lit(0).cast("bigint").alias(prefix + "gsume"),
            F.lit(0).cast("bigint").alias(prefix + "detail"),
            F.expr(f"cast({z('sh')} as bigint)").alias(prefix + "share"),
            F.expr(f"cast({z('lk')} as bigint)").alias(prefix + "like"),
            F.expr(f"cast({z('dl')} * dlm as bigint)").alias(prefix + "download"),
            F.expr(f"cast({z('rv')} as bigint) div 2").alias(prefix + "review"),
            F.expr(f"cast({z('n')} as bigint)").alias(prefix + "play_video"),
            F.expr(f"cast(coalesce(play_sum{sfx}, 0.0) * 1000 / 8 as bigint)").alias(prefix + "play_dur"),
        ]

    k = _k()
    cols = [k.alias("pid")] + block("", "")
    for g in (0, 1, 2):
        cols += block(f"s{g}_", str(g))
    return j.select(*cols)


def step_override(spark: SparkSession, d: str, as_of: int = AS_OF) -> DataFrame:
    """newpost step-state collection: posts with k%4=2 were moved to step 10."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("pid"))
    return p.filter(F.col("pid") % 4 == 2).select(
        "pid",
        F.lit(10).cast("bigint").alias("step_boot"),
        F.lit(as_of - 1000).cast("bigint").alias("step_boot_t"),
        F.lit(0).cast("bigint").alias("mover_support"),
        F.when(F.col("pid") % 3 != 0, (F.col("pid") % 3) * 10).cast("bigint").alias("real_step"),
    )


def serving_budget(spark: SparkSession, d: str) -> DataFrame:
    """In-flight serving hash pid -> (remaining exposure, 0 meaning finished; weight text, some unknown)."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("pid"))
    return p.filter(F.col("pid") % 7 == 0).select(
        "pid", F.expr("(pid div 7) % 3").cast("bigint").alias("remaining"),
        F.when(F.col("pid") % 5 != 0, F.concat(F.lit("1."), (F.col("pid") % 5).cast("string"), F.lit(":0.9"))).alias("weight"),
    )


def post_standard(spark: SparkSession, d: str) -> DataFrame:
    """Per-partition quality standards plus the image-wide one."""
    t = taxonomy(spark, d).select("part2_id")
    video = t.select(
        F.concat(F.lit("video_"), F.col("part2_id").cast("string")).alias("key"),
        (F.col("part2_id") % 20).cast("bigint").alias("pcnt"),
        (F.col("part2_id") % 12).cast("double").alias("download_rate"),
        (F.col("part2_id") % 25).cast("double").alias("like_rate"),
    )
    img = spark.createDataFrame([("img", 50, 6.5, 8.5)], "key string, pcnt bigint, download_rate double, like_rate double")
    flat = video.unionByName(img)
    return flat.select(
        "key", "pcnt",
        F.struct(F.struct("download_rate", "like_rate").alias("a")).alias("gender_standard"),
    )


def item_vectors(spark: SparkSession, d: str) -> DataFrame:
    """(pid, tid, vector array<float>) from the embeddings table."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("pid"), F.col("label").cast("bigint").alias("tid"), F.col("embedding").alias("vector"))


def event_actions(spark: SparkSession, d: str) -> DataFrame:
    """User actions: (mid, pid, ts, event_id, event_type) with pid = props.k, errors dropped."""
    e = table(spark, d, "events")
    return e.filter(F.col("event_type") != "error").select(
        F.col("user_id").alias("mid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("pid"),
        F.col("ts"), F.col("event_id"), F.col("event_type"),
    )


# event type -> the counters it adds to: (counter, amount; None: k * 100, as play time in ms)
EVENT_COUNTERS = {
    "view": (("rec", 1), ("play_video", 1), ("play_dur", None)),
    "click": (("rec", 1), ("sume", 1), ("detail", 1)),
    "purchase": (("download", 1), ("gsume", 1)),
    "signup": (("like", 1), ("review", 1)),
    "error": (("share", 1),),
}


def _counter_events(e: DataFrame) -> DataFrame:
    """Events -> counter increments: (pid, mid, ts, event_id, counter, amount)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = None
    for kind, adds in EVENT_COUNTERS.items():
        own = F.array(*[F.struct(F.lit(c).alias("counter"), (k * 100 if n is None else F.lit(n)).cast("bigint").alias("amount"))
                        for c, n in adds])
        rows = F.when(F.col("event_type") == kind, own) if rows is None else rows.when(F.col("event_type") == kind, own)
    e = e.select(k.alias("pid"), F.col("user_id").alias("mid"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
                 F.explode(rows).alias("x"))
    return e.select("pid", "mid", "ts", "event_id", "x.counter", "x.amount")


def exposure_events(spark: SparkSession, d: str) -> DataFrame:
    """Counter increments of the events table."""
    return _counter_events(table(spark, d, "events"))


def recall_log(spark: SparkSession, d: str) -> DataFrame:
    """Served-candidate log: (mid, pid, source, exposed, clicked, ts)."""
    e = table(spark, d, "events")
    pid = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("user_id").alias("mid"), pid.alias("pid"),
        (pid % 4).alias("source"),
        F.lit(1).cast("bigint").alias("exposed"),
        (F.col("event_type") == "click").cast("bigint").alias("clicked"),
        F.col("ts"),
    )


def exposure_stream(spark: SparkSession, d: str) -> DataFrame:
    """``exposure_events`` as a file stream over the events table (for Structured Streaming)."""
    schema = table(spark, d, "events").schema
    return _counter_events(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d))
