"""Item-to-item neighbour lists: validation, plain index and quality-gated index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import round_half_away
from .counters import post_standard_gate


def valid_posts(
    docs: DataFrame,
    *,
    as_of: int,
    max_age: int = C.I2I_POST_MAX_AGE,
    min_rec_old: int = C.I2I_MIN_REC_OLD,
) -> DataFrame:
    """(pid, ptype, tid) of posts usable as neighbours: exists, status>0, ptype>0, tid>0,
    and not (older than 30 days with rec < 1000)."""
    rec = F.coalesce(F.col("score_values.rec"), F.lit(0)) if "score_values" in docs.columns else F.coalesce(F.col("rec"), F.lit(0))
    return docs.filter(
        (F.coalesce(F.col("status"), F.lit(0)) > 0)
        & (F.coalesce(F.col("ptype"), F.lit(0)) > 0)
        & (F.coalesce(F.col("tid"), F.lit(0)) > 0)
        & ~((F.lit(as_of) - F.coalesce(F.col("ct"), F.lit(0)) > max_age) & (rec < min_rec_old))
    ).select("pid", "ptype", "tid")


def _score_text(score: Column) -> Column:
    """Text of a 2-decimal score in shortest form ('0.5', '0.57', '1.0')."""
    s = F.regexp_replace(F.format_string("%.2f", score), "0+$", "")
    return F.regexp_replace(s, "\\.$", ".0")


def i2i_neighbours(
    pairs: DataFrame,
    valid: DataFrame,
    *,
    min_score: float = C.I2I_MIN_SCORE,
    img_ptypes: tuple[int, int] = C.I2I_IMG_PTYPES,
) -> DataFrame:
    """Nearest pairs (already the top-k per item) -> validated, type-consistent neighbours.

    Both ends must be valid posts; a video item keeps video neighbours, any other item keeps
    neighbours with ptype in [2, 4]; similarity >= ``min_score``. ``score`` is the similarity
    at 2 decimals, ``sim`` the raw one (it orders ties), ``kind`` is the item's list family.
    Output: (pid, near_pid, score, sim, kind, item) with ``item`` = 'near:score'.
    """
    src = valid.select("pid", F.col("ptype").alias("src_ptype"))
    dst = valid.select(F.col("pid").alias("near_pid"), F.col("ptype").alias("near_ptype"))
    p = pairs.filter((F.col("score") >= min_score) & (F.col("pid") != F.col("near_pid")))
    j = p.join(src, "pid", "inner").join(dst, "near_pid", "inner")
    video = F.col("src_ptype") == C.VIDEO_PTYPE
    ok = F.when(video, F.col("near_ptype") == C.VIDEO_PTYPE).otherwise(
        (F.col("near_ptype") >= img_ptypes[0]) & (F.col("near_ptype") <= img_ptypes[1])
    )
    s2 = round_half_away(F.col("score"), 2)
    return j.filter(ok).select(
        "pid", "near_pid", s2.alias("score"), F.col("score").alias("sim"),
        F.when(video, F.lit("video")).otherwise(F.lit("img")).alias("kind"),
        F.concat(F.col("near_pid").cast("string"), F.lit(":"), _score_text(s2)).alias("item"),
    )


def neighbour_ids(neigh: DataFrame) -> DataFrame:
    """Distinct post ids over both ends of the neighbour lists: (pid)."""
    return neigh.select("pid").unionByName(neigh.select(F.col("near_pid").alias("pid"))).distinct()


def _list_order() -> list[Column]:
    return [F.col("score").desc(), F.col("sim").desc(), F.col("near_pid").asc()]


def neighbour_lines(neigh: DataFrame) -> DataFrame:
    """Long neighbours -> one text line per item: 'pid near:score,near:score,...' (+ kind).

    Ordered by rounded score, then raw similarity. A line holds at most the k of the
    nearest-neighbour step (200), so the list per row is bounded.
    """
    w = Window.partitionBy("pid").orderBy(*_list_order())
    n = neigh.withColumn("__pos", F.row_number().over(w))
    g = n.groupBy("pid", "kind").agg(F.sort_array(F.collect_list(F.struct("__pos", "item"))).alias("__l"))
    return g.select(
        "pid", "kind",
        F.concat(F.col("pid").cast("string"), F.lit(" "),
                 F.array_join(F.transform("__l", lambda x: x["item"]), ",")).alias("line"),
    )


def parse_neighbour_lines(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """Text lines 'pid\\x01list' (or 'pid list') -> long (pid, pos, near_pid, score, item).

    Lines that do not split into exactly two fields are skipped, as are items whose id is
    not an integer.
    """
    t = F.trim(F.col(col))
    a = F.split(t, "\\x01")
    parts = F.when(F.size(a) == 1, F.split(t, " ")).otherwise(a)
    x = lines.select(parts.alias("__p")).filter(F.size("__p") == 2)
    x = x.select(F.col("__p")[0].try_cast("bigint").alias("pid"), F.posexplode(F.split(F.col("__p")[1], ",")).alias("pos", "item"))
    kv = F.split("item", ":")
    return x.select(
        "pid", "pos", kv[0].try_cast("bigint").alias("near_pid"), F.element_at(kv, 2).try_cast("double").alias("score"), "item"
    ).filter(F.col("pid").isNotNull() & F.col("near_pid").isNotNull())


def i2i_index(
    neigh: DataFrame,
    *,
    limit: int = C.I2I_LIMIT,
    prefix: str = "",
    ttl: int = C.INDEX_TTL_I2I,
    as_of: int,
) -> DataFrame:
    """First ``limit`` neighbours of each item (in list order) -> (index_key, value, n_items, expires_at)."""
    w = Window.partitionBy("pid").orderBy(*_list_order())
    n = neigh.withColumn("__pos", F.row_number().over(w)).filter(F.col("__pos") <= limit)
    g = n.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("__pos", "item"))).alias("__l"))
    return g.select(
        F.concat(F.lit(prefix), F.col("pid").cast("string")).alias("index_key"),
        F.array_join(F.transform("__l", lambda x: x["item"]), ",").alias("value"),
        F.size("__l").cast("bigint").alias("n_items"),
        F.lit(as_of + ttl).cast("bigint").alias("expires_at"),
    )


def i2i_quality_index(
    neigh: DataFrame,
    counters: DataFrame,
    ptype_tid: DataFrame,
    taxonomy: DataFrame,
    standards: DataFrame,
    *,
    prefixes: dict[str, str],
    limit: int = C.I2I_LIMIT,
    ttl: int = C.INDEX_TTL_I2I,
    as_of: int,
    default_part2: int = C.DEFAULT_PART2,
) -> DataFrame:
    """Keep neighbours whose live counters pass the quality gate; first ``limit`` per item.

    Per neighbour: ctr = sume/(rec+1); download/like rates per mille of (1+rec);
    video: ctr>0.35 and ((dl>=2.5 and like>=5) or (like>=9 and avg_play>=15) or standard);
    image: ctr>0.25 and ((dl>=2.5 and like>=5) or standard). The standard is looked up
    with the list's type (video lists use ``video_<part2>``). Neighbours without counters
    are dropped. Every item of the input keeps a row, with an empty list if nothing passes.
    Both kinds go through one plan; ``prefixes`` gives each kind's key prefix.
    """
    nb = neigh.filter(F.col("kind").isin(*prefixes))
    # only the counters of posts that appear in the lists are needed (semi join first)
    counters = counters.join(nb.select(F.col("near_pid").alias("pid")).distinct(), "pid", "left_semi")
    c = counters.select(
        F.col("pid").alias("near_pid"), F.col("rec").alias("c_rec"), F.col("sume").alias("c_sume"),
        F.col("download").alias("c_dl"), F.col("like").alias("c_like"),
        F.col("play_video").alias("c_pv"), F.col("play_dur").alias("c_pd"),
    )
    pt = ptype_tid.select(F.col("pid").alias("near_pid"), F.col("tid").alias("near_tid"))
    tax = taxonomy.select(F.col("tid").alias("near_tid"), F.col("part2_id").alias("near_part2"))
    j = nb.join(c, "near_pid", "inner").join(pt, "near_pid", "left").withColumn(
        "near_tid", F.coalesce(F.col("near_tid"), F.lit(0))
    ).join(tax, "near_tid", "left")
    video = F.col("kind") == "video"
    j = j.select(
        "*",
        F.when(video, F.lit(C.VIDEO_PTYPE)).otherwise(F.lit(2)).alias("ptype"),
        F.coalesce(F.col("near_part2"), F.lit(default_part2)).alias("part2_id"),
        (1000 * F.col("c_dl") / (1.0 + F.col("c_rec"))).alias("download_rate"),
        (1000 * F.col("c_like") / (1.0 + F.col("c_rec"))).alias("like_rate"),
        (F.col("c_sume") / (F.col("c_rec") + 1.0)).alias("ctr"),
        F.when(F.col("c_pv") > 0, F.col("c_pd") / F.col("c_pv")).otherwise(F.lit(0.0)).alias("avg_play_dur"),
    )
    g = post_standard_gate(j, standards)
    dl, lk = F.col("download_rate"), F.col("like_rate")
    base = (dl >= C.GATE_MIN_DOWNLOAD_RATE) & (lk >= C.GATE_MIN_LIKE_RATE)
    played = (lk >= C.GATE_VIDEO_LIKE_RATE) & (F.col("avg_play_dur") >= C.GATE_VIDEO_AVG_PLAY)
    keep = F.when(video, (F.col("ctr") > C.GATE_VIDEO_MIN_CTR) & (base | played | F.col("meets_standard"))).otherwise(
        (F.col("ctr") > C.GATE_IMG_MIN_CTR) & (base | F.col("meets_standard")))
    kept = g.filter(keep).select("pid", "near_pid", "score", "sim", "item")
    idx = i2i_index(kept, limit=limit, as_of=as_of, ttl=ttl).withColumnRenamed("index_key", "own")
    items = nb.select("pid", "kind").distinct()  # an item has one kind
    prefix = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])[F.col("kind")]
    out = items.withColumn("own", F.col("pid").cast("string")).join(idx, "own", "left")
    return out.select(
        F.concat(prefix, F.col("own")).alias("index_key"), F.coalesce(F.col("value"), F.lit("")).alias("value"),
        F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.lit(as_of + ttl).cast("bigint").alias("expires_at"),
    )
