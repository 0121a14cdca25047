"""Registered hot-ranking queries over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import daily as D
from ..operators import engagement as E
from ..operators import ranking as R
from ..operators import sketches as K
from ..operators.index import short_groups, topn_index
from ..session import scratch_dir, set_down
from ..sources import fixtures as X
from . import oracle_hot as O
from .fixture_sql import with_views
from .params import AS_OF, HOT_SINCE_DAY
from .registry import register

# All 14 metrics for either type, with the fences of its own and 1.5 for the others.
VIDEO_ALL = {**E.VIDEO_FENCES, "view_img": (1.5, 1.5)}
IMG_ALL = {**E.IMG_FENCES, "play_rate": (1.5, 1.5), "play_video": (1.5, 1.5)}
BASE = ("ups", "users", "tax", "pool", "posts")


BEHAVIOUR_SINCE_DAY = "19980101"


def engagement(spark: SparkSession, d: str) -> DataFrame:
    pool = X.pool(spark, d)
    return E.engagement_cells(
        X.behaviour(spark, d), pool, X.posts(spark, d), X.users(spark, d), X.taxonomy(spark, d),
        since_day=HOT_SINCE_DAY, behaviour_since_day=BEHAVIOUR_SINCE_DAY,
    )


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Engagement cells over the fixture tables, set down: bounds and normalisation both read them."""
    return set_down(engagement(spark, d))


@register("engagement_cells", with_views("SELECT * FROM cells", *BASE, extra=[O.cells_cte()]), O.CELL_DOUBLES)
def q_engagement_cells(spark: SparkSession, d: str) -> DataFrame:
    return engagement(spark, d)


# the same cells by way of stored partial sums: the fixture's days span years, so a month is a period here
@register("engagement_cells_daily", with_views("SELECT * FROM cells", *BASE, extra=[O.cells_cte()]), O.CELL_DOUBLES)
def q_engagement_cells_daily(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "partials")
    D.write_partials(D.daily_partials(X.behaviour(spark, d), X.posts(spark, d), X.users(spark, d), X.taxonomy(spark, d)), path,
                     period="substr(ymd, 1, 6)", spread=2)
    return D.cells_from_partials(spark.read.parquet(path), X.pool(spark, d), since_day=HOT_SINCE_DAY, behaviour_since_day=BEHAVIOUR_SINCE_DAY)


_BOUND_COLS = [f"{m}_{s}" for m in O.VIDEO_ALL for s in ("min", "max")]


@register(
    "robust_bounds",
    with_views(
        "SELECT * FROM bv UNION ALL BY NAME SELECT * FROM bi", *BASE,
        extra=[O.cells_cte(),
               f"bv AS ({O.bounds_select('(SELECT * FROM cells WHERE ptype = 5)', O.VIDEO_ALL)})",
               f"bi AS ({O.bounds_select('(SELECT * FROM cells WHERE ptype <> 5)', O.IMG_ALL)})"],
    ),
    _BOUND_COLS,
)
def q_robust_bounds(spark: SparkSession, d: str) -> DataFrame:
    return E.robust_bounds(cells(spark, d), IMG_ALL, video_fences=VIDEO_ALL)


# the same bounds by way of stored sketches: exact here, as every cell has fewer values than a sketch keeps
@register(
    "robust_bounds_sketch",
    with_views(
        "SELECT * FROM bv UNION ALL BY NAME SELECT * FROM bi", *BASE,
        extra=[O.cells_cte(),
               f"bv AS ({O.sketch_bounds_select('(SELECT * FROM cells WHERE ptype = 5) c', O.VIDEO_ALL)})",
               f"bi AS ({O.sketch_bounds_select('(SELECT * FROM cells WHERE ptype <> 5) c', O.IMG_ALL)})"],
    ),
    _BOUND_COLS,
)
def q_robust_bounds_sketch(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "sketches")
    K.write_sketches(K.metric_sketches(engagement(spark, d), IMG_ALL, parts=4), path)
    q = K.merged_quantiles(spark.read.parquet(path), IMG_ALL, (C.P_LO, C.P_HI))
    return E.robust_bounds(q, IMG_ALL, video_fences=VIDEO_ALL, quantiles=q)


_NORM_DOUBLES = O.CELL_DOUBLES + [E.NORM_NAME[m] for m in O.VIDEO_ALL]


@register(
    "robust_norm",
    with_views(
        "SELECT * FROM nv UNION ALL SELECT * FROM ni", *BASE,
        extra=[O.cells_cte(),
               "cv AS (SELECT * FROM cells WHERE ptype = 5)",
               "ci AS (SELECT * FROM cells WHERE ptype <> 5)",
               f"bv AS ({O.bounds_select('cv', O.VIDEO_ALL)})",
               f"bi AS ({O.bounds_select('ci', O.IMG_ALL)})",
               f"nv AS ({O.norm_select('cv', 'bv', list(O.VIDEO_ALL))})",
               f"ni AS ({O.norm_select('ci', 'bi', list(O.VIDEO_ALL))})"],
    ),
    _NORM_DOUBLES,
)
def q_robust_norm(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return E.robust_norm(c, E.robust_bounds(c, IMG_ALL, video_fences=VIDEO_ALL), list(VIDEO_ALL))


def _rank_sql(video: bool) -> str:
    return with_views(O.rank_select(video, "normed"), *BASE, extra=[O.cells_cte(), O.hot_ctes(video)])


@register("hot_video_rank", _rank_sql(True), ["recall_score", *R.VIDEO_OUT_NORMS])
def q_hot_video_rank(spark: SparkSession, d: str) -> DataFrame:
    return R.hot_video_rank(cells(spark, d))


@register("hot_img_rank", _rank_sql(False), ["recall_score", *R.IMG_OUT_NORMS])
def q_hot_img_rank(spark: SparkSession, d: str) -> DataFrame:
    return R.hot_img_rank(cells(spark, d))


# Index over the video ranking: key = part2_age_gender, top 50000 by score, 30-day expiry.
_TOPN_BODY = f"""
SELECT 'index_olduser_video_hot_part2_age_gender_' || CAST(part2_id AS VARCHAR) || '_' || CAST(group_age AS VARCHAR)
         || '_' || CAST(group_gender AS VARCHAR) AS index_key,
       string_agg(CAST(pid AS VARCHAR) || ':' || printf('%.6f', recall_score), ',' ORDER BY recall_score DESC NULLS LAST, pid) AS value,
       CAST(count(*) AS BIGINT) AS n_items,
       CAST({AS_OF} + 30 * 86400 AS BIGINT) AS expires_at
FROM (SELECT *, row_number() OVER (PARTITION BY part2_id, group_age, group_gender ORDER BY recall_score DESC NULLS LAST, pid) AS rn
      FROM ranked) t
WHERE rn <= 50000
GROUP BY part2_id, group_age, group_gender"""


@register(
    "topn_index",
    with_views(_TOPN_BODY, *BASE, extra=[O.cells_cte(), O.hot_ctes(True), f"ranked AS ({O.rank_select(True, 'normed')})"]),
)
def q_topn_index(spark: SparkSession, d: str) -> DataFrame:
    return topn_index(
        R.hot_video_rank(cells(spark, d)), keys=["part2_id", "group_age", "group_gender"], id_col="pid", score_col="recall_score",
        top=50000, prefix="index_olduser_video_hot_part2_age_gender_", ttl=30 * 86400, as_of=AS_OF,
    ).drop("items")


_SHORT_BODY = """
SELECT 'index_olduser_img_hot_part2_age_gender_' || CAST(part2_id AS VARCHAR) || '_' || CAST(group_age AS VARCHAR)
         || '_' || CAST(group_gender AS VARCHAR) AS index_key,
       CAST(count(*) AS BIGINT) AS n
FROM ranked GROUP BY part2_id, group_age, group_gender HAVING count(*) < 200"""


@register(
    "short_groups",
    with_views(_SHORT_BODY, *BASE, extra=[O.cells_cte(), O.hot_ctes(False), f"ranked AS ({O.rank_select(False, 'normed')})"]),
)
def q_short_groups(spark: SparkSession, d: str) -> DataFrame:
    # a ranking has one row per typed cell, so the groups' sizes need no ranking
    typed = engagement(spark, d).filter(F.col("ptype") != C.VIDEO_PTYPE)
    return short_groups(typed, keys=["part2_id", "group_age", "group_gender"], min_limit=200,
                        prefix="index_olduser_img_hot_part2_age_gender_")
