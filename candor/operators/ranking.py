"""Weighted hot scores and per-cell ranks (video and image)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import round_half_away
from .skew import skew_safe_row_number
from .engagement import CELL_KEYS, IMG_FENCES, NORM_NAME, VIDEO_FENCES, robust_bounds, robust_norm

VIDEO_OUT_NORMS = (
    "sume_norm", "like_norm", "share_norm", "download_norm", "dur_norm", "detail_dur_norm",
    "play_rate_norm", "play_video_norm", "review_rate_norm", "like_review_rate_norm",
    "review_get_rate_norm", "detail_norm", "comment_dur_norm",
)
IMG_OUT_NORMS = (
    "sume_norm", "like_norm", "share_norm", "download_norm", "dur_norm", "detail_dur_norm",
    "view_img_norm", "review_rate_norm", "like_review_rate_norm", "review_get_rate_norm",
    "detail_norm", "comment_dur_norm",
)
RANK_KEYS = ("group_gender", "group_age", "part2_id")


def weights_table(weights: dict[str, float], genders=C.WEIGHT_GENDERS, ages=C.WEIGHT_AGES) -> dict:
    """(gender, age) -> weights; the default gives every cell the same weights."""
    return {(g, a): dict(weights) for g in genders for a in ages}


def weighted_score(table: dict, gender: str = "group_gender", age: str = "group_age") -> Column:
    """CASE over (gender, age) cells of sum(norm * weight); a cell with no weights -> NULL."""
    expr = None
    for (g, a), ws in table.items():
        s = None
        for norm, w in ws.items():
            t = F.col(norm) * F.lit(w)
            s = t if s is None else s + t
        cond = (F.col(gender) == g) & (F.col(age) == a)
        expr = F.when(cond, s) if expr is None else expr.when(cond, s)
    return expr if expr is not None else F.lit(None).cast("double")


def rank_cells(scored: DataFrame, *, keys=RANK_KEYS, score: str = "recall_score", tie: str = "pid",
               name: str = "reviewed_rank", bounded_cells: bool = False) -> DataFrame:
    """ROW_NUMBER() per cell by score desc (nulls last), ties by pid.

    Every row of a cell is ranked (no limit), so a hot cell would be sorted in one task; cells are
    therefore numbered over range partitions (see ``operators.skew``). A caller who knows that no
    cell is large says so with ``bounded_cells`` and gets the plain window.
    """
    order = [F.col(score).desc_nulls_last(), F.col(tie).asc()]
    if not bounded_cells:
        return skew_safe_row_number(scored, list(keys), order, name=name)
    w = Window.partitionBy(*keys).orderBy(*order)
    return scored.withColumn(name, F.row_number().over(w).cast("bigint"))


def hot_rank(
    cells: DataFrame,
    *,
    video: bool,
    weights: dict | DataFrame | None = None,
    approx: bool = False,
) -> DataFrame:
    """Rank one post type within each (gender, age, partition) cell.

    ``cells`` is the output of ``engagement_cells``; bounds are computed from the same
    type's cells, normalised, scored with the weights, rounded to 4 decimals. ``weights``
    is a {(gender, age): {norm: weight}} dict (compiled to one CASE) or a DataFrame keyed by
    group_gender, group_age (and optionally part2_id) with one ``<norm>`` weight column each.
    """
    fences = VIDEO_FENCES if video else IMG_FENCES
    out_norms = VIDEO_OUT_NORMS if video else IMG_OUT_NORMS
    typed = cells.filter(F.col("ptype") == C.VIDEO_PTYPE) if video else cells.filter(F.col("ptype") != C.VIDEO_PTYPE)
    bounds = robust_bounds(typed, fences, approx=approx)
    normed = robust_norm(typed, bounds, list(fences))
    if isinstance(weights, DataFrame):
        # weights per cell as a table: one row per (gender, age[, part2]); a cell without a row scores NULL
        wcols = [c for c in weights.columns if c.endswith("_norm")]
        keys = [k for k in RANK_KEYS if k in weights.columns]
        w = weights.select(*keys, *[F.col(c).alias(f"__w_{c}") for c in wcols])
        normed = normed.join(w, keys, "left")
        score = None
        for c in wcols:
            t = F.col(c) * F.col(f"__w_{c}")
            score = t if score is None else score + t
    else:
        score = weighted_score(weights or weights_table(C.VIDEO_WEIGHTS if video else C.IMG_WEIGHTS))
    scored = normed.select(
        *[F.col(k) for k in RANK_KEYS], "pid",
        round_half_away(score, 4).alias("recall_score"),
        *[F.col(n) for n in out_norms],
    )
    return rank_cells(scored)


def hot_video_rank(cells: DataFrame, **kw) -> DataFrame:
    return hot_rank(cells, video=True, **kw)


def hot_img_rank(cells: DataFrame, **kw) -> DataFrame:
    return hot_rank(cells, video=False, **kw)


__all__ = ["hot_rank", "hot_video_rank", "hot_img_rank", "rank_cells", "weighted_score", "weights_table",
           "CELL_KEYS", "NORM_NAME"]
