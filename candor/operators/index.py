"""Serving-index frames: group -> ordered ``id:score`` list with an expiry.

An index row is ``(index_key, items array<struct<id, score>>, value string, n_items, expires_at)``.
The top-k is applied in two levels *before* the list is collected (``operators.skew``), so each
list is bounded by ``top`` and no task numbers a hot group whole. With ``top=0`` (keep all) a
group's list is numbered over range partitions and split into pieces of ``chunk`` items, each
under a key of its own (``key#0``, ``key#1``, ...), beside a head entry ``key`` whose value is the
number of pieces: nothing is cut, no row holds an unbounded list and no key is written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .skew import skew_safe_row_number, top_per_group


def index_key(prefix: str, keys: Sequence[str], sep: str = "_") -> Column:
    return F.concat(F.lit(prefix), F.concat_ws(sep, *[F.col(k).cast("string") for k in keys]))


def topn_index(
    df: DataFrame,
    *,
    keys: Sequence[str],
    id_col: str = "pid",
    score_col: str = "score",
    top: int = 0,
    prefix: str = "",
    ttl: int = C.INDEX_TTL_HOT,
    as_of: int,
    fmt: str = "%d:%f",
    text_col: str | None = None,
    chunk: int = C.HOT_TOP,
) -> DataFrame:
    """Group -> list sorted by score desc (nulls last, ties by id), first ``top`` kept (0: all).

    With ``top=0`` there is a column ``chunk`` too: -1 for a group's head entry. Each item is written as ``fmt % (id, score)``, or as the given ``text_col`` when the
    caller has its own item text.
    """
    order = [F.col(score_col).desc_nulls_last(), F.col(id_col).asc()]
    text = F.col(text_col) if text_col else F.format_string(fmt, F.col(id_col), F.col(score_col))
    base = df.select(*keys, id_col, score_col, text.alias("__text"))
    if top > 0:
        ranked = top_per_group(base, list(keys), order, top, name="__rn")
        by: list[str] = []
    else:
        ranked = skew_safe_row_number(base, list(keys), order, name="__rn")
        ranked = ranked.withColumn("chunk", F.floor((F.col("__rn") - 1) / chunk).cast("bigint"))
        by = ["chunk"]
    item = F.struct(F.col("__rn").alias("rn"), F.col(id_col).alias("id"), F.col(score_col).alias("score"),
                    F.col("__text").alias("text"))
    g = ranked.groupBy(*keys, *by).agg(F.sort_array(F.collect_list(item)).alias("__items"))
    items = F.transform(F.col("__items"), lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score")))
    out = g.select(
        index_key(prefix, keys).alias("index_key"), *by, items.alias("items"),
        F.array_join(F.transform(F.col("__items"), lambda x: x["text"]), ",").alias("value"),
    ).withColumn("n_items", F.size("items").cast("bigint"))
    if by:
        out = with_heads(out)
    return out.withColumn("expires_at", F.lit(as_of + ttl).cast("bigint"))


def with_heads(pieces: DataFrame) -> DataFrame:
    """Pieces (index_key, chunk, value, n_items, ...) -> unique keys: ``key#chunk`` for each, and a head
    entry ``key`` (chunk -1, no items) that holds how many there are."""
    n = F.count(F.lit(1)).cast("string")
    heads = pieces.groupBy("index_key").agg(n.alias("value")).select(
        "index_key", F.lit(-1).cast("bigint").alias("chunk"), "value", F.lit(0).cast("bigint").alias("n_items"))
    own = F.concat(F.col("index_key"), F.lit("#"), F.col("chunk").cast("string"))
    return pieces.withColumn("index_key", own).unionByName(heads, allowMissingColumns=True)


def short_groups(
    df: DataFrame,
    *,
    keys: Sequence[str],
    min_limit: int = C.HOT_MIN_LIMIT,
    top: int = 0,
    prefix: str = "",
) -> DataFrame:
    """Groups whose (top-capped) size is below ``min_limit``: (index_key, n).

    Upstream only warns for these groups and still writes them; ``enforce_min`` in the
    index plan uses this frame as an anti-join filter when the refusal is wanted.
    """
    n = F.count(F.lit(1))
    if top > 0:
        n = F.least(n, F.lit(top))
    g = df.groupBy(*keys).agg(n.cast("bigint").alias("n"))
    return g.filter(F.col("n") < min_limit).select(index_key(prefix, keys).alias("index_key"), "n")
