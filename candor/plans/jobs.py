"""End-to-end jobs: the upstream schedules re-expressed as Spark DAGs with sinks.

Each job reads its input tables, runs one lazy operator chain and writes its outputs; an
intermediate read by several consumers is written once as a table in the shared folder
(which also cuts the lineage), never held only in executor memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import ymd_days_before
from ..operators import boot as B
from ..operators.community import community_review_index
from ..operators.counters import post_counters
from ..operators.delta import forest_search, updated_neighbours
from ..operators.embed import cooccurrence, cooccurrence_vectors, frequent, item2vec, summed
from ..operators.engagement import engagement_cells
from ..operators.forest import LEAF, TREES, knn_forest
from ..operators.index import short_groups, topn_index
from ..operators.neighbours import i2i_index, i2i_neighbours, i2i_quality_index, neighbour_lines, valid_posts
from ..operators.pool import pool_clean
from ..operators.ranking import hot_img_rank, hot_video_rank
from ..operators.review import review_board
from ..operators.sequences import behaviour_sequences
from ..operators.sgns import item_vectors, train
from ..session import set_down
from ..sinks import writers as W


@dataclass
class HotInputs:
    behaviour: DataFrame
    pool: DataFrame
    posts: DataFrame
    users: DataFrame
    taxonomy: DataFrame


def hot_job(spark: SparkSession, inp: HotInputs, out: str, *, as_of: int, days: int = 7,
            top: int = C.HOT_TOP, min_limit: int = C.HOT_MIN_LIMIT, enforce_min: bool = False) -> dict[str, str]:
    """Cells -> (video, image) ranks -> grouped top-N indexes; also reports short groups.

    The cells table is written once and read by both rankings. With ``enforce_min`` the
    groups below ``min_limit`` are not written (upstream only warns).
    """
    since = ymd_days_before(as_of, days)
    cells_path = f"{out}/cells"
    W.replace_table(engagement_cells(inp.behaviour, inp.pool, inp.posts, inp.users, inp.taxonomy, since_day=since),
                    cells_path)
    cells = spark.read.parquet(cells_path)
    paths = {"cells": cells_path}
    for kind, ranker in (("video", hot_video_rank), ("img", hot_img_rank)):
        ranked_path = f"{out}/{kind}_rank"
        W.replace_table(ranker(cells), ranked_path)
        ranked = spark.read.parquet(ranked_path)
        prefix = f"index_olduser_{kind}_hot_part2_age_gender_"
        keys = ["part2_id", "group_age", "group_gender"]
        idx = topn_index(ranked, keys=keys, id_col="pid", score_col="recall_score", top=top, prefix=prefix,
                         ttl=C.INDEX_TTL_HOT, as_of=as_of)
        short = short_groups(ranked, keys=keys, min_limit=min_limit, top=top, prefix=prefix)
        if enforce_min:
            idx = idx.join(short.select("index_key"), "index_key", "left_anti")
        W.write_index(idx, f"{out}/{kind}_index")
        W.replace_table(short, f"{out}/{kind}_short_groups")
        paths.update({f"{kind}_rank": ranked_path, f"{kind}_index": f"{out}/{kind}_index"})
    return paths


def community_job(spark: SparkSession, docs: DataFrame, counters: DataFrame, taxonomy: DataFrame, out: str, *,
                  as_of: int) -> dict[str, int]:
    """Write the community index; returns monitoring counts (posts indexed, lists written), observed during the write."""
    seen = Observation("community")
    lists = F.count(F.when(F.col("chunk") < 0, 1))
    index = community_review_index(docs, counters, taxonomy, as_of=as_of)
    W.write_index(index.observe(seen, F.sum("n_items").alias("posts"), lists.alias("keys")), out)
    return {"community_post_cnt": int(seen.get["posts"] or 0), "index_keys": int(seen.get["keys"] or 0)}


def pool_export_job(docs: DataFrame, step_override: DataFrame, base: str, *, as_of: int, version: str) -> str:
    """Clean the pool and publish it as a new version (readers switch when it is complete)."""
    return W.publish_version(pool_clean(docs, step_override, as_of=as_of), base, version)


def review_board_job(behaviour: DataFrame, posts: DataFrame, out: str, *, as_of: int, days: int = 5) -> None:
    W.replace_table(review_board(behaviour, posts, since_day=ymd_days_before(as_of, days)), out)


def i2i_job(
    spark: SparkSession, actions: DataFrame, docs: DataFrame, raw_counters: DataFrame, taxonomy: DataFrame,
    standards: DataFrame, out: str, *, as_of: int, day: str, mode: str = "full", max_day: int = 30,
    action: str = "review", method: str = "cooccurrence", k: int = C.I2I_TOPN, min_score: float = C.I2I_MIN_SCORE,
    trees: int = TREES, leaf: int = LEAF,
) -> None:
    """Sequences -> item vectors -> top-k neighbours -> validated lists -> (gated) indexes.

    Co-occurrence counts are kept: a full run publishes those of its whole window, an incremental run
    writes its day's, and vectors come from the last full run's and all days since. So an
    incremental run starts from what is known, its vocabulary grows, and items not seen today keep
    their lists. ``method="sgns"`` trains vectors by negative sampling, from the last day's on (published per day);
    ``"word2vec"`` or ``"als"`` trains a model on the sequences alone and saves it per day.

    Vectors and neighbour pairs are published as versions, and an incremental run searches only what has
    changed since the last ones (``operators.delta``).
    """
    seq = behaviour_sequences(actions, as_of=as_of, max_day=max_day, mode=mode)
    vectors_path, pairs_path = f"{out}/vectors", f"{out}/pairs"
    if method == "cooccurrence":
        full_path, daily_path = f"{out}/counts/full", f"{out}/counts/daily"
        counts = cooccurrence(seq, min_count=1)
        if mode == "full":
            W.publish_version(counts, full_path, day)
            every = W.read_latest(spark, full_path)
        else:
            W.replace_table(counts, f"{daily_path}/day={day}")  # a rerun of the day replaces its own rows
            daily = spark.read.schema("item string, ctx string, n double, day string").parquet(daily_path)
            full = W.published(spark, full_path)
            every = daily.select("item", "ctx", "n")
            if full is not None:  # it holds all days before its own
                since = full.agg(F.max("version")).first()[0]
                every = W.read_latest(spark, full_path).unionByName(daily.filter(F.col("day") >= since).select("item", "ctx", "n"))
        vecs = cooccurrence_vectors(frequent(summed(every), C.W2V_MIN_COUNT))
    elif method == "sgns":
        models = f"{out}/models/{action}"
        start = W.read_latest(spark, models) if W.published(spark, models) is not None else None
        trained, _ = train(cooccurrence(seq), start=start)
        W.publish_version(trained, models, day)
        vecs = item_vectors(W.read_latest(spark, models))
    else:
        vecs, model = item2vec(seq, return_model=True, method=method)
        W.save_model_snapshot(model, f"{out}/models/{action}", day)
    known = mode != "full" and all(W.published(spark, p) is not None for p in (vectors_path, pairs_path))
    before, lists = (W.read_latest(spark, vectors_path), W.read_latest(spark, pairs_path)) if known else (None, None)
    vectors = spark.read.parquet(W.publish_version(vecs, vectors_path, day))
    if known:
        pairs = updated_neighbours(vectors, before, lists, k=k, min_score=min_score,
                                   search=forest_search(k, min_score, trees=trees, leaf=leaf))
    else:
        pairs = knn_forest(vectors, k=k, min_score=min_score, trees=trees, leaf=leaf)
    pairs = spark.read.parquet(W.publish_version(pairs, pairs_path, day))
    valid = valid_posts(docs, as_of=as_of)
    neigh_path = f"{out}/neighbours/{day}"
    W.replace_table(i2i_neighbours(pairs, valid, min_score=min_score), neigh_path)
    neigh = spark.read.parquet(neigh_path)
    W.write_neighbour_text(neighbour_lines(neigh), f"{out}/neighbour_text/{day}")
    W.write_ptype_tid(valid, f"{out}/post_ptype_tid/{day}")
    prefixes = {"video": f"index_{action}_i2i_video_", "img": f"index_{action}_i2i_imgtext_"}
    if action == "review":
        index = i2i_quality_index(neigh, post_counters(raw_counters), valid, taxonomy, standards, prefixes=prefixes, as_of=as_of)
        W.write_index(index.filter(F.col("index_key").startswith(prefixes["video"])), f"{out}/index/video")
        W.write_index(index.filter(F.col("index_key").startswith(prefixes["img"])), f"{out}/index/img")
    else:
        for kind, prefix in prefixes.items():
            W.write_index(i2i_index(neigh.filter(F.col("kind") == kind), prefix=prefix, as_of=as_of),
                          f"{out}/index/{kind}")


def boot_round_job(
    spark: SparkSession, docs: DataFrame, step_override: DataFrame, taxonomy: DataFrame, counters: DataFrame,
    serving: DataFrame, out: str, *, as_of: int, days: int = 3, rules: dict | None = None,
) -> dict[str, str]:
    """One cold-start round on one snapshot: the transition, and the next documents, overrides and
    serving state, each published as a version that the next round reads (``read_latest``)."""
    rules = rules or B.load_rules()
    cands = set_down(B.boot_candidates(docs, step_override, taxonomy, as_of=as_of, days=days))
    t_path = f"{out}/transition/{as_of}"
    seen, of = Observation("transition"), lambda name: F.count(F.when(F.col("output") == name, 1)).alias(name)
    rows = B.boot_transition(cands, counters, serving, docs, step_override, rules, as_of=as_of)
    W.replace_table(rows.observe(seen, *[of(name) for name in ("pool", "override", "serving")]), t_path)
    t = spark.read.parquet(t_path)
    version = f"{as_of:012d}"
    paths = {
        "transition": t_path,
        "docs": W.publish_version(B.next_documents(docs, t), f"{out}/docs", version),
        "override": W.publish_version(B.next_overrides(step_override, t), f"{out}/override", version),
        "serving": W.publish_version(B.next_serving(t), f"{out}/serving", version),
    }
    return {**paths, "counts": {name: int(n) for name, n in seen.get.items() if n}}


def counter_stream_job(
    spark: SparkSession, events_dir: str, events_schema: str, out: str, checkpoint: str, *,
    watermark: str = "1 hour", window: str = "1 day", processing_time: str | None = "1 minute",
):
    """Start the live counter stream on a landing folder of exposure events (pid, ts, counter).

    Runs until stopped with ``processing_time`` triggers (or once over what is there when
    ``processing_time`` is None); the changelog under ``out`` is read with
    ``latest_counters`` and compacted with ``compact_changelog``.
    """
    from ..streaming.counters_stream import start_counter_stream

    events = spark.readStream.schema(events_schema).parquet(events_dir)
    q, _ = start_counter_stream(spark, events, out_dir=out, checkpoint=checkpoint, watermark=watermark, window=window,
                                available_now=processing_time is None, processing_time=processing_time)
    return q


def boot_stream_job(
    spark: SparkSession, changelog: str, docs: DataFrame, step_override: DataFrame, taxonomy: DataFrame,
    serving: DataFrame, start: DataFrame, out: str, *, ends: list[int], rules: dict | None = None, days: int = 3,
) -> str:
    """Run the ladder rounds at ``ends`` that are due on a live counter stream's changelog (its windows
    must be one round long); publishes their transitions and returns the folder."""
    from ..streaming.boot_stream import ladder_rounds
    from ..streaming.counters_stream import latest_counters

    windows = set_down(latest_counters(spark, changelog))
    t = ladder_rounds(docs, step_override, taxonomy, serving, start, windows, ends, rules=rules, days=days)
    return W.publish_version(t, out, f"{max(ends):012d}")
