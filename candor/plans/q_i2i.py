"""Registered item-to-item queries: sequences, embeddings, kNN, neighbours, indexes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counters import counters_from_columns, post_counters
from ..operators.delta import updated_neighbours
from ..operators.embed import cooccurrence, item2vec
from ..operators.forest import knn_forest
from ..operators.knn import knn_exact, knn_lsh
from ..operators.neighbours import i2i_index, i2i_neighbours, i2i_quality_index, valid_posts
from ..operators.sequences import behaviour_sequences
from ..operators.sgns import item_vectors, train
from ..session import set_down
from ..sources import fixtures as X
from .fixture_sql import with_views
from .params import AS_OF, EVENTS_AS_OF, I2I_MIN_SCORE, KNN_K
from .registry import register

SEQ_MAX_DAY = 30
PREFIX = {
    "plain": {"video": "index_click_i2i_video_", "img": "index_click_i2i_imgtext_"},
    "review": {"video": "index_review_i2i_video_", "img": "index_review_i2i_imgtext_"},
}


# ---------------------------------------------------------------- sequences
def sequences(spark: SparkSession, d: str) -> DataFrame:
    return behaviour_sequences(X.event_actions(spark, d), as_of=EVENTS_AS_OF, max_day=SEQ_MAX_DAY, mode="full")


_SEQ_SQL = with_views("""
SELECT mid, strftime(day, '%Y-%m-%d') AS day, CAST(part AS BIGINT) AS part, CAST(count(*) AS BIGINT) AS n_items,
       string_agg(CAST(pid AS VARCHAR), ' ' ORDER BY pos) AS sentence
FROM (SELECT mid, day, pid, pos, (pos // 1000) AS part
      FROM (SELECT mid, CAST(ts AS DATE) AS day, pid,
                   row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS pos
            FROM actions WHERE pid IS NOT NULL
              AND CAST(ts AS DATE) BETWEEN DATE '2023-12-31' AND DATE '2024-01-30') a) b
GROUP BY mid, day, part""", "actions")


@register("behaviour_sequences", _SEQ_SQL)
def q_behaviour_sequences(spark: SparkSession, d: str) -> DataFrame:
    s = sequences(spark, d)
    return s.select("mid", "day", "part", F.size("items").cast("bigint").alias("n_items"),
                    F.array_join("items", " ").alias("sentence"))


# ---------------------------------------------------------------- exact kNN
_KNN_CTE = f"""knn AS (
SELECT pid, near_pid, score FROM (
  SELECT a.pid, b.pid AS near_pid,
         list_cosine_similarity(CAST(a.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[])) AS score,
         row_number() OVER (PARTITION BY a.pid
                            ORDER BY list_cosine_similarity(CAST(a.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[])) DESC,
                                     b.pid) AS rn
  FROM vectors a JOIN vectors b ON a.pid <> b.pid) z
WHERE rn <= {KNN_K})"""


@register("knn_exact", with_views("SELECT * FROM knn", "vectors", extra=[_KNN_CTE]), ["score"])
def q_knn_exact(spark: SparkSession, d: str) -> DataFrame:
    return knn_exact(X.item_vectors(spark, d), k=KNN_K)


# ---------------------------------------------------------------- sign-projection kNN
TABLES, BITS = 32, 4  # at cosine 0.2 about 0.97 of all pairs meet: the fixture vectors are nearly orthogonal


def lsh_ctes(name: str, left: str, right: str, own: bool, k: int, min_score: float) -> list[str]:
    """CTEs of the approximate search of views ``left`` in ``right`` (pid, vector): same signs, same bands."""
    unit = lambda v: f"""(SELECT pid, i, CAST(round(x / sqrt(sum(x * x) OVER (PARTITION BY pid)) * 1000000) AS BIGINT) AS x
  FROM (SELECT pid, unnest(range(len(vector))) AS i, unnest(CAST(vector AS DOUBLE[])) AS x FROM {v}) e)"""  # noqa: E731
    keys = lambda v: f"""(SELECT pid, t, string_agg(CASE WHEN d >= 0 THEN '1' ELSE '0' END, '' ORDER BY b) AS key
  FROM (SELECT u.pid, p.t, p.b, sum(u.x * p.s) AS d FROM {unit(v)} u JOIN {name}_planes p ON p.j = u.i GROUP BY ALL) z GROUP BY pid, t)"""  # noqa: E731
    differ = " AND a.pid <> b.pid" if own else ""
    return [
        f"""{name}_planes AS (
SELECT t, b, j, CASE WHEN ((instr('0123456789abcdef', substr(md5('plane ' || t || ' ' || b || ':' || (j // 128)), (j % 128) // 4 + 1, 1)) - 1)
                          >> (j % 4)) & 1 = 1 THEN 1 ELSE -1 END AS s
FROM (SELECT CAST(unnest(range({TABLES})) AS INTEGER) AS t), (SELECT CAST(unnest(range({BITS})) AS INTEGER) AS b),
     (SELECT CAST(unnest(range(64)) AS INTEGER) AS j))""",
        f"""{name} AS (
SELECT pid, near_pid, score FROM (
  SELECT c.pid, c.near_pid, c.score, row_number() OVER (PARTITION BY c.pid ORDER BY c.score DESC, c.near_pid) AS rn FROM (
    SELECT p.pid, p.near_pid, list_cosine_similarity(CAST(x.vector AS DOUBLE[]), CAST(y.vector AS DOUBLE[])) AS score
    FROM (SELECT DISTINCT a.pid, b.pid AS near_pid FROM {keys(left)} a JOIN {keys(right)} b ON a.t = b.t AND a.key = b.key{differ}) p
    JOIN {left} x ON x.pid = p.pid JOIN {right} y ON y.pid = p.near_pid) c
  WHERE c.score >= {min_score}) z
WHERE rn <= {k})""",
    ]


_LSH_CTES = lsh_ctes("knn", "vectors", "vectors", True, KNN_K, I2I_MIN_SCORE)


@register("knn_lsh", with_views("SELECT * FROM knn", "vectors", extra=_LSH_CTES), ["score"])
def q_knn_lsh(spark: SparkSession, d: str) -> DataFrame:
    return knn_lsh(X.item_vectors(spark, d), k=KNN_K, min_score=I2I_MIN_SCORE, tables=TABLES, bits=BITS)


# ---------------------------------------------------------------- forest kNN
def near_cte(name: str, left: str, right: str, own: bool, k: int, min_score: float) -> str:
    """All pairs of views ``left`` and ``right`` (pid, vector): what the forest finds where one leaf holds the table,
    as it does at the oracle's scale; recall where it prunes is held to a floor by the tests."""
    differ = " AND a.pid <> b.pid" if own else ""
    return f"""{name} AS (
SELECT pid, near_pid, score FROM (
  SELECT pid, near_pid, score, row_number() OVER (PARTITION BY pid ORDER BY score DESC, near_pid) AS rn FROM (
    SELECT a.pid, b.pid AS near_pid, list_cosine_similarity(CAST(a.vector AS DOUBLE[]), CAST(b.vector AS DOUBLE[])) AS score
    FROM {left} a JOIN {right} b ON true{differ}) c
  WHERE score >= {min_score}) z
WHERE rn <= {k})"""


_NEAR_CTE = near_cte("knn", "vectors", "vectors", True, KNN_K, I2I_MIN_SCORE)


@register("knn_forest", with_views("SELECT * FROM knn", "vectors", extra=[_NEAR_CTE]), ["score"])
def q_knn_forest(spark: SparkSession, d: str) -> DataFrame:
    return knn_forest(X.item_vectors(spark, d), k=KNN_K, min_score=I2I_MIN_SCORE)


# ---------------------------------------------------------------- lists brought up to date
def yesterday(vectors: DataFrame) -> DataFrame:
    """The fixture's vectors a day before: some items not there yet, some since changed, some since gone."""
    v = vectors.select("pid", "vector").where(F.col("pid") % 17 != 0)
    turned = F.transform("vector", lambda x: -x)
    v = v.select("pid", F.when(F.col("pid") % 10 == 0, turned).otherwise(F.col("vector")).alias("vector"))
    old = vectors.where(F.col("pid") % 23 == 0).select((F.col("pid") + 10_000_000).alias("pid"), F.reverse("vector").alias("vector"))
    return v.unionByName(old)


@register("knn_delta", with_views("SELECT * FROM knn", "vectors", extra=[_NEAR_CTE]), ["score"])
def q_knn_delta(spark: SparkSession, d: str) -> DataFrame:
    now = X.item_vectors(spark, d).select("pid", "vector")
    before = yesterday(now)
    lists = set_down(knn_exact(before, k=KNN_K).where(F.col("score") >= I2I_MIN_SCORE))
    return updated_neighbours(now, before, lists, k=KNN_K, min_score=I2I_MIN_SCORE)


# ---------------------------------------------------------------- validated neighbours
_VALID_CTE = f"""valid AS (
SELECT pid, ptype, tid FROM pool
WHERE status > 0 AND ptype > 0 AND tid > 0 AND NOT ({AS_OF} - ct > 30 * 86400 AND rec < 1000))"""
_NEIGH_CTE = rf"""neigh AS (
SELECT k.pid, k.near_pid, round(k.score, 2) AS score, k.score AS sim,
       CASE WHEN s.ptype = 5 THEN 'video' ELSE 'img' END AS kind,
       CAST(k.near_pid AS VARCHAR) || ':' ||
         regexp_replace(regexp_replace(printf('%.2f', round(k.score, 2)), '0+$', ''), '\.$', '.0') AS item
FROM knn k JOIN valid s ON s.pid = k.pid JOIN valid n ON n.pid = k.near_pid
WHERE k.score >= {I2I_MIN_SCORE} AND k.pid <> k.near_pid
  AND ((s.ptype = 5 AND n.ptype = 5) OR (s.ptype <> 5 AND n.ptype BETWEEN 2 AND 4)))"""
_I2I_VIEWS = ("vectors", "pool", "tax", "counters", "standard")
_I2I_CTES = [_NEAR_CTE, _VALID_CTE, _NEIGH_CTE]


def neighbours(spark: SparkSession, d: str, docs: DataFrame | None = None) -> DataFrame:
    """Validated neighbours (``docs`` reuses derived posts: the pool's documents or its flat columns)."""
    pairs = knn_forest(X.item_vectors(spark, d), k=KNN_K, min_score=I2I_MIN_SCORE)
    docs = X.pool_docs(spark, d) if docs is None else docs
    return i2i_neighbours(pairs, valid_posts(docs, as_of=AS_OF), min_score=I2I_MIN_SCORE)


@register("i2i_neighbours", with_views("SELECT * FROM neigh", *_I2I_VIEWS, extra=_I2I_CTES), ["score", "sim"])
def q_i2i_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return neighbours(spark, d)


# ---------------------------------------------------------------- plain index (first 100)
_INDEX_SQL = with_views(f"""
SELECT CASE WHEN kind = 'video' THEN '{PREFIX['plain']['video']}' ELSE '{PREFIX['plain']['img']}' END
         || CAST(pid AS VARCHAR) AS index_key,
       string_agg(item, ',' ORDER BY rn) AS value, CAST(count(*) AS BIGINT) AS n_items,
       CAST({AS_OF} + 2 * 86400 AS BIGINT) AS expires_at
FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, sim DESC, near_pid) AS rn FROM neigh) z
WHERE rn <= 100
GROUP BY pid, kind""", *_I2I_VIEWS, extra=_I2I_CTES)


@register("i2i_index", _INDEX_SQL)
def q_i2i_index(spark: SparkSession, d: str) -> DataFrame:
    n = set_down(neighbours(spark, d))
    parts = [i2i_index(n.filter(F.col("kind") == k), prefix=PREFIX["plain"][k], as_of=AS_OF) for k in ("video", "img")]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- quality-gated index
def _quality_sql(kind: str) -> str:
    ptype = 5 if kind == "video" else 2
    gate = (
        "ctr > 0.35 AND ((dl >= 2.5 AND lk >= 5) OR (lk >= 9 AND avg_play >= 15) OR meets)"
        if kind == "video" else "ctr > 0.25 AND ((dl >= 2.5 AND lk >= 5) OR meets)"
    )
    key = "'video_' || CAST(part2_id AS VARCHAR)" if kind == "video" else "'img'"
    return f"""
q_{kind} AS (
  SELECT '{PREFIX['review'][kind]}' || CAST(src.pid AS VARCHAR) AS index_key, coalesce(v.value, '') AS value,
         CAST(coalesce(v.n, 0) AS BIGINT) AS n_items, CAST({AS_OF} + 2 * 86400 AS BIGINT) AS expires_at
  FROM (SELECT DISTINCT pid FROM neigh WHERE kind = '{kind}') src
  LEFT JOIN (
    SELECT pid, string_agg(item, ',' ORDER BY rn) AS value, count(*) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, sim DESC, near_pid) AS rn FROM (
        SELECT g.*, coalesce((dl >= th_d AND lk >= th_l) OR (dl >= 9 AND lk >= 9) OR ({ptype} <> 5 AND dl >= 9), false) AS meets
        FROM (
          SELECT j.*, CASE WHEN s.key IS NULL THEN 9.0 ELSE least(floor(coalesce(s.download_rate, 9.0)), 20.0) END AS th_d,
                      CASE WHEN s.key IS NULL THEN 9.0 ELSE least(floor(coalesce(s.like_rate, 9.0)), 20.0) END AS th_l
          FROM (
            SELECT nb.pid, nb.near_pid, nb.score, nb.sim, nb.item, coalesce(t.part2_id, 72) AS part2_id,
                   1000 * c.download / (1.0 + c.rec) AS dl, 1000 * c."like" / (1.0 + c.rec) AS lk,
                   c.sume / (c.rec + 1.0) AS ctr,
                   CASE WHEN c.play_video > 0 THEN (c.play_dur / 1000) / c.play_video ELSE 0 END AS avg_play
            FROM neigh nb JOIN counters c ON c.pid = nb.near_pid
            LEFT JOIN valid pt ON pt.pid = nb.near_pid
            LEFT JOIN tax t ON t.tid = coalesce(pt.tid, 0)
            WHERE nb.kind = '{kind}') j
          LEFT JOIN (SELECT * FROM standard WHERE pcnt >= 10) s ON s.key = {key}) g) x
      WHERE {gate}) y
    WHERE rn <= 100 GROUP BY pid) v ON v.pid = src.pid)"""


_QUALITY_SQL = with_views("SELECT * FROM q_video UNION ALL SELECT * FROM q_img", *_I2I_VIEWS,
                          extra=_I2I_CTES + [_quality_sql("video"), _quality_sql("img")])


@register("i2i_quality_index", _QUALITY_SQL)
def q_i2i_quality_index(spark: SparkSession, d: str) -> DataFrame:
    n = set_down(neighbours(spark, d))
    counters = post_counters(counters_from_columns(X.counters(spark, d)))
    pt = valid_posts(X.pool_docs(spark, d), as_of=AS_OF)
    return i2i_quality_index(n, counters, pt, X.taxonomy(spark, d), X.post_standard(spark, d), prefixes=PREFIX["review"], as_of=AS_OF)


# ---------------------------------------------------------------- co-occurrence and the vectors from it
_COOC_CTES = [
    """cs AS (
SELECT mid, CAST(ts AS DATE) AS day, pid, row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) AS pos
FROM actions WHERE pid IS NOT NULL AND CAST(ts AS DATE) BETWEEN DATE '2023-12-31' AND DATE '2024-01-30')""",
    """cv AS (SELECT pid FROM cs GROUP BY pid HAVING count(*) >= 5)""",
    """ct AS (SELECT cs.* FROM cs JOIN cv ON cv.pid = cs.pid)""",
    """cp AS (SELECT a.pid AS a, b.pid AS b FROM ct a JOIN ct b
          ON a.mid = b.mid AND a.day = b.day AND b.pos BETWEEN a.pos + 1 AND a.pos + 5
        WHERE a.pid <> b.pid)""",
    """co AS (SELECT CAST(item AS VARCHAR) AS item, CAST(ctx AS VARCHAR) AS ctx, CAST(count(*) AS DOUBLE) AS n
FROM (SELECT a AS item, b AS ctx FROM cp UNION ALL SELECT b, a FROM cp) x GROUP BY item, ctx)""",
]


@register("item_cooccurrence", with_views("SELECT * FROM co", "actions", extra=_COOC_CTES), ["n"])
def q_item_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence(sequences(spark, d), window=5, min_count=5)


_VEC_SQL = with_views("""
SELECT CAST(c.item AS BIGINT) AS pid, CAST(s.j AS INTEGER) AS dim, sum(ln(1 + c.n) / s.root * s.sign) AS value
FROM co c JOIN (
  SELECT ctx, root, j, CASE WHEN ((instr('0123456789abcdef', substr(md5(ctx || ':' || (j // 128)), (j % 128) // 4 + 1, 1)) - 1)
                                  >> (j % 4)) & 1 = 1 THEN 1.0 ELSE -1.0 END AS sign
  FROM (SELECT ctx, sqrt(sum(n)) AS root FROM co GROUP BY ctx), (SELECT CAST(unnest(range(100)) AS INTEGER) AS j)) s ON s.ctx = c.ctx
GROUP BY c.item, s.j""", "actions", extra=_COOC_CTES)


@register("item2vec", _VEC_SQL, ["value"])
def q_item2vec(spark: SparkSession, d: str) -> DataFrame:
    return item2vec(sequences(spark, d)).select("pid", F.posexplode("vector").alias("dim", "value"))


# ---------------------------------------------------------------- trained vectors
SPLIT_DAY = "2024-01-16"  # the first day of the second half of the training window


@register("item2vec_sgns")
def q_item2vec_sgns(spark: SparkSession, d: str) -> DataFrame:
    vectors, _ = train(cooccurrence(sequences(spark, d)))
    return item_vectors(vectors).select("pid", F.posexplode("vector").alias("dim", "value"))


@register("item2vec_daily")
def q_item2vec_daily(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of the first half of the window, then of the whole of it from there and from nothing: the loss of every pass."""
    seq = set_down(sequences(spark, d))
    first, whole = cooccurrence(seq.where(F.col("day") < SPLIT_DAY)), set_down(cooccurrence(seq))
    with ThreadPoolExecutor(1) as beside:  # a small vocabulary trains in one task: the run from nothing needs nothing of the others
        cold = beside.submit(inheritable_thread_target(train), whole)
        start, losses = train(first)
        rows = [("first", k, x) for k, x in enumerate(losses, 1)]
        warm, losses = train(whole, start=start, epochs=2)
        rows += [("warm", k, x) for k, x in enumerate(losses, 1)]
        rows += [("cold", k, x) for k, x in enumerate(cold.result()[1], 1)]
    told = spark.createDataFrame(rows, "run string, pass int, loss double")
    return told.withColumn("items", F.lit(warm.count()).cast("bigint"))
