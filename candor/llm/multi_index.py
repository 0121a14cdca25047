"""Approximate nearest neighbours by cosine: an inverted multi-index.

Vectors are scaled to unit length and cut in two halves, each quantised by its own k-means, so K
centroids a half make K * K cells. A query walks the centroid pairs in order of summed distance with
a heap over its two sorted lists, until the cells met hold ``candidates`` entries and ``share`` of
all; those entries are reranked by the exact cosine of the original vectors.

How many entries a recall takes is the data's: vectors without any structure, such as the test
tables', need about the same share of all at every size (0.9 of the true neighbours lie in the
nearest 0.4), clustered ones a small and falling one. The default share is for the former; lower it
where vectors have structure.

The centroids are fitted on the driver on a bounded sample (``sample`` distinct vectors, those with the
smallest hash); every vector is indexed. Equal vectors are one entry that carries its smallest
``nearest + 1`` ids: they tie and ties go to smaller ids, so no other of them can be among the
nearest. Cells are dealt to shards of about ``SHARD`` entries, a large cell to several, and a shard's
queries to parts of ``PART``, so no task holds a hot cell whole; a query visits the shards of its cells.

Defined results: vectors that are null, zero, of another length than most, or that hold null or
non-finite components, and rows without vec_id, take no part; repeated rows count once; a query with
fewer other vectors gets those there are; equal scores rank by vec_id; an empty table gives no rows.
vec_id and embedding are read by name, so further columns can have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, require, table

SHARD, PART = 4096, 8192


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of the rows of ``x`` (Lloyd's rounds from distinct random rows; empty ones stay put)."""
    rng = np.random.default_rng(seed)
    start = np.unique(x, axis=0)
    centre = start[rng.permutation(len(start))[:k]]
    for _ in range(rounds):
        own = nearest_centroid(x, centre)
        n = np.bincount(own, minlength=len(centre))
        total = np.stack([np.bincount(own, x[:, d], len(centre)) for d in range(x.shape[1])], 1)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1)[None, :]


def nearest_centroid(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i:i + 8192], centre).argmin(1) for i in range(0, len(x), 8192)])


class MultiIndex:
    """Two codebooks; cell (i, j) has number i * len(second) + j."""

    def __init__(self, unit: np.ndarray, k: int):
        self.half = unit.shape[1] // 2
        self.first, self.second = kmeans(unit[:, :self.half], k), kmeans(unit[:, self.half:], k)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a = nearest_centroid(unit[:, :self.half], self.first)
        return a * len(self.second) + nearest_centroid(unit[:, self.half:], self.second)

    def walk(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray, candidates: int) -> list[int]:
        """Cells with entries, by summed distance of a query's halves to the centroids, until they hold
        ``candidates`` entries."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, out, held = [(first[a[0]] + second[b[0]], 0, 0)], [], 0
        while heap and held < candidates:
            _, i, j = heapq.heappop(heap)
            cell = int(a[i]) * len(second) + int(b[j])
            if sizes[cell]:
                out.append(cell)
                held += int(sizes[cell])
            if j + 1 < len(b):
                heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
        return out

    def probes(self, unit: np.ndarray, sizes: np.ndarray, candidates: int) -> list[list[int]]:
        one, two = _distances(unit[:, :self.half], self.first), _distances(unit[:, self.half:], self.second)
        return [self.walk(x, y, sizes, candidates) for x, y in zip(one, two, strict=True)]


def _dealt(sizes: np.ndarray) -> list[list[int]]:
    """The shards of each cell: cells in order fill shards of about SHARD entries; a larger cell has its own."""
    out: list[list[int]] = []
    shard = held = 0
    for n in sizes.tolist():
        if n > SHARD:
            own = list(range(shard + 1, shard + 1 + -(-n // SHARD)))
            out.append(own)
            shard, held = own[-1] + 1, 0
            continue
        if held + n > SHARD:
            shard, held = shard + 1, 0
        out.append([shard])
        held += n
    return out


def _best(queries: pd.DataFrame, entries: pd.DataFrame, keep: int) -> Iterator[pd.DataFrame]:
    """For each query the entries of its cells that may be among its nearest, by exact cosine."""
    v = np.array(entries["vector"].tolist(), np.float64)
    norm, unit = np.sqrt((v * v).sum(1)), _unit(v)
    names, at = np.unique(entries["cell"].to_numpy(), return_inverse=True)
    least = np.array([min(ids) for ids in entries["ids"]])
    for begin in range(0, len(queries), 256):
        part = queries.iloc[begin:begin + 256]
        q = np.array(part["vector"].tolist(), np.float64)
        seen = np.zeros((len(q), len(names)), bool)
        for k, cells in enumerate(part["cells"]):
            seen[k, np.searchsorted(names, np.intersect1d(cells, names))] = True
        near = np.where(seen[:, at], _unit(q) @ unit.T, -np.inf)
        edge = np.partition(near, max(0, near.shape[1] - keep), axis=1)[:, max(0, near.shape[1] - keep)]
        rows = []
        for k, key in enumerate(part["vkey"]):
            found = np.flatnonzero((near[k] >= edge[k] - 1e-9) & (near[k] > -np.inf))
            score = (v[found] * q[k]).sum(1) / (norm[found] * np.sqrt((q[k] * q[k]).sum()))
            for e in np.lexsort((least[found], -score))[:keep]:
                rows += [(key, int(i), float(score[e])) for i in entries["ids"].iloc[found[e]]]
        yield pd.DataFrame(rows, columns=["vkey", "vec_id", "score"])


def search(vectors: DataFrame, every: int = 50, nearest: int = 5, centroids: int = 64, candidates: int = 4096,
           share: float = 0.5, sample: int = 20_000) -> DataFrame:
    """The ``nearest`` neighbours of every vector whose vec_id is divisible by ``every``, among all
    others: query_id, rank (from 1), vec_id, score (cosine)."""
    spark, keep = vectors.sparkSession, nearest + 1
    rows = require(vectors, ["vec_id", "embedding"]).where(F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("embedding") == lengths[0]["n"]).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    # entries: distinct vectors; of a hot one each task sends on its few smallest ids alone
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    entries = rows.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= keep)
    entries = entries.groupBy("vector").agg(F.collect_set("vec_id").alias("ids")).withColumn("vkey", F.xxhash64("vector"))
    entries = materialise(entries, "index-entries")
    picked = entries.orderBy(F.xxhash64("vkey"), "vkey").limit(sample).select("vector").collect()
    index = spark.sparkContext.broadcast(MultiIndex(_unit(np.array([r["vector"] for r in picked])), centroids))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=index.value.cells(_unit(np.array(batch["vector"].tolist()))))

    entries = materialise(entries.mapInPandas(placed, "vector array<double>, ids array<bigint>, vkey bigint, cell int"), "index-cells")
    n_cells = len(index.value.first) * len(index.value.second)
    sizes = np.zeros(n_cells, np.int64)
    for r in entries.groupBy("cell").count().collect():  # centroids ** 2 rows at most
        sizes[r["cell"]] = r["count"]
    layout = spark.sparkContext.broadcast((sizes, _dealt(sizes)))
    wanted = max(candidates, int(np.ceil(share * sizes.sum())))

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, dealt = layout.value
        for batch in batches:
            out = []
            if len(batch):
                cells = index.value.probes(_unit(np.array(batch["vector"].tolist())), sizes, wanted)
                for key, vector, own in zip(batch["vkey"], batch["vector"], cells, strict=True):
                    by_shard: dict[int, list[int]] = {}
                    for cell in own:
                        for shard in dealt[cell]:
                            by_shard.setdefault(shard, []).append(cell)
                    out += [(key, vector, shard, c) for shard, c in by_shard.items()]
            yield pd.DataFrame(out, columns=["vkey", "vector", "shard", "cells"])

    def sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dealt = layout.value[1]
        for batch in batches:
            yield batch.assign(shard=[dealt[c][k % len(dealt[c])] for c, k in zip(batch["cell"], batch["vkey"], strict=True)])

    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector", F.xxhash64("vector").alias("vkey"))
    queries = asked.groupBy("vkey").agg(F.first("vector").alias("vector"))
    probes = materialise(queries.mapInPandas(probed, "vkey bigint, vector array<double>, shard int, cells array<int>"), "index-probes")
    parts = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    parts = materialise(parts.withColumnRenamed("shard", "of"), "index-parts")
    left = probes.join(parts, F.col("shard") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("vkey"), F.col("parts")).cast("int"))
    right = entries.mapInPandas(sharded, "vector array<double>, ids array<bigint>, vkey bigint, cell int, shard int")
    right = right.join(parts, F.col("shard") == F.col("of")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left, right = left.select("shard", "part", "vkey", "vector", "cells"), right.select("shard", "part", "vector", "ids", "cell")

    def rerank(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"vkey": [], "vec_id": [], "score": []}).astype({"vkey": "int64", "vec_id": "int64"})
        return pd.concat([none, *_best(q, e, keep)]) if len(q) and len(e) else none

    found = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(
        rerank, "vkey bigint, vec_id bigint, score double")
    best = Window.partitionBy("vkey").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    found = found.groupBy("vkey").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    found = materialise(found.withColumnRenamed("vkey", "of"), "index-found")
    own = asked.select(F.col("vec_id").alias("query_id"), "vkey").distinct().join(found, F.col("vkey") == F.col("of"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    out = own.select("query_id", F.posexplode(others).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose vec_id is divisible by 50: query_id, rank, vec_id, score."""
    return search(table(spark, sf_dir, "embeddings"))
