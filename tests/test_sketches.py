"""Quantile sketches: rank error beyond k values, parts replaced, nulls and empty tables."""

import tempfile

from pyspark.sql import functions as F

from candor.operators import sketches as K

KEYS = ["cell"]


def test_rank_error_merge_and_replaced_parts(spark):
    n, k, probs = 100_000, 200, (0.15, 0.5, 0.95)
    rows = spark.range(n).select(F.col("id").alias("pid"), F.lit("a").alias("cell"), F.col("id").cast("double").alias("m"))
    few = spark.range(7).select((F.col("id") + n).alias("pid"), F.lit("b").alias("cell"), F.col("id").cast("double").alias("m"))
    void = spark.range(3).select((F.col("id") + 2 * n).alias("pid"), F.lit("c").alias("cell"), F.lit(None).cast("double").alias("m"))
    path = tempfile.mkdtemp(prefix="candor-sketch-", dir="/tmp") + "/s"
    sketches = K.metric_sketches(rows.unionByName(few).unionByName(void), ["m"], keys=KEYS, parts=4, k=k)
    K.write_sketches(sketches, path)
    # a part that is sketched again replaces its own: nothing is counted twice
    K.write_sketches(sketches.where("part = 1"), path)
    stored = spark.read.parquet(path)
    total = stored.groupBy("cell").agg(F.kll_sketch_get_n_double(F.kll_merge_agg_double("s_m")).alias("n"))
    assert {r["cell"]: r["n"] for r in total.collect()} == {"a": n, "b": 7, "c": 0}
    got = {r["cell"]: r["__q_m"] for r in K.merged_quantiles(stored, ["m"], probs, keys=KEYS).collect()}
    assert all(abs(q / n - p) < 8 / k for q, p in zip(got["a"], probs, strict=True))
    assert got["b"] == [1.0, 3.0, 6.0] and got["c"] == [None, None, None]


def test_empty_table(spark):
    none = spark.createDataFrame([], "pid long, cell string, m double")
    assert K.merged_quantiles(K.metric_sketches(none, ["m"], keys=KEYS), ["m"], (0.5,), keys=KEYS).count() == 0
