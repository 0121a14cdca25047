"""Item embeddings from behaviour sequences.

The default is a projection of weighted co-occurrence counts: every item's vector is the sum, over the
items it occurs near, of a fixed random sign vector of that item times a weight. Counts are a
table that adds up over days, so yesterday's knowledge is the starting point of today's vectors and the
vocabulary grows with the data; nothing is held on the driver. ``method="word2vec"`` (Spark ML's
skip-gram, whose matrix lives on the driver) and ``method="als"`` remain as options.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def item2vec(
    sequences: DataFrame,
    *,
    items_col: str = "items",
    size: int = C.W2V_SIZE,
    window: int = C.W2V_WINDOW,
    min_count: int = C.W2V_MIN_COUNT,
    epochs: int = C.W2V_EPOCHS,
    seed: int = 42,
    num_partitions: int | None = None,
    step_size: float = 0.025,
    max_sentence_length: int = 1000,
    return_model: bool = False,
    method: str = "cooccurrence",
    reg: float = 0.05,
    alpha: float = 10.0,
):
    """Sentences of item ids -> (pid, vector) for every item seen ``min_count`` times.

    ``cooccurrence`` (default): ``cooccurrence`` counts -> ``cooccurrence_vectors``. ``als``: implicit
    ALS on the same counts. ``word2vec``: Spark ML skip-gram with hierarchical softmax, for
    vocabularies that fit the driver; it has no warm start. Non-numeric tokens are dropped from the
    output (only digit ids are items). With ``return_model`` the fitted model of ``als`` or
    ``word2vec`` is returned too, for the daily snapshot sink.
    """
    if method == "cooccurrence":
        return cooccurrence_vectors(cooccurrence(sequences, items_col=items_col, window=window, min_count=min_count), size=size)
    if method == "als":
        out, model = item2vec_als(sequences, items_col=items_col, size=size, window=window, min_count=min_count,
                                  epochs=epochs, seed=seed, reg=reg, alpha=alpha)
        return (out, model) if return_model else out
    if num_partitions is None:
        num_partitions = max(1, sequences.sparkSession.sparkContext.defaultParallelism)
    w2v = Word2Vec(
        vectorSize=size, windowSize=window, minCount=min_count, maxIter=epochs, seed=seed,
        numPartitions=num_partitions, stepSize=step_size, maxSentenceLength=max_sentence_length,
        inputCol=items_col, outputCol="__vec",
    )
    model = w2v.fit(sequences.select(items_col))
    v = model.getVectors()
    out = v.filter(F.col("word").rlike("^[0-9]+$")).select(
        F.col("word").cast("bigint").alias("pid"), vector_to_array("vector", "float32").alias("vector")
    )
    return (out, model) if return_model else out


def cooccurrence(sequences: DataFrame, *, items_col: str = "items", window: int = 5, min_count: int = 5) -> DataFrame:
    """Symmetric windowed co-occurrence counts (item, ctx, n) of items seen ``min_count`` times.

    Each item meets the next ``window`` items of its sentence (those of column ``ahead``, if there
    is one, follow the sentence's own). Pairs are built inside the row and counted before the
    shuffle, so only counts travel; the fan-out of an item is ``window``, never a whole sentence.
    """
    items = F.col(items_col)
    after = F.concat(items, F.col("ahead")) if "ahead" in sequences.columns else items
    pairs = F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(items)),
        lambda i: F.transform(F.slice(after, i + 1, F.lit(window)), lambda b: F.struct(F.element_at(items, i).alias("a"), b.alias("b")))))
    some = sequences.filter(F.size(items) > 0)
    p = some.select(F.explode(pairs).alias("p")).select("p.a", "p.b").filter("a <> b")
    p = p.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    vocab = some.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    vocab = vocab.filter(F.col("c") >= min_count).select("item")
    p = p.join(vocab.withColumnRenamed("item", "a"), "a", "left_semi").join(vocab.withColumnRenamed("item", "b"), "b", "left_semi")
    both = p.select(F.explode(F.array(
        F.struct(F.col("a").alias("item"), F.col("b").alias("ctx"), "n"),
        F.struct(F.col("b").alias("item"), F.col("a").alias("ctx"), "n"))).alias("x")).select("x.*")
    return both.groupBy("item", "ctx").agg(F.sum("n").cast("double").alias("n"))


def summed(counts: DataFrame) -> DataFrame:
    """Counts of several days (item, ctx, n, ...) -> their sums (item, ctx, n)."""
    return counts.groupBy("item", "ctx").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, min_count: int) -> DataFrame:
    """Counts among items whose co-occurrences sum to ``min_count`` at least."""
    often = counts.groupBy("item").agg(F.sum("n").alias("c")).filter(F.col("c") >= min_count).select("item")
    c = counts.join(often, "item", "left_semi")
    return c.join(often.withColumnRenamed("item", "ctx"), "ctx", "left_semi").select("item", "ctx", "n")


def sign_bits(key: Column, size: int) -> Column:
    """``size`` signs (1.0 or -1.0) fixed by the text of ``key``: the bits of its MD5, of md5(key:1) and so on."""
    hexes = F.concat(*[F.md5(F.concat(key, F.lit(f":{k}")).cast("binary")) for k in range(-(-size // 128))])
    def sign(j: Column) -> Column:
        digit = F.conv(F.substr(hexes, F.floor(j / 4).cast("int") + 1, F.lit(1)), 16, 10).cast("int")
        bit = F.floor(digit / F.pow(F.lit(2.0), j % 4)).cast("int") % 2
        return F.when(bit == 1, F.lit(1.0)).otherwise(F.lit(-1.0))

    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), sign)


def signs_of(key: str, size: int) -> list[int]:
    """``sign_bits`` of a constant: 1 or -1 each."""
    digits = "".join(hashlib.md5(f"{key}:{k}".encode()).hexdigest() for k in range(-(-size // 128)))
    return [1 if int(digits[j // 4], 16) >> j % 4 & 1 else -1 for j in range(size)]


def cooccurrence_vectors(counts: DataFrame, *, size: int = C.W2V_SIZE) -> DataFrame:
    """(item, ctx, n) -> (pid, vector array<double>): sum over contexts of ln(1 + n) / sqrt(total of ctx)
    times the context's sign vector. A group-by with partial aggregation over a join on the context."""
    totals = counts.groupBy("ctx").agg(F.sum("n").alias("total"))
    totals = totals.select("ctx", F.sqrt("total").alias("root"), sign_bits(F.col("ctx"), size).alias("signs"))
    x = counts.filter(F.col("item").rlike("^[0-9]+$")).join(totals, "ctx")
    w = F.log1p("n") / F.col("root")
    sums = [F.sum(w * F.col("signs")[j]).alias(f"x{j}") for j in range(size)]
    g = x.groupBy("item").agg(*sums)
    return g.select(F.col("item").cast("bigint").alias("pid"), F.array(*[f"x{j}" for j in range(size)]).alias("vector"))


def item2vec_als(
    sequences: DataFrame,
    *,
    items_col: str = "items",
    size: int = C.W2V_SIZE,
    window: int = C.W2V_WINDOW,
    min_count: int = C.W2V_MIN_COUNT,
    epochs: int = C.W2V_EPOCHS,
    seed: int = 42,
    reg: float = 0.05,
    alpha: float = 10.0,
):
    """Item vectors by implicit-feedback ALS on the co-occurrence matrix -> ((pid, vector), model).

    Factors live in DataFrames partitioned over the cluster, so the vocabulary is not bound
    by driver memory. ALS needs int ids: item ids are densified with an exact distributed
    global numbering (no single-task window).
    """
    from .skew import skew_safe_row_number

    co = cooccurrence(sequences, items_col=items_col, window=window, min_count=min_count)
    vocab = co.select("item").distinct()
    ids = skew_safe_row_number(vocab, [], [F.col("item").asc()], name="iid")
    ids = ids.select("item", (F.col("iid") - 1).cast("int").alias("iid"))
    m = co.join(ids, "item").join(ids.select(F.col("item").alias("ctx"), F.col("iid").alias("cid")), "ctx")
    als = ALS(rank=size, maxIter=epochs, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
              userCol="iid", itemCol="cid", ratingCol="n", nonnegative=False, coldStartStrategy="drop")
    model = als.fit(m.select("iid", "cid", "n"))
    f = model.userFactors.select(F.col("id").alias("iid"), "features")
    out = f.join(ids, "iid").filter(F.col("item").rlike("^[0-9]+$")).select(
        F.col("item").cast("bigint").alias("pid"), F.col("features").cast("array<float>").alias("vector"))
    return out, model
