"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a reproducible shuffled order, repeated up to
``max_repeats`` times. A document's virtual finish time is the cumulative tokens of its queue up to
its end divided by the queue's target; the mix is all queues merged in that order and cut where the
total budget is used up. Since the targets sum to the budget, the cut is at one virtual time for all
queues: the document which that moment crosses is cut there, so a source is off its target by less
than a word whatever its documents' lengths.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own, last in
order; rows that repeat are separate rows; a source of size 0 has target 0; an empty table gives an
empty mix. Columns of the input never clash with the operator's own (it reads three by name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, require, stored, table, with_row_id

WEIGHTS = (1.0, 2.0, 3.0)

# Leading hexadecimal digits of the shuffled order that make a slice of a queue: with 4096 slices, a
# source that holds a third of n rows has about n / 12288 of them in a slice.
SLICE_DIGITS = 3


def document_sizes(docs: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, source, size (words of the whole text) and ``turn``,
    its place in the shuffled order: the leading 60 bits of md5 of the doc_id, as hexadecimal."""
    rows = with_row_id(require(docs, ["doc_id", "source", "text"]))
    words = F.regexp_count("row.text", F.lit(WORD))
    return rows.select(
        "rid", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
        F.substring(F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15).alias("turn"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Sources in code-point order, null last, take ``weights`` in turn. Each target is its weight's
    share of all sizes, but at most ``max_repeats`` times the source's size; what is above goes
    to the others by weight until none is above. In order of size / weight the sources that stop
    are a prefix, so running sums find the level at once: a source stops if, at the level where it
    just reaches its limit, the budget still isn't used up. One small row per source is handled.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    of = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(of, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", F.col("source_size") * F.lit(float(max_repeats)))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = by_level.rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("budget", F.sum("source_size").over(everything).cast("double"))
    per = per.withColumn("used_at_limit", F.sum("limit").over(upto)
                         + F.coalesce(F.sum("weight").over(rest), F.lit(0.0)) * F.col("limit") / F.col("weight"))
    per = per.withColumn("stops", F.col("used_at_limit") <= F.col("budget"))
    free = F.col("budget") - F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), F.col("limit")).otherwise(free * F.col("weight") / open_weight)
    return per.select("source", "source_size", "weight", target.alias("target"))


def queue(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every document with ``before``, the words of its source that stand ahead of it in the queue.

    The running total needs no task that holds a whole source: sums per slice of the shuffled order
    are combined before the shuffle, their running totals are at most 4096 rows a source, and
    the order inside a slice is settled among that slice's rows alone.
    """
    d = sizes.withColumn("slice", F.conv(F.substring("turn", 1, SLICE_DIGITS), 16, 10).cast("int"))
    sums = d.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    s = sums.withColumn("slice_before", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0))).drop("slice_size")
    t = targets.withColumnRenamed("source", "of_source")
    s = s.join(t, F.col("source").eqNullSafe(F.col("of_source"))).drop("source").withColumnRenamed("slice", "of_slice")
    within = (Window.partitionBy("source", "slice").orderBy("turn", "doc_id", "rid")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("in_slice", F.coalesce(F.sum("size").over(within), F.lit(0)))
    d = d.join(s, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("slice") == F.col("of_slice")))
    return d.select("rid", "doc_id", "source", "size", "source_size", "target",
                    (F.col("slice_before") + F.col("in_slice")).alias("before"))


def passes(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3,
           budget_share: float = 1.0) -> DataFrame:
    """Every document once for each pass of its queue, with ``finish`` (its virtual finish time) and
    ``words`` (those of it that the merged order reaches before the cut; 0 beyond it)."""
    sizes = materialise(document_sizes(docs), "mix-sizes")
    queued = queue(sizes, source_targets(sizes, weights, max_repeats))
    turns = queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    begin = F.col("before") + F.col("pass") * F.col("source_size")
    reached = F.round(F.col("target") * F.lit(float(budget_share))).cast("long") - begin
    return (turns.withColumn("words", F.greatest(F.lit(0), F.least(F.col("size"), reached)))
            .withColumn("finish", (begin + F.col("size")) / F.col("target")).drop("before"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix in its order, range-sorted by virtual finish time and cut at the budget: a row for each
    document and pass that is taken. Options are those of ``passes``; ``budget_share`` cuts the
    merged order at that share of the targets' total."""
    return passes(docs, **options).where("words > 0").orderBy("finish", "source", "doc_id", "rid")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass that takes words, with all columns of the
    input, in the order of ``mix``: range-sorted, so each file that is written holds one stretch of the
    merged order, sources interleaved by weight. A document that the cut crosses ends with the last
    word taken (``n_chars``, if there is such a column, follows)."""
    docs = stored(docs)
    taken = passes(docs, **options).where("words > 0").select(
        F.col("rid").alias("t_rid"), F.col("doc_id").alias("t_id"), "words", F.col("size").alias("t_size"),
        "finish", F.col("source").alias("t_source"))
    on = (F.col("rid") == F.col("t_rid")) & F.col("row.doc_id").eqNullSafe(F.col("t_id"))
    out = with_row_id(docs).join(taken, on).orderBy("finish", "t_source", "t_id", "rid")
    pieces = F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") == F.col("t_size"), F.col("row.text")).otherwise(head)
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.withColumn("row", row).select("row.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words of it that the mix takes: doc_id, size, source_size, target, taken."""
    p = passes(table(spark, sf_dir, "documents"))
    return (p.groupBy("rid", "doc_id", "size", "source_size", "target").agg(F.sum("words").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS turn
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most
  FROM p),
l AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS budget,
         sum(most) OVER up + coalesce(sum(weight) OVER rest, 0) * most / weight <= sum(source_size) OVER () AS stops
  FROM w
  WINDOW up AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         rest AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT source, source_size,
         CASE WHEN stops THEN most
              ELSE (budget - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ()) * weight
                   / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () END AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY turn, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(size, round(target)::BIGINT - ahead))
        + greatest(0, least(size, round(target)::BIGINT - ahead - source_size))
        + greatest(0, least(size, round(target)::BIGINT - ahead - 2 * source_size)))::BIGINT AS taken
FROM q
"""
