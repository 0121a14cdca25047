"""Exact duplicates against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the SHA-256 of the
normalised text. A batch of new documents is first reduced to one row per digest (combined before the
shuffle, so a text with a third of all copies costs one row a task), then anti-joined with the index
bucket by bucket: the index side is read in its stored order, neither shuffled nor sorted. What the
index lacks is appended to it.

Equal means identical after lower-casing A-Z only. Within a batch the row with the largest doc_id
stays; a text that an earlier batch brought stays with the row indexed then, so feed batches newest
first where the largest id is wanted over all of them.

Defined results: a null text counts as empty; a null doc_id is smaller than any other; of rows that
repeat doc_id and text exactly one stays; an empty table gives no rows and leaves the index as it
is. Only doc_id and text are read, so other columns can have any name.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import decided, materialise, require, stored, table, with_row_id


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, rid and the SHA-256 (binary) of each whole normalised text."""
    rows = with_row_id(require(docs, ["doc_id", "text"]))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)  # lower() then changes A-Z alone, and is faster
    normal = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "rid", F.unhex(F.sha2(normal, 256)).alias("digest"))


class DigestIndex:
    """A bucketed, sorted table ``name`` of (digest, keep_id, keep_rid) in the session's catalog.

    ``buckets`` (default: the session's shuffle partitions) counts when the table is made; later
    sessions take it from the catalog. A catalog that outlives the session keeps the index.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark, self.name = spark, name
        if self.exists():
            about = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
            self.buckets = int(about["data_type"])
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, batch: DataFrame) -> None:
        """Append the texts of ``batch`` (rows of ``digests``) that the index lacks."""
        own = batch.groupBy("digest").agg(F.max(F.struct("doc_id", "rid")).alias("last"))
        own = own.select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.rid").alias("keep_rid"))
        own = own.repartition(self.buckets, "digest")  # the table's own layout: bucket i is partition i
        if self.exists():
            own = own.hint("merge").join(self.read(), "digest", "left_anti")
        # The new rows are set down first: a table can't be appended to while it is read, and a
        # task that is run again must find the index as it was.
        new = materialise(own, "digest-new").repartition(self.buckets, "digest")
        (new.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .saveAsTable(self.name))

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``digests`` (all ingested) with keep_id, keep_rid and group_size, their copies here.

        Copies of one text need not meet in one task: sizes are counted before the shuffle and set
        down with the index's entries, so both sides of the join are plain shuffles, which adaptive
        execution splits where a digest is hot.
        """
        sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        held = materialise(sizes.join(self.read(), "digest"), "digest-held").withColumnRenamed("digest", "held")
        return rows.join(held, F.col("digest") == F.col("held")).drop("held")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """All of ``docs`` through a fresh index, in ``batches`` that arrive with the largest ids first.

    Returns one row per document: doc_id, rid, digest, keep_id, keep_rid, group_size, kept. The batches
    are equal ranges of doc_id that together hold every row (null ids come last), so the row with
    the largest doc_id of each text is the one that the index knows.
    """
    rows = materialise(digests(docs), "digests")
    least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = DigestIndex(docs.sparkSession, f"candor_digests_{uuid.uuid4().hex}")
    least, most = (0, 0) if least is None else (least, most)
    # whole numbers in Python, each one at most the largest id: exact however far apart the ids are
    last = [least - (-k * (most - least + 1) // batches) - 1 for k in range(1, batches)]
    part = sum(((F.coalesce(F.col("doc_id"), F.lit(least)) > F.lit(x)).cast("int") for x in last), F.lit(0))
    for k in reversed(range(batches)):
        index.ingest(rows.where(part == k))
    out = index.resolve(rows)
    index.drop()
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("rid") == F.col("keep_rid"))
    return out.withColumn("kept", same)


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs``, all columns kept, without the rows whose text another row stands for."""
    docs = stored(docs)
    return decided(with_row_id(docs), dedup(docs).where("kept"), "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, keep_id, group_size, kept, text_sha256."""
    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
