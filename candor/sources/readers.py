"""Readers for the upstream job's inputs: warehouse tables and the text/CSV/YAML/JSON files.

All readers are lazy DataFrame reads with explicit schemas (no inference); malformed lines
are filtered in Spark, never on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.boot import load_rules
from ..operators.neighbours import parse_neighbour_lines


def read_table(spark: SparkSession, path: str, *, ymd_since: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A warehouse table stored as Parquet (optionally partitioned by ``ymd``).

    The ``ymd`` bound is a partition filter, so only the needed days are listed and read.
    """
    df = spark.read.parquet(path)
    if ymd_since is not None:
        df = df.filter(F.col("ymd") >= F.lit(ymd_since))
    return df.select(*columns) if columns else df


def read_neighbour_text(spark: SparkSession, path: str) -> DataFrame:
    """Neighbour lists 'pid<\\x01 or space>near:score,...' -> long (pid, pos, near_pid, score, item)."""
    return parse_neighbour_lines(spark.read.text(path))


def read_ptype_tid_csv(spark: SparkSession, path: str) -> DataFrame:
    """'pid,ptype,tid' lines -> (pid, ptype, tid); lines not of width 3 or not integers are skipped."""
    parts = F.split(F.col("value"), ",")
    t = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") == 3)
    out = t.select(*[F.col("p")[i].try_cast("bigint").alias(n) for i, n in enumerate(("pid", "ptype", "tid"))])
    return out.filter(F.col("pid").isNotNull() & F.col("ptype").isNotNull() & F.col("tid").isNotNull())


def read_ranked_csv(
    spark: SparkSession, path: str, *, key_index_list: Sequence[int], pid_index: int = 0, score_index: int = 1
) -> DataFrame:
    """Ranked CSV with configurable column positions -> (key, pid, score).

    ``key`` joins the key columns with '_' (rows with an empty key are skipped).
    """
    p = F.split(F.col("value"), ",")
    key = F.concat_ws("_", *[F.element_at(p, i + 1) for i in key_index_list])
    t = spark.read.text(path).select(
        key.alias("key"), F.element_at(p, pid_index + 1).try_cast("bigint").alias("pid"),
        F.element_at(p, score_index + 1).try_cast("double").alias("score"),
    )
    return t.filter((F.length("key") > 0) & F.col("pid").isNotNull())


def read_sequence_lines(spark: SparkSession, path: str) -> DataFrame:
    """One sentence of item ids per line, whitespace separated -> (items array<string>)."""
    toks = F.filter(F.split(F.trim(F.col("value")), "\\s+"), lambda x: F.length(x) > 0)
    return spark.read.text(path).select(toks.alias("items")).filter(F.size("items") > 0)


def read_rules(spark: SparkSession, path: str) -> dict:
    """Ladder YAML file -> rules dict (a small config file, read once on the driver)."""
    rows = spark.read.text(path, wholetext=True).collect()     # one row per file: line order kept
    return load_rules("\n".join(r["value"] for r in rows))


NODE = T.StructType([
    T.StructField("_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("ct", T.LongType()), T.StructField("status", T.LongType()),
])
TAXONOMY_PAYLOAD = T.StructType([
    T.StructField("ret", T.LongType()),
    T.StructField("data", T.StructType([T.StructField("list", T.ArrayType(
        T.StructType(NODE.fields + [T.StructField("child_list", T.ArrayType(NODE))])))])),
])
PART_TIDS_PAYLOAD = T.StructType([
    T.StructField("ret", T.LongType()),
    T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.ArrayType(T.LongType())))),
])


def read_taxonomy_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed partition-tree payload(s) -> one row per part1 node (_id, name, ct, status, child_list).

    Payloads whose ``ret`` is not 1 are ignored; a ``child_list`` that is not a list reads
    as NULL and the node contributes no partitions.
    """
    j = spark.read.schema(TAXONOMY_PAYLOAD).option("multiLine", "true").json(path)
    return j.filter(F.col("ret") == 1).select(F.explode("data.list").alias("n")).select("n.*")


def read_part_tids_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed partition -> topics payload(s) ({part2_id: [tid, ...]}) -> (part2_id, tid).

    Partition ids arrive as JSON keys (text) and are cast to bigint.
    """
    j = spark.read.schema(PART_TIDS_PAYLOAD).option("multiLine", "true").json(path)
    e = j.filter(F.col("ret") == 1).select(F.explode("data").alias("m")).select(F.explode("m").alias("k", "tids"))
    return e.select(F.col("k").try_cast("bigint").alias("part2_id"), F.explode("tids").alias("tid")).filter(
        F.col("part2_id").isNotNull()
    )
