"""Small helpers that the training-data operators share: row ids, scratch tables, columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import table

# White space of the word definition used throughout: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "decided", "materialise", "require", "scratch", "spaced", "stored", "table", "with_row_id"]


def spaced(text: str | None) -> str:
    """``text`` with each white-space character as a space (much faster than ``str.translate``)."""
    text = text or ""
    for c in "\t\n\v\f\r":
        if c in text:
            text = text.replace(c, " ")
    return text


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/candor-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage (an executor that is lost later costs no recomputation) and gives every
    reader the same rows. The folder stays until whoever owns ``spark.checkpoint.dir`` clears it.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns, by exact name; columns that the table lacks raise a clear error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[df[f"`{c}`"] for c in columns])


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if it reads files, whose rows have places; else written to the shared folder first.

    Whoever scans a table more than once and joins the scans by row id starts from this.
    """
    try:
        df.select(df.metadataColumn("_metadata")["file_path"]).schema  # noqa: B018 (resolves the column)
        return df
    except AnalysisException:
        return materialise(df, "rows")


def with_row_id(df: DataFrame) -> DataFrame:
    """``stored(df)`` nested as struct ``row`` beside ``rid``, a long that names the physical row.

    ``rid`` hashes the file's path and the row's place in it, so two scans of the same table agree
    without a shuffle. Nesting keeps any column of the input from clashing with the operators'
    own names.
    """
    df = stored(df)
    meta = df.metadataColumn("_metadata")
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    return df.select(row, F.xxhash64(meta["file_path"], meta["row_index"]).alias("rid"))


def decided(rows: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The nested rows of ``rows`` whose (``rid``, id) is in ``kept``, flat again.

    ``key`` is the id column of the table; it joins with ``rid`` so that two rows could be
    confused only if both agreed. Null ids join null ids.
    """
    kept = kept.select(F.col("rid").alias("kept_rid"), F.col(key).alias("kept_id"))
    at = (F.col("rid") == F.col("kept_rid")) & F.col("row")[key].eqNullSafe(F.col("kept_id"))
    return rows.join(kept, at, "left_semi").select("row.*")
