"""From raw documents to packed training sequences, in five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but
the last return the columns of ``docs``:

1. toxicity: documents that the classifier (fitted on the labels' training part) scores 0.5 or more go;
2. exact_dedup: of texts that are equal after lower-casing A-Z the row with the largest doc_id stays;
3. near_dedup: of each class of near copies (five-word shingles, similarity 0.8 or more, and what is
   linked through others) the row with the largest doc_id stays;
4. mix_sources: each source is taken up to its target, up to three passes, a row for each pass; the
   document at a source's cut is shortened;
5. packing: token ids in windows of 4096; a row for each piece.

Any stage accepts nulls, empty and very long texts, repeated rows, empty tables and further columns;
the modules of the operators say what they give for each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candor.llm import bagminhash, exact_dedup, mixing, packing, toxicity
from candor.llm.common import materialise, table
from candor.session import apply_job_conf


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

# A trained model, signatures and a tokenizer can't be said in SQL: tests/llm holds each stage against a
# brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each one's result written and read again by the next."""
    apply_job_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
