"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the stage before it kept; its result is written as
Parquet into the shared folder and read again as the next one's documents. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersmith.llm.common import release_staged, stage, staged_for
from ordersmith.llm.decontamination import drop_contaminated
from ordersmith.llm.exact_dedup import drop_exact_duplicates
from ordersmith.llm.near_dedup import drop_near_duplicates
from ordersmith.llm.packing import pack
from ordersmith.llm.quality import keep_good


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _stage(work):
    """What the operator of a stage stages goes when the next stage begins: its result is written by then."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_staged(spark, "pipeline")
        with staged_for("pipeline"):
            return work(spark, docs, sf_dir)
    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null and empty texts are judged like any other."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one document stays (null, empty and blank texts are one such group)."""
    return drop_exact_duplicates(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one document stays; texts without words are no duplicates of each other."""
    return drop_near_duplicates(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go; those without words stay."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in the packed sequences, with their token ids' crc32.

    A document without text is one piece of the end id; ids may be null, and repeated rows are packed each."""
    return pack(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                             "sequence_id", "offset")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: SQL can express neither the classifier nor the packing; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
