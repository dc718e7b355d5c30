"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import text_bytes


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, text) of labelled rows to learn from, about ``max_rows`` of them whatever the tables' size.

    ``learn`` picks the ids that may be learned from. If more are labelled,
    those with the smallest hashes of their id are taken. The sample's ids and
    labels, at most twice ``max_rows`` rows, are broadcast to the texts; an id
    that several documents have brings all of them.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
    n = known.count()
    if n > max_rows:
        share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
        known = known.filter(share < max_rows / n).limit(2 * max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    return texts.join(F.broadcast(known), "doc_id")
