"""Training samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fold 0 of five, by the CRC-32 of the id as text, is never learned from.
FOLDS = 5
#: A model is fitted on at most this many labelled documents.
MAX_ROWS = 20_000


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample_labels(labels: DataFrame, label: str, id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, label): at most ``max_rows`` labelled ids outside the held-out fold, chosen by
    the hash of the id.  An id with several labels counts with the largest; null ids or labels do not."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )


def sampled_documents(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, label) of the sampled ids.  The broadcast side holds at most ``max_rows`` pairs of numbers."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
