"""Labelled rows for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null without an id."""
    return F.crc32(doc_id.cast("string")) % folds


def sample(docs: DataFrame, labels: DataFrame, per_class: int, classes: list) -> DataFrame:
    """Up to ``per_class`` labelled documents (text, label) of each class: those
    whose ids hash lowest, the same rows on any layout. ``docs`` has doc_id and
    text, ``labels`` doc_id and label; repeated label rows count once, an id
    with two labels counts for each, null ids and labels not at all."""
    known = labels.select("doc_id", "label").where("doc_id is not null and label is not null").distinct()
    chosen = None
    for c in classes:
        part = known.where(F.col("label") == F.lit(c)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")  # per_class * classes rows at most
