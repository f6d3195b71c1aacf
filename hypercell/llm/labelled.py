"""Labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a model is fitted on; chosen by a hash of the id, so the same at every run.
MAX_TRAINING_ROWS = 20_000


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def outside(labels: DataFrame, label_col: str, id_col: str = "doc_id", folds: int = 1, held_out: int | None = None) -> DataFrame:
    """``id`` and label ``y``, 0 or 1, outside fold ``held_out``; null ids and labels are left out."""
    src = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    return src if held_out is None else src.where(fold("id", folds) != held_out)


def sample(labels: DataFrame, label_col: str, id_col: str = "doc_id", folds: int = 1, held_out: int | None = None, limit: int = MAX_TRAINING_ROWS) -> list[tuple[int, int]]:
    """At most ``limit`` pairs of an id and a label of those ``outside`` the fold."""
    src = outside(labels, label_col, id_col, folds, held_out)
    rows = src.orderBy(F.xxhash64("id"), "id", "y").limit(limit).collect()
    return [(r["id"], r["y"]) for r in rows]


def with_labels(docs: DataFrame, rows: list[tuple[int, int]]) -> DataFrame:
    """``id``, ``text`` and ``y`` of the documents in a sample; ``docs`` has ``id`` and ``text``. The sample's bound bounds the broadcast."""
    right = docs.sparkSession.createDataFrame(rows, "id long, y int")
    return docs.join(F.broadcast(right), "id")
