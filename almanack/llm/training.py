"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, settle

#: Bound of the sample a classifier is fitted on: rows of each class.
ROWS_PER_CLASS = 4000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """Settled ``row, y`` and the columns of ``docs`` for at most ``rows_per_class`` labelled documents of each class.

    They are the first by hash of the id of those that are in both tables; ids whose ``crc32 mod`` is
    ``held_out`` are left out.  Null labels and ids
    don't count; of contradicting labels the larger counts; of rows with the same id one, by hash of the row.
    Only ids are shuffled; the chosen ones, which are bounded, are broadcast to the texts.  ``row``
    numbers the sample in an order that depends on nothing but ids and texts.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod(F.col("doc_id"), mod) != held_out))
    usable = usable.groupBy(F.col("doc_id").cast("string").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y")).where("y in (0, 1)")
    usable = usable.join(docs.select(F.col("doc_id").cast("string").alias("id")), "id", "left_semi")
    parts = [usable.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows_per_class) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    columns = [c for c in docs.columns if c in ("doc_id", "text", "n_chars")]
    found = docs.select(F.struct(*columns).alias("doc")).join(chosen, F.col("doc.doc_id").cast("string") == F.col("id"))
    one = found.groupBy("id", "y").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    ranked = one.withColumn("row", F.xxhash64("doc.text", "id"))
    return settle(ranked.select("row", "y", "doc.*"), "sample")


def constant(y) -> float | None:
    """The score of everything where there is nothing to learn: no rows, or one class only."""
    if len(y) == 0:
        return 0.5
    return None if 0 < y.sum() < len(y) else (0.99 if y[0] else 0.01)
