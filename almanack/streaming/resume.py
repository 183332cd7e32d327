"""Incremental runs: new rows are processed once, results appended, and the latest row of a key wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import keep_one


def latest(results: DataFrame, key: str) -> DataFrame:
    """Of all appended rows the last of each key, by batch and then by order in the batch."""
    ranked = results.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col("batch_id").desc(), F.col("ord").desc())))
    return ranked.where("_rank = 1").drop("_rank")


def resume(spark: SparkSession, source: DataFrame, out: str, checkpoint: str, key: str, step: Callable[[DataFrame], DataFrame], order: str | None = None):
    """Starts a query over the stream ``source`` that applies ``step`` to keys not done yet and appends to ``out``.

    Of rows of a key that come together the first counts, by the column ``order``, else by all their columns.
    A batch that is repeated after a failure overwrites its own partition, so results appear once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        by = [F.col(order)] if order else []
        todo = keep_one(batch.where(F.col(key).isNotNull()), [key], *by, F.to_json(F.struct(*batch.columns)))
        try:
            done = spark.read.parquet(out).where(F.col("batch_id") < batch_id).select(key)
            todo = todo.join(done, key, "left_anti")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
        rows = step(todo).withColumn("ord", F.monotonically_increasing_id())
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
