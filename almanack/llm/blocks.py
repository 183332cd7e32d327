"""Deals blocks of possibly similar sets to tasks of bounded size, every pair of a block in exactly one task.

A block is a component of the candidate graph: members of different blocks
cannot be partners.  Many small blocks share a task.  A block over the limit is
cut into cells by set size (steps of 1/threshold, so that partners lie in equal
or adjacent steps) and, within a step, by hash; each task then holds two cells.
Nothing is dropped, and no task holds more than two cells.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_tasks(members: DataFrame, threshold: float, limit: int) -> DataFrame:
    """``node, block, n, weight`` -> ``node, block, task, cell``.

    A row appears once per task that needs it.  In a task, members of one block
    are compared if their ``cell`` is equal and marked ``-1`` (all pairs of a
    cell), or if their cells are 0 and 1.
    """
    step = math.log(1 / threshold)
    rows = members.withColumn("step", F.floor(F.log(F.greatest("n", F.lit(1))) / F.lit(step) + 1e-9).cast("int"))
    totals = rows.groupBy("block").agg(F.sum("weight").alias("block_weight"))
    rows = rows.join(totals, "block")
    groups = F.greatest(F.lit(1), F.ceil(F.sum("weight") / limit)).alias("groups")
    small = rows.where(F.col("block_weight") <= limit)
    small = small.crossJoin(small.agg(groups))  # one row
    small = small.select("node", "block", F.concat(F.lit("s"), F.pmod(F.xxhash64("block"), F.col("groups"))).alias("task"), F.lit(-1).alias("cell"))
    large = rows.where(F.col("block_weight") > limit)
    cells = large.groupBy("block", "step").agg(F.ceil(F.sum("weight") / limit).cast("int").alias("cells"))
    large = large.join(cells, ["block", "step"])
    for name, shift in (("above", -1), ("below", 1)):
        large = large.join(cells.select("block", (F.col("step") + shift).alias("step"), F.col("cells").alias(name)), ["block", "step"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    large = large.withColumn("own", own)

    def name(low_step, low, high_step, high):
        return F.concat_ws("_", F.lit("l"), "block", low_step, low, high_step, high)

    def some(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    here = F.transform(some(F.col("cells")), lambda k: F.struct(
        name(F.col("step"), F.least("own", k), F.col("step"), F.greatest("own", k)).alias("task"),
        F.when(k == F.col("own"), -1).when(F.col("own") < k, 0).otherwise(1).alias("cell")))
    above = F.transform(some(F.coalesce("above", F.lit(0))), lambda k: F.struct(name(F.col("step"), F.col("own"), F.col("step") + 1, k).alias("task"), F.lit(0).alias("cell")))
    below = F.transform(some(F.coalesce("below", F.lit(0))), lambda k: F.struct(name(F.col("step") - 1, k, F.col("step"), F.col("own")).alias("task"), F.lit(1).alias("cell")))
    large = large.select("node", "block", F.inline(F.concat(here, above, below)))
    return small.unionByName(large)
