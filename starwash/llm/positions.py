"""Positions in a total order, counted in parallel.

Rows are dealt to tasks by ranges of the order, sorted there and written once
with their number in the task. A task's first position is the sum of the rows
of the tasks before it: one number a task, whatever the number of rows, and the
only thing that passes through the driver. No window spans the table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save

_TASK_BITS = 33  # monotonically_increasing_id keeps the task's number above these bits


def with_position(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3, ... in ``order``.

    ``order`` should be total: among rows equal in it the positions are dealt
    arbitrarily, and such rows meet in one task. An empty table stays empty.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    # the written number is the same for every later reader, also after a task is repeated
    placed = save(ranged.withColumn("_at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("_at", _TASK_BITS)
    sizes = sorted((r["task"], r["n"]) for r in placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    first = spark.createDataFrame([(t, b) for (t, _), b in zip(sizes, before)], "_task long, _before long")
    return placed.withColumn("_task", task).join(first, "_task").withColumn(
        name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)) + 1).drop("_at", "_task", "_before")
