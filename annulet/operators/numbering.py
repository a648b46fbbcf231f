"""Numbers along a global order without one task that holds all rows.

Rows are range-partitioned, sorted within their partitions and written once; the counts of the partitions before it
give each partition its offset, and a row's place in its partition is what it was written as, so nothing is shuffled
again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.session import cut


ROW = (1 << 33) - 1  # the part of a row's running id that counts within its partition


def numbered(df: DataFrame, order: list[str], name: str, start: int | Column = 1) -> DataFrame:
    """df with ``name`` counting from ``start`` along ``order``, which must be a total order for a stable result."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND(F.lit(ROW))}).drop("_id")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_row") + first).drop("_part", "_row", "_before")
