"""Top N items within every group, with a total order.

A histogram of scores per group (bins of fixed width on a logarithmic scale, counted map-side) tells for each
group the highest bin down to which at least N rows lie. Groups of more than ``heavy`` rows lose their rows below
that bin before anything is shuffled by group; what is left is ranked exactly, and Spark's group limit keeps no
more than N rows of a group in each task before that shuffle. The bins of the ``MOST_FLOORS`` largest such groups
are broadcast, which bounds them by construction; smaller ones have the group limit.

Defined cases: rows with a null group, or a null or NaN score, are left out; a group with fewer than N rows is
kept whole; equal scores are ordered by the further keys, nulls (and NaN) last; a key that came more than once
counts in the version loaded last; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MOST_FLOORS = 100_000


def score_bin(score: Column) -> Column:
    """A whole number that never falls as the score rises."""
    size = F.log2(F.least(F.abs(score), F.lit(1e300)) + 1)
    return F.floor(F.signum(score) * 4 * size).cast("int")


def latest(df: DataFrame, key: str, version: str, columns: list[str]) -> DataFrame:
    """key and columns of the row of each key with the latest version; among equal versions the greatest row."""
    return df.groupBy(key).agg(F.max(F.struct(version, *columns)).alias("_v")).select(key, *(F.col(f"_v.{c}").alias(c) for c in columns))


def thresholds(rows: DataFrame, group: str, n: int, heavy: int) -> DataFrame:
    """group, _floor of the largest groups: all their rows in bins from _floor on are n or more."""
    hist = rows.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    down = Window.partitionBy(group).orderBy(F.desc("_bin"))
    hist = hist.withColumn("_from", F.sum("_n").over(down)).withColumn("_all", F.sum("_n").over(Window.partitionBy(group)))
    floors = hist.where((F.col("_from") >= n) & (F.col("_all") > heavy)).groupBy(group).agg(F.max("_bin").alias("_floor"), F.max("_all").alias("_all"))
    return floors.orderBy(F.desc("_all"), group).limit(MOST_FLOORS).drop("_all")


def top_n(df: DataFrame, group: str, score: str, then: list[str], key: str, n: int, heavy: int = 1000) -> DataFrame:
    """group, score, then, key and ``rank`` of the n first rows of each group by score descending, ``then`` descending, key ascending."""
    rows = df.select(group, score, *then, key).where(F.col(group).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    rows = rows.withColumn("_bin", score_bin(F.col(score)))
    floor = F.broadcast(thresholds(rows, group, n, heavy))  # at most MOST_FLOORS rows
    rows = rows.join(floor, group, "left").where(F.col("_floor").isNull() | (F.col("_bin") >= F.col("_floor")))
    descending = [F.expr(f"if(isnan(cast(`{c}` as double)), null, `{c}`)").desc_nulls_last() for c in [score, *then]]
    order = Window.partitionBy(group).orderBy(*descending, F.col(key).asc())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("_bin", "_floor")
