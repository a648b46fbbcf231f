"""Tandem repeats of reads to rings and read classes.

A read with one repeat is simple. Repeats of other reads that share more than 50 positions, also through others,
form a component of which the longest stays (of equals the first). What is left is judged by how consistent its
unit lengths are. Null match degrees fail the filter; null copy numbers count as missing in sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions.scalars import ring_id

# Classes by priority.
CLASSES = ["CtcR-perfect", "CtcR-hybrid", "CtcR-inversion", "Other"]
SHARED = 50


def good(df: DataFrame, least: float = 99.0) -> DataFrame:
    """Rows of sufficient match with their effective length in per cent of the read."""
    kept = df.where((F.col("aveMatch") >= least) & ~F.isnan("aveMatch"))
    return kept.withColumn("eff", (F.col("end") - F.col("start") + 1) / F.col("readLen") * 100)


def simple_class(eff: Column) -> Column:
    return F.when(eff >= 99, CLASSES[0]).when(eff >= 70, CLASSES[1]).otherwise(CLASSES[3])


def with_counts(df: DataFrame) -> DataFrame:
    return df.withColumn("regions", F.count("*").over(Window.partitionBy("readName")))


def keep_longest(df: DataFrame) -> DataFrame:
    """The longest repeat of every overlap component of a read (``rec_id`` breaks ties).

    A repeat of 50 positions or less shares with nobody. For the others a new component begins where the longest
    reach so far goes at most 50 positions past the start.
    """
    w = Window.partitionBy("readName", "_short").orderBy("start", "end", "rec_id")
    df = df.withColumn("_short", F.when(F.col("end") - F.col("start") + 1 <= SHARED, F.col("rec_id")))
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_open", F.when(reach.isNull() | (reach - F.col("start") + 1 <= SHARED), 1).otherwise(0))
    df = df.withColumn("component", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("readName", "_short", "component").orderBy(F.desc("eff"), "rec_id")
    return df.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "_open", "_short", "component")


def consistency(df: DataFrame) -> DataFrame:
    """Per read: unit length statistics and the type of consistency."""
    stats = df.groupBy("readName").agg(
        F.count("*").alias("num_regions"), F.avg("consLen").alias("mean_len"), F.stddev_pop("consLen").alias("std_len"),
        F.min("consLen").alias("min_len"), F.max("consLen").alias("max_len"), F.sum("eff").alias("total_eff"), F.collect_set("consLen").alias("_lens"),
    )
    cv = F.when(F.col("mean_len") > 0, F.col("std_len") / F.col("mean_len") * 100).otherwise(0.0)
    multiple = F.forall("_lens", lambda x: F.abs(x / F.col("min_len") - F.rint(x / F.col("min_len"))) <= 0.05) & (F.col("min_len") > 0)
    kind = F.when(F.col("cv") < 1, "highly_consistent").when(F.col("cv") < 5, "consistent").when(multiple, "integer_multiple").otherwise("variable")
    return stats.withColumn("cv", cv).withColumn("consistency", kind).drop("_lens")


def rings(df: DataFrame) -> DataFrame:
    """ring_id, readName, repN, consLen, copyNum (whole), eff, class, consSeq of all classified repeats."""
    counted = with_counts(good(df))
    simple = counted.where("regions = 1").withColumn("class", simple_class(F.col("eff")))
    kept = keep_longest(counted.where("regions > 1"))
    w = Window.partitionBy("readName")
    first = F.row_number().over(w.orderBy("start", "end", "rec_id"))
    judged = kept.join(consistency(kept).select("readName", "num_regions", "consistency"), "readName")
    judged = judged.withColumn("_first", first).withColumn("_eff", F.sum("eff").over(w)).withColumn("_copies", F.sum("copyNum").over(w))
    merged = (F.col("num_regions") > 1) & (F.col("consistency") == "highly_consistent")
    judged = judged.where(~merged | (F.col("_first") == 1))
    cls = F.when(merged, F.when(F.col("_eff") >= 70, CLASSES[2]).otherwise(CLASSES[3])).when(F.col("num_regions") == 1, simple_class(F.col("eff"))).otherwise(CLASSES[1])
    judged = judged.withColumn("class", cls).withColumn("eff", F.when(merged, F.col("_eff")).otherwise(F.col("eff")))
    judged = judged.withColumn("copyNum", F.when(merged, F.col("_copies")).otherwise(F.col("copyNum")))
    columns = ["rec_id", "readName", "repN", "consLen", "copyNum", "eff", "class", "consSeq"]
    both = simple.select(*columns).unionByName(judged.select(*columns))
    return both.withColumn("copyNum", F.rint("copyNum").cast("bigint")).withColumn("ring_id", ring_id(F.col("readName"), F.col("repN"), F.col("consLen"), F.col("copyNum")))


def read_classes(rings: DataFrame) -> DataFrame:
    """readName, readClass: the class of highest priority among a read's rings."""
    order = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("class"))
    return rings.groupBy("readName").agg(F.min_by("class", order).alias("readClass"))
