"""Split-read overview rows to simple and chimeric inferred circles.

Rows need a circle of at least 100 bases, regions and a segment count; every region must read ``chr:start-end``.
Of rows with equal regions the best scored stays. Numbers run along the sorted region strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions.scalars import parse_region
from annulet.operators.numbering import numbered

LEAST_LENGTH = 100


def best_of_duplicates(df: DataFrame) -> DataFrame:
    """One row per ``regions``: by presence, split reads relative to the most of the group, and absence of artefacts."""
    most = F.max("num_split_reads").over(Window.partitionBy("regions"))
    clean = 1 - F.coalesce(F.when(~F.isnan("prob_artifact"), F.col("prob_artifact")), F.lit(0.0))
    with_reads = F.col("prob_present") * 0.5 + F.col("num_split_reads") / most * 0.3 + clean * 0.2
    score = F.when(most > 0, with_reads).otherwise(F.col("prob_present") * 0.7 + clean * 0.3)
    ranked = df.withColumn("score", score)
    order = Window.partitionBy("regions").orderBy(F.desc_nulls_last("score"), "rec_id")
    return ranked.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def circles(df: DataFrame) -> DataFrame:
    """Best rows with ``parts``, their parsed regions, of which there is at least one and none malformed."""
    long = df.where((F.col("circle_length") >= LEAST_LENGTH) & F.col("regions").isNotNull() & F.col("segment_count").isNotNull())
    items = F.filter(F.transform(F.split(F.trim("regions"), "[;,]+"), lambda x: F.trim(x)), lambda x: x != "")
    best = best_of_duplicates(long).withColumn("_items", items)
    best = best.withColumn("_used", F.when(F.col("segment_count") == 1, F.slice("_items", 1, 1)).otherwise(F.col("_items")))
    best = best.withColumn("parts", F.transform("_used", parse_region)).drop("_items", "_used")
    return best.where((F.size("parts") > 0) & F.forall("parts", lambda p: p["chr"].isNotNull() & p["s"].isNotNull() & p["e"].isNotNull()))


def _segments(df: DataFrame) -> DataFrame:
    p = F.col("p")
    return df.withColumns({"chr": p["chr"], "start0": F.least(p["s"], p["e"]) - 1, "end0": F.greatest(p["s"], p["e"]), "strand": F.when(p["s"] <= p["e"], "+").otherwise("-")}).drop("p")


def simple(df: DataFrame) -> DataFrame:
    """eccDNA_id, chr, start0, end0, strand, length, num_split_reads of circles of one segment."""
    rows = numbered(circles(df).where("segment_count = 1"), ["regions"], "_no")
    rows = _segments(rows.withColumn("p", F.col("parts")[0]))
    return rows.select(F.concat(F.lit("IUeccDNA"), F.col("_no")).alias("eccDNA_id"), "chr", "start0", "end0", "strand", F.col("circle_length").alias("length"), "num_split_reads")


def role(index: str, total: str):  # noqa: ANN201
    return F.when(F.col(index) == 1, "head").when(F.col(index) == F.col(total), "tail").otherwise("middle")


def chimeric(df: DataFrame, min_segments: int = 2, min_splits: int = 0) -> DataFrame:
    """One row per segment of circles of several; with a minimum, circles of two segments need ``min_splits`` split reads."""
    rows = numbered(circles(df).where("segment_count <> 1"), ["regions"], "_no").withColumn("seg_total", F.size("parts"))
    if min_segments > 2 or min_splits > 0:
        rows = rows.where((F.col("seg_total") >= min_segments) | ((F.col("seg_total") == 2) & (F.col("num_split_reads") >= min_splits) & F.lit(min_splits > 0)))
    rows = rows.select("*", F.posexplode("parts").alias("_i", "p")).withColumn("seg_index", F.col("_i") + 1)
    return _segments(rows).select(
        F.concat(F.lit("ICeccDNA"), F.col("_no")).alias("eccDNA_id"), "chr", "start0", "end0", "strand", F.col("circle_length").alias("length"),
        "seg_index", "seg_total", role("seg_index", "seg_total").alias("junction_role"), "num_split_reads",
    )
