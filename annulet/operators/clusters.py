"""Clusters of equal circles: signatures, representatives, merged evidence, and merging within a jitter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators.graph import components
from annulet.operators.unify import segment_matches

# Spellings of a missing string, in lower case.
MISSING = ["", "na", "n/a", "nan", "none", "null", "."]


def present(c: str) -> Column:
    return F.when(~F.lower(F.trim(c)).isin(MISSING), F.trim(c))


def cleaned(df: DataFrame) -> DataFrame:
    """Calls with missing values as null, keyed by cluster in upper case."""
    return df.select(
        "rec_id", F.upper(present("cluster_id")).alias("cluster"), present("eccDNA_id").alias("ecc_id"), present("chr").alias("chr"),
        F.col("start0").cast("bigint").alias("start0"), F.col("end0").cast("bigint").alias("end0"), S.strand(F.col("strand")).alias("strand"),
        F.when(~F.isnan(F.col("length").cast("double")), F.col("length")).cast("bigint").alias("length"), "eccdna_type", present("state").alias("state"), "reads",
        F.when(F.col("copy_number") > 0, F.nanvl("copy_number", F.lit(None).cast("double"))).alias("copies"),
        "mapq_best", F.nanvl("identity_best", F.lit(None).cast("double")).alias("identity_best"), F.nanvl("confidence_score", F.lit(None).cast("double")).alias("confidence"),
    ).where("cluster is not null")


def ring_key(segs: Column, strand_blind: bool = True) -> Column:
    """The least rotation of an array of strings, of both directions if blind to the strand: equal for equal circles."""
    turns = lambda a: F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: F.concat(F.slice(a, i + 1, F.size(a)), F.slice(a, F.lit(1), i)))
    both = F.concat(turns(segs), turns(F.reverse(segs))) if strand_blind else turns(segs)
    return F.array_join(F.array_min(both), ";")


def set_key(segs: DataFrame) -> DataFrame:
    """id, key: the segments sorted by chromosome and place, whatever their order in the circle."""
    row = F.struct("chr", "start0", "end0")
    out = segs.groupBy("id").agg(F.array_sort(F.collect_list(row)).alias("s"))
    return out.select("id", F.array_join(F.transform("s", lambda x: S.region(x["chr"], x["start0"], x["end0"])), ";").alias("key"))


def order_key(segs: DataFrame) -> DataFrame:
    """id, key: the segments in the circle's order, started and read so that equal circles have equal keys."""
    out = segs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seg", S.region(F.col("chr"), F.col("start0"), F.col("end0")).alias("r")))).alias("s"))
    return out.select("id", ring_key(F.transform("s", lambda x: x["r"])).alias("key"))


def representatives(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """The row of each cluster that stands for it: confirmed calls first, then the greatest metric, then tie, then the smallest rec_id."""
    order = Window.partitionBy("cluster").orderBy(F.desc(F.coalesce(F.col("state") == "Confirmed", F.lit(False))), F.desc_nulls_last(metric), F.desc_nulls_last(tie), "rec_id")
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def read_rows(df: DataFrame) -> DataFrame:
    """cluster, read: each distinct read name of a cluster once."""
    names = F.regexp_extract_all("reads", F.lit(r"(m\d+_\d+_\d+_s\d+/\d+/ccs)"), F.lit(1))
    return df.select("cluster", F.explode(names).alias("read")).distinct()


def merged_evidence(df: DataFrame) -> DataFrame:
    """Per cluster: best and worst evidence, distinct calls and copies summed over distinct (call, value), the strand most calls have."""
    best = df.groupBy("cluster").agg(
        F.count("*").alias("size"), F.countDistinct("ecc_id").alias("ids"), F.max("mapq_best").alias("mapq_best"), F.min("mapq_best").alias("mapq_min"),
        F.max("identity_best").alias("identity_best"), F.min("identity_best").alias("identity_min"), F.max("confidence").alias("confidence"),
    )
    copies = df.where("copies is not null and ecc_id is not null").select("cluster", "ecc_id", "copies").distinct().groupBy("cluster").agg(F.sum("copies").alias("copies"))
    votes = df.where("strand is not null").groupBy("cluster", "strand").agg(F.count("*").alias("n"))
    strand = votes.groupBy("cluster").agg(F.max_by("strand", F.struct("n", (F.col("strand") == "+").alias("plus"))).alias("strand"))
    reads = read_rows(df).groupBy("cluster").agg(F.count("*").alias("reads"))
    out = best.join(copies, "cluster", "left").join(strand, "cluster", "left").join(reads, "cluster", "left").na.fill(0, ["reads"])
    return out.withColumn("low_mapq", F.col("mapq_best") < S.LOW_MAPQ).withColumn("low_identity", F.col("identity_best") < S.LOW_IDENTITY)


def jitter_groups(segs: DataFrame, reach: int = 10) -> DataFrame:
    """id, group of circles whose segments, one to one, lie within ``reach`` at both ends, also through other circles.

    Circles meet through matching segments; a pair is linked if both have as many segments and every segment of
    either has a match in the other.
    """
    pairs = segment_matches(segs, segs, share=2.0, tolerance=reach).where("id < match and n = m")
    linked = pairs.groupBy("id", "match", "n").agg(F.countDistinct("i").alias("a"), F.countDistinct("j").alias("b")).where("a = n and b = n")
    ids = segs.select(F.col("id").alias("node")).distinct()
    return components(ids, linked.select(F.col("id").alias("src"), F.col("match").alias("dst"))).select(F.col("node").alias("id"), F.col("component").alias("group"))


def tolerant_distinct(segs: DataFrame, share: float = 0.5, reach: int = 100) -> DataFrame:
    """id, seg of segments kept in the order of (chr, start0): one is dropped if a kept one covers more than a share of either, or has both ends within reach."""
    row = F.struct("chr", "start0", "end0", "seg")
    ordered = segs.groupBy("id").agg(F.array_sort(F.collect_list(row)).alias("s"))

    def like(x: Column, k: Column) -> Column:
        shared = F.least(x["end0"], k["end0"]) - F.greatest(x["start0"], k["start0"])
        near = (F.abs(x["start0"] - k["start0"]) <= reach) & (F.abs(x["end0"] - k["end0"]) <= reach)
        return (x["chr"] == k["chr"]) & (near | (shared > share * (x["end0"] - x["start0"])) | (shared > share * (k["end0"] - k["start0"])))

    kept = F.aggregate("s", F.slice("s", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda k: like(x, k)), acc).otherwise(F.concat(acc, F.array(x))))
    return ordered.select("id", F.explode(kept).alias("k")).select("id", "k.seg")
