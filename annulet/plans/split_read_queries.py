"""Split-read inference over the alignments, each query's alignments taken as one read's hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.operators import split_reads as R
from annulet.plans.base import once, once_sql
from annulet.session import cut


def hits(spark: SparkSession, d: str, mapq: int = 30) -> DataFrame:
    rows = once(spark, d, "alignments", "query_id", "subject_id", "alignment_length", "mismatches", "q_start", "q_end", "s_start", "s_end", "sstrand", "mapq")
    rows = rows.where((F.col("mapq") >= mapq) & F.col("query_id").isNotNull())
    return rows.select(
        F.col("query_id").alias("readid"), (F.col("q_start") - 1).alias("q_start"), "q_end", F.col("subject_id").alias("ref"), (F.least("s_start", "s_end") - 1).alias("r_start"), F.greatest("s_start", "s_end").alias("r_end"),
        (F.col("alignment_length") - F.col("mismatches")).alias("match"), F.col("alignment_length").alias("block"), F.col("mapq").cast("int").alias("mapq"), F.when(F.col("sstrand") == "plus", 1).otherwise(-1).alias("strand"),
    )


def f8_mapq_and_contigs(spark: SparkSession, d: str) -> DataFrame:
    rows = hits(spark, d).where(~F.col("ref").isin("chrM", "chrY"))
    return rows.groupBy("ref").agg(F.count("*").alias("hits"))


def g10_trimmed_reads(spark: SparkSession, d: str) -> DataFrame:
    return R.trim(hits(spark, d))


def g9_tandem_reads(spark: SparkSession, d: str) -> DataFrame:
    return R.trim(hits(spark, d)).where("ctc").groupBy("readid").agg(F.count("*").alias("copies"))


def j19_region_hits(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(R.trim(hits(spark, d)))
    return R.annotated(rows, cut(R.regions(rows, 1.0, 200))).select("mergeid", "hit", "n5", "n3", "overlap")


def a31_breakpoint_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(R.trim(hits(spark, d)))
    return R.breakpoint_edges(R.annotated(rows, cut(R.regions(rows, 1.0, 200))), 1)


def q7_split_read_circles(spark: SparkSession, d: str) -> DataFrame:
    return R.circles(hits(spark, d), min_depth=1.0, support=1)


QUERIES = {f.__name__: f for f in (f8_mapq_and_contigs, g10_trimmed_reads, g9_tandem_reads, j19_region_hits, a31_breakpoint_edges, q7_split_read_circles)}
SQL = {"f8_mapq_and_contigs": f"SELECT subject_id AS ref, count(*) AS hits FROM {once_sql('alignments')} WHERE mapq >= 30 AND query_id IS NOT NULL AND subject_id NOT IN ('chrM', 'chrY') GROUP BY 1"}
