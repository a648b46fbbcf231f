"""Tandem repeats of reads: filters, overlap components, consistency, classes and rings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import tandem as T
from annulet.plans.base import fixed, fixed_sql, once, once_sql

COLUMNS = ["readName", "repN", "copyNum", "readLen", "start", "end", "consLen", "aveMatch", "consSeq"]


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "tandem", *COLUMNS)


def _complex(spark: SparkSession, d: str) -> DataFrame:
    return T.keep_longest(T.with_counts(T.good(_rows(spark, d))).where("regions > 1"))


def f1_quality(spark: SparkSession, d: str) -> DataFrame:
    return T.good(_rows(spark, d)).select("rec_id", "aveMatch")


def f2_effective_length(spark: SparkSession, d: str) -> DataFrame:
    return T.good(_rows(spark, d)).select("rec_id", fixed(F.col("eff")).alias("eff"))


def a2_read_complexity(spark: SparkSession, d: str) -> DataFrame:
    rows = T.with_counts(T.good(_rows(spark, d)))
    return rows.groupBy(F.when(F.col("regions") == 1, "simple").otherwise("complex").alias("kind")).agg(F.count("*").alias("repeats"), F.countDistinct("readName").alias("reads"))


def a3_keep_longest(spark: SparkSession, d: str) -> DataFrame:
    return _complex(spark, d).select("rec_id")


def a4_total_effective_length(spark: SparkSession, d: str) -> DataFrame:
    return _complex(spark, d).groupBy("readName").agg(fixed(F.sum("eff"), 3).alias("total_eff"))


def a5_consistency(spark: SparkSession, d: str) -> DataFrame:
    c = T.consistency(_complex(spark, d))
    return c.select("readName", "num_regions", fixed(F.col("mean_len"), 3).alias("mean_len"), fixed(F.col("cv"), 3).alias("cv"), "min_len", "max_len", "consistency")


def a7_simple_classes(spark: SparkSession, d: str) -> DataFrame:
    rows = T.with_counts(T.good(_rows(spark, d))).where("regions = 1")
    return rows.select("rec_id", T.simple_class(F.col("eff")).alias("class"))


def q1_rings(spark: SparkSession, d: str) -> DataFrame:
    return T.rings(_rows(spark, d)).select("rec_id", "ring_id", "class", fixed(F.col("eff"), 3).alias("eff"), "copyNum")


def a8_read_classes(spark: SparkSession, d: str) -> DataFrame:
    return T.read_classes(T.rings(_rows(spark, d)))


def a27_read_class_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Reads per class, in per cent of circular ones and of all reads of the table."""
    rows = _rows(spark, d)
    classes = T.read_classes(T.rings(rows))
    total = rows.agg(F.countDistinct("readName")).scalar()
    ctcr = classes.where("readClass <> 'Other'").agg(F.count("*")).scalar()
    out = classes.groupBy("readClass").agg(F.count("*").alias("reads"))
    share = F.when(F.col("readClass") != "Other", fixed(F.col("reads") / F.nullif(ctcr, F.lit(0)) * 100, 1))
    return out.select("readClass", "reads", share.alias("of_circular"), fixed(F.col("reads") / F.nullif(total, F.lit(0)) * 100, 1).alias("of_all"))


def x9_circularised(spark: SparkSession, d: str) -> DataFrame:
    rings = T.rings(_rows(spark, d)).where("consSeq is not null")
    return rings.select(F.concat("ring_id", F.lit("|circular")).alias("id"), S.circularised(F.col("consSeq")).alias("seq"))


def f16_circular_reads(spark: SparkSession, d: str) -> DataFrame:
    classes = T.read_classes(T.rings(_rows(spark, d)))
    return classes.where(F.col("readClass").isin(*T.CLASSES[:3])).select("readName")


def j8_sieved_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads that are not circular: an anti-join on the read name."""
    rows = _rows(spark, d)
    circular = T.read_classes(T.rings(rows)).where(F.col("readClass").isin(*T.CLASSES[:3]))
    return rows.select("readName").distinct().join(circular, "readName", "left_anti")


def a42_sieve_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    classes = T.read_classes(T.rings(rows)).where(F.col("readClass").isin(*T.CLASSES[:3])).withColumn("drop", F.lit(1))
    reads = rows.select("readName").distinct().join(classes, "readName", "left")
    out = reads.agg(F.count("*").alias("total"), F.count("drop").alias("filtered"))
    return out.select("total", "filtered", (F.col("total") - F.col("filtered")).alias("retained"), fixed(F.coalesce(F.col("filtered") / F.nullif("total", F.lit(0)) * 100, F.lit(0.0)), 2).alias("filtered_percent"))


QUERIES = {f.__name__: f for f in (
    f1_quality, f2_effective_length, a2_read_complexity, a3_keep_longest, a4_total_effective_length, a5_consistency, a7_simple_classes, q1_rings,
    a8_read_classes, a27_read_class_statistics, x9_circularised, f16_circular_reads, j8_sieved_reads, a42_sieve_statistics,
)}

_TAN = once_sql("tandem")
_BASE = f"""good AS (SELECT *, ("end" - start + 1) / readLen * 100 AS eff FROM {_TAN} WHERE aveMatch >= 99 AND NOT isnan(aveMatch)),
counted AS (SELECT *, count(*) OVER (PARTITION BY readName) AS regions FROM good),
marked AS (SELECT *, CASE WHEN "end" - start + 1 <= 50 THEN rec_id ELSE 0 END AS short FROM counted WHERE regions > 1),
opened AS (SELECT *, CASE WHEN coalesce(max("end") OVER (PARTITION BY readName, short ORDER BY start, "end", rec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - start + 1, 0) <= 50 THEN 1 ELSE 0 END AS open FROM marked),
numbered AS (SELECT *, sum(open) OVER (PARTITION BY readName, short ORDER BY start, "end", rec_id ROWS UNBOUNDED PRECEDING) AS part FROM opened),
kept AS (SELECT * FROM numbered QUALIFY row_number() OVER (PARTITION BY readName, short, part ORDER BY eff DESC, rec_id) = 1)"""
_CONS = """stats AS (SELECT readName, count(*) AS num_regions, avg(consLen) AS mean_len, CASE WHEN avg(consLen) > 0 THEN stddev_pop(consLen) / avg(consLen) * 100 ELSE 0 END AS cv, min(consLen) AS min_len, max(consLen) AS max_len FROM kept GROUP BY readName),
multiples AS (SELECT readName, bool_and(abs(consLen / min_len - round_even(consLen / min_len, 0)) <= 0.05) AND min(min_len) > 0 AS whole FROM kept JOIN stats USING (readName) GROUP BY readName),
cons AS (SELECT *, CASE WHEN cv < 1 THEN 'highly_consistent' WHEN cv < 5 THEN 'consistent' WHEN whole THEN 'integer_multiple' ELSE 'variable' END AS consistency FROM stats JOIN multiples USING (readName))"""
_SIMPLE = "CASE WHEN eff >= 99 THEN 'CtcR-perfect' WHEN eff >= 70 THEN 'CtcR-hybrid' ELSE 'Other' END"
_RINGS = f"""{_BASE}, {_CONS},
joined AS (SELECT kept.*, num_regions, consistency, num_regions > 1 AND consistency = 'highly_consistent' AS merged, row_number() OVER (PARTITION BY readName ORDER BY start, "end", rec_id) AS nth,
  sum(eff) OVER (PARTITION BY readName) AS all_eff, sum(copyNum) OVER (PARTITION BY readName) AS all_copies FROM kept JOIN cons USING (readName)),
both_kinds AS (SELECT rec_id, readName, repN, consLen, copyNum, eff, {_SIMPLE} AS class, consSeq FROM counted WHERE regions = 1
  UNION ALL SELECT rec_id, readName, repN, consLen, CASE WHEN merged THEN all_copies ELSE copyNum END, CASE WHEN merged THEN all_eff ELSE eff END,
    CASE WHEN merged THEN CASE WHEN all_eff >= 70 THEN 'CtcR-inversion' ELSE 'Other' END WHEN num_regions = 1 THEN {_SIMPLE} ELSE 'CtcR-hybrid' END, consSeq FROM joined WHERE NOT merged OR nth = 1),
rings AS (SELECT rec_id, readName, repN, consLen, eff, class, consSeq, CAST(round_even(copyNum, 0) AS BIGINT) AS copyNum, concat_ws('|', readName, repN, CAST(consLen AS VARCHAR), CAST(CAST(round_even(copyNum, 0) AS BIGINT) AS VARCHAR)) AS ring_id FROM both_kinds),
classes AS (SELECT readName, arg_min(class, list_position(['CtcR-perfect', 'CtcR-hybrid', 'CtcR-inversion', 'Other'], class)) AS readClass FROM rings GROUP BY readName)"""

SQL = {
    "f1_quality": f"WITH {_BASE} SELECT rec_id, aveMatch FROM good",
    "f2_effective_length": f"WITH {_BASE} SELECT rec_id, {fixed_sql('eff')} AS eff FROM good",
    "a2_read_complexity": f"WITH {_BASE} SELECT CASE WHEN regions = 1 THEN 'simple' ELSE 'complex' END AS kind, count(*) AS repeats, count(DISTINCT readName) AS reads FROM counted GROUP BY 1",
    "a3_keep_longest": f"WITH {_BASE} SELECT rec_id FROM kept",
    "a4_total_effective_length": f"WITH {_BASE} SELECT readName, {fixed_sql('sum(eff)', 3)} AS total_eff FROM kept GROUP BY readName",
    "a5_consistency": f"WITH {_BASE}, {_CONS} SELECT readName, num_regions, {fixed_sql('mean_len', 3)} AS mean_len, {fixed_sql('cv', 3)} AS cv, min_len, max_len, consistency FROM cons",
    "a7_simple_classes": f"WITH {_BASE} SELECT rec_id, {_SIMPLE} AS class FROM counted WHERE regions = 1",
    "q1_rings": f"WITH {_RINGS} SELECT rec_id, ring_id, class, {fixed_sql('eff', 3)} AS eff, copyNum FROM rings",
    "a8_read_classes": f"WITH {_RINGS} SELECT readName, readClass FROM classes",
    "a27_read_class_statistics": f"""WITH {_RINGS}, t AS (SELECT count(DISTINCT readName) AS n FROM {_TAN}), c AS (SELECT count(*) AS n FROM classes WHERE readClass <> 'Other')
      SELECT readClass, count(*) AS reads, CASE WHEN readClass <> 'Other' THEN {fixed_sql('count(*) / any_value(c.n) * 100', 1)} END AS of_circular, {fixed_sql('count(*) / any_value(t.n) * 100', 1)} AS of_all FROM classes, t, c GROUP BY readClass""",
    "x9_circularised": f"WITH {_RINGS} SELECT ring_id || '|circular' AS id, consSeq || consSeq AS seq FROM rings WHERE consSeq IS NOT NULL",
    "f16_circular_reads": f"WITH {_RINGS} SELECT readName FROM classes WHERE readClass <> 'Other'",
    "j8_sieved_reads": f"WITH {_RINGS} SELECT DISTINCT readName FROM {_TAN} WHERE readName NOT IN (SELECT readName FROM classes WHERE readClass <> 'Other')",
    "a42_sieve_statistics": f"""WITH {_RINGS}, n AS (SELECT count(DISTINCT readName) AS total FROM {_TAN}), f AS (SELECT count(*) AS filtered FROM classes WHERE readClass <> 'Other')
      SELECT total, filtered, total - filtered AS retained, {fixed_sql('CASE WHEN total > 0 THEN filtered / total * 100 ELSE 0 END', 2)} AS filtered_percent FROM n, f""",
}
