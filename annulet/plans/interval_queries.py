"""Interval operators over inferred circles (of all samples together) and split-read regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.operators import intervals as I
from annulet.operators.interval_sweep import chromosome
from annulet.plans.base import fixed, fixed_sql, once, once_sql


def simple_circles(spark: SparkSession, d: str) -> DataFrame:
    """id, sample, chr, start0, end0 of usable inferred circles; ends in the right order."""
    rows = once(spark, d, "inferred_simple", "sample", "chr", "start0", "end0", "num_split_reads", "copy_number")
    rows = rows.select(
        F.regexp_extract("eccDNA_id", r"(\d+)$", 1).cast("bigint").alias("id"), "sample", chromosome(F.col("chr")).alias("chr"),
        F.least("start0", "end0").cast("bigint").alias("start0"), F.greatest("start0", "end0").cast("bigint").alias("end0"), "num_split_reads", "copy_number",
        F.col("start0").isNotNull().alias("_a"), F.col("end0").isNotNull().alias("_b"),
    )
    return rows.where("_a and _b and start0 < end0 and chr is not null").drop("_a", "_b")


SIMPLE_SQL = f"""iv AS (SELECT CAST(regexp_extract(eccDNA_id, '([0-9]+)$', 1) AS BIGINT) AS id, sample, 'chr' || regexp_replace(upper(trim(chr)), '^CHR', '') AS chr,
  CAST(least(start0, end0) AS BIGINT) AS start0, CAST(greatest(start0, end0) AS BIGINT) AS end0, num_split_reads, copy_number
  FROM {once_sql('inferred_simple')} WHERE chr IS NOT NULL AND trim(chr) <> '' AND start0 IS NOT NULL AND end0 IS NOT NULL AND start0 <> end0)"""


def a29_interval_merge(spark: SparkSession, d: str) -> DataFrame:
    return I.merge(simple_circles(spark, d).select("id", "chr", "start0", "end0"), ["chr"], "start0", "end0")


def w10_merge_within_500(spark: SparkSession, d: str) -> DataFrame:
    rows = simple_circles(spark, d).where("sample is not null").select("id", "sample", "chr", "start0", "end0")
    return I.merge(rows, ["sample", "chr"], "start0", "end0", slack=500)


def a28_depth(spark: SparkSession, d: str) -> DataFrame:
    return I.depth(simple_circles(spark, d).where("sample is not null").select("sample", "chr", "start0", "end0"), ["sample", "chr"], "start0", "end0")


def f9_depth_and_size(spark: SparkSession, d: str) -> DataFrame:
    depth = I.depth(simple_circles(spark, d).where("sample is not null").select("sample", "chr", "start0", "end0"), ["sample", "chr"], "start0", "end0")
    return depth.where("depth >= 2 and end0 - start0 >= 200")


def _regions(rows: DataFrame) -> DataFrame:
    return I.merge(rows, ["sample", "chr"], "start0", "end0").select("sample", "chr", F.col("start0").alias("lo"), F.col("end0").alias("hi"))


def a30_region_summary(spark: SparkSession, d: str) -> DataFrame:
    """Merged regions with the mean depth of their stretches of depth 2 or more."""
    rows = simple_circles(spark, d).where("sample is not null").select("id", "sample", "chr", "start0", "end0")
    regions = _regions(rows)
    deep = I.depth(rows, ["sample", "chr"], "start0", "end0").where("depth >= 2")
    hits = I.overlap_join(deep, regions, ["sample", "chr"], ("start0", "end0"), ("lo", "hi"))
    return hits.groupBy("sample", "chr", "lo", "hi").agg(F.min("start0").alias("bg_start"), F.max("end0").alias("bg_end"), fixed(F.avg("depth"), 3).alias("mean_depth"))


def j18_region_by_depth(spark: SparkSession, d: str) -> DataFrame:
    rows = simple_circles(spark, d).where("sample is not null").select("id", "sample", "chr", "start0", "end0")
    regions = _regions(rows)
    return I.overlap_join(I.depth(rows, ["sample", "chr"], "start0", "end0"), regions, ["sample", "chr"], ("start0", "end0"), ("lo", "hi"))


def j20_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """For each circle, how many 50-base windows at starts of circles of its sample it overlaps."""
    rows = simple_circles(spark, d).where("sample is not null").select("id", "sample", "chr", "start0", "end0")
    windows = rows.select("sample", "chr", F.col("start0").alias("w0"), (F.col("start0") + 50).alias("w1"))
    return I.count_overlaps(rows, windows, ["sample", "chr"], "id", ("start0", "end0"), ("w0", "w1"), "windows").select("id", "windows")


def x20_reciprocal_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Circles and those of a second caller, whose ends lie up to 44 and 36 bases off, that describe the same place."""
    rows = simple_circles(spark, d).where("sample is not null")
    a = rows.select("chr", F.col("id").alias("id_a"), F.col("start0").alias("s1"), F.col("end0").alias("e1"))
    b = rows.select("chr", F.col("id").alias("id_b"), (F.col("start0") + F.col("id") % 45).alias("s2"), (F.col("end0") + F.col("id") % 37).alias("e2")).where("s2 < e2")
    return I.reciprocal_join(a, b, ["chr"], ("s1", "e1"), ("s2", "e2")).select("id_a", "id_b")


def a43_best_per_component(spark: SparkSession, d: str) -> DataFrame:
    """Closed overlap components per chromosome, each represented by the member with most split reads."""
    rows = simple_circles(spark, d).select("chr", "id", "start0", "end0", "num_split_reads")
    parts = I.merge(rows, ["chr"], "start0", "end0").select("chr", F.col("start0").alias("lo"), F.col("end0").alias("hi"))
    points = rows.select("chr", "id", "num_split_reads", F.col("start0").alias("p0"), (F.col("start0") + 1).alias("p1"))
    best = I.overlap_join(parts, points, ["chr"], ("lo", "hi"), ("p0", "p1"), tile=1 << 18).groupBy("chr", "lo").agg(F.max(F.struct("num_split_reads", (-F.col("id")).alias("m"))).alias("b"))
    return best.select("chr", (-F.col("b.m")).alias("id"))


QUERIES = {f.__name__: f for f in (
    a29_interval_merge, w10_merge_within_500, a28_depth, f9_depth_and_size, a30_region_summary, j18_region_by_depth, j20_window_counts, x20_reciprocal_pairs, a43_best_per_component,
)}


def _islands(keys: str, slack: int = 0, where: str = "TRUE") -> str:
    return f"""opened AS (SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY {keys} ORDER BY start0, end0, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {slack} THEN 0 ELSE 1 END AS open FROM iv WHERE {where}),
numbered AS (SELECT *, sum(open) OVER (PARTITION BY {keys} ORDER BY start0, end0, id ROWS UNBOUNDED PRECEDING) AS island FROM opened)"""


_DEPTH = """ends AS (SELECT sample, chr, start0 AS p, 1 AS d FROM iv WHERE sample IS NOT NULL UNION ALL SELECT sample, chr, end0, -1 FROM iv WHERE sample IS NOT NULL),
steps AS (SELECT sample, chr, p, sum(d) AS d FROM ends GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT sample, chr, p AS start0, lead(p) OVER (PARTITION BY sample, chr ORDER BY p) AS end0, CAST(sum(d) OVER (PARTITION BY sample, chr ORDER BY p) AS BIGINT) AS depth FROM steps),
bg AS (SELECT * FROM runs WHERE depth > 0 AND end0 IS NOT NULL)"""
_BYS = _islands("sample, chr", 0, "sample IS NOT NULL")
_REGIONS = "regions AS (SELECT sample, chr, min(start0) AS lo, max(end0) AS hi FROM numbered GROUP BY sample, chr, island)"

SQL = {
    "a29_interval_merge": f"WITH {SIMPLE_SQL}, {_islands('chr')} SELECT chr, min(start0) AS start0, max(end0) AS end0, count(*) AS members FROM numbered GROUP BY chr, island",
    "w10_merge_within_500": f"WITH {SIMPLE_SQL}, {_islands('sample, chr', 500, 'sample IS NOT NULL')} SELECT sample, chr, min(start0) AS start0, max(end0) AS end0, count(*) AS members FROM numbered GROUP BY sample, chr, island",
    "a28_depth": f"WITH {SIMPLE_SQL}, {_DEPTH} SELECT sample, chr, start0, end0, depth FROM bg",
    "f9_depth_and_size": f"WITH {SIMPLE_SQL}, {_DEPTH} SELECT sample, chr, start0, end0, depth FROM bg WHERE depth >= 2 AND end0 - start0 >= 200",
    "a30_region_summary": f"""WITH {SIMPLE_SQL}, {_DEPTH}, {_BYS}, {_REGIONS} SELECT r.sample, r.chr, lo, hi, min(start0) AS bg_start, max(end0) AS bg_end, {fixed_sql('avg(depth)', 3)} AS mean_depth
      FROM regions r JOIN bg ON bg.sample = r.sample AND bg.chr = r.chr AND start0 < hi AND lo < end0 AND depth >= 2 GROUP BY r.sample, r.chr, lo, hi""",
    "j18_region_by_depth": f"""WITH {SIMPLE_SQL}, {_DEPTH}, {_BYS}, {_REGIONS} SELECT r.sample, r.chr, lo, hi, start0, end0, depth, least(end0, hi) - greatest(start0, lo) AS overlap
      FROM regions r JOIN bg ON bg.sample = r.sample AND bg.chr = r.chr AND start0 < hi AND lo < end0""",
    "j20_window_counts": f"""WITH {SIMPLE_SQL} SELECT a.id, count(b.id) AS windows FROM iv a LEFT JOIN iv b ON a.sample = b.sample AND a.chr = b.chr AND b.start0 < a.end0 AND a.start0 < b.start0 + 50 WHERE a.sample IS NOT NULL GROUP BY a.id""",
    "x20_reciprocal_pairs": f"""WITH {SIMPLE_SQL}, a AS (SELECT * FROM iv WHERE sample IS NOT NULL), b AS (SELECT id, chr, start0 + id % 45 AS start0, end0 + id % 37 AS end0 FROM a WHERE start0 + id % 45 < end0 + id % 37)
      SELECT a.id AS id_a, b.id AS id_b FROM a JOIN b ON a.chr = b.chr AND a.start0 < b.end0 AND b.start0 < a.end0
      AND ((abs(a.start0 - b.start0) <= 20 AND abs(a.end0 - b.end0) <= 20) OR ((least(a.end0, b.end0) - greatest(a.start0, b.start0)) / (a.end0 - a.start0) >= 0.99 AND (least(a.end0, b.end0) - greatest(a.start0, b.start0)) / (b.end0 - b.start0) >= 0.99))""",
    "a43_best_per_component": f"WITH {SIMPLE_SQL}, {_islands('chr')} SELECT chr, arg_max(id, CAST(num_split_reads AS DOUBLE) * 1e12 - id) AS id FROM numbered GROUP BY chr, island",
}
