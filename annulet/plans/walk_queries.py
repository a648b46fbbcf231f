"""Chimeric detection and tandem reads at their usual thresholds, on reads that go twice round each inferred circle.

The alignments of the test tables hold next to no chimeric rings, so these queries take every complete circle of
``inferred_chimeric`` and lay its segments along a read, once and once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.operators import chimeric as C
from annulet.operators import split_reads as R
from annulet.plans import inferred_queries
from annulet.plans.base import fixed, fixed_sql
from annulet.plans.ring_queries import _BODY, _CONF
from annulet.session import cut


def walks(spark: SparkSession, d: str) -> DataFrame:
    """id, seg, turn, and the alignment (query_id, aln_id, chr, start0, end0, strand, qs, qe, size, identity) of every segment in both turns."""
    segs = inferred_queries.segments(spark, d).where("start0 < end0").withColumn("n", F.col("end0") - F.col("start0"))
    w = Window.partitionBy("id")
    before = F.coalesce(F.sum("n").over(w.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = segs.withColumns({"before": before, "size": F.sum("n").over(w)}).withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    qs = F.col("turn") * F.col("size") + F.col("before")
    return rows.select(
        "id", "seg", "turn", F.concat(F.lit("c"), F.col("id")).alias("query_id"), ((F.col("id") * 2 + F.col("turn")) * 100 + F.col("seg")).alias("aln_id"), "chr", "start0", "end0", "strand",
        qs.alias("qs"), (qs + F.col("n")).alias("qe"), "size", F.lit(99.0).alias("identity"),
    )


def g7_chimeric_of_walks(spark: SparkSession, d: str) -> DataFrame:
    rows = C.detect(walks(spark, d).drop("id", "seg", "turn"))
    return rows.select("query_id", "segment_in_circle", "num_segments", "chr", "start0", "end0", "strand", "cumulative_length", fixed(F.col("match_degree"), 3).alias("match_degree"), fixed(F.col("cov"), 4).alias("cov"), "class", fixed(F.col("confidence"), 4).alias("confidence"))


def g8_doubled_pairs_of_walks(spark: SparkSession, d: str) -> DataFrame:
    return C.doubled_pairs(walks(spark, d).drop("id", "seg", "turn"))


def _hits(spark: SparkSession, d: str) -> DataFrame:
    """The walks as hits of split reads, of circles no two segments of which lie at one place."""
    rows = walks(spark, d)
    one = rows.where("turn = 0")
    a, b = one.select("id", "chr", F.col("seg").alias("i"), F.col("start0").alias("s1"), F.col("end0").alias("e1")), one.select("id", "chr", F.col("seg").alias("j"), F.col("start0").alias("s2"), F.col("end0").alias("e2"))
    twice = a.join(b, ["id", "chr"]).where("i < j and abs(s1 - s2) <= 50 and abs(e1 - e2) <= 50").select("id")
    size = F.col("end0") - F.col("start0")
    return rows.join(twice, "id", "left_anti").select(
        F.col("query_id").alias("readid"), F.col("qs").alias("q_start"), F.col("qe").alias("q_end"), F.col("chr").alias("ref"), F.col("start0").alias("r_start"), F.col("end0").alias("r_end"),
        size.alias("match"), size.alias("block"), F.lit(60).alias("mapq"), F.when(F.col("strand") == "+", 1).otherwise(-1).alias("strand"),
    )


def g9_tandem_reads_of_walks(spark: SparkSession, d: str) -> DataFrame:
    return R.trim(_hits(spark, d)).where("ctc").groupBy("readid").agg(F.count("*").alias("copies"))


def g10_trimmed_walks(spark: SparkSession, d: str) -> DataFrame:
    return R.trim(_hits(spark, d)).select("readid", "q_start", "q_end", "ref", "r_start", "r_end", "strand", "trimmed", "freq", "ord", "ctc")


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(R.trim(_hits(spark, d)))
    return R.annotated(rows, cut(R.regions(rows, 1.0, 200)))


def j19_region_hits_of_walks(spark: SparkSession, d: str) -> DataFrame:
    return _annotated(spark, d).select("mergeid", "hit", "n5", "n3", "overlap")


def a31_breakpoint_edges_of_walks(spark: SparkSession, d: str) -> DataFrame:
    return R.breakpoint_edges(_annotated(spark, d), 1)


QUERIES = {f.__name__: f for f in (g7_chimeric_of_walks, g8_doubled_pairs_of_walks, g9_tandem_reads_of_walks, g10_trimmed_walks, j19_region_hits_of_walks, a31_breakpoint_edges_of_walks)}

_WALKS = f"""{inferred_queries.CHIMERIC_SQL},
w AS (SELECT id, seg, chr, start0, end0, strand, end0 - start0 AS n, coalesce(sum(end0 - start0) OVER (PARTITION BY id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(end0 - start0) OVER (PARTITION BY id) AS size
  FROM seg WHERE start0 < end0),
dbl AS (SELECT id, 'c' || id AS query_id, (id * 2 + p) * 100 + seg AS aln_id, chr, start0, end0, strand, CAST(p * size + before AS BIGINT) AS qs, CAST(p * size + before + n AS BIGINT) AS qe, CAST(size AS BIGINT) AS size, 99.0 AS identity FROM w, (VALUES (0), (1)) AS t(p))"""
_ALL = f"{_WALKS}, {_BODY.split(chr(10), 1)[1]}"
_APART = """ok AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY qs) - 1 AS ord, count(*) OVER (PARTITION BY id) AS hits FROM dbl
  WHERE id NOT IN (SELECT a.id FROM w a JOIN w b ON a.id = b.id AND a.seg < b.seg AND a.chr = b.chr AND abs(a.start0 - b.start0) <= 50 AND abs(a.end0 - b.end0) <= 50))"""
_REGIONS = f"""{_APART},
h AS (SELECT query_id AS readid, ord, query_id || '#' || ord AS hit, chr AS ref, start0, end0, qs, qe, strand FROM ok),
opened AS (SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY ref ORDER BY start0, end0, hit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS open FROM h),
stretch AS (SELECT *, sum(open) OVER (PARTITION BY ref ORDER BY start0, end0, hit ROWS UNBOUNDED PRECEDING) AS k FROM opened),
region AS (SELECT ref || '_' || min(start0) || '_' || max(end0) AS mergeid, ref, min(start0) AS lo, max(end0) AS hi FROM stretch GROUP BY ref, k HAVING max(end0) - min(start0) >= 200),
five AS (SELECT hit, count(*) AS n FROM h JOIN region g ON g.ref = h.ref AND start0 < lo + 50 AND end0 > lo GROUP BY hit),
three AS (SELECT hit, count(*) AS n FROM h JOIN region g ON g.ref = h.ref AND start0 < hi AND end0 > greatest(hi - 50, 0) GROUP BY hit),
pair AS (SELECT h.*, mergeid, coalesce(five.n, 0) AS n5, coalesce(three.n, 0) AS n3, least(end0, hi) - greatest(start0, lo) AS overlap
  FROM h JOIN region g ON g.ref = h.ref AND start0 < hi AND end0 > lo LEFT JOIN five USING (hit) LEFT JOIN three USING (hit))"""

SQL = {
    "j19_region_hits_of_walks": f"WITH {_WALKS}, {_REGIONS} SELECT mergeid, hit, n5, n3, overlap FROM pair",
    "a31_breakpoint_edges_of_walks": f"""WITH {_WALKS}, {_REGIONS}, nx AS (SELECT *, lead(mergeid) OVER w AS m2, lead(qs) OVER w AS qs2, lead(qe) OVER w AS qe2, lead(strand) OVER w AS st2, lead(n5) OVER w AS n52, lead(n3) OVER w AS n32 FROM pair WINDOW w AS (PARTITION BY readid ORDER BY ord, mergeid)),
      on_read AS (SELECT *, max(CASE WHEN qs <= qe2 AND qs2 <= qe + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY readid ORDER BY ord, mergeid ROWS UNBOUNDED PRECEDING) AS stop FROM nx WHERE m2 IS NOT NULL),
      e AS (SELECT CASE WHEN strand = '-' AND st2 = '-' THEN m2 ELSE mergeid END AS src, CASE WHEN strand = '-' AND st2 = '-' THEN mergeid ELSE m2 END AS dst, strand || '_' || st2 AS t FROM on_read WHERE stop = 0
        AND CASE strand || st2 WHEN '++' THEN n3 = 1 AND n52 = 1 WHEN '--' THEN n32 = 1 AND n5 = 1 WHEN '-+' THEN n5 = 1 AND n52 = 1 ELSE n3 = 1 AND n32 = 1 END)
      SELECT src, dst, count(*) AS reads, list_sort(list(DISTINCT t)) AS transitions FROM e GROUP BY src, dst""",
    "g7_chimeric_of_walks": f"""WITH {_ALL} SELECT query_id, place AS segment_in_circle, num_segments, chr, lo AS start0, hi AS end0, locus_strand AS strand, cumulative_length, {fixed_sql('match_degree', 3)} AS match_degree, {fixed_sql('cov', 4)} AS cov,
      CASE WHEN chrs > 1 THEN 'Cecc-InterChr' ELSE 'Cecc-IntraChr' END AS class, {fixed_sql(f"CASE WHEN least({', '.join(_CONF)}) <= 0 THEN 0 ELSE pow({' * '.join(_CONF)}, 0.25) END", 4)} AS confidence
      FROM cyc JOIN whole USING (query_id) JOIN facts USING (query_id) WHERE num_segments >= 2 AND match_degree BETWEEN 95 AND 105""",
    "g8_doubled_pairs_of_walks": f"""WITH {_ALL}, r AS (SELECT dbl.* FROM dbl JOIN facts USING (query_id) WHERE cov >= 0.8) SELECT a.query_id, a.aln_id AS first, b.aln_id AS second FROM r a JOIN r b ON a.query_id = b.query_id AND a.chr = b.chr AND a.strand = b.strand
      AND a.qs < a.size - 50 AND b.qe > b.size + 50 AND abs((a.qs + a.qe) / 2 - (b.qs + b.qe) / 2) >= 100
      AND (least(a.end0, b.end0) > greatest(a.start0, b.start0) OR abs((a.start0 + a.end0) / 2 - (b.start0 + b.end0) / 2) < 50)""",
    "g9_tandem_reads_of_walks": f"WITH {_WALKS}, {_APART} SELECT query_id AS readid, count(*) AS copies FROM ok GROUP BY query_id",
    "g10_trimmed_walks": f"""WITH {_WALKS}, {_APART} SELECT query_id AS readid, qs AS q_start, qe AS q_end, chr AS ref, start0 AS r_start, end0 AS r_end, CASE WHEN strand = '+' THEN 1 ELSE -1 END AS strand,
      2 * size AS trimmed, printf('%.2f', (qe - qs) / (2 * size)) AS freq, CAST(ord AS INTEGER) AS ord, TRUE AS ctc FROM ok""",
}
