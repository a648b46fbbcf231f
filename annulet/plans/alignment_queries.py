"""Alignment filters, locus clustering, ring coverage and the U / M classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.operators import classify as C
from annulet.plans.base import fixed, fixed_sql, once, once_sql

COLUMNS = ["query_id", "subject_id", "identity", "alignment_length", "q_start", "q_end", "s_start", "s_end", "bit_score", "sstrand", "mapq"]


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "alignments", *COLUMNS)


def _hq(spark: SparkSession, d: str) -> DataFrame:
    return C.prepared(_rows(spark, d)).where("gap_percentage <= 10")


def f3_prepared(spark: SparkSession, d: str) -> DataFrame:
    rows = C.prepared(_rows(spark, d))
    return rows.select("aln_id", "read", "size", fixed(F.col("copies"), 2).alias("copies"), "strand", "start0", "end0", "r_length", "gap_length", fixed(F.col("gap_percentage"), 2).alias("gap_percentage"))


def f4_high_quality(spark: SparkSession, d: str) -> DataFrame:
    return _hq(spark, d).select("aln_id", "query_id")


def f5_query_shape(spark: SparkSession, d: str) -> DataFrame:
    ok = F.size(F.split("query_id", r"\|")) >= 4
    return _rows(spark, d).groupBy(F.coalesce(ok, F.lit(False)).alias("valid")).agg(F.count("*").alias("n"))


def f6_min_length(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).where("alignment_length >= 50").select("aln_id", "alignment_length")


def f7_identity_by_length(spark: SparkSession, d: str) -> DataFrame:
    return C.prepared(_rows(spark, d)).where(C.identity_passes(F.col("identity"), F.col("size"))).select("aln_id")


def a10_coordinate_style(spark: SparkSession, d: str) -> DataFrame:
    hq = _hq(spark, d)
    return hq.limit(1).select(C.zero_based(hq).alias("zero_based"))


def g2_loci(spark: SparkSession, d: str) -> DataFrame:
    return C.with_loci(_hq(spark, d)).select("aln_id", "locus")


def _loci(spark: SparkSession, d: str) -> DataFrame:
    hq = _hq(spark, d)
    return C.loci(C.with_loci(hq), C.zero_based(hq))


def a9_ring_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _loci(spark, d).select("query_id", "locus", fixed(F.col("cov"), 6).alias("cov"))


def a11_locus_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _loci(spark, d).select("query_id", "locus", "mapq_best", "mapq_min", fixed(F.col("id_best"), 3).alias("id_best"), fixed(F.col("id_min"), 3).alias("id_min"), "hits")


def a12_representatives(spark: SparkSession, d: str) -> DataFrame:
    return _loci(spark, d).select("locus", "rep_aln")


def q2_classify(spark: SparkSession, d: str) -> DataFrame:
    out = C.classify(_rows(spark, d))
    return out.select(
        "query_id", "class", fixed(F.col("U_cov"), 6).alias("u_cov"), fixed(F.col("U_cov_2nd"), 6).alias("u_cov_2nd"), F.col("M_count").cast("bigint").alias("m_count"),
        fixed(F.col("conf"), 6).alias("conf"), "best_locus",
    )


def q2_summary(spark: SparkSession, d: str) -> DataFrame:
    out = C.classify(_rows(spark, d)).groupBy("class")
    return out.agg(F.count("*").alias("queries"), fixed(F.avg("conf"), 4).alias("mean_conf"), F.sum(F.when(F.col("mapq_best") < 20, 1).otherwise(0)).alias("low_mapq"), F.sum(F.when(F.col("identity_best") < 95, 1).otherwise(0)).alias("low_identity"))


def j5_unclassified(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    return C.unclassified(rows, C.classify(rows)).select("aln_id", "query_id")


def a39_full_length_repeats(spark: SparkSession, d: str) -> DataFrame:
    full = F.sum(F.when(F.col("r_length") / F.col("size") * 100 >= 95, 1).otherwise(0))
    return C.prepared(_rows(spark, d)).groupBy("query_id").agg((full >= 2).alias("full_length_repeat"))


def a40_identity_gap(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("identity"), "aln_id")
    top = C.prepared(_rows(spark, d)).where("identity is not null").withColumn("rn", F.row_number().over(w)).where("rn <= 2")
    out = top.groupBy("query_id").agg(F.max("identity").alias("a"), F.min("identity").alias("b"), F.count("*").alias("n"))
    return out.select("query_id", F.when(F.col("n") < 2, False).otherwise(F.col("a") - F.col("b") <= 5.0).alias("passes"))


QUERIES = {f.__name__: f for f in (
    f3_prepared, f4_high_quality, f5_query_shape, f6_min_length, f7_identity_by_length, a10_coordinate_style, g2_loci, a9_ring_coverage,
    a11_locus_evidence, a12_representatives, q2_classify, q2_summary, j5_unclassified, a39_full_length_repeats, a40_identity_gap,
)}

_ONCE = once_sql("alignments")
_PREP = f"""prep AS (
  SELECT *, end0 - start0 AS r_length, size - (end0 - start0) AS gap_length, round_even(abs(size - (end0 - start0)) / size * 100 * 100, 0) / 100 AS gap_percentage
  FROM (SELECT *, string_split(query_id, '|')[1] AS read, TRY_CAST(string_split(query_id, '|')[3] AS BIGINT) AS size, TRY_CAST(string_split(query_id, '|')[4] AS DOUBLE) AS copies,
      CASE WHEN sstrand = 'plus' THEN '+' ELSE '-' END AS strand, least(s_start, s_end) - 1 AS start0, greatest(s_start, s_end) AS end0, subject_id AS chr
    FROM {_ONCE} WHERE len(string_split(query_id, '|')) >= 4) WHERE size > 0 AND s_start IS NOT NULL AND s_end IS NOT NULL),
hq AS (SELECT * FROM prep WHERE gap_percentage <= 10)"""
_STYLE = """style AS (SELECT coalesce(median(abs(abs(q_end - q_start) - alignment_length)) + 1e-6 < median(abs(abs(q_end - q_start + 1) - alignment_length)), FALSE) AS zero_based FROM hq)"""
_LOCI = f"""
link AS (SELECT a.aln_id AS x, b.aln_id AS y FROM hq a JOIN hq b ON a.query_id = b.query_id AND a.chr = b.chr AND a.strand = b.strand AND a.aln_id <> b.aln_id
  AND ((abs(a.start0 - b.start0) <= 50 AND abs(a.end0 - b.end0) <= 50)
    OR (least(a.r_length, b.r_length) > 0 AND greatest(0, least(a.end0, b.end0) - greatest(a.start0, b.start0)) >= 0.95 * least(a.r_length, b.r_length)))),
reach AS (SELECT aln_id AS x, aln_id AS y FROM hq UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
located AS (SELECT hq.*, l.locus FROM hq JOIN (SELECT x, min(y) AS locus FROM reach GROUP BY x) l ON l.x = hq.aln_id),
ringed AS (SELECT p.*, CASE WHEN zero_based THEN least(q_start, q_end) ELSE least(q_start, q_end) - 1 END AS qs, greatest(q_start, q_end) AS qe FROM prep p, style),
cut AS (SELECT aln_id, 0 AS s, size AS e FROM ringed WHERE qe > qs AND (qe - qs >= size OR qs % size = qe % size)
  UNION ALL SELECT aln_id, qs % size, qe % size FROM ringed WHERE qe > qs AND qe - qs < size AND qs % size < qe % size
  UNION ALL SELECT aln_id, qs % size, size FROM ringed WHERE qe > qs AND qe - qs < size AND qs % size > qe % size
  UNION ALL SELECT aln_id, 0, qe % size FROM ringed WHERE qe > qs AND qe - qs < size AND qs % size > qe % size AND qe % size > 0),
spans AS (SELECT l.query_id, l.locus, l.size, c.s, c.e, max(c.e) OVER (PARTITION BY l.locus ORDER BY c.s, c.e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM located l JOIN cut c USING (aln_id)),
covs AS (SELECT query_id, locus, sum(greatest(0, e - greatest(s, coalesce(before, s)))) / max(size) AS cov FROM spans GROUP BY query_id, locus),
loci AS (SELECT query_id, locus, max(cov) AS cov, coalesce(max(mapq), 0) AS mapq_best, coalesce(min(mapq), 0) AS mapq_min, coalesce(max(identity), 0) AS id_best, coalesce(min(identity), 0) AS id_min,
  min(start0) AS lo, max(end0) AS hi, max(size) AS size, any_value(chr) AS chr, count(*) AS hits, arg_max(aln_id, alignment_length * 100000000000 - aln_id) AS rep_aln FROM located JOIN covs USING (query_id, locus) GROUP BY query_id, locus)"""
_GM = lambda *t: f"CASE WHEN least({', '.join(t)}) <= 0 THEN 0 ELSE pow({' * '.join(t)}, 0.25) END"
_C01 = lambda x: f"greatest(0, least(1, {x}))"
_DECIDE = f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cov DESC, locus) AS rn FROM loci),
q AS (SELECT a.query_id, a.cov AS cov1, coalesce(b.cov, 0) AS cov2, a.mapq_best AS mapq1, coalesce(b.mapq_best, 0) AS mapq2, a.id_best AS id1, coalesce(b.id_best, 0) AS id2,
  a.lo, a.hi, a.size, a.chr, a.locus, m.m_count, m.ids FROM ranked a LEFT JOIN ranked b ON b.query_id = a.query_id AND b.rn = 2
  JOIN (SELECT query_id, count(*) FILTER (cov >= 0.95) AS m_count, list(id_best ORDER BY id_best DESC) FILTER (cov >= 0.95) AS ids FROM loci GROUP BY query_id) m ON m.query_id = a.query_id WHERE a.rn = 1),
u AS (SELECT *, m_count < 2 AND cov1 >= 0.95 AND cov2 <= 0.05 AS maybe_u, (hi - lo) / size < 0.95 AS low FROM q),
away AS (SELECT p.query_id, p.size, c.s, c.e, max(c.e) OVER (PARTITION BY p.query_id ORDER BY c.s, c.e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM prep p JOIN u ON u.query_id = p.query_id AND u.maybe_u AND NOT u.low JOIN cut c ON c.aln_id = p.aln_id WHERE p.chr <> u.chr OR p.end0 < u.lo - 1000 OR p.start0 > u.hi + 1000),
second AS (SELECT query_id, sum(greatest(0, e - greatest(s, coalesce(before, s)))) / max(size) AS second FROM away GROUP BY query_id),
judged AS (SELECT u.*, coalesce(second, 0) AS second, (CASE WHEN cov1 >= 0.98 THEN 2.0 ELSE 1.0 END * CASE WHEN mapq1 >= 50 THEN 1.5 ELSE 1.0 END) AS ease FROM u LEFT JOIN second USING (query_id)),
decided AS (SELECT *, CASE WHEN m_count >= 2 THEN CASE WHEN coalesce(ids[1] - ids[2] > 1.0, FALSE) THEN 'vetoed' ELSE 'Mecc' END
    WHEN maybe_u AND NOT low THEN CASE WHEN (second >= ease * 0.01 OR second * size >= ease * 50) AND NOT (cov1 > 0 AND second / cov1 < 0.05) THEN 'vetoed' ELSE 'Uecc' END
    WHEN maybe_u THEN 'vetoed' ELSE 'none' END AS class FROM judged),
final AS (SELECT *, CASE class WHEN 'Mecc' THEN {_GM(_C01('greatest(mapq1, mapq2) / 60.0'), _C01('(greatest(id1, id2) - 90.0) / 10.0'), _C01('cov1'), _C01('cov2'))}
  WHEN 'Uecc' THEN {_GM(_C01('mapq1 / 60.0'), _C01('(id1 - 90.0) / 10.0'), _C01('cov1'), _C01('1.0 - cov2 / 0.05'))} END AS conf FROM decided)"""
_ALL = f"WITH RECURSIVE {_PREP}, {_STYLE}, {_LOCI}"

SQL = {
    "f3_prepared": f"WITH {_PREP} SELECT aln_id, read, size, {fixed_sql('copies', 2)} AS copies, strand, start0, end0, r_length, gap_length, {fixed_sql('gap_percentage', 2)} AS gap_percentage FROM prep",
    "f4_high_quality": f"WITH {_PREP} SELECT aln_id, query_id FROM hq",
    "f5_query_shape": f"SELECT coalesce(len(string_split(query_id, '|')) >= 4, FALSE) AS valid, count(*) AS n FROM {_ONCE} GROUP BY 1",
    "f6_min_length": f"SELECT aln_id, alignment_length FROM {_ONCE} WHERE alignment_length >= 50",
    "f7_identity_by_length": f"WITH {_PREP} SELECT aln_id FROM prep WHERE identity >= greatest(99.0 - size / 10000.0 * 0.5, 97.0)",
    "a10_coordinate_style": f"WITH {_PREP}, {_STYLE} SELECT zero_based FROM style",
    "g2_loci": f"{_ALL} SELECT aln_id, locus FROM located",
    "a9_ring_coverage": f"{_ALL} SELECT query_id, locus, {fixed_sql('cov', 6)} AS cov FROM loci",
    "a11_locus_evidence": f"{_ALL} SELECT query_id, locus, mapq_best, mapq_min, {fixed_sql('id_best', 3)} AS id_best, {fixed_sql('id_min', 3)} AS id_min, hits FROM loci",
    "a12_representatives": f"{_ALL} SELECT locus, rep_aln FROM loci",
    "q2_classify": f"{_ALL}, {_DECIDE} SELECT query_id, class, {fixed_sql('cov1', 6)} AS u_cov, {fixed_sql('cov2', 6)} AS u_cov_2nd, m_count, {fixed_sql('conf', 6)} AS conf, locus AS best_locus FROM final",
    "q2_summary": f"""{_ALL}, {_DECIDE} SELECT class, count(*) AS queries, {fixed_sql('avg(conf)', 4)} AS mean_conf,
      CAST(sum(CASE WHEN (CASE WHEN m_count >= 2 THEN greatest(mapq1, mapq2) ELSE mapq1 END) < 20 THEN 1 ELSE 0 END) AS BIGINT) AS low_mapq,
      CAST(sum(CASE WHEN (CASE WHEN m_count >= 2 THEN greatest(id1, id2) ELSE id1 END) < 95 THEN 1 ELSE 0 END) AS BIGINT) AS low_identity FROM final GROUP BY class""",
    "j5_unclassified": f"{_ALL}, {_DECIDE} SELECT aln_id, query_id FROM prep WHERE query_id NOT IN (SELECT query_id FROM final WHERE class IN ('Uecc', 'Mecc'))",
    "a39_full_length_repeats": f"WITH {_PREP} SELECT query_id, count(*) FILTER (r_length / size * 100 >= 95) >= 2 AS full_length_repeat FROM prep GROUP BY query_id",
    "a40_identity_gap": f"""WITH {_PREP}, t AS (SELECT query_id, identity FROM prep WHERE identity IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY identity DESC, aln_id) <= 2)
      SELECT query_id, CASE WHEN count(*) < 2 THEN FALSE ELSE max(identity) - min(identity) <= 5.0 END AS passes FROM t GROUP BY query_id""",
}
