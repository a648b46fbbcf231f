"""Queries of the text and training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.llm import best_record, pii, prefix_bpe, ring_join, source_mix, top_n
from annulet.session import table


def _circles(spark: SparkSession, d: str) -> DataFrame:
    return best_record.survivors(table(spark, d, "ecc_core"), "cluster_id", "rec_id", *best_record.circle_bundles())


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _circles(spark, d).where("members > 1")
    return rows.select("cluster_id", F.col("identity.rec").alias("ecc_rec"), F.col("copies.rec").alias("cn_rec"))


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _circles(spark, d)
    fields = [F.col(f"{b.name}.{f}").alias(f) for b in best_record.circle_bundles()[0] for f in b.fields]
    return rows.select("cluster_id", *fields, F.col("place.rec").alias("place_rec"), F.col("support.rec").alias("support_rec"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    tandem = ring_join.ring_pairs(table(spark, d, "tandem").select(F.col("rec_id").alias("id"), F.col("consSeq").alias("seq")))
    circles = ring_join.circle_pairs(table(spark, d, "inferred_chimeric"))
    return tandem.select(F.lit("tandem").alias("src"), "*").unionByName(circles.select(F.lit("inferred_chimeric").alias("src"), "*"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    tandem = ring_join.ring_groups(table(spark, d, "tandem").select(F.col("rec_id").alias("id"), F.col("consSeq").alias("seq")))
    circles = ring_join.circle_groups(table(spark, d, "inferred_chimeric"))
    return tandem.select(F.lit("tandem").alias("src"), "*").unionByName(circles.select(F.lit("inferred_chimeric").alias("src"), "*"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    hits = top_n.latest(table(spark, d, "alignments"), "aln_id", "loaded_at", ["query_id", "bit_score", "identity"])
    return top_n.top_n(hits, "query_id", "bit_score", ["identity"], "aln_id", 3).select("query_id", "aln_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return prefix_bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, d, "mix_targets")
    sizes = source_mix.sized(table(spark, d, "documents"), targets)
    rates = source_mix.rates(sizes, targets)
    return source_mix.mix(sizes, rates), rates


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return source_mix.shares(*_mix(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pii.find(docs, pii.learned(docs, table(spark, d, "person_words")))


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pii.redact(docs, pii.learned(docs, table(spark, d, "person_words")))


QUERIES = {"p2_found": p2_found, "p2_records": p2_records, "p3_found": p3_found, "p3_groups": p3_groups, "p4_found": p4_found, "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_redacted": p9_redacted}

_MISSING = ", ".join(f"'{x}'" for x in best_record.MISSING)
_T = lambda c: f"({c} IS NOT NULL AND lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) NOT IN ({_MISSING}))"
_V = lambda c: f"({c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))"
_STATE = "CASE state WHEN 'Confirmed' THEN 0 WHEN 'Inferred' THEN 1 ELSE 2 END"
_FILLED = " + ".join(
    [f"CAST({_T(c)} AS INT)" for c in ("chr", "strand", "reads")]
    + [f"CAST({_V(c)} AS INT)" for c in ("start0", "end0", "length", "copy_number", "match_degree", "confidence_score", "mapq_best", "identity_best", "query_cov_best")]
)
_SUM = lambda *cs: " + ".join(f"CAST({c} AS INT)" for c in cs)
_KIND = lambda c: f"coalesce(nullif(regexp_extract({c}, '^\\s*I?([UMC])ecc', 1), ''), '?')"
_ST = "CASE state WHEN 'Confirmed' THEN 2 WHEN 'Inferred' THEN 1 ELSE 0 END"
_LATER = "st DESC, updated_at DESC NULLS LAST, rec_id"


def _best(name: str, offered: str, trust: str, ties: str = "") -> str:
    """The candidates of a bundle: the best record of each type, numbered by falling trust; and none of them."""
    order = f"trust DESC, {ties}{_LATER}"
    return f"""{name} AS (SELECT k, rec_id, ek AS kind, trust, row_number() OVER (PARTITION BY k ORDER BY {order}) AS i FROM (SELECT *, CAST(floor({trust}) AS BIGINT) + 20 * st AS trust FROM r WHERE {offered}
  QUALIFY row_number() OVER (PARTITION BY k, ek ORDER BY {order}) = 1) UNION ALL SELECT DISTINCT k, NULL, NULL, 0, 99 FROM r)"""


def _agree(a: str, b: str) -> str:
    return f"({a} IS NULL OR {b} IS NULL OR '?' IN ({a}, {b}) OR {a} = {b})"


_PLACE = [_T("chr"), _V("start0"), _V("end0"), _T("strand"), _V("length")]
_QUALITY = [_V(c) for c in ("match_degree", "confidence_score", "mapq_best", "identity_best", "query_cov_best")]
_RECORDS = f"""
WITH r AS (SELECT *, upper(regexp_replace(cluster_id, '^\\s+|\\s+$', '', 'g')) AS k, {_ST} AS st, {_KIND('eccdna_type')} AS ek, {_FILLED} AS "full" FROM ecc_core WHERE {_T('cluster_id')}
  QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1),
ident AS (SELECT k, eccDNA_id, {_KIND('eccDNA_id')} AS kind FROM r WHERE {_T('eccDNA_id')} QUALIFY row_number() OVER (PARTITION BY k ORDER BY "full" DESC, {_LATER}) = 1),
copies AS (SELECT k, copy_number FROM r WHERE {_V('copy_number')} AND copy_number > 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_LATER}) = 1),
{_best('place', f"({_SUM(*_PLACE[:3])}) > 0 AND coalesce(eccdna_type <> 'Uecc' OR length = end0 - start0, TRUE)", f"({_SUM(*_PLACE)}) * 100 / 5")},
{_best('support', _T('reads'), f"(1 + {_SUM(_T('per_read_copy_number'))}) * 100 / 2", 'read_count DESC NULLS LAST, ')},
{_best('quality', f"({_SUM(*_QUALITY)}) > 0 AND coalesce((mapq_best < 20) = low_mapq, TRUE) AND coalesce((identity_best < 95) = low_identity, TRUE)", f"({_SUM(*_QUALITY)}) * 100 / 5")},
pick AS (SELECT p.k, p.rec_id AS p, s.rec_id AS s, q.rec_id AS q FROM place p JOIN support s ON s.k = p.k JOIN quality q ON q.k = p.k LEFT JOIN ident n ON n.k = p.k
  WHERE {' AND '.join(_agree(f'{a}.kind', f'{b}.kind') for a, b in ('np', 'ns', 'nq', 'ps', 'pq', 'sq'))}
  QUALIFY row_number() OVER (PARTITION BY p.k ORDER BY p.trust + s.trust + q.trust DESC, p.i, s.i, q.i) = 1)
SELECT pick.k AS cluster_id, n.eccDNA_id, c.copy_number, p.chr, p.start0, p.end0, p.strand, p.length, p.eccdna_type, s.reads, s.read_count, s.per_read_copy_number,
  q.match_degree, q.confidence_score, q.mapq_best, q.identity_best, q.query_cov_best, q.query_cov_2nd, q.low_mapq, q.low_identity, coalesce(p.rec_id, 0) AS place_rec, coalesce(s.rec_id, 0) AS support_rec
FROM pick LEFT JOIN ident n ON n.k = pick.k LEFT JOIN copies c ON c.k = pick.k LEFT JOIN r p ON p.rec_id = pick.p LEFT JOIN r s ON s.rec_id = pick.s LEFT JOIN r q ON q.rec_id = pick.q"""

SQL = {
    "p2_records": _RECORDS,
    "p2_found": f"""
WITH r AS (SELECT *, upper(regexp_replace(cluster_id, '^\\s+|\\s+$', '', 'g')) AS k FROM ecc_core WHERE {_T('cluster_id')}
  QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1),
many AS (SELECT k FROM r GROUP BY k HAVING count(*) > 1),
e AS (SELECT k, rec_id FROM r WHERE {_T('eccDNA_id')}
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_FILLED} DESC, {_STATE}, updated_at DESC NULLS LAST, rec_id) = 1),
c AS (SELECT k, rec_id FROM r WHERE {_V('copy_number')} AND copy_number > 0
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_STATE}, updated_at DESC NULLS LAST, rec_id) = 1)
SELECT many.k AS cluster_id, coalesce(e.rec_id, 0) AS ecc_rec, coalesce(c.rec_id, 0) AS cn_rec
FROM many LEFT JOIN e ON e.k = many.k LEFT JOIN c ON c.k = many.k""",
    "p4_found": """
WITH v AS (SELECT aln_id, query_id, bit_score, identity FROM alignments
  QUALIFY row_number() OVER (PARTITION BY aln_id ORDER BY loaded_at DESC) = 1)
SELECT query_id, aln_id FROM v WHERE query_id IS NOT NULL AND bit_score IS NOT NULL AND NOT isnan(bit_score)
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bit_score DESC, identity DESC NULLS LAST, aln_id) <= 3""",
}
