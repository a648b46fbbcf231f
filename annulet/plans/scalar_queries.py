"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions import rings, scalars as S
from annulet.operators import alignment_text as T
from annulet.operators.clusters import cleaned, present
from annulet.plans.base import fixed, fixed_sql, once, once_sql
from annulet.plans.inferred_queries import CHIMERIC_SQL, segments


def _aln(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return once(spark, d, "alignments", *columns)


def x1_evidence_norms(spark: SparkSession, d: str) -> DataFrame:
    rows = _aln(spark, d, "identity", "mapq")
    return rows.select("aln_id", fixed(S.norm_mapq(F.col("mapq")), 6).alias("mapq"), fixed(S.norm_identity(F.col("identity")), 6).alias("identity"), fixed(S.as_fraction(F.col("identity")), 6).alias("fraction"))


def a13_confidence(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "ecc_core", "mapq_best", "identity_best", "query_cov_best", "query_cov_2nd")
    conf = S.geometric_mean(S.norm_mapq(F.col("mapq_best")), S.norm_identity(F.nanvl("identity_best", F.lit(None))), F.nanvl("query_cov_best", F.lit(None)), F.nanvl("query_cov_2nd", F.lit(None)))
    return rows.select("rec_id", fixed(conf, 6).alias("confidence"))


def x2_match_degree(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "ecc_core", "match_degree")
    return rows.select("rec_id", fixed(S.clamp(F.nanvl("match_degree", F.lit(None)), 0.0, 100.0), 2).alias("match_degree"))


def f15_match_degree_band(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "ecc_core", "match_degree").where("match_degree between 95 and 105 and not isnan(match_degree)").select("rec_id")


def x4_ring_projection(spark: SparkSession, d: str) -> DataFrame:
    rows = _aln(spark, d, "query_id", "q_start", "q_end").withColumn("size", S.to_bigint(F.split("query_id", r"\|")[2])).where("size > 0")
    q = S.query_interval(F.col("q_start"), F.col("q_end"), F.lit(False))
    rows = rows.withColumn("q", q).withColumn("p", F.explode(S.ring_projection(F.col("q.s"), F.col("q.e"), F.col("size"))))
    return rows.select("aln_id", F.col("p.s").alias("s"), F.col("p.e").alias("e"))


def x5_ring_substring(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "tandem", "consSeq", "start", "consLen").where("consSeq is not null")
    at = F.pmod(F.col("start"), F.col("consLen")) + 1
    return rows.select("rec_id", S.ring_substring(F.col("consSeq"), at, F.col("consLen")).alias("seq"))


def x6_reverse_complement(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "tandem", "consSeq").where("consSeq is not null").select("rec_id", S.reverse_complement(F.col("consSeq")).alias("seq"))


def x7_least_rotation(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "tandem", "consSeq").where("consSeq is not null").select("rec_id", rings.rotated(F.upper("consSeq")).alias("seq"))


def x8_canonical_ring(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "tandem", "consSeq").where("consSeq is not null").select("rec_id", rings.canonical(F.col("consSeq")).alias("seq"))


def x10_ring_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "tandem", "readName", "repN", "consLen", "copyNum").where("copyNum is not null")
    return rows.select("rec_id", S.ring_id(F.col("readName"), F.col("repN"), F.col("consLen"), F.col("copyNum")).alias("id"))


def x11_regions(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "split_overview", "regions").select("rec_id", S.parse_region(F.split("regions", "[;,]")[0]).alias("r")).where("r.chr is not null")
    return rows.select("rec_id", F.col("r.chr").alias("chr"), F.col("r.s").alias("s"), F.col("r.e").alias("e"), S.region(F.col("r.chr"), F.col("r.s"), F.col("r.e")).alias("region"))


def x12_locus_codec(spark: SparkSession, d: str) -> DataFrame:
    rows = segments(spark, d).withColumn("code", S.locus_code(F.col("chr"), F.col("start0"), F.col("end0"), F.col("strand")))
    back = S.parse_locus(F.col("code"))
    return rows.select("id", "seg", "code", F.concat(back["chr"], F.lit(":"), (back["s"] + 1).cast("string"), F.lit("-"), back["e"].cast("string"), F.lit("_"), back["strand"]).alias("shown"))


def x13_strands(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "ecc_core", "strand")
    return rows.select("rec_id", S.strand(F.col("strand")).alias("strand"), S.flipped(S.strand(F.col("strand"))).alias("opposite"))


def x14_read_counts(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "ecc_core", "reads").select("rec_id", F.size(S.read_names(F.col("reads"))).cast("bigint").alias("n"))


def x15_formatted(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "ecc_core", "length").where("length is not null")
    return rows.select("rec_id", F.format_number("length", 0).alias("length"), F.format_string("%.2f", F.rint(F.col("length") / 10.0) / 100).alias("kb"))


def x16_base_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = _aln(spark, d, "query_id").where("query_id is not null")
    return rows.select("aln_id", S.base_id(F.col("query_id")).alias("base"), S.safe_id(F.concat_ws(" ", "query_id", F.lit("#1"))).alias("safe"))


def x17_abundance(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "inferred_simple", "num_split_reads", "copy_number")
    return rows.select("eccDNA_id", fixed(S.abundance(F.col("num_split_reads").cast("double")), 4).alias("abundance"), S.copies_or_one(F.col("copy_number")).alias("copies"))


def x18_loci_length(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).groupBy("id").agg(F.sum(F.col("end0") - F.col("start0")).alias("length"))


def x23_per_read_copies(spark: SparkSession, d: str) -> DataFrame:
    """Each read with the copy number at its place, or the circle's where there is none."""
    rows = once(spark, d, "ecc_core", "reads", "per_read_copy_number", "copy_number").where("reads is not null")
    rows = rows.select("rec_id", F.nanvl("copy_number", F.lit(None)).alias("c"), F.split("per_read_copy_number", ";").alias("v"), F.posexplode(F.split("reads", ";")).alias("i", "read"))
    own = F.trim(F.get("v", F.col("i"))).try_cast("double")
    return rows.where("trim(read) <> ''").select("rec_id", (F.col("i") + 1).alias("place"), F.trim("read").alias("read"), fixed(F.coalesce(F.nanvl(own, F.lit(None)), F.col("c")), 2).alias("copies"))


def x25_coercion(spark: SparkSession, d: str) -> DataFrame:
    part = F.split("query_id", r"\|")
    rows = _aln(spark, d, "query_id").where("query_id is not null")
    return rows.select("aln_id", S.to_bigint(part[3]).alias("whole"), fixed(S.to_double(F.get(part, F.lit(9)), 1.0), 2).alias("missing"))


def x26_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = _aln(spark, d, "subject_id", "s_start", "s_end", "sstrand")
    return rows.select("aln_id", F.col("subject_id").alias("chr"), (F.least("s_start", "s_end") - 1).alias("start0"), F.greatest("s_start", "s_end").alias("end0"), S.strand(F.col("sstrand")).alias("strand"))


def x28_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "ecc_core", "mapq_best", "identity_best")
    return rows.select("rec_id", (F.col("mapq_best") < S.LOW_MAPQ).alias("low_mapq"), (F.nanvl("identity_best", F.lit(None)) < S.LOW_IDENTITY).alias("low_identity"))


def a1_paf_rows(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as PAF lines and read back as alignment rows."""
    rows = _aln(spark, d, "query_id", "subject_id", "identity", "alignment_length", "mismatches", "q_start", "q_end", "s_start", "s_end", "sstrand", "mapq").where("query_id is not null and mapq is not null")
    out = T.paf_rows(rows.select("aln_id", T.paf_line(rows).alias("line")), "line")
    return out.select("aln_id", fixed(F.col("identity"), 2).alias("identity"), "alignment_length", "mismatches", "gap_opens", "q_start", "q_end", "s_start", "s_end", "sstrand", "mapq")


def f17_read_cleanup(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "ecc_core", "reads").select("rec_id", F.coalesce(present("reads"), F.lit("")).alias("reads"))


def f18_normalised(spark: SparkSession, d: str) -> DataFrame:
    rows = cleaned(once(spark, d, "ecc_core"))
    return rows.select("rec_id", "cluster", "ecc_id", "chr", "start0", "end0", "strand", "length", "state", fixed(F.col("copies"), 2).alias("copies"))


QUERIES = {f.__name__: f for f in (
    x1_evidence_norms, a13_confidence, x2_match_degree, f15_match_degree_band, x4_ring_projection, x5_ring_substring, x6_reverse_complement, x7_least_rotation, x8_canonical_ring,
    x10_ring_ids, x11_regions, x12_locus_codec, x13_strands, x14_read_counts, x15_formatted, x16_base_ids, x17_abundance, x18_loci_length, x23_per_read_copies, x25_coercion, x26_segments,
    x28_flags, a1_paf_rows, f17_read_cleanup, f18_normalised,
)}

_A, _T, _E = once_sql("alignments"), once_sql("tandem"), once_sql("ecc_core")
_C01 = lambda x: f"CASE WHEN {x} IS NOT NULL THEN greatest(0.0, least(1.0, {x})) END"
_NN = lambda x: f"CASE WHEN NOT isnan(CAST({x} AS DOUBLE)) THEN {x} END"
_TERMS = [f"coalesce({_C01(x)}, 0)" for x in ("(mapq_best / 60.0)", f"((({_NN('identity_best')}) - 90.0) / 10.0)", f"({_NN('query_cov_best')})", f"({_NN('query_cov_2nd')})")]
_TURN = "list_min([s[i + 1:] || s[:i] FOR i IN range(length(s))])"
_MISS = "'', 'na', 'n/a', 'nan', 'none', 'null', '.'"
_IUPAC = f"'{S.IUPAC_FROM}', '{S.IUPAC_TO}'"
_RE = r"^\s*([^:\s]+):(\d+)-(\d+)(_[+-])?\s*$"

SQL = {
    "x1_evidence_norms": f"SELECT aln_id, {fixed_sql(_C01('(mapq / 60.0)'), 6)} AS mapq, {fixed_sql(_C01('((identity - 90.0) / 10.0)'), 6)} AS identity, {fixed_sql('CASE WHEN identity > 1 THEN identity / 100.0 ELSE identity END', 6)} AS fraction FROM {_A}",
    "a13_confidence": f"SELECT rec_id, {fixed_sql(f'CASE WHEN least({chr(44).join(_TERMS)}) <= 0 THEN 0 ELSE pow({chr(42).join(_TERMS)}, 0.25) END', 6)} AS confidence FROM {_E}",
    "x2_match_degree": f"SELECT rec_id, {fixed_sql(f'CASE WHEN NOT isnan(match_degree) THEN greatest(0, least(100, match_degree)) END', 2)} AS match_degree FROM {_E}",
    "f15_match_degree_band": f"SELECT rec_id FROM {_E} WHERE match_degree BETWEEN 95 AND 105 AND NOT isnan(match_degree)",
    "x4_ring_projection": f"""WITH r AS (SELECT aln_id, TRY_CAST(string_split(query_id, '|')[3] AS BIGINT) AS size, least(q_start, q_end) - 1 AS s, greatest(q_start, q_end) AS e FROM {_A}), k AS (SELECT * FROM r WHERE size > 0 AND e > s)
      SELECT aln_id, CAST(0 AS BIGINT) AS s, size AS e FROM k WHERE e - s >= size OR s % size = e % size UNION ALL SELECT aln_id, s % size, CASE WHEN e % size = 0 THEN size ELSE e % size END FROM k WHERE e - s < size AND (s % size < e % size OR e % size = 0)
      UNION ALL SELECT aln_id, s % size, size FROM k WHERE e - s < size AND s % size > e % size AND e % size > 0 UNION ALL SELECT aln_id, 0, e % size FROM k WHERE e - s < size AND s % size > e % size AND e % size > 0""",
    "x5_ring_substring": f"SELECT rec_id, CASE WHEN length(consSeq) > 0 AND consLen > 0 THEN substr(consSeq || consSeq, 1 + (start % consLen) % length(consSeq), least(consLen, length(consSeq))) ELSE '' END AS seq FROM {_T} WHERE consSeq IS NOT NULL",
    "x6_reverse_complement": f"SELECT rec_id, reverse(translate(consSeq, {_IUPAC})) AS seq FROM {_T} WHERE consSeq IS NOT NULL",
    "x7_least_rotation": f"SELECT rec_id, {_TURN} AS seq FROM (SELECT rec_id, upper(consSeq) AS s FROM {_T} WHERE consSeq IS NOT NULL)",
    "x8_canonical_ring": f"WITH b AS (SELECT rec_id, upper(trim(consSeq)) AS s FROM {_T} WHERE consSeq IS NOT NULL), t AS (SELECT rec_id, {_TURN} AS seq FROM b UNION ALL SELECT rec_id, {_TURN} FROM (SELECT rec_id, reverse(translate(s, {_IUPAC})) AS s FROM b)) SELECT rec_id, min(seq) AS seq FROM t GROUP BY rec_id",
    "x10_ring_ids": f"SELECT rec_id, concat_ws('|', readName, repN, CAST(consLen AS VARCHAR), CAST(CAST(round_even(copyNum, 0) AS BIGINT) AS VARCHAR)) AS id FROM {_T} WHERE copyNum IS NOT NULL",
    "x11_regions": f"""WITH r AS (SELECT rec_id, string_split_regex(regions, '[;,]')[1] AS x FROM {once_sql('split_overview')} WHERE regions IS NOT NULL), p AS (SELECT rec_id, regexp_extract(x, '{_RE}', 1) AS chr, TRY_CAST(regexp_extract(x, '{_RE}', 2) AS BIGINT) AS s, TRY_CAST(regexp_extract(x, '{_RE}', 3) AS BIGINT) AS e FROM r WHERE regexp_matches(x, '{_RE}'))
      SELECT rec_id, chr, s, e, chr || ':' || s || '-' || e AS region FROM p""",
    "x12_locus_codec": f"WITH {CHIMERIC_SQL} SELECT id, seg, concat_ws('_', chr, CAST(start0 AS VARCHAR), CAST(end0 AS VARCHAR), strand) AS code, chr || ':' || (start0 + 1) || '-' || end0 || '_' || strand AS shown FROM seg",
    "x13_strands": f"SELECT rec_id, CASE WHEN trim(strand) IN ('+', '-') THEN trim(strand) END AS strand, CASE trim(strand) WHEN '+' THEN '-' WHEN '-' THEN '+' END AS opposite FROM {_E}",
    "x14_read_counts": f"SELECT rec_id, coalesce(len(list_distinct([trim(x) FOR x IN string_split(reads, ';') IF trim(x) <> ''])), 0) AS n FROM {_E}",
    "x15_formatted": f"SELECT rec_id, format('{{:,}}', CAST(length AS BIGINT)) AS length, printf('%.2f', round_even(length / 10.0, 0) / 100) AS kb FROM {_E} WHERE length IS NOT NULL",
    "x16_base_ids": f"SELECT aln_id, regexp_extract(query_id, '^>?([^\\s|]*)', 1) AS base, regexp_replace(query_id || ' #1', '[^A-Za-z0-9._|:-]+', '_', 'g') AS safe FROM {_A} WHERE query_id IS NOT NULL",
    "x17_abundance": f"SELECT eccDNA_id, {fixed_sql('least(num_split_reads / 100.0, 1.0)', 4)} AS abundance, CASE WHEN copy_number > 0 THEN CAST(copy_number AS DOUBLE) ELSE 1.0 END AS copies FROM {once_sql('inferred_simple')}",
    "x18_loci_length": f"WITH {CHIMERIC_SQL} SELECT id, CAST(sum(end0 - start0) AS BIGINT) AS length FROM seg GROUP BY id",
    "x23_per_read_copies": f"""WITH r AS (SELECT rec_id, {_NN('copy_number')} AS c, string_split(per_read_copy_number, ';') AS v, string_split(reads, ';') AS x FROM {_E} WHERE reads IS NOT NULL), u AS (SELECT rec_id, c, v, unnest(x) AS read, generate_subscripts(x, 1) AS i FROM r)
      SELECT rec_id, CAST(i AS INTEGER) AS place, trim(read) AS read, {fixed_sql("coalesce(CASE WHEN NOT isnan(TRY_CAST(trim(v[i]) AS DOUBLE)) THEN TRY_CAST(trim(v[i]) AS DOUBLE) END, c)", 2)} AS copies FROM u WHERE trim(read) <> ''""",
    "x25_coercion": f"SELECT aln_id, CASE WHEN TRY_CAST(string_split(query_id, '|')[4] AS DOUBLE) = floor(TRY_CAST(string_split(query_id, '|')[4] AS DOUBLE)) THEN CAST(TRY_CAST(string_split(query_id, '|')[4] AS DOUBLE) AS BIGINT) END AS whole, CAST(100 AS BIGINT) AS missing FROM {_A} WHERE query_id IS NOT NULL",
    "x26_segments": f"SELECT aln_id, subject_id AS chr, least(s_start, s_end) - 1 AS start0, greatest(s_start, s_end) AS end0, CASE sstrand WHEN 'plus' THEN '+' WHEN 'minus' THEN '-' END AS strand FROM {_A}",
    "x28_flags": f"SELECT rec_id, mapq_best < 20 AS low_mapq, ({_NN('identity_best')}) < 95 AS low_identity FROM {_E}",
    "a1_paf_rows": f"""SELECT aln_id, CAST(round_even((alignment_length - mismatches) / alignment_length * 100 * 100, 0) AS BIGINT) AS identity, alignment_length, CAST(mismatches AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS gap_opens, q_start, q_end,
      CASE WHEN sstrand = 'plus' THEN least(s_start, s_end) ELSE greatest(s_start, s_end) END AS s_start, CASE WHEN sstrand = 'plus' THEN greatest(s_start, s_end) ELSE least(s_start, s_end) END AS s_end, sstrand, CAST(mapq AS BIGINT) AS mapq FROM {_A} WHERE query_id IS NOT NULL AND mapq IS NOT NULL""",
    "f17_read_cleanup": f"SELECT rec_id, CASE WHEN reads IS NULL OR lower(trim(reads)) IN ({_MISS}) THEN '' ELSE trim(reads) END AS reads FROM {_E}",
    "f18_normalised": f"""SELECT * FROM (SELECT rec_id, CASE WHEN lower(trim(cluster_id)) NOT IN ({_MISS}) THEN upper(trim(cluster_id)) END AS cluster, CASE WHEN lower(trim(eccDNA_id)) NOT IN ({_MISS}) THEN trim(eccDNA_id) END AS ecc_id, CASE WHEN lower(trim(chr)) NOT IN ({_MISS}) THEN trim(chr) END AS chr,
      CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0, CASE WHEN trim(strand) IN ('+', '-') THEN trim(strand) END AS strand, CAST(length AS BIGINT) AS length, CASE WHEN lower(trim(state)) NOT IN ({_MISS}) THEN trim(state) END AS state,
      {fixed_sql('CASE WHEN copy_number > 0 AND NOT isnan(copy_number) THEN copy_number END', 2)} AS copies FROM {_E}) WHERE cluster IS NOT NULL""",
}
