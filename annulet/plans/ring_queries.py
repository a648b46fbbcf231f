"""Chimeric detection, ring sequences, left-over rings, matching against truth, and the composite pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions import rings, scalars as S
from annulet.operators import chimeric as C
from annulet.operators import classify, clusters, curate, matching as M, sequences, tandem
from annulet.plans import alignment_queries, cluster_queries, inferred_queries, interval_queries, tandem_queries
from annulet.plans.base import fixed, fixed_sql, once, once_sql


def doubled(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of the queries as alignments of doubled rings."""
    rows = classify.prepared(once(spark, d, "alignments", *alignment_queries.COLUMNS))
    return rows.select("query_id", "aln_id", "chr", "start0", "end0", "strand", (F.col("q_start") - 1).alias("qs"), F.col("q_end").alias("qe"), "size", "identity")


def g3_loci(spark: SparkSession, d: str) -> DataFrame:
    return C.with_locus(doubled(spark, d)).select("aln_id", "locus", "lo", "hi", "locus_strand")


def g4_locus_edges(spark: SparkSession, d: str) -> DataFrame:
    return C.locus_edges(C.runs(C.with_locus(doubled(spark, d)))).groupBy("query_id", "src", "dst", "transition").agg(F.count("*").alias("n"))


def g5_cycles(spark: SparkSession, d: str) -> DataFrame:
    return C.cycles(C.with_locus(doubled(spark, d))).select("query_id", "place", "locus", "qs", "qe", "closed")


def g8_doubled_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of the two halves of a doubled ring at one place."""
    return C.doubled_pairs(doubled(spark, d), least_cover=0.5)


def q3_chimeric(spark: SparkSession, d: str) -> DataFrame:
    """Chimeric rings among the queries that are neither U nor M (anti-join)."""
    decided = classify.classify(once(spark, d, "alignments", *alignment_queries.COLUMNS)).where("class in ('Uecc', 'Mecc')")
    rows = C.detect(doubled(spark, d).join(decided.select("query_id"), "query_id", "left_anti"), least=50.0)
    return rows.select("query_id", "segment_in_circle", "num_segments", "chr", "start0", "end0", "strand", "cumulative_length", fixed(F.col("match_degree"), 3).alias("match_degree"), fixed(F.col("cov"), 4).alias("cov"), "class", fixed(F.col("confidence"), 4).alias("confidence"))


def _library(spark: SparkSession, d: str) -> DataFrame:
    """The doubled ring sequences as a FASTA library: id and seq."""
    rows = once(spark, d, "tandem", "readName", "repN", "copyNum", "consLen", "consSeq").where("consSeq is not null and copyNum is not null")
    return rows.select(F.concat_ws("|", "readName", "repN", F.col("consLen").cast("string"), F.col("copyNum").cast("string"), F.lit("circular")).alias("id"), S.circularised(F.col("consSeq")).alias("seq"))


def j3_sequence_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = classify.prepared(once(spark, d, "alignments", *alignment_queries.COLUMNS)).select("aln_id", "query_id")
    return sequences.looked_up(rows, "query_id", _library(spark, d), ["seq"]).select("aln_id", F.length("seq").alias("letters"))


def x24_ring_sequences(spark: SparkSession, d: str) -> DataFrame:
    rows = classify.prepared(once(spark, d, "alignments", *alignment_queries.COLUMNS)).select("aln_id", "query_id", "q_start", "size")
    return sequences.ring_sequences(rows, _library(spark, d)).select("aln_id", "ring_key")


def j7_left_over(spark: SparkSession, d: str) -> DataFrame:
    return sequences.left_over(_library(spark, d), once(spark, d, "alignments", "query_id"))


def t9_provisional_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d, "tandem", "consSeq", "start", "consLen").where("consSeq is not null")
    return sequences.provisional(rows.select("rec_id", rings.canonical(F.col("consSeq")).alias("ring_key")), "U").select("rec_id", "eccDNA_id")


def _match_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[str]]:
    rows = interval_queries.simple_circles(spark, d).where("sample is not null")
    truths = rows.groupBy("sample", "chr", "start0", "end0").agg(F.min("id").alias("id"))
    preds = rows.select("sample", "chr", "id", (F.col("start0") + F.col("id") % 61).alias("start0"), (F.col("end0") + F.col("id") % 53).alias("end0"))
    read = F.lit(None).cast("string").alias("read")
    return preds.select("*", read), truths.select("*", read), ["sample", "chr"]


def j22_greedy_matches(spark: SparkSession, d: str) -> DataFrame:
    return M.greedy(M.candidates(*_match_sides(spark, d)))


def q11_metrics(spark: SparkSession, d: str) -> DataFrame:
    preds, truths, keys = _match_sides(spark, d)
    out = M.score(M.greedy(M.candidates(preds, truths, keys)), preds, truths)
    return out.select("tp", "fp", "fn", *(fixed(F.col(c), 6).alias(c) for c in ("recall", "precision", "f1")))


def j23_molecule_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Chimeric circles that cover each other to four fifths in both directions, matched one to one with earlier ones."""
    segs = M.union_segments(inferred_queries.segments(spark, d).select("id", "chr", "start0", "end0").where("start0 < end0"), ["chr"])
    edges = M.coverage_candidates(segs, segs, ["chr"], 0.8).where("truth < pred")
    return M.greedy(edges)


def q4_ring_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Rings of the tandem step grouped by the sequence both strands share: a cluster's size, its longest ring and number."""
    rows = tandem.rings(once(spark, d, "tandem", *tandem_queries.COLUMNS)).where("consSeq is not null")
    keyed = rows.select("ring_id", "consLen", rings.canonical(F.col("consSeq")).alias("ring_key"))
    groups = keyed.groupBy("ring_key").agg(F.count("*").alias("size"), F.min("ring_id").alias("first_ring"))
    return groups.select(F.xxhash64("ring_key").alias("key"), "size", "first_ring").drop("key")


def q5_confirmed(spark: SparkSession, d: str) -> DataFrame:
    """Confirmed clusters: the representative with merged evidence."""
    core = clusters.cleaned(once(spark, d, "ecc_core"))
    rep = clusters.representatives(core, "length", "copies").select("cluster", "rec_id", "chr", "start0", "end0", "length", "eccdna_type", "state").where("state = 'Confirmed'")
    ev = clusters.merged_evidence(core).select("cluster", "size", "ids", "mapq_best", "reads", fixed(F.col("copies"), 2).alias("copies"), F.col("strand").alias("majority"))
    return rep.join(ev, "cluster")


def q6_sieved_with_rest(spark: SparkSession, d: str) -> DataFrame:
    """Reads for the split-read step: those that are not circular, and those of unclassified rings."""
    rest = tandem_queries.j8_sieved_reads(spark, d).select("readName")
    unclassified = alignment_queries.j5_unclassified(spark, d).select(F.split("query_id", r"\|")[0].alias("readName"))
    return rest.unionByName(unclassified).distinct()


def q10_deliverable(spark: SparkSession, d: str) -> DataFrame:
    """Segments of the packaged table with role and padded identifier."""
    segs = inferred_queries.segments(spark, d)
    rows = segs.withColumn("seg_index", F.col("seg") + 1)
    return rows.select(F.format_string("CeccDNA%04d", F.col("id")).alias("eccDNA_id"), "seg_index", F.col("segs").alias("seg_total"), curate.role("seg_index", "segs").alias("role"), "chr", "start0", "end0", "strand")


def u1_union(spark: SparkSession, d: str) -> DataFrame:
    """Confirmed and inferred circles in one table; flags an inferred row lacks are false."""
    core = clusters.cleaned(once(spark, d, "ecc_core")).where("state = 'Confirmed'").select(F.col("rec_id").alias("id"), "state", "chr", "length", (F.col("mapq_best") < 20).alias("low_mapq"))
    inferred = interval_queries.simple_circles(spark, d).select("id", F.lit("Inferred").alias("state"), "chr", (F.col("end0") - F.col("start0")).alias("length"))
    both = core.unionByName(inferred, allowMissingColumns=True)
    return both.withColumn("low_mapq", F.coalesce("low_mapq", F.lit(False)))


def u3_unaligned_reads(spark: SparkSession, d: str) -> DataFrame:
    reads = once(spark, d, "tandem", "readName").select("readName")
    aligned = once(spark, d, "alignments", "query_id").select(F.split("query_id", r"\|")[0].alias("readName")).where("readName is not null")
    return reads.distinct().exceptAll(aligned.distinct())


def u4_all_reads(spark: SparkSession, d: str) -> DataFrame:
    reads = once(spark, d, "tandem", "readName").select("readName")
    aligned = once(spark, d, "alignments", "query_id").select(F.split("query_id", r"\|")[0].alias("readName")).where("readName is not null")
    return reads.union(aligned).distinct()


def u5_distinct_cluster_reads(spark: SparkSession, d: str) -> DataFrame:
    return clusters.read_rows(clusters.cleaned(once(spark, d, "ecc_core")))


QUERIES = {f.__name__: f for f in (
    g3_loci, g4_locus_edges, g5_cycles, g8_doubled_pairs, q3_chimeric, j3_sequence_lookup, x24_ring_sequences, j7_left_over, t9_provisional_numbers, j22_greedy_matches, q11_metrics, j23_molecule_coverage,
    q4_ring_clusters, q5_confirmed, q6_sieved_with_rest, q10_deliverable, u1_union, u3_unaligned_reads, u4_all_reads, u5_distinct_cluster_reads,
)}

_BODY = """dbl AS (SELECT query_id, aln_id, chr, start0, end0, strand, q_start - 1 AS qs, q_end AS qe, size, identity FROM prep {more}),
o AS (SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY query_id, chr ORDER BY start0, aln_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 500 THEN 0 ELSE 1 END AS open FROM dbl),
n AS (SELECT *, sum(open) OVER (PARTITION BY query_id, chr ORDER BY start0, aln_id ROWS UNBOUNDED PRECEDING) AS island FROM o),
g AS (SELECT query_id, chr, island, min(start0) AS lo, max(end0) AS hi, arg_min(strand, start0 * 100000000 + aln_id) AS locus_strand FROM n GROUP BY query_id, chr, island),
loc AS (SELECT n.*, lo, hi, locus_strand, n.chr || ':' || lo AS locus FROM n JOIN g USING (query_id, chr, island)),
b AS (SELECT *, lag(locus) OVER (PARTITION BY query_id ORDER BY qs, aln_id) AS before FROM loc),
runs AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY qs, aln_id) - 1 AS k, row_number() OVER (PARTITION BY query_id, locus ORDER BY qs, aln_id) AS nth FROM b WHERE before IS NULL OR before <> locus),
f AS (SELECT query_id, locus AS first FROM runs WHERE k = 0),
m AS (SELECT runs.*, first, min(CASE WHEN k > 0 AND locus = first THEN k END) OVER (PARTITION BY query_id) AS ret, count(*) OVER (PARTITION BY query_id) AS c FROM runs JOIN f USING (query_id)),
around AS (SELECT a.query_id, a.locus, a.k, coalesce(s.qs, a.qs) AS qs, coalesce(s.qe, a.qe) AS qe, TRUE AS closed, a.size, a.chr, a.lo, a.hi, a.locus_strand FROM m a LEFT JOIN m s ON s.query_id = a.query_id AND s.locus = a.locus AND s.nth = 2 AND s.locus = s.first
  WHERE a.c >= 3 AND a.ret >= 2 AND a.k < a.ret AND a.nth = 1),
hl AS (SELECT loc.* FROM loc WHERE (qs + qe) / 2 < size AND query_id IN (SELECT query_id FROM m WHERE c >= 3 AND coalesce(ret, 0) < 2)),
hb AS (SELECT *, lag(locus) OVER (PARTITION BY query_id ORDER BY qs, aln_id) AS before FROM hl),
hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY qs, aln_id) - 1 AS k, row_number() OVER (PARTITION BY query_id, locus ORDER BY qs, aln_id) AS nth, count(*) OVER (PARTITION BY query_id) AS c FROM hb WHERE before IS NULL OR before <> locus),
cyc AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY k) AS place FROM (SELECT * FROM around UNION ALL SELECT query_id, locus, k, qs, qe, FALSE, size, chr, lo, hi, locus_strand FROM hr WHERE c >= 2 AND nth = 1)),
whole AS (SELECT query_id, count(*) AS num_segments, CAST(sum(hi - lo) AS BIGINT) AS cumulative_length, count(DISTINCT chr) AS chrs, sum(hi - lo) / max(size) * 100 AS match_degree FROM cyc GROUP BY query_id),
co AS (SELECT *, max(qe) OVER (PARTITION BY query_id ORDER BY qs, aln_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM loc),
facts AS (SELECT query_id, sum(greatest(0, qe - greatest(qs, coalesce(reach, qs)))) / (2 * max(size)) AS cov, count(*) AS alns, max(identity) AS best FROM co GROUP BY query_id)"""
_DOUBLED = f"{alignment_queries._PREP}, {_BODY.format(more='')}"
_ONLY = "WHERE query_id NOT IN (SELECT query_id FROM final WHERE class IN ('Uecc', 'Mecc'))"
_LIB = f"lib AS (SELECT concat_ws('|', readName, repN, CAST(consLen AS VARCHAR), CAST(copyNum AS VARCHAR), 'circular') AS id, consSeq || consSeq AS seq FROM {once_sql('tandem')} WHERE consSeq IS NOT NULL AND copyNum IS NOT NULL)"
_FINAL = alignment_queries._ALL + ", " + alignment_queries._DECIDE
_TURN = "list_min([s[i + 1:] || s[:i] FOR i IN range(length(s))])"
_RC = f"reverse(translate(s, '{S.IUPAC_FROM}', '{S.IUPAC_TO}'))"
_CONF = ["1.0", "greatest(0, least(1, (best - 90.0) / 10.0))", "greatest(0, least(1, cov))", "greatest(0, least(1, num_segments / alns))"]

SQL = {
    "g3_loci": f"WITH {_DOUBLED} SELECT aln_id, locus, lo, hi, locus_strand FROM loc",
    "g4_locus_edges": f"WITH {_DOUBLED}, e AS (SELECT query_id, locus AS src, lead(locus) OVER w AS dst, strand || '_' || lead(strand) OVER w AS transition FROM runs WINDOW w AS (PARTITION BY query_id ORDER BY k)) SELECT query_id, src, dst, transition, count(*) AS n FROM e WHERE dst IS NOT NULL GROUP BY ALL",
    "g5_cycles": f"WITH {_DOUBLED} SELECT query_id, place, locus, qs, qe, closed FROM cyc",
    "g8_doubled_pairs": f"""WITH {_DOUBLED}, r AS (SELECT dbl.* FROM dbl JOIN facts USING (query_id) WHERE cov >= 0.5) SELECT a.query_id, a.aln_id AS first, b.aln_id AS second FROM r a JOIN r b ON a.query_id = b.query_id AND a.chr = b.chr AND a.strand = b.strand
      AND a.qs < a.size - 50 AND b.qe > b.size + 50 AND abs((a.qs + a.qe) / 2 - (b.qs + b.qe) / 2) >= 100
      AND (least(a.end0, b.end0) > greatest(a.start0, b.start0) OR abs((a.start0 + a.end0) / 2 - (b.start0 + b.end0) / 2) < 50)""",
    "q3_chimeric": f"""{_FINAL}, {_BODY.format(more=_ONLY)}
      SELECT query_id, place AS segment_in_circle, num_segments, chr, lo AS start0, hi AS end0, locus_strand AS strand, cumulative_length, {fixed_sql('match_degree', 3)} AS match_degree, {fixed_sql('cov', 4)} AS cov,
      CASE WHEN chrs > 1 THEN 'Cecc-InterChr' ELSE 'Cecc-IntraChr' END AS class, {fixed_sql(f"CASE WHEN least({', '.join(_CONF)}) <= 0 THEN 0 ELSE pow({' * '.join(_CONF)}, 0.25) END", 4)} AS confidence
      FROM cyc JOIN whole USING (query_id) JOIN facts USING (query_id) WHERE num_segments >= 2 AND match_degree BETWEEN 50 AND 105""",
    "q5_confirmed": f"""WITH {cluster_queries._CORE}, {cluster_queries._READS}, rep AS (SELECT * FROM core QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY coalesce(state = 'Confirmed', FALSE) DESC, length DESC NULLS LAST, copies DESC NULLS LAST, rec_id) = 1),
      c AS (SELECT cluster, sum(copies) AS copies FROM (SELECT DISTINCT cluster, ecc_id, copies FROM core WHERE copies IS NOT NULL AND ecc_id IS NOT NULL) GROUP BY cluster), r AS (SELECT cluster, count(*) AS reads FROM reads GROUP BY cluster),
      s AS (SELECT cluster, strand FROM core WHERE strand IS NOT NULL GROUP BY cluster, strand QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, strand = '+' DESC) = 1),
      e AS (SELECT cluster, count(*) AS size, count(DISTINCT ecc_id) AS ids, max(mapq_best) AS mapq_best FROM core GROUP BY cluster)
      SELECT rep.cluster, rec_id, chr, start0, end0, length, eccdna_type, state, size, ids, e.mapq_best, coalesce(r.reads, 0) AS reads, {fixed_sql('c.copies', 2)} AS copies, s.strand AS majority
      FROM rep JOIN e ON e.cluster = rep.cluster LEFT JOIN c ON c.cluster = rep.cluster LEFT JOIN r ON r.cluster = rep.cluster LEFT JOIN s ON s.cluster = rep.cluster WHERE state = 'Confirmed'""",
    "q4_ring_clusters": f"""WITH {tandem_queries._RINGS}, b AS (SELECT ring_id, upper(trim(consSeq)) AS s FROM rings WHERE consSeq IS NOT NULL), t AS (SELECT ring_id, {_TURN} AS k FROM b UNION ALL SELECT ring_id, {_TURN} FROM (SELECT ring_id, {_RC} AS s FROM b)),
      k AS (SELECT ring_id, min(k) AS k FROM t GROUP BY ring_id) SELECT count(*) AS size, min(ring_id) AS first_ring FROM k GROUP BY k""",
    "t9_provisional_numbers": f"""WITH b AS (SELECT rec_id, upper(trim(consSeq)) AS s FROM {once_sql('tandem')} WHERE consSeq IS NOT NULL), t AS (SELECT rec_id, {_TURN} AS k FROM b UNION ALL SELECT rec_id, {_TURN} FROM (SELECT rec_id, {_RC} AS s FROM b)),
      k AS (SELECT rec_id, min(k) AS k FROM t GROUP BY rec_id) SELECT rec_id, 'U' || dense_rank() OVER (ORDER BY k) AS eccDNA_id FROM k WHERE k <> ''""",
    "j3_sequence_lookup": f"""WITH {alignment_queries._PREP}, {_LIB}, base AS (SELECT string_split(id, '|')[1] AS base, arg_min(seq, id || seq) AS seq FROM lib GROUP BY 1)
      SELECT aln_id, length(coalesce(lib.seq, base.seq)) AS letters FROM prep LEFT JOIN lib ON lib.id = query_id LEFT JOIN base ON base.base = read""",
    "x24_ring_sequences": f"""WITH {alignment_queries._PREP}, {_LIB}, base AS (SELECT string_split(id, '|')[1] AS base, arg_min(seq, id || seq) AS seq FROM lib GROUP BY 1),
      r AS (SELECT aln_id, q_start, size, coalesce(lib.seq, base.seq) AS seq FROM prep LEFT JOIN lib ON lib.id = query_id LEFT JOIN base ON base.base = read),
      c AS (SELECT aln_id, upper(trim(CASE WHEN length(seq) > 0 AND q_start > 0 AND size > 0 THEN substr(seq || seq, CAST(1 + (q_start - 1) % length(seq) AS BIGINT), CAST(least(size, length(seq)) AS BIGINT)) ELSE '' END)) AS ring FROM r),
      d AS (SELECT DISTINCT ring FROM c WHERE ring <> ''), t AS (SELECT ring, {_TURN} AS k FROM (SELECT ring, ring AS s FROM d) UNION ALL SELECT ring, {_TURN} FROM (SELECT ring, {_RC.replace('(s,', '(ring,').replace('translate(s', 'translate(ring')} AS s FROM d)),
      k AS (SELECT ring, min(k) AS k FROM t GROUP BY ring) SELECT aln_id, coalesce(k.k, '') AS ring_key FROM c LEFT JOIN k USING (ring)""",
    "u1_union": f"""WITH {cluster_queries._CORE}, {interval_queries.SIMPLE_SQL} SELECT rec_id AS id, state, chr, length, coalesce(mapq_best < 20, FALSE) AS low_mapq FROM core WHERE state = 'Confirmed'
      UNION ALL SELECT id, 'Inferred', chr, end0 - start0, FALSE FROM iv""",
    "u3_unaligned_reads": f"SELECT DISTINCT readName FROM {once_sql('tandem')} WHERE readName NOT IN (SELECT string_split(query_id, '|')[1] FROM {once_sql('alignments')} WHERE query_id IS NOT NULL)",
    "u4_all_reads": f"SELECT readName FROM {once_sql('tandem')} UNION SELECT string_split(query_id, '|')[1] FROM {once_sql('alignments')} WHERE query_id IS NOT NULL",
    "u5_distinct_cluster_reads": f"WITH {cluster_queries._CORE}, {cluster_queries._READS} SELECT cluster, read FROM reads",
    "q6_sieved_with_rest": f"""{_FINAL}, {tandem_queries._RINGS} SELECT DISTINCT readName FROM {once_sql('tandem')} WHERE readName NOT IN (SELECT readName FROM classes WHERE readClass <> 'Other')
      UNION SELECT string_split(query_id, '|')[1] FROM prep WHERE query_id NOT IN (SELECT query_id FROM final WHERE class IN ('Uecc', 'Mecc'))""",
    "q10_deliverable": f"""WITH {inferred_queries.CHIMERIC_SQL} SELECT printf('CeccDNA%04d', id) AS eccDNA_id, seg + 1 AS seg_index, segs AS seg_total, CASE WHEN seg = 0 THEN 'head' WHEN seg + 1 = segs THEN 'tail' ELSE 'middle' END AS role, chr, start0, end0, strand FROM seg""",
    "j7_left_over": f"WITH {_LIB}, r AS (SELECT id, seq, row_number() OVER (ORDER BY id, seq) AS no FROM lib WHERE length(seq) > 0 AND id NOT IN (SELECT query_id FROM {once_sql('alignments')} WHERE query_id IS NOT NULL)) SELECT regexp_replace(id || '__X' || no, '[^A-Za-z0-9._|:-]+', '_', 'g') AS id, CASE WHEN length(seq) > 1 THEN substr(seq, 1, length(seq) // 2) ELSE seq END AS seq FROM r",
}
