"""Curation of split-read circles, redundancy between circles, and the unified table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import curate, unify
from annulet.operators.interval_sweep import chromosome
from annulet.operators.intervals import reciprocal_join
from annulet.operators.numbering import numbered
from annulet.plans.base import fixed, fixed_sql, once, once_sql
from annulet.plans.interval_queries import SIMPLE_SQL, simple_circles


def _overview(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "split_overview", "regions", "circle_length", "segment_count", "num_split_reads", "prob_present", "prob_artifact")


def f11_long_circles(spark: SparkSession, d: str) -> DataFrame:
    return _overview(spark, d).where("circle_length >= 100").select("rec_id")


def f13_malformed_regions(spark: SparkSession, d: str) -> DataFrame:
    rows = _overview(spark, d).where("circle_length >= 100").join(curate.circles(_overview(spark, d)).select("rec_id"), "rec_id", "left_anti")
    return rows.select("rec_id")


def a24_best_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = curate.best_of_duplicates(_overview(spark, d).where("circle_length >= 100 and regions is not null"))
    return rows.select("rec_id", fixed(F.col("score"), 6).alias("score"))


def q8_simple(spark: SparkSession, d: str) -> DataFrame:
    return curate.simple(_overview(spark, d))


def q8_chimeric(spark: SparkSession, d: str) -> DataFrame:
    return curate.chimeric(_overview(spark, d))


def f12_chimeric_filter(spark: SparkSession, d: str) -> DataFrame:
    return curate.chimeric(_overview(spark, d), min_segments=3, min_splits=5).select("eccDNA_id", "seg_index", "seg_total", "num_split_reads")


def segments(spark: SparkSession, d: str) -> DataFrame:
    """id, seg (from 0), segs, chr, start0, end0, strand of all complete chimeric circles."""
    rows = once(spark, d, "inferred_chimeric", "chr", "start0", "end0", "strand", "length", "num_split_reads", "copy_number", "prob_present")
    rows = rows.withColumn("chr", chromosome(F.col("chr"))).withColumn("_bad", F.col("chr").isNull() | F.col("start0").isNull() | F.col("end0").isNull())
    w = Window.partitionBy("circle_no")
    rows = rows.withColumns({"segs": F.count("*").over(w), "_any": F.max("_bad").over(w), "seg": F.row_number().over(w.orderBy("seg_index")) - 1}).where("not _any")
    return rows.select(
        F.col("circle_no").alias("id"), "seg", "segs", "chr", F.col("start0").cast("bigint").alias("start0"), F.col("end0").cast("bigint").alias("end0"), "strand",
        "length", "num_split_reads", "copy_number", "prob_present",
    )


def _earlier(matches: DataFrame) -> DataFrame:
    """Of two circles of one table the later one is redundant."""
    return unify.first_match(matches.where("match < id"))


def j10_simple_redundant(spark: SparkSession, d: str) -> DataFrame:
    rows = simple_circles(spark, d).where("sample is not null").select("id", "chr", "start0", "end0")
    known = rows.select("chr", F.col("id").alias("match"), F.lit(0).alias("kind"), F.col("start0").alias("m_start"), F.col("end0").alias("m_end"))
    pairs = reciprocal_join(rows, known, ["chr"], ("start0", "end0"), ("m_start", "m_end")).where("match < id")
    return pairs.groupBy("id").agg(F.min(F.struct("m_start", "match")).alias("m")).select("id", "m.match")


def j11_simple_in_chimeric(spark: SparkSession, d: str) -> DataFrame:
    """Calls of ecc_core that match a segment of a chimeric circle: U calls are looked for first, then segments."""
    core = once(spark, d, "ecc_core", "eccdna_type", "state", "chr", "start0", "end0").where("start0 is not null and end0 is not null")
    core = core.withColumn("chr", chromosome(F.col("chr"))).withColumns({"start0": F.col("start0").cast("bigint"), "end0": F.col("end0").cast("bigint")})
    u = core.where("eccdna_type = 'Uecc' and state = 'Confirmed'").select("chr", F.col("rec_id").alias("match"), F.lit(0).alias("kind"), F.col("start0").alias("m_start"), F.col("end0").alias("m_end"))
    c = segments(spark, d).select("chr", F.col("id").alias("match"), F.lit(1).alias("kind"), F.col("start0").alias("m_start"), F.col("end0").alias("m_end"))
    inferred = core.where("state = 'Inferred'").select(F.col("rec_id").alias("id"), "chr", "start0", "end0")
    return unify.simple_matches(inferred, u.unionByName(c))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = segments(spark, d)
    return unify.segment_matches(rows, rows).where("id <> match")


def j12_chimeric_equal(spark: SparkSession, d: str) -> DataFrame:
    return _earlier(unify.full_matches(_pairs(spark, d)))


def j13_chimeric_part(spark: SparkSession, d: str) -> DataFrame:
    return unify.first_match(unify.part_matches(_pairs(spark, d)))


def j14_chimeric_exact(spark: SparkSession, d: str) -> DataFrame:
    """Circles and those of a second caller, which puts every other circle one base further, by their region strings."""
    rows = segments(spark, d)
    other = rows.withColumns({"start0": F.col("start0") + F.col("id") % 2, "id": F.col("id") + 1_000_000_000})
    return unify.redundant("exact", rows, other)


def j15_chimeric_unstranded(spark: SparkSession, d: str) -> DataFrame:
    return _earlier(unify.full_matches(_pairs(spark, d), stranded=False))


def _redundant_chimeric(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d)
    return _earlier(unify.full_matches(pairs).unionByName(unify.part_matches(pairs)))


def q9_chimeric_kept(spark: SparkSession, d: str) -> DataFrame:
    """Chimeric circles that are not redundant, one row each in the unified form (anti-join, then regions in order)."""
    rows = segments(spark, d).join(_redundant_chimeric(spark, d), "id", "left_anti")
    one = F.struct("seg", S.region(F.col("chr"), F.col("start0"), F.col("end0")).alias("r"), "strand")
    out = rows.groupBy("id").agg(
        F.array_sort(F.collect_list(one)).alias("s"), F.max("segs").alias("seg_total"), F.max("length").alias("length"), F.max("num_split_reads").alias("hit_count"), F.max("copy_number").alias("copies")
    )
    return out.select("id", F.array_join(F.transform("s", lambda x: x["r"]), ";").alias("regions"), F.array_join(F.transform("s", lambda x: x["strand"]), ";").alias("strands"),
                      "seg_total", "length", "hit_count", S.copies_or_one(F.col("copies")).alias("copy_number"))


def j24_evidence_of_redundant(spark: SparkSession, d: str) -> DataFrame:
    """What redundant simple circles add to the one that stays: sums of copies and reads."""
    facts = simple_circles(spark, d).select("id", "copy_number", "num_split_reads")
    held = j10_simple_redundant(spark, d).join(facts, "id").groupBy("match")
    return held.agg(F.sum("copy_number").alias("more_copies"), F.sum("num_split_reads").alias("more_reads"), F.count("*").alias("inferred"))


def t7_renumbered(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of inferred simple circles, going on after the highest number of a confirmed call of the same type."""
    core = once(spark, d, "ecc_core", "eccDNA_id", "eccdna_type", "state").where("state = 'Confirmed' and eccdna_type = 'Uecc'")
    top = core.agg(F.coalesce(F.max(F.regexp_extract("eccDNA_id", r"^UeccDNA(\d+)$", 1).try_cast("bigint")), F.lit(0))).scalar()
    rows = simple_circles(spark, d).where("sample is not null").select("id", "chr", "start0")
    return numbered(rows, ["id"], "_no").select("id", F.concat(F.lit("UeccDNA"), (F.col("_no") + top).cast("string")).alias("eccDNA_id"))


def a25_overlap_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows, red = segments(spark, d).select("id").distinct(), _redundant_chimeric(spark, d).withColumn("r", F.lit(1))
    out = rows.join(red, "id", "left").agg(F.count("*").alias("total"), F.count("r").alias("redundant"))
    return out.select("total", "redundant", (F.col("total") - F.col("redundant")).alias("kept"), fixed(F.coalesce(F.col("redundant") / F.nullif("total", F.lit(0)) * 100, F.lit(0.0)), 2).alias("percent"))


QUERIES = {f.__name__: f for f in (
    f11_long_circles, f13_malformed_regions, a24_best_duplicates, q8_simple, q8_chimeric, f12_chimeric_filter, j10_simple_redundant, j11_simple_in_chimeric,
    j12_chimeric_equal, j13_chimeric_part, j14_chimeric_exact, j15_chimeric_unstranded, q9_chimeric_kept, j24_evidence_of_redundant, t7_renumbered, a25_overlap_statistics,
)}

_OV = once_sql("split_overview")
_BEST = f"""scored AS (SELECT *, CASE WHEN m > 0 THEN prob_present * 0.5 + num_split_reads / m * 0.3 + clean * 0.2 ELSE prob_present * 0.7 + clean * 0.3 END AS score
  FROM (SELECT *, max(num_split_reads) OVER (PARTITION BY regions) AS m, 1 - coalesce(CASE WHEN NOT isnan(prob_artifact) THEN prob_artifact END, 0) AS clean FROM {_OV} WHERE circle_length >= 100 AND regions IS NOT NULL {{more}})),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY regions ORDER BY score DESC NULLS LAST, rec_id) = 1)"""
_RE = r"^\s*([^:\s]+):(\d+)-(\d+)(_[+-])?\s*$"
_CIRCLES = f"""{_BEST.format(more='AND segment_count IS NOT NULL')},
listed AS (SELECT *, [trim(x) FOR x IN string_split_regex(trim(regions), '[;,]+') IF trim(x) <> ''] AS items FROM best),
used AS (SELECT *, CASE WHEN segment_count = 1 THEN items[1:1] ELSE items END AS parts FROM listed),
circles AS (SELECT * FROM used WHERE len(parts) > 0 AND len([x FOR x IN parts IF NOT regexp_matches(x, '{_RE}')]) = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY segment_count = 1 ORDER BY regions) AS no FROM circles),
segs AS (SELECT *, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM numbered),
cut AS (SELECT *, regexp_extract(part, '{_RE}', 1) AS chr, CAST(regexp_extract(part, '{_RE}', 2) AS BIGINT) AS s, CAST(regexp_extract(part, '{_RE}', 3) AS BIGINT) AS e FROM segs)"""
_PLACE = "chr, least(s, e) - 1 AS start0, greatest(s, e) AS end0, CASE WHEN s <= e THEN '+' ELSE '-' END AS strand, circle_length AS length"
_ROLE = "CASE WHEN i = 1 THEN 'head' WHEN i = len(parts) THEN 'tail' ELSE 'middle' END"
CHIMERIC_SQL = f"""raw AS (SELECT *, CASE WHEN trim(chr) <> '' THEN 'chr' || regexp_replace(upper(trim(chr)), '^CHR', '') END AS c FROM {once_sql('inferred_chimeric')}),
seg AS (SELECT circle_no AS id, row_number() OVER (PARTITION BY circle_no ORDER BY seg_index) - 1 AS seg, count(*) OVER (PARTITION BY circle_no) AS segs, c AS chr, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0,
  strand, length, num_split_reads, copy_number FROM raw QUALIFY NOT max(c IS NULL OR start0 IS NULL OR end0 IS NULL) OVER (PARTITION BY circle_no))"""


def _recip(a0: str, a1: str, b0: str, b1: str) -> str:
    ov = f"(least({a1}, {b1}) - greatest({a0}, {b0}))"
    return f"({ov} > 0 AND ((abs({a0} - {b0}) <= 20 AND abs({a1} - {b1}) <= 20) OR ({ov} / greatest({a1} - {a0}, 1) >= 0.99 AND {ov} / greatest({b1} - {b0}, 1) >= 0.99)))"


_SEGPAIRS = f"""{CHIMERIC_SQL}, pairs AS (SELECT a.id, a.seg AS i, a.segs AS n, b.id AS match, b.seg AS j, b.segs AS m, a.strand = b.strand AS same, a.strand = translate(b.strand, '+-', '-+') AS opposite
  FROM seg a JOIN seg b ON a.chr = b.chr AND a.id <> b.id AND {_recip('a.start0', 'a.end0', 'b.start0', 'b.end0')}),
fwd AS (SELECT id, match FROM pairs WHERE n = m AND same GROUP BY id, match, n, (j - i + n) % n HAVING count(DISTINCT i) = n),
rev AS (SELECT id, match FROM pairs WHERE n = m AND opposite GROUP BY id, match, n, (j + i) % n HAVING count(DISTINCT i) = n),
part AS (SELECT id, match FROM pairs WHERE n < m GROUP BY id, match, n HAVING count(DISTINCT i) FILTER (same) = n OR count(DISTINCT i) FILTER (opposite) = n),
full_m AS (SELECT * FROM fwd UNION SELECT * FROM rev),
gone AS (SELECT id, min(match) AS match FROM (SELECT * FROM full_m UNION SELECT * FROM part) WHERE match < id GROUP BY id)"""
_SIMPAIRS = f"""{SIMPLE_SQL}, hits AS (SELECT a.id, arg_min(b.id, b.start0 * 1000000000 + b.id) AS match FROM iv a JOIN iv b ON a.chr = b.chr AND b.id < a.id AND a.sample IS NOT NULL AND b.sample IS NOT NULL
  AND {_recip('a.start0', 'a.end0', 'b.start0', 'b.end0')} GROUP BY a.id)"""
_CORECHR = r"'chr' || regexp_replace(upper(trim(chr)), '^CHR', '')"

SQL = {
    "f11_long_circles": f"SELECT rec_id FROM {_OV} WHERE circle_length >= 100",
    "f13_malformed_regions": f"WITH {_CIRCLES} SELECT rec_id FROM {_OV} WHERE circle_length >= 100 AND rec_id NOT IN (SELECT rec_id FROM circles)",
    "a24_best_duplicates": f"WITH {_BEST.format(more='')} SELECT rec_id, {fixed_sql('score', 6)} AS score FROM best",
    "q8_simple": f"WITH {_CIRCLES} SELECT 'IUeccDNA' || no AS eccDNA_id, {_PLACE}, num_split_reads FROM cut WHERE segment_count = 1",
    "q8_chimeric": f"WITH {_CIRCLES} SELECT 'ICeccDNA' || no AS eccDNA_id, {_PLACE}, i AS seg_index, len(parts) AS seg_total, {_ROLE} AS junction_role, num_split_reads FROM cut WHERE segment_count <> 1",
    "f12_chimeric_filter": f"WITH {_CIRCLES} SELECT 'ICeccDNA' || no AS eccDNA_id, i AS seg_index, len(parts) AS seg_total, num_split_reads FROM cut WHERE segment_count <> 1 AND (len(parts) >= 3 OR (len(parts) = 2 AND num_split_reads >= 5))",
    "j10_simple_redundant": f"WITH {_SIMPAIRS} SELECT id, match FROM hits",
    "j11_simple_in_chimeric": f"""WITH {CHIMERIC_SQL}, core AS (SELECT rec_id, eccdna_type, state, {_CORECHR} AS chr, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0 FROM {once_sql('ecc_core')} WHERE start0 IS NOT NULL AND end0 IS NOT NULL AND trim(chr) <> ''),
      known AS (SELECT rec_id AS match, 0 AS kind, chr, start0 AS s, end0 AS e FROM core WHERE eccdna_type = 'Uecc' AND state = 'Confirmed' UNION ALL SELECT id, 1, chr, start0, end0 FROM seg)
      SELECT rec_id AS id, match, kind FROM core JOIN known ON core.chr = known.chr AND {_recip('start0', 'end0', 's', 'e')} WHERE state = 'Inferred'
      QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY kind, s, match) = 1""",
    "j12_chimeric_equal": f"WITH {_SEGPAIRS} SELECT id, min(match) AS match FROM full_m WHERE match < id GROUP BY id",
    "j13_chimeric_part": f"WITH {_SEGPAIRS} SELECT id, min(match) AS match FROM part GROUP BY id",
    "j14_chimeric_exact": f"WITH {CHIMERIC_SQL}, r AS (SELECT id, id % 2 AS off, string_agg(chr || ':' || start0 || '-' || end0, ';' ORDER BY seg) AS regions, string_agg(chr || ':' || (start0 + id % 2) || '-' || end0, ';' ORDER BY seg) AS other FROM seg GROUP BY id) SELECT a.id, min(b.id) + 1000000000 AS match FROM r a JOIN r b ON a.regions = b.other GROUP BY a.id",
    "j15_chimeric_unstranded": f"WITH {_SEGPAIRS}, u AS (SELECT id, match FROM pairs WHERE n = m GROUP BY id, match, n, (j - i + n) % n HAVING count(DISTINCT i) = n) SELECT id, min(match) AS match FROM u WHERE match < id GROUP BY id",
    "q9_chimeric_kept": f"""WITH {_SEGPAIRS} SELECT id, string_agg(chr || ':' || start0 || '-' || end0, ';' ORDER BY seg) AS regions, string_agg(strand, ';' ORDER BY seg) AS strands, max(segs) AS seg_total, max(length) AS length,
      max(num_split_reads) AS hit_count, CASE WHEN max(copy_number) > 0 THEN CAST(max(copy_number) AS DOUBLE) ELSE 1.0 END AS copy_number FROM seg WHERE id NOT IN (SELECT id FROM gone) GROUP BY id""",
    "j24_evidence_of_redundant": f"WITH {_SIMPAIRS} SELECT match, CAST(sum(copy_number) AS BIGINT) AS more_copies, CAST(sum(num_split_reads) AS BIGINT) AS more_reads, count(*) AS inferred FROM hits JOIN iv USING (id) GROUP BY match",
    "t7_renumbered": f"""WITH {SIMPLE_SQL}, t AS (SELECT coalesce(max(TRY_CAST(regexp_extract(eccDNA_id, '^UeccDNA([0-9]+)$', 1) AS BIGINT)), 0) AS top FROM {once_sql('ecc_core')} WHERE state = 'Confirmed' AND eccdna_type = 'Uecc')
      SELECT id, 'UeccDNA' || (top + row_number() OVER (ORDER BY id)) AS eccDNA_id FROM iv, t WHERE sample IS NOT NULL""",
    "a25_overlap_statistics": f"WITH {_SEGPAIRS}, n AS (SELECT count(DISTINCT id) AS total FROM seg), g AS (SELECT count(*) AS redundant FROM gone) SELECT total, redundant, total - redundant AS kept, {fixed_sql('CASE WHEN total > 0 THEN redundant / total * 100 ELSE 0 END', 2)} AS percent FROM n, g",
}
