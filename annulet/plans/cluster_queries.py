"""Cluster signatures, representatives, merged evidence, windows over segments, reports and deliverables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import clusters as K
from annulet.operators import curate
from annulet.operators.numbering import numbered
from annulet.plans.base import fixed, fixed_sql, once, once_sql
from annulet.plans.inferred_queries import CHIMERIC_SQL, segments
from annulet.plans.interval_queries import SIMPLE_SQL, simple_circles


def _core(spark: SparkSession, d: str) -> DataFrame:
    return K.cleaned(once(spark, d, "ecc_core"))


def a15_location_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Circles at the same place: copies, reads and samples together; clusters are numbered along their key."""
    rows = simple_circles(spark, d).where("sample is not null").withColumn("key", S.region(F.col("chr"), F.col("start0"), F.col("end0")))
    groups = rows.groupBy("key").agg(F.count("*").alias("size"), F.sum("copy_number").alias("copies"), F.sum("num_split_reads").alias("reads"), F.countDistinct("sample").alias("samples"), F.min("id").alias("first_id"))
    return numbered(groups, ["key"], "cluster")


def a16_set_signatures(spark: SparkSession, d: str) -> DataFrame:
    return K.set_key(segments(spark, d)).groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("first_id"))


def a17_ring_signatures(spark: SparkSession, d: str) -> DataFrame:
    return K.order_key(segments(spark, d)).groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("first_id"))


def a18_representatives(spark: SparkSession, d: str) -> DataFrame:
    return K.representatives(_core(spark, d), "length", "copies").select("cluster", "rec_id")


def a18_representatives_m(spark: SparkSession, d: str) -> DataFrame:
    return K.representatives(_core(spark, d).where("eccdna_type = 'Mecc'"), "copies", "length").select("cluster", "rec_id")


def a19_merged_evidence(spark: SparkSession, d: str) -> DataFrame:
    e = K.merged_evidence(_core(spark, d))
    return e.select("cluster", "size", "ids", "mapq_best", "mapq_min", fixed(F.col("identity_best"), 2).alias("identity_best"), fixed(F.col("identity_min"), 2).alias("identity_min"),
                    fixed(F.col("confidence"), 3).alias("confidence"), fixed(F.col("copies"), 2).alias("copies"), "strand", "reads", "low_mapq", "low_identity")


def a21_merged_reads(spark: SparkSession, d: str) -> DataFrame:
    reads = K.read_rows(_core(spark, d))
    return reads.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list("read")), ";").alias("reads"))


def a37_cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    sizes = _core(spark, d).groupBy("cluster").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("clusters"))


def t5_cluster_numbers(spark: SparkSession, d: str) -> DataFrame:
    """New identifiers per ring type along the clusters' names as strings."""
    names = _core(spark, d).groupBy("cluster").agg(F.min("eccdna_type").alias("kind"))
    out = None
    for kind in ("Uecc", "Mecc", "Cecc"):
        part = numbered(names.where(F.col("kind") == kind), ["cluster"], "_no").select("cluster", F.concat(F.lit(f"{kind}DNA"), F.col("_no").cast("string")).alias("eccDNA_id"))
        out = part if out is None else out.unionByName(part)
    return out


def t1_natural_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of each call of a cluster in the natural order of its identifier: letters, then number."""
    rows = _core(spark, d).withColumns({"prefix": F.regexp_extract("ecc_id", r"^(\D*)", 1), "no": F.regexp_extract("ecc_id", r"(\d+)$", 1).try_cast("bigint")})
    w = Window.partitionBy("cluster").orderBy(F.asc_nulls_last("prefix"), F.asc_nulls_last("no"), "rec_id")
    return rows.select("cluster", "rec_id", F.row_number().over(w).alias("place"))


def t3_type_and_state_order(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("eccdna_type") == "Uecc", 0).when(F.col("eccdna_type") == "Mecc", 1).otherwise(2)
    state = F.when(F.col("state") == "Confirmed", 0).otherwise(1)
    rows = _core(spark, d).select("rec_id", kind.alias("k"), state.alias("s"))
    return numbered(rows, ["k", "s", "rec_id"], "place").select("rec_id", "place")


def t6_padded_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = numbered(_core(spark, d).where("state = 'Confirmed'").select("rec_id"), ["rec_id"], "_no")
    return rows.select("rec_id", F.format_string("ecc%04d", F.col("_no")).alias("name"))


def w1_hit_index(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("cluster")
    rows = _core(spark, d).where("start0 is not null")
    return rows.select("cluster", "rec_id", F.row_number().over(w.orderBy("start0", "rec_id")).alias("hit_index"), F.count("*").over(w).alias("hit_count"))


def w2_segment_rank(spark: SparkSession, d: str) -> DataFrame:
    """Segments by their start within the circle, with their role there."""
    w = Window.partitionBy("id")
    rows = segments(spark, d).withColumn("seg_index", F.row_number().over(w.orderBy("start0", "seg")))
    return rows.select("id", "seg", "seg_index", "segs", curate.role("seg_index", "segs").alias("junction_role"))


def w6_primary(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("cluster").orderBy(F.desc_nulls_last("mapq_best"), "rec_id")
    return _core(spark, d).select("rec_id", F.when(F.row_number().over(w) == 1, "primary").otherwise("candidate").alias("role"))


def w7_junctions(spark: SparkSession, d: str) -> DataFrame:
    """BEDPE junctions between a circle's consecutive segments; no closing edge."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = segments(spark, d).withColumns({"chr2": F.lead("chr").over(w), "s2": F.lead("start0").over(w), "st2": F.lead("strand").over(w)}).where("chr2 is not null")
    return rows.select(F.col("chr").alias("chr1"), (F.col("end0") - 1).alias("start1"), F.col("end0").alias("end1"), "chr2", F.col("s2").alias("start2"), (F.col("s2") + 1).alias("end2"),
                       F.concat_ws("|", F.col("id").cast("string"), F.concat(F.lit("J"), (F.col("seg") + 1).cast("string"))).alias("name"), F.col("strand").alias("strand1"), F.col("st2").alias("strand2"))


def w8_collapsed_runs(spark: SparkSession, d: str) -> DataFrame:
    """Segments that open a run of one chromosome."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = segments(spark, d).withColumn("before", F.lag("chr").over(w))
    return rows.where("before is null or before <> chr").select("id", "seg", "chr")


def w9_first_return(spark: SparkSession, d: str) -> DataFrame:
    """The first later segment on the chromosome of the first one."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = segments(spark, d).withColumn("start_chr", F.first("chr").over(w))
    return rows.where("seg > 0 and chr = start_chr").groupBy("id").agg(F.min("seg").alias("returns_at"))


def w11_unbroken_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Segments before the first change of strand."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = segments(spark, d).withColumn("failed", F.when(F.lag("strand").over(w) != F.col("strand"), 1).otherwise(0))
    rows = rows.withColumn("any", F.max("failed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("any = 0").select("id", "seg")


def g6_strand_closure(spark: SparkSession, d: str) -> DataFrame:
    """A circle closes if its strand flips an even number of times on the way round."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = segments(spark, d).withColumn("next", F.coalesce(F.lead("strand").over(w), F.first("strand").over(w)))
    return rows.groupBy("id").agg((F.sum(F.when(F.col("next") != F.col("strand"), 1).otherwise(0)) % 2 == 0).alias("closed"))


def g15_jitter_groups(spark: SparkSession, d: str) -> DataFrame:
    return K.jitter_groups(segments(spark, d))


def a22_jitter_merge(spark: SparkSession, d: str) -> DataFrame:
    """Groups of circles within the jitter: the one with most split reads stands for them, their evidence adds up."""
    facts = segments(spark, d).where("seg = 0").select("id", "num_split_reads", "copy_number")
    rows = K.jitter_groups(segments(spark, d)).join(facts, "id")
    out = rows.groupBy("group").agg(F.max(F.struct("num_split_reads", (-F.col("id")).alias("m"))).alias("b"), F.count("*").alias("merged"), F.sum("copy_number").alias("copies"))
    return out.select((-F.col("b.m")).alias("id"), "merged", "copies")


def u7_tolerant_distinct(spark: SparkSession, d: str) -> DataFrame:
    return K.tolerant_distinct(segments(spark, d))


def a23_confirmed_table(spark: SparkSession, d: str) -> DataFrame:
    """One row per confirmed cluster: its places (``|`` between), strand, hits and best evidence."""
    rows = _core(spark, d).where("state = 'Confirmed' and chr is not null and start0 is not null and end0 is not null")
    one = F.struct("chr", "start0", "end0", S.region(F.col("chr"), F.col("start0"), F.col("end0")).alias("r"))
    out = rows.groupBy("cluster").agg(F.array_sort(F.collect_set(one)).alias("s"), F.count("*").alias("hit_count"), F.max("confidence").alias("c"), F.max("length").alias("length"))
    return out.select("cluster", F.array_join(F.transform("s", lambda x: x["r"]), "|").alias("regions"), "hit_count", fixed(F.col("c"), 3).alias("confidence"), "length")


def a26_length_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of all calls and of each type in one pass of grouping sets."""
    rows = _core(spark, d).where("length is not null").select("eccdna_type", "length")
    out = rows.groupingSets([[], [F.col("eccdna_type")]], F.col("eccdna_type")).agg(
        F.grouping("eccdna_type").alias("g"), F.count("*").alias("n"), F.min("length").alias("least"), F.max("length").alias("most"), fixed(F.avg("length"), 1).alias("mean"),
        fixed(F.median("length"), 1).alias("median"), F.mode("length", True).alias("mode"), fixed(F.stddev_pop("length"), 2).alias("std"),
    )
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("eccdna_type")).alias("kind"), "n", "least", "most", "mean", "median", "mode", "std")


def a38_circle_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = segments(spark, d)
    one = F.struct("seg", S.region(F.col("chr"), F.col("start0"), F.col("end0")).alias("r"))
    out = rows.groupBy("id").agg(F.array_sort(F.collect_list(one)).alias("s"), F.countDistinct("chr").alias("chrs"), F.max("segs").alias("segment_count"), F.max("length").alias("length"), F.first("chr").alias("any_chr"))
    return out.select("id", F.when(F.col("chrs") > 1, "multi").otherwise(F.col("any_chr")).alias("chr"), F.array_join(F.transform("s", lambda x: x["r"]), ";").alias("regions"), "segment_count", "length",
                      F.when(F.col("chrs") > 1, "Inter-chr").otherwise("Intra-chr").alias("class"))


def s21_bed(spark: SparkSession, d: str) -> DataFrame:
    """BED6 of confirmed single-locus calls."""
    rows = _core(spark, d).where("eccdna_type = 'Uecc' and state = 'Confirmed' and chr is not null and start0 < end0")
    return rows.select("chr", "start0", "end0", F.concat_ws("|", "cluster", F.col("rec_id").cast("string")).alias("name"), F.coalesce(fixed(F.col("confidence") * 1000, 0), F.lit(0)).alias("score"), F.coalesce("strand", F.lit(".")).alias("strand"))


QUERIES = {f.__name__: f for f in (
    a15_location_clusters, a16_set_signatures, a17_ring_signatures, a18_representatives, a18_representatives_m, a19_merged_evidence, a21_merged_reads, a37_cluster_sizes,
    t5_cluster_numbers, t1_natural_order, t3_type_and_state_order, t6_padded_numbers, w1_hit_index, w2_segment_rank, w6_primary, w7_junctions, w8_collapsed_runs, w9_first_return,
    w11_unbroken_prefix, g6_strand_closure, g15_jitter_groups, a22_jitter_merge, u7_tolerant_distinct, a23_confirmed_table, a26_length_statistics, a38_circle_summary, s21_bed,
)}

_MISS = ", ".join(f"'{x}'" for x in K.MISSING)
_P = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ({_MISS}) THEN trim({c}) END"
_NUM = lambda c: f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN {c} END"
_CORE = f"""core AS (SELECT * FROM (SELECT rec_id, upper({_P('cluster_id')}) AS cluster, {_P('eccDNA_id')} AS ecc_id, {_P('chr')} AS chr, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0,
  CASE WHEN trim(strand) IN ('+', '-') THEN trim(strand) END AS strand, CAST({_NUM('length')} AS BIGINT) AS length, eccdna_type, {_P('state')} AS state, reads,
  CASE WHEN copy_number > 0 AND NOT isnan(copy_number) THEN copy_number END AS copies, mapq_best, {_NUM('identity_best')} AS identity_best, {_NUM('confidence_score')} AS confidence FROM {once_sql('ecc_core')}) WHERE cluster IS NOT NULL)"""
_READS = r"""reads AS (SELECT DISTINCT cluster, unnest(regexp_extract_all(reads, 'm[0-9]+_[0-9]+_[0-9]+_s[0-9]+/[0-9]+/ccs')) AS read FROM core)"""
_REG = "chr || ':' || start0 || '-' || end0"
_ARR = f"arrs AS (SELECT id, list({_REG} ORDER BY seg) AS a, list({_REG} ORDER BY chr, start0, end0) AS sorted FROM seg GROUP BY id)"
_TURNS = lambda a: f"[array_to_string(list_concat({a}[i + 1:], {a}[1:i]), ';') FOR i IN range(len({a}))]"
_JITTER = f"""{CHIMERIC_SQL}, pairs AS (SELECT a.id AS x, b.id AS y, a.segs AS n, count(DISTINCT a.seg) AS p, count(DISTINCT b.seg) AS q FROM seg a JOIN seg b ON a.chr = b.chr AND a.id <> b.id AND a.segs = b.segs
  AND abs(a.start0 - b.start0) <= 10 AND abs(a.end0 - b.end0) <= 10 AND a.start0 < b.end0 AND b.start0 < a.end0 GROUP BY a.id, b.id, a.segs HAVING p = n AND q = n),
reach AS (SELECT DISTINCT id AS x, id AS y FROM seg UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON pairs.x = reach.y),
grp AS (SELECT x AS id, min(y) AS "group" FROM reach GROUP BY x)"""
_STATS = f"count(*) AS n, min(length) AS least, max(length) AS most, {fixed_sql('avg(length)', 1)} AS mean, {fixed_sql('median(length)', 1)} AS median, any_value(mode) AS mode, {fixed_sql('stddev_pop(length)', 2)} AS std"
_MODES = """lens AS (SELECT eccdna_type AS kind, length FROM core WHERE length IS NOT NULL UNION ALL SELECT 'all', length FROM core WHERE length IS NOT NULL),
modes AS (SELECT kind, length AS mode FROM (SELECT kind, length, count(*) AS c FROM lens GROUP BY kind, length) QUALIFY row_number() OVER (PARTITION BY kind ORDER BY c DESC, length) = 1)"""

SQL = {
    "a15_location_clusters": f"""WITH {SIMPLE_SQL} SELECT {_REG} AS key, count(*) AS size, CAST(sum(copy_number) AS BIGINT) AS copies, CAST(sum(num_split_reads) AS BIGINT) AS reads, count(DISTINCT sample) AS samples, min(id) AS first_id,
      row_number() OVER (ORDER BY {_REG}) AS cluster FROM iv WHERE sample IS NOT NULL GROUP BY {_REG}""",
    "a16_set_signatures": f"WITH {CHIMERIC_SQL}, {_ARR} SELECT array_to_string(sorted, ';') AS key, count(*) AS size, min(id) AS first_id FROM arrs GROUP BY 1",
    "a18_representatives": f"WITH {_CORE} SELECT cluster, rec_id FROM core QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY coalesce(state = 'Confirmed', FALSE) DESC, length DESC NULLS LAST, copies DESC NULLS LAST, rec_id) = 1",
    "a18_representatives_m": f"WITH {_CORE} SELECT cluster, rec_id FROM core WHERE eccdna_type = 'Mecc' QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY coalesce(state = 'Confirmed', FALSE) DESC, copies DESC NULLS LAST, length DESC NULLS LAST, rec_id) = 1",
    "a19_merged_evidence": f"""WITH {_CORE}, {_READS}, c AS (SELECT cluster, sum(copies) AS copies FROM (SELECT DISTINCT cluster, ecc_id, copies FROM core WHERE copies IS NOT NULL AND ecc_id IS NOT NULL) GROUP BY cluster),
      s AS (SELECT cluster, strand FROM core WHERE strand IS NOT NULL GROUP BY cluster, strand QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, strand = '+' DESC) = 1), r AS (SELECT cluster, count(*) AS reads FROM reads GROUP BY cluster)
      SELECT core.cluster, count(*) AS size, count(DISTINCT ecc_id) AS ids, max(mapq_best) AS mapq_best, min(mapq_best) AS mapq_min, {fixed_sql('max(identity_best)', 2)} AS identity_best, {fixed_sql('min(identity_best)', 2)} AS identity_min,
      {fixed_sql('max(confidence)', 3)} AS confidence, {fixed_sql('any_value(c.copies)', 2)} AS copies, any_value(s.strand) AS strand, coalesce(any_value(r.reads), 0) AS reads, max(mapq_best) < 20 AS low_mapq, max(identity_best) < 95 AS low_identity
      FROM core LEFT JOIN c USING (cluster) LEFT JOIN s ON s.cluster = core.cluster LEFT JOIN r ON r.cluster = core.cluster GROUP BY core.cluster""",
    "a21_merged_reads": f"WITH {_CORE}, {_READS} SELECT cluster, string_agg(read, ';' ORDER BY read) AS reads FROM reads GROUP BY cluster",
    "a37_cluster_sizes": f"WITH {_CORE} SELECT size, count(*) AS clusters FROM (SELECT cluster, count(*) AS size FROM core GROUP BY cluster) GROUP BY size",
    "t5_cluster_numbers": f"WITH {_CORE}, n AS (SELECT cluster, min(eccdna_type) AS kind FROM core GROUP BY cluster) SELECT cluster, kind || 'DNA' || row_number() OVER (PARTITION BY kind ORDER BY cluster) AS eccDNA_id FROM n",
    "t1_natural_order": f"WITH {_CORE} SELECT cluster, rec_id, row_number() OVER (PARTITION BY cluster ORDER BY regexp_extract(ecc_id, '^([^0-9]*)', 1) NULLS LAST, TRY_CAST(regexp_extract(ecc_id, '([0-9]+)$', 1) AS BIGINT) NULLS LAST, rec_id) AS place FROM core",
    "t3_type_and_state_order": f"WITH {_CORE} SELECT rec_id, row_number() OVER (ORDER BY CASE eccdna_type WHEN 'Uecc' THEN 0 WHEN 'Mecc' THEN 1 ELSE 2 END, CASE WHEN state = 'Confirmed' THEN 0 ELSE 1 END, rec_id) AS place FROM core",
    "t6_padded_numbers": f"WITH {_CORE} SELECT rec_id, printf('ecc%04d', row_number() OVER (ORDER BY rec_id)) AS name FROM core WHERE state = 'Confirmed'",
    "w1_hit_index": f"WITH {_CORE} SELECT cluster, rec_id, row_number() OVER (PARTITION BY cluster ORDER BY start0, rec_id) AS hit_index, count(*) OVER (PARTITION BY cluster) AS hit_count FROM core WHERE start0 IS NOT NULL",
    "w2_segment_rank": f"""WITH {CHIMERIC_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY start0, seg) AS seg_index FROM seg)
      SELECT id, seg, seg_index, segs, CASE WHEN seg_index = 1 THEN 'head' WHEN seg_index = segs THEN 'tail' ELSE 'middle' END AS junction_role FROM r""",
    "w6_primary": f"WITH {_CORE} SELECT rec_id, CASE WHEN row_number() OVER (PARTITION BY cluster ORDER BY mapq_best DESC NULLS LAST, rec_id) = 1 THEN 'primary' ELSE 'candidate' END AS role FROM core",
    "w7_junctions": f"""WITH {CHIMERIC_SQL}, l AS (SELECT *, lead(chr) OVER w AS chr2, lead(start0) OVER w AS s2, lead(strand) OVER w AS strand2 FROM seg WINDOW w AS (PARTITION BY id ORDER BY seg))
      SELECT chr AS chr1, end0 - 1 AS start1, end0 AS end1, chr2, s2 AS start2, s2 + 1 AS end2, id || '|J' || (seg + 1) AS name, strand AS strand1, strand2 FROM l WHERE chr2 IS NOT NULL""",
    "w8_collapsed_runs": f"WITH {CHIMERIC_SQL} SELECT id, seg, chr FROM seg QUALIFY coalesce(lag(chr) OVER (PARTITION BY id ORDER BY seg) <> chr, TRUE)",
    "w9_first_return": f"WITH {CHIMERIC_SQL}, f AS (SELECT id, chr AS c FROM seg WHERE seg = 0) SELECT id, min(seg) AS returns_at FROM seg JOIN f USING (id) WHERE seg > 0 AND chr = c GROUP BY id",
    "w11_unbroken_prefix": f"WITH {CHIMERIC_SQL}, l AS (SELECT id, seg, lag(strand) OVER (PARTITION BY id ORDER BY seg) <> strand AS broken FROM seg), b AS (SELECT id, min(seg) AS stop FROM l WHERE broken GROUP BY id) SELECT l.id, seg FROM l LEFT JOIN b USING (id) WHERE stop IS NULL OR seg < stop",
    "g6_strand_closure": f"WITH {CHIMERIC_SQL}, f AS (SELECT id, strand, coalesce(lead(strand) OVER (PARTITION BY id ORDER BY seg), first(strand) OVER (PARTITION BY id ORDER BY seg)) AS nxt FROM seg) SELECT id, count(*) FILTER (nxt <> strand) % 2 = 0 AS closed FROM f GROUP BY id",
    "a17_ring_signatures": f"WITH {CHIMERIC_SQL}, {_ARR} SELECT list_min(list_concat({_TURNS('a')}, {_TURNS('list_reverse(a)')})) AS key, count(*) AS size, min(id) AS first_id FROM arrs GROUP BY 1",
    "g15_jitter_groups": f"WITH RECURSIVE {_JITTER} SELECT id, \"group\" FROM grp",
    "a22_jitter_merge": f"WITH RECURSIVE {_JITTER} SELECT arg_max(id, CAST(num_split_reads AS BIGINT) * 1000000000 - id) AS id, count(*) AS merged, CAST(sum(copy_number) AS BIGINT) AS copies FROM grp JOIN (SELECT id, num_split_reads, copy_number FROM seg WHERE seg = 0) USING (id) GROUP BY \"group\"",
    "a23_confirmed_table": f"""WITH {_CORE}, u AS (SELECT * FROM core WHERE state = 'Confirmed' AND chr IS NOT NULL AND start0 IS NOT NULL AND end0 IS NOT NULL), r AS (SELECT cluster, string_agg({_REG}, '|' ORDER BY chr, start0, end0) AS regions FROM (SELECT DISTINCT cluster, chr, start0, end0 FROM u) GROUP BY cluster)
      SELECT cluster, any_value(regions) AS regions, count(*) AS hit_count, {fixed_sql('max(confidence)', 3)} AS confidence, max(length) AS length FROM u JOIN r USING (cluster) GROUP BY cluster""",
    "a26_length_statistics": f"WITH {_CORE}, {_MODES} SELECT kind, {_STATS} FROM lens JOIN modes USING (kind) GROUP BY kind",
    "a38_circle_summary": f"""WITH {CHIMERIC_SQL} SELECT id, CASE WHEN count(DISTINCT chr) > 1 THEN 'multi' ELSE any_value(chr) END AS chr, string_agg({_REG}, ';' ORDER BY seg) AS regions, max(segs) AS segment_count, max(length) AS length,
      CASE WHEN count(DISTINCT chr) > 1 THEN 'Inter-chr' ELSE 'Intra-chr' END AS class FROM seg GROUP BY id""",
    "s21_bed": f"WITH {_CORE} SELECT chr, start0, end0, cluster || '|' || rec_id AS name, coalesce({fixed_sql('confidence * 1000', 0)}, 0) AS score, coalesce(strand, '.') AS strand FROM core WHERE eccdna_type = 'Uecc' AND state = 'Confirmed' AND chr IS NOT NULL AND start0 < end0",
}
