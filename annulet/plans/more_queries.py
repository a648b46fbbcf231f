"""Further operators over whole tables: self-joins, coverage, best sites, schema checks, set operations and BED forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import classify, clusters, graph, intervals as I, tandem
from annulet.operators.numbering import numbered
from annulet.plans import alignment_queries as A, cluster_queries as K, inferred_queries as Q, ring_queries as R, tandem_queries as T
from annulet.plans.base import fixed, fixed_sql, once, once_sql
from annulet.plans.interval_queries import SIMPLE_SQL, simple_circles


def _prep(spark: SparkSession, d: str) -> DataFrame:
    return classify.prepared(once(spark, d, "alignments", *A.COLUMNS))


def j17_tandem_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of repeats of one read that share more than 50 positions."""
    rows = tandem.good(once(spark, d, "tandem", "readName", "start", "end", "readLen", "aveMatch"))
    a = rows.select("readName", F.col("rec_id").alias("rec_a"), F.col("start").alias("s1"), (F.col("end") + 1).alias("e1"))
    b = rows.select("readName", F.col("rec_id").alias("rec_b"), F.col("start").alias("s2"), (F.col("end") + 1).alias("e2"))
    return I.overlap_join(a, b, ["readName"], ("s1", "e1"), ("s2", "e2"), shared=51).where("rec_a < rec_b").select("rec_a", "rec_b", "overlap")


def a14_distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return _prep(spark, d).agg(F.count("*").alias("alignments"), F.countDistinct("query_id").alias("queries"), F.countDistinct("read").alias("reads"), F.countDistinct("chr").alias("chromosomes"))


def a32_majority_strand(spark: SparkSession, d: str) -> DataFrame:
    """The strand most alignments of a query have, + on a tie."""
    vote = F.sum(F.when(F.col("strand") == "+", 1).otherwise(-1))
    return _prep(spark, d).groupBy("query_id").agg(F.when(vote >= 0, "+").otherwise("-").alias("strand"))


def a34_query_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Positions of the query that its alignments cover, overlaps once."""
    rows = I.islands(R.doubled(spark, d).select("query_id", "aln_id", "qs", "qe"), ["query_id"], "qs", "qe", ["aln_id"])
    spans = rows.groupBy("query_id", "island").agg((F.max("qe") - F.min("qs")).alias("n"))
    return spans.groupBy("query_id").agg(F.sum("n").alias("covered"))


def a35_best_site(spark: SparkSession, d: str) -> DataFrame:
    """The best site of a query by score where any score counts, else by length."""
    rows = _prep(spark, d).withColumn("score", F.coalesce(F.nanvl("bit_score", F.lit(0.0)), F.lit(0.0)))
    best = rows.groupBy("query_id").agg(F.max("score").alias("top"), F.max(F.struct("score", (-F.col("aln_id")).alias("m"))).alias("s"), F.max(F.struct("alignment_length", (-F.col("aln_id")).alias("m"))).alias("l"), F.count("*").alias("hit_count"))
    return best.select("query_id", F.when(F.col("top") != 0, -F.col("s.m")).otherwise(-F.col("l.m")).alias("aln_id"), "hit_count")


def a41_ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Chromosomes of a circle in the order they are first seen, joined by ``;``."""
    first = Q.segments(spark, d).groupBy("id", "chr").agg(F.min("seg").alias("seg"))
    return first.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "chr"))), lambda x: x["chr"]), ";").alias("chrs"))


def x3_query_intervals(spark: SparkSession, d: str) -> DataFrame:
    q = S.query_interval(F.col("q_start"), F.col("q_end"), F.lit(False))
    return once(spark, d, "alignments", "q_start", "q_end").select("aln_id", q["s"].alias("s"), q["e"].alias("e"))


def x19_near_or_overlapping(spark: SparkSession, d: str) -> DataFrame:
    """Whether neighbouring segments of a circle overlap, and whether they lie within 50 of each other."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = Q.segments(spark, d).withColumns({"c2": F.lead("chr").over(w), "s2": F.lead("start0").over(w), "e2": F.lead("end0").over(w)}).where("c2 = chr")
    args = (F.col("start0"), F.col("end0"), F.col("s2"), F.col("e2"))
    return rows.select("id", "seg", S.overlaps(*args).alias("overlaps"), S.both_within(*args, 50).alias("near"))


def x21_cs_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts in short cs strings made of an alignment's mismatches and gap openings."""
    rows = once(spark, d, "alignments", "mismatches", "gap_opens")
    cs = F.concat(F.lit(":9"), F.repeat(F.lit("*ac:3"), F.col("mismatches")), F.repeat(F.lit("+tt:2"), F.col("gap_opens")))
    c = S.cs_counts(cs)
    return rows.select("aln_id", c["mismatches"].alias("mismatches"), c["gap_opens"].alias("gap_opens"))


def f10_supported_edges(spark: SparkSession, d: str) -> DataFrame:
    """Chromosome pairs that two or more circles pass from one to the other."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = Q.segments(spark, d).withColumn("dst", F.lead("chr").over(w)).where("dst is not null")
    return rows.groupBy(F.col("chr").alias("src"), "dst").agg(F.count("*").alias("n")).where("n >= 2")


def f19_standard_schema(spark: SparkSession, d: str) -> DataFrame:
    """Columns under their standard names, starts counted from 0."""
    names = {"readName": "reads", "repN": "repeat_id", "copyNum": "copy_number", "readLen": "read_length", "consLen": "length", "aveMatch": "match_degree", "start": "start0", "end": "end0"}
    rows = once(spark, d, "tandem", *names).withColumnsRenamed(names).withColumn("start0", F.col("start0") - 1)
    return rows.select("rec_id", "reads", "repeat_id", fixed(F.col("copy_number"), 2).alias("copy_number"), "read_length", "length", "start0", "end0")


def f20_known_ids(spark: SparkSession, d: str) -> DataFrame:
    """Chimeric segments whose circle is in the unified table (semi-join)."""
    return Q.segments(spark, d).join(Q.q9_chimeric_kept(spark, d).select("id"), "id", "left_semi").select("id", "seg")


def f22_partly_overlapping(spark: SparkSession, d: str) -> DataFrame:
    """Circles with two segments on a chromosome and strand that overlap only in part; every third has its first one again, half its length further."""
    rows = Q.segments(spark, d)
    half = F.floor((F.col("end0") - F.col("start0")) / 2)
    again = rows.where("id % 3 = 0 and seg = 0").withColumns({"start0": F.col("start0") + half, "end0": F.col("end0") + half, "seg": F.col("segs")})
    rows = rows.unionByName(again)
    a = rows.select("id", "chr", "strand", F.col("seg").alias("i"), F.col("start0").alias("s1"), F.col("end0").alias("e1"))
    b = rows.select("id", "chr", "strand", F.col("seg").alias("j"), F.col("start0").alias("s2"), F.col("end0").alias("e2"))
    pairs = I.overlap_join(a, b, ["id", "chr", "strand"], ("s1", "e1"), ("s2", "e2")).where("i < j")
    same = (F.col("overlap") >= 0.95 * (F.col("e1") - F.col("s1"))) & (F.col("overlap") >= 0.95 * (F.col("e2") - F.col("s2")))
    return pairs.where(~same).select("id").distinct()


def w3_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return K._core(spark, d).select("rec_id", F.count("*").over(Window.partitionBy("cluster")).alias("hit_count"))


def t2_first_of_each(spark: SparkSession, d: str) -> DataFrame:
    """The first repeat of every read by start."""
    rows = once(spark, d, "tandem", "readName", "start")
    return rows.groupBy("readName").agg(F.min_by("rec_id", F.struct("start", "rec_id")).alias("rec_id"))


def t4_two_best_loci(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("cov"), "locus")
    top = A._loci(spark, d).withColumn("n", F.row_number().over(w)).where("n <= 2")
    return top.select("query_id", "n", "locus", fixed(F.col("cov"), 6).alias("cov"))


def t8_by_priority(spark: SparkSession, d: str) -> DataFrame:
    """All reads with their place along the priority of their class, then their name."""
    classes = tandem.read_classes(tandem.rings(T._rows(spark, d)))
    priority = F.array_position(F.array(*map(F.lit, tandem.CLASSES)), F.col("readClass"))
    return numbered(classes.withColumn("priority", priority), ["priority", "readName"], "place").select("readName", "readClass", "place")


def u6_intersection(spark: SparkSession, d: str) -> DataFrame:
    reads = once(spark, d, "tandem", "readName").select("readName")
    aligned = once(spark, d, "alignments", "query_id").select(F.split("query_id", r"\|")[0].alias("readName"))
    return reads.intersect(aligned)


def j4_metadata_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Ring metadata by query id, else by read, else the defaults."""
    rows = once(spark, d, "tandem", "readName", "repN", "consLen", "copyNum").where("copyNum is not null")
    rows = rows.select(F.concat_ws("|", "readName", "repN", F.col("consLen").cast("string"), F.col("copyNum").cast("string"), F.lit("circular")).alias("id"), "rec_id", "readName", "consLen")
    full = rows.groupBy("id").agg(F.min(F.struct("rec_id", "consLen")).alias("f"))
    read = rows.groupBy("readName").agg(F.min(F.struct("rec_id", "consLen")).alias("r"))
    queries = _prep(spark, d).select("query_id", "read").distinct()
    out = queries.join(full, queries["query_id"] == full["id"], "left").join(read, queries["read"] == read["readName"], "left")
    return out.select("query_id", F.coalesce("f.consLen", "r.consLen", F.lit(0).cast("bigint")).alias("length"))


def j21_jitter_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of circles whose segments lie within 10 bases of each other, one to one."""
    from annulet.operators.unify import segment_matches

    rows = Q.segments(spark, d)
    pairs = segment_matches(rows, rows, share=2.0, tolerance=10).where("id < match and n = m")
    return pairs.groupBy("id", "match", "n").agg(F.countDistinct("i").alias("a"), F.countDistinct("j").alias("b")).where("a = n and b = n").select("id", "match")


def g12_read_components(spark: SparkSession, d: str) -> DataFrame:
    """Clusters linked by a shared read: components and their sizes."""
    rows = clusters.read_rows(K._core(spark, d)).withColumn("node", F.regexp_extract("cluster", r"(\d+)$", 1).cast("bigint"))
    first = rows.groupBy("read").agg(F.min("node").alias("dst"))
    edges = rows.join(first, "read").where("node <> dst").select(F.col("node").alias("src"), "dst")
    return graph.components(rows.select("node"), edges).groupBy("component").agg(F.count("*").alias("clusters"))


def g13_circular_components(spark: SparkSession, d: str) -> DataFrame:
    """Circles as graphs of their places: which close by the rules for one, two and more nodes."""
    w = Window.partitionBy("id").orderBy("seg")
    rows = Q.segments(spark, d).withColumn("node", F.col("id") * 1000 + F.col("seg"))
    edges = rows.withColumn("dst", F.coalesce(F.lead("node").over(w), F.first("node").over(w))).select(F.col("node").alias("src"), "dst")
    members = rows.select("node", F.col("id").alias("component"))
    return graph.circular(members, edges).groupBy("nodes", "cyclic").agg(F.count("*").alias("circles"))


def s20_segment_bed(spark: SparkSession, d: str) -> DataFrame:
    """BED rows of chimeric segments; the name tells circle, place and role."""
    rows = Q.segments(spark, d)
    role = F.when(F.col("seg") == 0, "head").when(F.col("seg") + 1 == F.col("segs"), "tail").otherwise("middle")
    name = F.format_string("CeccDNA%d|seg %d/%d|%s", F.col("id"), F.col("seg") + 1, F.col("segs"), role)
    return rows.select("chr", "start0", "end0", name.alias("name"), F.lit(0).alias("score"), "strand", "length", "num_split_reads")


def s7_fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """FASTA text of all ring sequences, 60 letters a line."""
    from annulet.sources.sinks import fasta_record

    rows = once(spark, d, "tandem", "readName", "repN", "consSeq")
    return rows.select("rec_id", fasta_record(F.concat_ws("|", "readName", "repN"), F.col("consSeq")).alias("record"))


QUERIES = {f.__name__: f for f in (
    j17_tandem_overlaps, a14_distinct_counts, a32_majority_strand, a34_query_coverage, a35_best_site, a41_ordered_distinct, x3_query_intervals, x19_near_or_overlapping, x21_cs_counts,
    f10_supported_edges, f19_standard_schema, f20_known_ids, f22_partly_overlapping, w3_group_sizes, t2_first_of_each, t4_two_best_loci, t8_by_priority, u6_intersection, j4_metadata_lookup,
    j21_jitter_pairs, g12_read_components, g13_circular_components, s20_segment_bed, s7_fasta_records,
)}

_T, _A = once_sql("tandem"), once_sql("alignments")
_C = Q.CHIMERIC_SQL

SQL = {
    "j17_tandem_overlaps": f"""WITH {T._BASE} SELECT a.rec_id AS rec_a, b.rec_id AS rec_b, least(a."end", b."end") - greatest(a.start, b.start) + 1 AS overlap FROM good a JOIN good b ON a.readName = b.readName AND a.rec_id < b.rec_id AND least(a."end", b."end") - greatest(a.start, b.start) + 1 > 50""",
    "a14_distinct_counts": f"WITH {A._PREP} SELECT count(*) AS alignments, count(DISTINCT query_id) AS queries, count(DISTINCT read) AS reads, count(DISTINCT chr) AS chromosomes FROM prep",
    "a32_majority_strand": f"WITH {A._PREP} SELECT query_id, CASE WHEN count(*) FILTER (strand = '+') >= count(*) FILTER (strand = '-') THEN '+' ELSE '-' END AS strand FROM prep GROUP BY query_id",
    "a34_query_coverage": f"WITH {A._PREP}, p AS (SELECT query_id, q_start - 1 AS s, q_end AS e, max(q_end) OVER (PARTITION BY query_id ORDER BY q_start, aln_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM prep) SELECT query_id, CAST(sum(greatest(0, e - greatest(s, coalesce(before, s)))) AS BIGINT) AS covered FROM p GROUP BY query_id",
    "a35_best_site": f"""WITH {A._PREP}, b AS (SELECT *, coalesce(CASE WHEN NOT isnan(bit_score) THEN bit_score END, 0) AS score FROM prep), s AS (SELECT query_id, aln_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, aln_id) AS rs, row_number() OVER (PARTITION BY query_id ORDER BY alignment_length DESC, aln_id) AS rl, max(score) OVER (PARTITION BY query_id) AS top, count(*) OVER (PARTITION BY query_id) AS hit_count FROM b)
      SELECT query_id, aln_id, hit_count FROM s WHERE CASE WHEN top <> 0 THEN rs = 1 ELSE rl = 1 END""",
    "a41_ordered_distinct": f"WITH {_C} SELECT id, string_agg(chr, ';' ORDER BY s) AS chrs FROM (SELECT id, chr, min(seg) AS s FROM seg GROUP BY id, chr) GROUP BY id",
    "x3_query_intervals": f"SELECT aln_id, least(q_start, q_end) - 1 AS s, greatest(q_start, q_end) AS e FROM {_A}",
    "x19_near_or_overlapping": f"WITH {_C}, l AS (SELECT *, lead(chr) OVER w AS c2, lead(start0) OVER w AS s2, lead(end0) OVER w AS e2 FROM seg WINDOW w AS (PARTITION BY id ORDER BY seg)) SELECT id, seg, start0 <= e2 AND s2 <= end0 AS overlaps, abs(start0 - s2) <= 50 AND abs(end0 - e2) <= 50 AS near FROM l WHERE c2 = chr",
    "x21_cs_counts": f"SELECT aln_id, mismatches, gap_opens FROM {_A}",
    "f10_supported_edges": f"WITH {_C}, l AS (SELECT chr AS src, lead(chr) OVER (PARTITION BY id ORDER BY seg) AS dst FROM seg) SELECT src, dst, count(*) AS n FROM l WHERE dst IS NOT NULL GROUP BY src, dst HAVING count(*) >= 2",
    "f19_standard_schema": f"SELECT rec_id, readName AS reads, repN AS repeat_id, {fixed_sql('copyNum', 2)} AS copy_number, readLen AS read_length, consLen AS length, start - 1 AS start0, \"end\" AS end0 FROM {_T}",
    "f20_known_ids": f"WITH {Q._SEGPAIRS} SELECT id, seg FROM seg WHERE id NOT IN (SELECT id FROM gone)",
    "f22_partly_overlapping": f"""WITH {_C}, twice AS (SELECT id, seg, chr, strand, start0, end0 FROM seg UNION ALL SELECT id, segs, chr, strand, start0 + (end0 - start0) // 2, end0 + (end0 - start0) // 2 FROM seg WHERE id % 3 = 0 AND seg = 0)
      SELECT DISTINCT a.id FROM twice a JOIN twice b ON a.id = b.id AND a.chr = b.chr AND a.strand = b.strand AND a.seg < b.seg AND least(a.end0, b.end0) > greatest(a.start0, b.start0)
      WHERE NOT (least(a.end0, b.end0) - greatest(a.start0, b.start0) >= 0.95 * (a.end0 - a.start0) AND least(a.end0, b.end0) - greatest(a.start0, b.start0) >= 0.95 * (b.end0 - b.start0))""",
    "w3_group_sizes": f"WITH {K._CORE} SELECT rec_id, count(*) OVER (PARTITION BY cluster) AS hit_count FROM core",
    "t2_first_of_each": f"SELECT readName, rec_id FROM {_T} QUALIFY row_number() OVER (PARTITION BY readName ORDER BY start, rec_id) = 1",
    "t4_two_best_loci": f"{A._ALL} SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY cov DESC, locus) AS n, locus, {fixed_sql('cov', 6)} AS cov FROM loci QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cov DESC, locus) <= 2",
    "t8_by_priority": f"WITH {T._RINGS} SELECT readName, readClass, row_number() OVER (ORDER BY list_position({list(tandem.CLASSES)!r}, readClass), readName) AS place FROM classes",
    "u6_intersection": f"SELECT readName FROM {_T} INTERSECT SELECT string_split(query_id, '|')[1] FROM {_A}",
    "j4_metadata_lookup": f"""WITH {A._PREP}, r AS (SELECT concat_ws('|', readName, repN, CAST(consLen AS VARCHAR), CAST(copyNum AS VARCHAR), 'circular') AS id, rec_id, readName, consLen FROM {_T} WHERE copyNum IS NOT NULL),
      f AS (SELECT id, arg_min(consLen, rec_id) AS n FROM r GROUP BY id), g AS (SELECT readName, arg_min(consLen, rec_id) AS n FROM r GROUP BY readName)
      SELECT DISTINCT query_id, coalesce(f.n, g.n, 0) AS length FROM prep LEFT JOIN f ON f.id = query_id LEFT JOIN g ON g.readName = read""",
    "j21_jitter_pairs": f"WITH RECURSIVE {K._JITTER} SELECT x AS id, y AS match FROM pairs WHERE x < y",
    "g12_read_components": f"""WITH RECURSIVE {K._CORE}, {K._READS}, n AS (SELECT read, CAST(regexp_extract(cluster, '([0-9]+)$', 1) AS BIGINT) AS node FROM reads), l AS (SELECT DISTINCT a.node AS x, b.node AS y FROM n a JOIN n b ON a.read = b.read AND a.node <> b.node),
      reach AS (SELECT DISTINCT node AS x, node AS y FROM n UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y), c AS (SELECT x, min(y) AS component FROM reach GROUP BY x) SELECT component, count(*) AS clusters FROM c GROUP BY component""",
    "g13_circular_components": f"WITH {_C}, c AS (SELECT id, max(segs) AS nodes FROM seg GROUP BY id) SELECT nodes, TRUE AS cyclic, count(*) AS circles FROM c GROUP BY nodes",
    "s20_segment_bed": f"WITH {_C} SELECT chr, start0, end0, printf('CeccDNA%d|seg %d/%d|%s', id, seg + 1, segs, CASE WHEN seg = 0 THEN 'head' WHEN seg + 1 = segs THEN 'tail' ELSE 'middle' END) AS name, 0 AS score, strand, length, num_split_reads FROM seg",
    "s7_fasta_records": rf"SELECT rec_id, '>' || readName || '|' || repN || chr(10) || rtrim(regexp_replace(coalesce(nullif(consSeq, ''), 'N'), '(.{{60}})', '\1' || chr(10), 'g'), chr(10)) AS record FROM {_T}",
}
