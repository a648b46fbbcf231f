"""Chimeric rings from alignments of doubled sequences: loci, the cycle they are passed in, and its measures.

All of it is windows and aggregates over (query_id, place on the query); a query's alignments are never gathered.
Fixed values: loci merge within 500 bases; the loci's joint length must be 95 to 105 per cent of the ring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators.intervals import islands, overlap_join
from annulet.session import cut

MERGE, LEAST_DEGREE, MOST_DEGREE, MAPQ = 500, 95.0, 105.0, 60


def with_locus(alns: DataFrame, merge: int = MERGE) -> DataFrame:
    """Adds ``locus``, ``lo``, ``hi``, ``locus_strand``: alignments of a query close on a chromosome, whatever their strand."""
    rows = islands(alns, ["query_id", "chr"], "start0", "end0", ["aln_id"], slack=merge)
    w = Window.partitionBy("query_id", "chr", "island")
    rows = rows.withColumns({"lo": F.min("start0").over(w), "hi": F.max("end0").over(w), "locus_strand": F.min_by("strand", F.struct("start0", "aln_id")).over(w)})
    return rows.withColumn("locus", F.concat_ws(":", "chr", "lo")).drop("island")


def runs(located: DataFrame) -> DataFrame:
    """The first alignment of every run of one locus along the query, numbered ``k`` from 0."""
    w = Window.partitionBy("query_id").orderBy("qs", "aln_id")
    opened = located.withColumn("_before", F.lag("locus").over(w)).where("_before is null or _before <> locus").drop("_before")
    return opened.withColumn("k", F.row_number().over(w) - 1)


def locus_edges(run_rows: DataFrame) -> DataFrame:
    """query_id, src, dst, transition of neighbouring runs."""
    w = Window.partitionBy("query_id").orderBy("k")
    rows = run_rows.withColumns({"dst": F.lead("locus").over(w), "_s": F.lead("strand").over(w)}).where("dst is not null")
    return rows.select("query_id", F.col("locus").alias("src"), "dst", F.concat_ws("_", "strand", "_s").alias("transition"))


def cycles(located: DataFrame) -> DataFrame:
    """query_id, locus, place (from 1), qs, qe, closed of the loci on the cycle of each query that has one.

    The cycle goes up to the first return to the first locus, at the third run or later; the first locus takes the
    query place of its second run, for its first one may be cut. Without a return, the runs among alignments that
    lie in the first half, if there are two or more.
    """
    run_rows = runs(located)
    w = Window.partitionBy("query_id")
    first = F.first("locus").over(w.orderBy("k"))
    marked = run_rows.withColumn("_first", first)
    returns = F.min(F.when((F.col("k") > 0) & (F.col("locus") == F.col("_first")), F.col("k"))).over(w)
    marked = marked.withColumns({"_returns": returns, "_runs": F.count("*").over(w)}).where("_runs >= 3")
    nth = F.row_number().over(Window.partitionBy("query_id", "locus").orderBy("k"))
    marked = marked.withColumn("_nth", nth)
    around = marked.where("_returns >= 2")
    second = around.where("_nth = 2 and locus = _first").select("query_id", "locus", F.col("qs").alias("_qs"), F.col("qe").alias("_qe"))
    around = around.where("k < _returns and _nth = 1").join(second, ["query_id", "locus"], "left")
    around = around.withColumns({"qs": F.coalesce("_qs", "qs"), "qe": F.coalesce("_qe", "qe"), "closed": F.lit(True)})
    open_ids = marked.where("_returns is null or _returns < 2").select("query_id").distinct()
    half = runs(located.join(open_ids, "query_id", "left_semi").where((F.col("qs") + F.col("qe")) / 2 < F.col("size")).drop("k"))
    half = half.withColumns({"_n": F.count("*").over(w), "_nth": nth, "closed": F.lit(False)}).where("_n >= 2 and _nth = 1")
    columns = ["query_id", "locus", "k", "qs", "qe", "closed", "size", "chr", "lo", "hi", "locus_strand"]
    both = around.select(*columns).unionByName(half.select(*columns))
    return both.withColumn("place", F.row_number().over(w.orderBy("k"))).drop("k")


def strand_closure(located: DataFrame) -> DataFrame:
    """query_id, valid: whether the strand flips an even number of times along the runs of the query."""
    flips = locus_edges(runs(located)).withColumn("f", F.when(F.col("transition").isin("+_-", "-_+"), 1).otherwise(0))
    return flips.groupBy("query_id").agg((F.sum("f") % 2 == 0).alias("valid"))


def detect(alns: DataFrame, min_loci: int = 2, least: float = LEAST_DEGREE) -> DataFrame:
    """One row per segment of each chimeric ring, from (query_id, aln_id, chr, start0, end0, strand, qs, qe, size, identity); size is the ring's."""
    located = cut(with_locus(alns))  # read by the cycles, twice, and by the coverage
    segs = cut(cycles(located))
    whole = segs.groupBy("query_id").agg(F.count("*").alias("num_segments"), F.sum(F.col("hi") - F.col("lo")).alias("cumulative_length"), F.countDistinct("chr").alias("chromosomes"), F.max("size").alias("size"))
    whole = whole.withColumn("match_degree", F.col("cumulative_length") / F.col("size") * 100)
    whole = whole.where((F.col("num_segments") >= min_loci) & F.col("match_degree").between(least, MOST_DEGREE)).drop("size")
    covered = islands(located.select("query_id", "aln_id", "qs", "qe", "size", "identity"), ["query_id"], "qs", "qe", ["aln_id"])
    spans = covered.groupBy("query_id", "island").agg((F.max("qe") - F.min("qs")).alias("n"), F.max("size").alias("size"), F.count("*").alias("c"), F.max("identity").alias("best"), F.min("identity").alias("worst"))
    facts = spans.groupBy("query_id").agg((F.sum("n") / (2 * F.max("size"))).alias("cov"), F.sum("c").alias("alns"), F.max("best").alias("identity_best"), F.min("worst").alias("identity_min"))
    out = segs.join(whole, "query_id").join(facts, "query_id")
    conf = S.geometric_mean(S.norm_mapq(F.lit(MAPQ)), S.norm_identity(F.col("identity_best")), F.col("cov"), F.col("num_segments") / F.col("alns"))
    return out.select(
        "query_id", F.col("place").alias("segment_in_circle"), "num_segments", "chr", F.col("lo").alias("start0"), F.col("hi").alias("end0"), F.col("locus_strand").alias("strand"), "qs", "qe", "cumulative_length",
        "match_degree", "cov", F.when(F.col("chromosomes") > 1, "Cecc-InterChr").otherwise("Cecc-IntraChr").alias("class"), conf.alias("confidence"), "identity_best", "identity_min", "closed",
    )


def doubled_pairs(alns: DataFrame, least_cover: float = 0.8, tolerance: int = 50, margin: int = 50, least_gap: int = 100) -> DataFrame:
    """query_id, first, second: alignments of the two halves of a doubled sequence that lie at one place of the genome.

    Only of queries whose alignments cover enough of the doubled sequence. An alignment belongs to the first half if it
    starts, to the second if it ends, more than the margin on that side of the middle. A pair has one strand, overlaps
    or has middles within the tolerance on the genome, and middles at least ``least_gap`` apart on the query.
    """
    spans = islands(alns.select("query_id", "aln_id", "qs", "qe", "size"), ["query_id"], "qs", "qe", ["aln_id"]).groupBy("query_id", "island")
    cover = spans.agg((F.max("qe") - F.min("qs")).alias("n"), F.max("size").alias("size")).groupBy("query_id").agg((F.sum("n") / (2 * F.max("size"))).alias("cov"))
    rows = alns.join(cover.where(F.col("cov") >= least_cover), "query_id", "left_semi")
    keys, middle = ["query_id", "chr", "strand"], (F.col("qs") + F.col("qe")) / 2
    one = rows.where(F.col("qs") < F.col("size") - margin).select(*keys, F.col("aln_id").alias("first"), (F.col("start0") - tolerance).alias("s1"), (F.col("end0") + tolerance).alias("e1"), middle.alias("m1"))
    two = rows.where(F.col("qe") > F.col("size") + margin).select(*keys, F.col("aln_id").alias("second"), F.col("start0").alias("s2"), F.col("end0").alias("e2"), middle.alias("m2"))
    pairs = overlap_join(one, two, keys, ("s1", "e1"), ("s2", "e2"))
    shared = F.least(F.col("e1") - tolerance, "e2") - F.greatest(F.col("s1") + tolerance, "s2")
    apart = F.abs((F.col("s1") + F.col("e1")) / 2 - (F.col("s2") + F.col("e2")) / 2)
    return pairs.where((F.abs(F.col("m1") - F.col("m2")) >= least_gap) & ((shared > 0) | (apart < tolerance))).select("query_id", "first", "second")
