"""Circles from split reads: trimmed reads, covered regions, breakpoint edges, components and their statistics.

Only two steps run outside the relational engine, on arrays of one read's hits or one component's edges: the
sequential trimming of a read and the walk around a circle. The hits of one read, and the regions of one molecule,
are small by nature; coverage, overlap joins, edge counts and components are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions import read_trim as R
from annulet.operators import intervals as I
from annulet.operators.graph import components
from annulet.session import cut

HIT = ["q_start", "q_end", "ref", "r_start", "r_end", "match", "block", "mapq", "strand"]
_OUT = "readid string, q_start bigint, q_end bigint, ref string, r_start bigint, r_end bigint, match bigint, block bigint, mapq int, strand int, trimmed bigint, freq string, ord int, ctc boolean"
ROWS_AT_ONCE = 10_000


def trim(hits: DataFrame, gap: int = 10, overlap: int = 10, distance: int = 1000) -> DataFrame:
    """readid and the kept hits with the trimmed length, their share of it, their order and the tandem flag.

    Reads come sorted, one hit after the other; a task holds the hits of one read, about 400 bytes each, as the test
    for tandem copies needs them all.
    """
    names = [c.split()[0] for c in _OUT.split(", ")]

    def of_read(name: str, rows: list[R.Hit]) -> Iterator[tuple]:
        chosen, size, ctc = R.trimmed(rows, gap, overlap, distance)
        for i, h in enumerate(chosen):
            yield (name, *(getattr(h, c) for c in HIT), size, f"{(h.q_end - h.q_start) / size:.2f}" if size else "0.00", i, ctc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
        schema = [kinds[c.split()[1]] for c in _OUT.split(", ")]
        out: list[tuple] = []
        name, rows = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema)], names)

        for batch in batches:
            ids, *columns = (c.to_pylist() for c in batch.columns)
            for read, hit in zip(ids, map(R.Hit, *columns)):
                if read != name:
                    if rows:
                        out.extend(of_read(name, rows))
                    name, rows = read, []
                rows.append(hit)
            if len(out) >= ROWS_AT_ONCE:
                yield flush()
        if rows:
            out.extend(of_read(name, rows))
        yield flush()

    ordered = hits.where("readid is not null").select("readid", *HIT).repartition("readid").sortWithinPartitions("readid", "q_start", "q_end", "ref", "r_start", "strand")
    return ordered.mapInArrow(run, _OUT)


def regions(rows: DataFrame, min_depth: float, min_size: int) -> DataFrame:
    """mergeid, ref, lo, hi, depth of merged regions: the part with enough depth, if it is long enough and deep on average."""
    depth = I.depth(rows.select("ref", "r_start", "r_end"), ["ref"], "r_start", "r_end").where(F.col("depth") >= min_depth)
    spans = I.merge(rows.select("ref", F.col("r_start").alias("m0"), F.col("r_end").alias("m1")), ["ref"], "m0", "m1").drop("members")
    deep = I.overlap_join(depth, spans, ["ref"], ("r_start", "r_end"), ("m0", "m1"))
    out = deep.groupBy("ref", "m0", "m1").agg(F.min("r_start").alias("lo"), F.max("r_end").alias("hi"), F.avg("depth").alias("depth"))
    out = out.where((F.col("depth") >= min_depth) & (F.col("hi") - F.col("lo") >= min_size))
    return out.select(F.concat_ws("_", "ref", F.col("lo").cast("string"), F.col("hi").cast("string")).alias("mergeid"), "ref", "lo", "hi", "depth")


def annotated(rows: DataFrame, found: DataFrame, end_size: int = 50) -> DataFrame:
    """(region, hit) pairs with how many 5' and 3' end windows, of all regions, the hit overlaps."""
    rows = rows.withColumn("hit", F.concat_ws("#", "readid", F.col("ord").cast("string")))
    five = found.select("ref", F.col("lo").alias("w0"), (F.col("lo") + end_size).alias("w1"))
    three = found.select("ref", F.greatest(F.col("hi") - end_size, F.lit(0)).alias("w0"), F.col("hi").alias("w1"))
    counted = I.count_overlaps(rows, five, ["ref"], "hit", ("r_start", "r_end"), ("w0", "w1"), "n5")
    counted = I.count_overlaps(counted, three, ["ref"], "hit", ("r_start", "r_end"), ("w0", "w1"), "n3")
    return I.overlap_join(counted, found.select("mergeid", "ref", "lo", "hi"), ["ref"], ("r_start", "r_end"), ("lo", "hi"))


def breakpoint_edges(pairs: DataFrame, support: int) -> DataFrame:
    """src, dst, reads, transitions of edges with enough support; a read's scan stops at its first pair of hits that don't meet on the read."""
    w = Window.partitionBy("readid").orderBy("ord", "mergeid")
    ahead = lambda c: F.lead(c).over(w)
    rows = pairs.select("readid", "ord", "mergeid", "q_start", "q_end", "strand", "n5", "n3", *(ahead(c).alias(f"{c}2") for c in ("mergeid", "q_start", "q_end", "strand", "n5", "n3"))).where("mergeid2 is not null")
    apart = ~((F.col("q_start") <= F.col("q_end2")) & (F.col("q_start2") <= F.col("q_end") + 50))
    rows = rows.withColumn("_stop", F.max(apart).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("not _stop")
    rule = lambda a, b, test, t, back=False: F.when(
        (F.col("strand") == a) & (F.col("strand2") == b) & F.expr(test), F.struct(F.col("mergeid2" if back else "mergeid").alias("src"), F.col("mergeid" if back else "mergeid2").alias("dst"), F.lit(t).alias("t"))
    )
    edge = F.coalesce(rule(1, 1, "n3 = 1 and n52 = 1", "+_+"), rule(-1, -1, "n32 = 1 and n5 = 1", "-_-", True), rule(-1, 1, "n5 = 1 and n52 = 1", "-_+"), rule(1, -1, "n3 = 1 and n32 = 1", "+_-"))
    edges = rows.select(edge.alias("e")).where("e is not null").groupBy("e.src", "e.dst").agg(F.count("*").alias("reads"), F.array_sort(F.collect_set("e.t")).alias("transitions"))
    return edges.where(F.col("reads") >= support)


def shown(region: Column) -> Column:
    """``chr_s_e_strand``, half-open from 0, as ``chr:s-e_strand``, closed from 1."""
    part = lambda i: F.regexp_extract(region, r"^(.*)_(\d+)_(\d+)_([+-])$", i)
    return F.concat(part(1), F.lit(":"), (part(2).cast("bigint") + 1).cast("string"), F.lit("-"), part(3), F.lit("_"), part(4))


def circles(hits: DataFrame, min_depth: float = 5.0, min_size: int = 200, support: int = 3, gap: int = 10, overlap: int = 10, distance: int = 1000) -> DataFrame:
    """id, merge_region, merge_len, num_region, ctc, numreads, totalbase, coverage of every component of the breakpoint graph.

    ``merge_region`` holds ``chr:s-e_strand``, closed from 1, joined by commas along the circle.
    """
    kept = cut(trim(hits, gap, overlap, distance))
    found = cut(regions(kept, min_depth, min_size))
    pairs = cut(annotated(kept, found))
    edges = cut(breakpoint_edges(pairs, support))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    placed = components(nodes, edges.select("src", "dst"))
    votes = pairs.groupBy("mergeid").agg(F.when(F.sum(F.when(F.col("strand") == 1, 1).otherwise(-1)) >= 0, "+").otherwise("-").alias("majority"))
    members = placed.join(votes.withColumnRenamed("mergeid", "node"), "node", "left")
    links = edges.join(placed.select(F.col("node").alias("src"), "component"), "src")

    @F.pandas_udf("struct<regions:array<string>,solved:boolean,loop:boolean,cyclic:boolean>")
    def walk(nodes: pd.Series, links: pd.Series) -> pd.DataFrame:
        out = []
        for ns, es in zip(nodes, links):
            strands = {n["node"]: n["majority"] or "+" for n in ns}
            out.append(R.resolved(list(strands), {(e["src"], e["dst"]): list(e["transitions"]) for e in es}, strands))
        return pd.DataFrame(out, columns=["regions", "solved", "loop", "cyclic"])

    whole = members.groupBy("component").agg(F.collect_list(F.struct("node", "majority")).alias("n"), F.count("*").alias("num_region"))
    whole = whole.join(links.groupBy("component").agg(F.collect_list(F.struct("src", "dst", "transitions")).alias("e")), "component")
    whole = whole.withColumn("w", walk("n", "e")).select("component", "num_region", F.col("w.regions").alias("regions"), F.col("w.cyclic").alias("ctc"))
    part = whole.select("component", F.explode("regions").alias("r"))
    node = F.regexp_extract("r", r"^(.*)_[+-]$", 1)
    part = part.withColumns({"node": node, "size": F.element_at(F.split(node, "_"), -1).cast("bigint") - F.element_at(F.split(node, "_"), -2).cast("bigint")})
    length = part.groupBy("component").agg(F.sum("size").alias("merge_len"))
    stats = part.join(pairs.select(F.col("mergeid").alias("node"), "readid", "q_start", "q_end"), "node").groupBy("component")
    stats = stats.agg(F.sum(F.col("q_end") - F.col("q_start")).alias("totalbase"), F.countDistinct("readid").alias("numreads"))
    out = whole.join(length, "component").join(stats, "component")
    coverage = F.when(F.col("merge_len") > 0, F.col("totalbase") / F.col("merge_len")).otherwise(0.0)
    return out.select(F.col("component").alias("id"), F.array_join(F.transform("regions", shown), ",").alias("merge_region"), "merge_len", "num_region", "ctc", "numreads", "totalbase", F.format_string("%.2f", coverage).alias("coverage"))


def overview(found: DataFrame, prob_present: float = 0.95, prob_artifact: float = 0.0) -> DataFrame:
    """The split-read circles in the form of the overview table: regions ``chr:s-e``, closed from 1, joined by ``;``.

    The probabilities are placeholders, for nothing here measures them; regions that don't read ``chr:s-e_strand`` make a row fall out.
    """
    regions = F.split("merge_region", "[;,]")
    read = F.forall(regions, lambda r: r.rlike(r"^.+:\d+-\d+_[+-]$"))
    return found.where(read).select(
        F.array_join(F.transform(regions, lambda r: F.regexp_replace(r, "_[+-]$", "")), ";").alias("regions"), F.col("merge_len").alias("circle_length"), F.size(regions).alias("segment_count"),
        F.col("numreads").alias("num_split_reads"), F.lit(prob_present).alias("prob_present"), F.lit(prob_artifact).alias("prob_artifact"), F.least(F.col("coverage").cast("double") / 100.0, F.lit(1.0)).alias("af_nanopore"),
    )
