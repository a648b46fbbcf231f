"""The packaged result of a run: numbered circles as tables, BED, BEDPE and FASTA, with a report.

Layout under the folder, ``x`` being the prefix: ``x_summary`` (one row a circle), ``x_regions`` (one row a segment),
``UeccDNA/x_uecc.bed``, ``MeccDNA/x_mecc_sites.bed``, ``CeccDNA/x_cecc_segments.bed``, ``CeccDNA/x_cecc_junctions.bedpe``,
``{U,M,C}eccDNA/x_{U,M,C}eccDNA.fasta`` where a reference is given, and ``x_report.txt``, ``.html``, ``.json``. Tables
and sequences are folders of parts, written in parallel. Confirmed circles are numbered before inferred ones of their
type; both keep their former id beside the new one. An empty result gives the same layout.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annulet.operators.curate import role
from annulet.operators.numbering import numbered
from annulet.sources import sinks, storage, text

KINDS = {"Uecc": "U", "Mecc": "M", "Cecc": "C"}


def renamed(unified: DataFrame, width: int = 4) -> DataFrame:
    """Segments with ``eccDNA_id``, numbered within their type: confirmed first, then by former id; ``width`` digits or more."""
    out = None
    for kind, letter in KINDS.items():
        ids = unified.where(F.col("kind") == kind).select("id", "state").distinct()
        ids = numbered(ids.withColumns({"_s": (F.col("state") != "Confirmed").cast("int"), "_n": F.length("id")}), ["_s", "_n", "id"], "_no").select("id", "state", "_no")
        digits = F.col("_no").cast("string")
        ids = ids.withColumn("eccDNA_id", F.concat(F.lit(f"{letter}eccDNA"), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))))
        rows = unified.where(F.col("kind") == kind).join(ids.drop("_no"), ["id", "state"])
        out = rows if out is None else out.unionByName(rows)
    return out


def regions(named: DataFrame) -> DataFrame:
    rows = named.withColumns({"seg_index": F.col("seg") + 1, "seg_total": F.col("segs")})
    return rows.select("eccDNA_id", F.col("id").alias("original_id"), F.col("kind").alias("eccDNA_type"), "state", "chr", "start0", "end0", "strand", "length", "seg_index", "seg_total", role("seg_index", "seg_total").alias("role"))


def summary(named: DataFrame) -> DataFrame:
    """One row a circle: its places in order, ``;`` between, and its numbers."""
    place = F.struct("seg", F.concat("chr", F.lit(":"), F.col("start0").cast("string"), F.lit("-"), F.col("end0").cast("string")).alias("r"), F.col("strand").alias("s"))
    rows = named.groupBy("eccDNA_id", F.col("id").alias("original_id"), F.col("kind").alias("eccDNA_type"), "state").agg(
        F.array_sort(F.collect_list(place)).alias("p"), F.max("length").alias("length"), F.max("conf").alias("confidence"), F.count("*").alias("seg_total")
    )
    return rows.select("eccDNA_id", "original_id", "eccDNA_type", "state", F.array_join("p.r", ";").alias("regions"), F.array_join("p.s", ";").alias("strands"), "length", "seg_total", "confidence")


def bed(regions_df: DataFrame, kind: str) -> DataFrame:
    """chrom, start, end, name (with the segment's number and role where there are several), score, strand."""
    name = F.when(F.col("seg_total") > 1, F.concat_ws("|", "eccDNA_id", F.concat(F.lit("seg"), F.col("seg_index").cast("string")), "role")).otherwise(F.col("eccDNA_id"))
    return regions_df.where(F.col("eccDNA_type") == kind).select("chr", "start0", "end0", name.alias("name"), F.lit(0).alias("score"), "strand")


def bedpe(regions_df: DataFrame) -> DataFrame:
    """Junctions of neighbouring segments, the last base of one and the first of the next; the ring is not closed."""
    w = Window.partitionBy("eccDNA_id").orderBy("seg_index")
    ahead = {f"{c}2": F.lead(c).over(w) for c in ("chr", "start0", "strand", "seg_index")}
    rows = regions_df.where("eccDNA_type = 'Cecc'").withColumns(ahead).where("chr2 is not null")
    name = F.concat("eccDNA_id", F.lit("|seg"), F.col("seg_index").cast("string"), F.lit("->seg"), F.col("seg_index2").cast("string"))
    return rows.select("chr", (F.col("end0") - 1).alias("start1"), F.col("end0").alias("end1"), "chr2", F.col("start02").alias("start2"), (F.col("start02") + 1).alias("end2"), name.alias("name"), F.lit(0).alias("score"), "strand", "strand2")


def statistics(summary_df: DataFrame, read_classes: DataFrame | None = None) -> dict[str, dict[str, object]]:
    """Sections of the report: reads by class, circles by type and state, lengths by type. A few rows of aggregates."""
    sections: dict[str, dict[str, object]] = {}
    if read_classes is not None:
        counts = {r["readClass"]: r["n"] for r in read_classes.groupBy("readClass").agg(F.count("*").alias("n")).collect()}
        total = sum(counts.values())
        sections["Reads"] = {"all": f"{total:,}"} | {str(k): f"{n:,} ({100 * n / total:.1f} %)" for k, n in sorted(counts.items())}
    by = summary_df.groupBy("eccDNA_type", "state").agg(F.count("*").alias("n")).collect()
    sections["Circles"] = {f"{r['eccDNA_type']} {r['state']}": f"{r['n']:,}" for r in sorted(by)}
    n = summary_df.groupBy("eccDNA_type").agg(F.count("*").alias("n"), F.min("length").alias("lo"), F.max("length").alias("hi"), F.avg("length").alias("mean"), F.expr("median(length)").alias("median"), F.expr("coalesce(stddev_samp(length), 0)").alias("std"))
    for r in sorted(n.collect()):
        sections[f"Lengths of {r['eccDNA_type']}"] = {"count": r["n"], "min": r["lo"], "max": r["hi"], "mean": round(r["mean"], 1), "median": round(r["median"], 1), "std": round(r["std"], 1)}
    return sections


def write(spark: SparkSession, unified: DataFrame, folder: str, prefix: str, read_classes: DataFrame | None = None, reference: DataFrame | None = None, width: int = 4) -> dict:
    """Writes the whole layout; ``reference`` has chunks (chr, start0, seq), see ``text.chunked``. Returns the report's sections."""
    named = renamed(unified, width)
    segs, circles = regions(named), summary(named)
    sinks.write_table(circles, f"{folder}/{prefix}_summary", single=False)
    sinks.write_table(segs, f"{folder}/{prefix}_regions", single=False)
    sinks.write_bed(bed(segs, "Uecc"), f"{folder}/UeccDNA/{prefix}_uecc.bed")
    sinks.write_bed(bed(segs, "Mecc"), f"{folder}/MeccDNA/{prefix}_mecc_sites.bed")
    sinks.write_bed(bed(segs, "Cecc"), f"{folder}/CeccDNA/{prefix}_cecc_segments.bed")
    sinks.write_bed(bedpe(segs), f"{folder}/CeccDNA/{prefix}_cecc_junctions.bedpe")
    if reference is not None:
        seqs = text.from_reference(reference, named.select(F.col("eccDNA_id").alias("id"), "seg", "chr", "start0", "end0"))
        titled = circles.join(seqs, F.col("eccDNA_id") == F.col("id"), "left")
        title = F.concat_ws("|", "eccDNA_id", "regions", F.concat(F.lit("length="), F.col("length").cast("string")), F.col("state"))
        for kind, letter in KINDS.items():
            rows = titled.where(F.col("eccDNA_type") == kind).select(title.alias("id"), "seq")
            sinks.write_fasta(rows, f"{folder}/{letter}eccDNA/{prefix}_{letter}eccDNA.fasta")
    sections = statistics(circles, read_classes)
    storage.write_text(spark, sinks.text_report(f"Circles of {prefix}", sections), f"{folder}/{prefix}_report.txt")
    storage.write_text(spark, sinks.html_report(f"Circles of {prefix}", sections), f"{folder}/{prefix}_report.html")
    storage.write_text(spark, json.dumps(sections, indent=2), f"{folder}/{prefix}_report.json")
    return sections


def write_split_reads(found: DataFrame, overview: DataFrame, folder: str) -> None:
    """The split-read circles and their overview as tab-separated tables; empty ones still have their header."""
    sinks.write_table(found, f"{folder}/circles.tsv", sep="\t")
    sinks.write_table(overview, f"{folder}/overview.tsv", sep="\t")


def write_curated(simple: DataFrame, chimeric: DataFrame, folder: str, prefix: str, reference: DataFrame | None = None) -> None:
    """The curated inferred circles, ``x_simple.csv`` and ``x_chimeric.csv``, with sequences where a reference is given."""
    sinks.write_table(simple, f"{folder}/{prefix}_simple.csv")
    sinks.write_table(chimeric, f"{folder}/{prefix}_chimeric.csv")
    if reference is not None:
        for kind, rows in (("UeccDNA_I", simple.withColumn("seg_index", F.lit(1))), ("CeccDNA_I", chimeric)):
            segs = rows.select(F.col("eccDNA_id").alias("id"), F.col("seg_index").alias("seg"), "chr", "start0", "end0")
            sinks.write_fasta(text.from_reference(reference, segs), f"{folder}/{prefix}_{kind}.fasta")
