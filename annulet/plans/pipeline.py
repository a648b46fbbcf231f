"""Named stages from DataFrames to DataFrames, in an order their needs allow, each written once and resumable.

A stage's result is a parquet folder; a manifest beside them holds the parameters' fingerprint and what is done. A
later run with the same parameters reads what is there; with others it starts again, goes on, or stops, as asked.
"""

from __future__ import annotations

import graphlib
import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import chimeric, classify, curate, split_reads, tandem, unify
from annulet.plans.config import Config
from annulet.sources import storage
from annulet.sources.sinks import write_json


class PipelineError(RuntimeError):
    """The stages cannot be run as asked."""


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]
    required: tuple[str, ...] = ()


def in_order(stages: list[Stage], inputs: set[str]) -> list[Stage]:
    """Stages so that each comes after what it needs; unknown needs, double names and circles are errors."""
    by_name = {s.name: s for s in stages}
    if len(by_name) < len(stages) or by_name.keys() & inputs:
        raise PipelineError("two stages or inputs have one name")
    unknown = {n for s in stages for n in s.needs} - by_name.keys() - inputs
    if unknown:
        raise PipelineError(f"unknown: {sorted(unknown)}")
    try:
        order = list(graphlib.TopologicalSorter({s.name: set(s.needs) & by_name.keys() for s in stages}).static_order())
    except graphlib.CycleError as e:
        raise PipelineError(f"stages need each other: {e.args[1]}") from None
    return [by_name[n] for n in order]


def run(spark: SparkSession, stages: list[Stage], inputs: dict[str, DataFrame], folder: str, config: Config, on_change: str = "reset", force: bool = False, only: set[str] | None = None) -> dict[str, DataFrame]:
    """All stages' results by name; ``on_change``: 'reset', 'continue' or 'fail' when the parameters differ from those of the folder."""
    manifest = os.path.join(folder, "manifest.json")
    state = {"version": 1, "config": config.fingerprint(), "done": {}}
    if storage.exists(spark, manifest):
        held = json.loads(storage.read_text(spark, manifest))
        if held.get("config") == state["config"] or on_change == "continue":
            state["done"] = held.get("done", {})
        elif on_change == "fail":
            raise PipelineError("the folder holds results of other parameters")
    frames, fresh = dict(inputs), set()
    for stage in in_order(stages, set(inputs)):
        if only is not None and stage.name not in only:
            continue
        path = os.path.join(folder, stage.name)
        stale = force or stage.name not in state["done"] or fresh & set(stage.needs)
        if stale:
            began = time.time()
            result = stage.run(*(frames[n] for n in stage.needs), config)
            missing = [c for c in stage.required if c not in result.columns]
            if missing:
                raise PipelineError(f"{stage.name} lacks columns {missing}")
            result.write.mode("overwrite").parquet(path)
            fresh.add(stage.name)
            state["done"][stage.name] = {"seconds": round(time.time() - began, 3)}
            write_json(spark, state, manifest)
        frames[stage.name] = spark.read.parquet(path)
    return {n: f for n, f in frames.items() if n not in inputs}


def _doubled(rows: DataFrame) -> DataFrame:
    rows = classify.prepared(rows)
    return rows.select("query_id", "aln_id", "chr", "start0", "end0", "strand", (F.col("q_start") - 1).alias("qs"), F.col("q_end").alias("qe"), "size", "identity")


def _split_hits(rows: DataFrame, mapq: int) -> DataFrame:
    rows = rows.where((F.col("mapq") >= mapq) & F.col("query_id").isNotNull())
    return rows.select(
        F.col("query_id").alias("readid"), (F.col("q_start") - 1).alias("q_start"), "q_end", F.col("subject_id").alias("ref"), (F.least("s_start", "s_end") - 1).alias("r_start"), F.greatest("s_start", "s_end").alias("r_end"),
        (F.col("alignment_length") - F.col("mismatches")).alias("match"), F.col("alignment_length").alias("block"), F.col("mapq").cast("int").alias("mapq"), F.when(F.col("sstrand") == "plus", 1).otherwise(-1).alias("strand"),
    )


def _curated(found: DataFrame, config: Config) -> DataFrame:
    rows = split_reads.overview(found).withColumn("rec_id", F.xxhash64("regions"))
    simple = curate.simple(rows).select("eccDNA_id", F.lit(0).alias("seg"), F.lit(1).alias("segs"), "chr", "start0", "end0", "strand", "length", "num_split_reads")
    many = curate.chimeric(rows, config.curate.min_segments, config.curate.min_splits)
    return simple.unionByName(many.select("eccDNA_id", (F.col("seg_index") - 1).alias("seg"), F.col("seg_total").alias("segs"), "chr", "start0", "end0", "strand", "length", "num_split_reads"))


def _confirmed(decided: DataFrame, rows: DataFrame, rings: DataFrame, config: Config) -> DataFrame:
    place = classify.prepared(rows).select(F.col("aln_id").alias("rep_aln"), "chr", "start0", "end0", "strand", "read", "size", "copies")
    both = decided.where("class in ('Uecc', 'Mecc')").join(place, "rep_aln")
    one = both.select(F.col("query_id").alias("id"), F.col("class").alias("kind"), F.lit(0).alias("seg"), F.lit(1).alias("segs"), "chr", "start0", "end0", "strand", F.col("size").alias("length"), "conf")
    many = rings.select(F.col("query_id").alias("id"), F.lit("Cecc").alias("kind"), (F.col("segment_in_circle") - 1).alias("seg"), F.col("num_segments").cast("int").alias("segs"), "chr", "start0", "end0", "strand", F.col("cumulative_length").alias("length"), F.col("confidence").alias("conf"))
    return one.unionByName(many)


def _unified(confirmed: DataFrame, inferred: DataFrame, config: Config) -> DataFrame:
    known = confirmed.where("kind <> 'Mecc'").select("chr", F.col("id").alias("match"), F.when(F.col("kind") == "Uecc", 0).otherwise(1).alias("kind"), F.col("start0").alias("m_start"), F.col("end0").alias("m_end"))
    simple = inferred.where("segs = 1").select(F.col("eccDNA_id").alias("id"), "chr", "start0", "end0")
    gone = unify.simple_matches(simple, known, config.unify.share, config.unify.tolerance).select("id")
    segs = inferred.where("segs > 1").select(F.col("eccDNA_id").alias("id"), "seg", "segs", "chr", "start0", "end0", "strand")
    many = confirmed.where("kind = 'Cecc'").select("id", "seg", "segs", "chr", "start0", "end0", "strand")
    gone = gone.unionByName(unify.redundant(config.unify.method, segs, many, config.unify.share, config.unify.tolerance).select("id"))
    rest = inferred.withColumnRenamed("eccDNA_id", "id").join(gone, "id", "left_anti")
    rest = rest.select("id", F.when(F.col("segs") == 1, "Uecc").otherwise("Cecc").alias("kind"), F.lit("Inferred").alias("state"), "seg", "segs", "chr", "start0", "end0", "strand", "length", F.lit(None).cast("double").alias("conf"))
    return confirmed.withColumn("state", F.lit("Confirmed")).unionByName(rest)


def _summary(unified: DataFrame, config: Config) -> DataFrame:
    one = unified.where("seg = 0")
    out = one.groupBy("kind", "state").agg(F.count("*").alias("circles"), F.avg("length").alias("mean_length"), F.avg("conf").alias("mean_conf"), F.expr("median(length)").alias("median_length"))
    return out.withColumn("prefix", F.lit(config.prefix))


def standard() -> list[Stage]:
    """Tandem and alignment tables to the unified circles; external aligners stay outside, their tables are inputs."""
    return [
        Stage("rings", ("tandem",), lambda t, c: tandem.rings(t.where(F.col("aveMatch") >= c.tandem.min_match)), ("ring_id", "class")),
        Stage("read_classes", ("rings",), lambda r, c: tandem.read_classes(r), ("readName", "readClass")),
        Stage("classes", ("alignments",), lambda a, c: classify.classify(a, c.rules), ("query_id", "class")),
        Stage("unclassified", ("alignments", "classes"), lambda a, d, c: a.join(d.where("class in ('Uecc', 'Mecc')").select("query_id"), "query_id", "left_anti")),
        Stage("chimeric", ("unclassified",), lambda a, c: chimeric.detect(_doubled(a), c.chimeric.min_loci, c.chimeric.min_match_degree)),
        Stage("confirmed", ("classes", "alignments", "chimeric"), _confirmed, ("id", "kind", "chr", "start0", "end0")),
        Stage("split_reads", ("unclassified",), lambda a, c: split_reads.circles(_split_hits(a, c.split_reads.mapq), c.split_reads.min_depth, c.split_reads.min_size, c.split_reads.support, c.split_reads.gap, c.split_reads.overlap, c.split_reads.distance)),
        Stage("inferred", ("split_reads",), _curated),
        Stage("unified", ("confirmed", "inferred"), _unified, ("id", "kind", "state")),
        Stage("summary", ("unified",), _summary),
    ]
