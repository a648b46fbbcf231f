"""Alignments of rings to loci and ring classes: one locus (U), several loci (M), or unclassified.

The evidence of a locus is the share of the ring its alignments cover, after projecting each alignment onto the
ring. Loci are single-linkage clusters within (query, chromosome, strand); only alignments in one island of
positions can be linked, so clustering runs island by island. Ring pieces are gathered as distinct pairs, whose
number the ring's length bounds. Ties fall to the smallest ``aln_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators.intervals import islands
from annulet.session import cut


@dataclass(frozen=True)
class Rules:
    """Default thresholds of the classes."""

    gap_percent: float = 10.0
    theta_u: float = 0.95
    theta_m: float = 0.95
    theta_u2_max: float = 0.05
    mapq_u_min: int = 0
    mapq_m_ambiguous: int = 0
    identity_gap: float = 1.0
    theta_locus: float = 0.95
    pos_tol: int = 50
    span_ratio_min: float = 0.95
    second_frac: float = 0.01
    second_bp: float = 50.0
    contig_gap: int = 1000
    second_ratio: float = 0.05
    high_cov: float = 0.98
    high_mapq: int = 50

    @classmethod
    def preset(cls, name: str) -> Rules:
        return {"balanced": cls(), "relaxed": cls(theta_u=0.9, theta_m=0.9, theta_u2_max=0.1, span_ratio_min=0.9), "strict": cls(theta_u=0.98, theta_m=0.98, theta_u2_max=0.02, span_ratio_min=0.98)}[name]


def shaped(df: DataFrame) -> DataFrame:
    """Rows whose query_id has at least four parts between bars."""
    return df.where(F.size(F.split("query_id", r"\|")) >= 4)


def prepared(df: DataFrame) -> DataFrame:
    """Alignments with read, ring size, copies, half-open genomic ends and the gap to the ring's size in per cent."""
    part = F.split("query_id", r"\|")
    rows = shaped(df).withColumns({
        "read": part[0], "rep": part[1], "size": S.to_bigint(part[2]), "copies": S.to_double(part[3]),
        "strand": F.when(F.col("sstrand") == "plus", "+").otherwise("-"),
        "start0": F.least("s_start", "s_end") - 1, "end0": F.greatest("s_start", "s_end"), "chr": F.col("subject_id"),
    })
    rows = rows.where("size > 0 and s_start is not null and s_end is not null")
    return rows.withColumn("r_length", F.col("end0") - F.col("start0")).withColumn("gap_length", F.col("size") - F.col("r_length")).withColumn(
        "gap_percentage", F.rint(F.abs("gap_length") / F.col("size") * 100 * 100) / 100
    )


def identity_passes(identity, length, least: float = 99.0, decay: float = 0.5, floor: float = 97.0):  # noqa: ANN001, ANN201
    """Longer queries may match a little less, down to the floor."""
    return identity >= F.greatest(F.lit(least) - length / 10000.0 * decay, F.lit(floor))


def zero_based(hq: DataFrame) -> Column:
    """One value for the table, a subquery: whether query ends look half-open from 0 rather than closed from 1."""
    off = lambda n: F.median(F.abs(F.abs(F.col("q_end") - F.col("q_start") + n) - F.col("alignment_length")))
    return hq.agg(F.coalesce(off(0) + 1e-6 < off(1), F.lit(False))).scalar()


def linked(starts: np.ndarray, ends: np.ndarray, pos_tol: int, theta: float) -> np.ndarray:
    """For intervals sorted by start, the first member of each one's single-linkage cluster."""
    n = len(starts)
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    size = np.maximum(ends - starts, 0)
    for i in range(n - 1):
        stop = np.searchsorted(starts, max(ends[i], starts[i] + pos_tol), "right")
        j = np.arange(i + 1, stop)
        if not j.size:
            continue
        near = (np.abs(starts[j] - starts[i]) <= pos_tol) & (np.abs(ends[j] - ends[i]) <= pos_tol)
        least = np.minimum(size[j], size[i])
        shared = np.maximum(np.minimum(ends[j], ends[i]) - np.maximum(starts[j], starts[i]), 0)
        near |= (least > 0) & (shared >= theta * least)
        for k in j[near]:
            a, b = find(i), find(int(k))
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def with_loci(hq: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds ``locus``: the smallest aln_id of the cluster an alignment belongs to."""
    keys = ["query_id", "chr", "strand"]
    placed = islands(hq, keys, "start0", "end0", ["aln_id"], slack=rules.pos_tol)
    sizes = Window.partitionBy(*keys, "island")
    placed = placed.withColumn("_n", F.count("*").over(sizes))

    @F.pandas_udf("array<bigint>")
    def label(members: pd.Series) -> pd.Series:
        out = []
        for rows in members:
            s, e, a = (np.array([r[c] for r in rows]) for c in ("s", "e", "a"))
            root = linked(s, e, rules.pos_tol, rules.theta_locus)
            least = np.full(len(a), np.iinfo(np.int64).max)
            np.minimum.at(least, root, a)
            out.append(least[root])
        return pd.Series(out)

    several = placed.where("_n > 1").groupBy(*keys, "island").agg(F.array_sort(F.collect_list(F.struct(F.col("start0").alias("s"), F.col("end0").alias("e"), F.col("aln_id").alias("a")))).alias("m"))
    labels = several.select(F.arrays_zip(F.col("m.a").alias("a"), label("m").alias("locus")).alias("z")).select(F.explode("z").alias("z")).select(F.col("z.a").alias("aln_id"), "z.locus")
    return placed.join(labels, "aln_id", "left").withColumn("locus", F.coalesce("locus", "aln_id")).drop("island", "_n")


def pieces(df: DataFrame, style) -> DataFrame:  # noqa: ANN001
    q = S.query_interval(F.col("q_start"), F.col("q_end"), F.col("_style"))
    return df.withColumn("_style", style).withColumn("_q", q).withColumn("pieces", S.ring_projection(F.col("_q.s"), F.col("_q.e"), F.col("size"))).drop("_style", "_q")


def coverage(df: DataFrame, *keys: str) -> DataFrame:
    """keys, cov: share of the ring that the pieces of each group cover."""
    flat = df.select(*keys, "size", F.explode("pieces").alias("p"))
    held = flat.groupBy(*keys).agg(F.collect_set("p").alias("_p"), F.max("size").alias("_size"))
    return held.select(*keys, (S.union_length(F.col("_p")) / F.col("_size")).alias("cov"))


def loci(located: DataFrame, style) -> DataFrame:  # noqa: ANN001
    """One row per (query_id, locus): coverage, evidence and the longest alignment."""
    cov = coverage(pieces(located, style), "query_id", "locus")
    zero = lambda c, d: F.coalesce(c, F.lit(d))
    facts = located.groupBy("query_id", "locus").agg(
        zero(F.max("mapq"), 0).alias("mapq_best"), zero(F.min("mapq"), 0).alias("mapq_min"), zero(F.max("identity"), 0.0).alias("id_best"),
        zero(F.min("identity"), 0.0).alias("id_min"), F.min("start0").alias("lo"), F.max("end0").alias("hi"), F.max("size").alias("size"), F.first("chr").alias("chr"),
        F.max(F.struct("alignment_length", (-F.col("aln_id")).alias("minus"))).alias("_rep"), F.count("*").alias("hits"),
    )
    return facts.join(cov, ["query_id", "locus"]).withColumn("rep_aln", -F.col("_rep.minus")).drop("_rep")


def decide(all_rows: DataFrame, loci_df: DataFrame, style, rules: Rules = Rules()) -> DataFrame:  # noqa: ANN001
    """query_id, class ('Uecc', 'Mecc', 'vetoed' or 'none'), U_cov, U_cov_2nd, M_count, conf, best locus of every query with loci."""
    order = Window.partitionBy("query_id").orderBy(F.desc("cov"), "locus")
    top = loci_df.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    names = ["cov", "mapq_best", "mapq_min", "id_best", "id_min", "lo", "hi", "chr", "locus", "size", "rep_aln"]
    one = top.groupBy("query_id").agg(*(F.max(F.when(F.col("rn") == i, F.col(c))).alias(f"{c}{i}") for i in (1, 2) for c in names))
    counts = loci_df.groupBy("query_id").agg(
        F.sum(F.when(F.col("cov") >= rules.theta_m, 1).otherwise(0)).alias("M_count"),
        F.max(F.when(F.col("cov") >= rules.theta_m, F.col("mapq_best"))).alias("_full_mapq"),
    )
    by_identity = Window.partitionBy("query_id").orderBy(F.desc("id_best"), "locus")
    full = loci_df.where(F.col("cov") >= rules.theta_m).withColumn("rn", F.row_number().over(by_identity)).where("rn <= 2")
    gaps = full.groupBy("query_id").agg((F.max("id_best") - F.min("id_best")).alias("_gap"))
    q = one.join(counts, "query_id").join(gaps, "query_id", "left").withColumn("cov2", F.coalesce("cov2", F.lit(0.0)))
    is_m = F.col("M_count") >= 2
    m_veto = F.lit(False)
    if rules.mapq_m_ambiguous > 0:
        m_veto = m_veto | (F.col("_full_mapq") < rules.mapq_m_ambiguous)
    if rules.identity_gap > 0:
        m_veto = m_veto | (F.col("_gap") > rules.identity_gap)
    maybe_u = ~is_m & (F.col("cov1") >= rules.theta_u) & (F.col("cov2") <= rules.theta_u2_max)
    low = (F.col("hi1") - F.col("lo1")) / F.col("size1") < rules.span_ratio_min
    if rules.mapq_u_min > 0:
        low = low | (F.col("mapq_best1") < rules.mapq_u_min)
    q = q.withColumn("_u", maybe_u & ~low)

    # Hits of a possible U elsewhere: other chromosomes, or too far from its locus.
    u = q.where("_u").select("query_id", F.col("chr1").alias("_c"), F.col("lo1").alias("_lo"), F.col("hi1").alias("_hi"))
    away = all_rows.join(u, "query_id").where((F.col("chr") != F.col("_c")) | (F.col("end0") < F.col("_lo") - rules.contig_gap) | (F.col("start0") > F.col("_hi") + rules.contig_gap))
    second = coverage(pieces(away, style), "query_id").withColumnRenamed("cov", "_second")
    q = q.join(second, "query_id", "left").withColumn("_second", F.coalesce("_second", F.lit(0.0)))
    ease = F.when(F.col("cov1") >= rules.high_cov, 2.0).otherwise(1.0) * F.when(F.col("mapq_best1") >= rules.high_mapq, 1.5).otherwise(1.0)
    strong = (F.col("_second") >= ease * rules.second_frac) | (F.col("_second") * F.col("size1") >= ease * rules.second_bp)
    u_veto = strong & ~((F.col("cov1") > 0) & (F.col("_second") / F.col("cov1") < rules.second_ratio))
    cls = F.when(is_m, F.when(m_veto, "vetoed").otherwise("Mecc")).when(F.col("_u"), F.when(u_veto, "vetoed").otherwise("Uecc")).when(maybe_u, "vetoed").otherwise("none")
    best = lambda c: F.greatest(f"{c}1", F.coalesce(f"{c}2", F.lit(0)))
    unique = S.clamp01(1.0 - F.col("cov2") / max(rules.theta_u2_max, 0.05))
    conf = F.when(is_m, S.geometric_mean(S.norm_mapq(best("mapq_best")), S.norm_identity(best("id_best")), F.col("cov1"), F.col("cov2"))).otherwise(
        S.geometric_mean(S.norm_mapq(F.col("mapq_best1")), S.norm_identity(F.col("id_best1")), F.col("cov1"), unique)
    )
    return q.withColumn("class", cls).select(
        "query_id", "class", F.col("cov1").alias("U_cov"), F.col("cov2").alias("U_cov_2nd"), "M_count", F.when(F.col("class").isin("Uecc", "Mecc"), conf).alias("conf"),
        F.when(is_m, best("mapq_best")).otherwise(F.col("mapq_best1")).alias("mapq_best"), F.when(is_m, best("id_best")).otherwise(F.col("id_best1")).alias("identity_best"),
        F.col("locus1").alias("best_locus"), F.col("rep_aln1").alias("rep_aln"),
    )


def classify(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All of it, from raw alignments: the decision for every query that has alignments of good size.

    What several steps read is written once: the prepared columns, the located alignments and the table of loci.
    """
    rows = cut(prepared(df).select("aln_id", "query_id", "chr", "strand", "start0", "end0", "q_start", "q_end", "size", "mapq", "identity", "alignment_length", "gap_percentage"))
    hq = rows.where(F.col("gap_percentage") <= rules.gap_percent)
    style = zero_based(hq)
    located = with_loci(hq.drop("gap_percentage"), rules)
    return decide(rows, cut(loci(cut(located), style)), style, rules)


def unclassified(df: DataFrame, decided: DataFrame) -> DataFrame:
    """All alignments of queries that are neither U nor M."""
    return prepared(df).join(decided.where("class in ('Uecc', 'Mecc')").select("query_id"), "query_id", "left_anti")
