"""Redundancy between circles: simple against simple, chimeric against chimeric, and the table of what stays.

Chimeric circles are compared through pairs of matching segments: a pair of circles with n segments each is equal,
going round, if some shift is shared by matches of all n segments; in reverse, if some mirror place is; one is part
of the other if all its segments have a match. So no circle is ever compared with all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators.intervals import reciprocal_join


def simple_matches(inferred: DataFrame, confirmed: DataFrame, share: float = 0.99, tolerance: int = 20) -> DataFrame:
    """id, match: for each inferred (id, chr, start0, end0) the first confirmed (match, kind, chr, m_start, m_end) by kind, start and match."""
    pairs = reciprocal_join(inferred, confirmed, ["chr"], ("start0", "end0"), ("m_start", "m_end"), share, tolerance)
    first = pairs.groupBy("id").agg(F.min(F.struct("kind", "m_start", "match")).alias("m"))
    return first.select("id", F.col("m.match").alias("match"), F.col("m.kind").alias("kind"))


def segment_matches(a: DataFrame, b: DataFrame, share: float = 0.99, tolerance: int = 20) -> DataFrame:
    """(id, i, n) x (match, j, m) of matching segments with ``same`` and ``opposite`` strand; both sides: id, seg (from 0), segs, chr, start0, end0, strand."""
    left = a.select(F.col("id"), F.col("seg").alias("i"), F.col("segs").alias("n"), "chr", F.col("start0").alias("s1"), F.col("end0").alias("e1"), F.col("strand").alias("st1"))
    right = b.select(F.col("id").alias("match"), F.col("seg").alias("j"), F.col("segs").alias("m"), "chr", F.col("start0").alias("s2"), F.col("end0").alias("e2"), F.col("strand").alias("st2"))
    pairs = reciprocal_join(left, right, ["chr"], ("s1", "e1"), ("s2", "e2"), share, tolerance)
    return pairs.select("id", "i", "n", "match", "j", "m", (F.col("st1") == F.col("st2")).alias("same"), (F.col("st1") == S.flipped(F.col("st2"))).alias("opposite"))


def full_matches(pairs: DataFrame, stranded: bool = True) -> DataFrame:
    """id, match with as many segments each, equal after a rotation (also of the reverse complement, if stranded)."""
    even = pairs.where("n = m")
    turned = even.where("same") if stranded else even
    forward = turned.groupBy("id", "match", "n", ((F.col("j") - F.col("i") + F.col("n")) % F.col("n")).alias("k")).agg(F.countDistinct("i").alias("c"))
    out = forward.where("c = n").select("id", "match")
    if stranded:
        mirrored = even.where("opposite").groupBy("id", "match", "n", ((F.col("j") + F.col("i")) % F.col("n")).alias("k")).agg(F.countDistinct("i").alias("c"))
        out = out.unionByName(mirrored.where("c = n").select("id", "match"))
    return out.distinct()


def part_matches(pairs: DataFrame, stranded: bool = True) -> DataFrame:
    """id, match where the match has more segments and holds all of id's, on the same or all on the other strand."""
    fewer = pairs.where("n < m")
    held = fewer.groupBy("id", "match", "n").agg(
        F.countDistinct(F.when(F.col("same"), F.col("i"))).alias("s"), F.countDistinct(F.when(F.col("opposite"), F.col("i"))).alias("o"), F.countDistinct("i").alias("a")
    )
    return held.where("s = n or o = n" if stranded else "a = n").select("id", "match")


def first_match(matches: DataFrame) -> DataFrame:
    """id, match: the first confirmed circle in the order of its id."""
    return matches.groupBy("id").agg(F.min("match").alias("match"))


def chimeric_matches(a: DataFrame, b: DataFrame, share: float = 0.99, tolerance: int = 20, stranded: bool = True, parts: bool = True) -> DataFrame:
    """id, match of redundant chimeric circles, a circle never with itself."""
    pairs = segment_matches(a, b, share, tolerance).where("id <> match")
    found = full_matches(pairs, stranded)
    return first_match(found.unionByName(part_matches(pairs, stranded)) if parts else found)


def redundant(method: str, a: DataFrame, b: DataFrame, share: float = 0.99, tolerance: int = 20) -> DataFrame:
    """The chimeric comparison by name: ``overlap`` of segments or ``exact`` region strings."""
    if method == "overlap":
        return chimeric_matches(a, b, share, tolerance)
    if method == "exact":
        left, right = region_strings(a), region_strings(b).withColumnRenamed("id", "match")
        return first_match(left.join(right, "regions").where("id <> match").select("id", "match"))
    raise ValueError(f"unknown method {method!r}: overlap or exact")


def region_strings(segs: DataFrame) -> DataFrame:
    """id, regions: ``chr:s-e`` of the segments in order, joined by ``;``."""
    one = F.struct("seg", S.region(F.col("chr"), F.col("start0"), F.col("end0")).alias("r"))
    return segs.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["r"]), ";").alias("regions"))
