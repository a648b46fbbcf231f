"""Overlapping and gapped intervals: covered periods and the gaps between them, by a sweep line.

Every interval gives a +1 event at its lower and a -1 event at its upper end. Events at one position are
added up before they are shuffled, so a tile of the axis holds at most ``tile`` rows for a key however many
intervals lie on it; active counts are prefix sums within a tile plus the net count of all tiles before it.
A key with a third of all intervals is therefore spread over as many tasks as it has tiles.

Defined cases: intervals with a null key or end, or with equal ends, are left out; ends in the wrong order are
exchanged; touching intervals are one period; repeated rows change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.session import cut


def chromosome(name: Column) -> Column:
    """``chr`` and the bare name, whatever the case, blanks or missing ``chr``; null if nothing is left."""
    bare = F.regexp_replace(F.upper(F.regexp_replace(name, r"(?U)^\s+|\s+$", "")), r"(?U)^CHR\s*", "")
    return F.when(bare != "", F.concat(F.lit("chr"), bare))


def active(df: DataFrame, keys: list[str], lo: str, hi: str, tile: int) -> DataFrame:
    """keys, _tile, _pos, _d, _n: every position where the number of intervals over it changes by _d, to _n."""
    ends = df.select(*keys, F.least(lo, hi).cast("bigint").alias("a"), F.greatest(lo, hi).cast("bigint").alias("b"))
    ends = ends.where("a is not null and b is not null and a < b").dropna(subset=keys)
    events = ends.select(*keys, F.explode(F.array(F.struct(F.col("a").alias("p"), F.lit(1).alias("d")), F.struct(F.col("b").alias("p"), F.lit(-1).alias("d")))).alias("e"))
    events = events.select(*keys, F.floor(F.col("e.p") / tile).alias("_tile"), F.col("e.p").alias("_pos"), F.col("e.d").alias("_d"))
    # Written once: what lies in a tile and what all tiles add up to both come from it.
    steps = cut(events.groupBy(*keys, "_tile", "_pos").agg(F.sum("_d").alias("_d")).where("_d <> 0"))
    before = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = steps.groupBy(*keys, "_tile").agg(F.sum("_d").alias("_net"))
    tiles = tiles.select(*keys, "_tile", F.coalesce(F.sum("_net").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_tile").orderBy("_pos")
    return steps.join(tiles, [*keys, "_tile"]).withColumn("_n", F.col("_base") + F.sum("_d").over(inside))


def followed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_to``, the position of the next row of the key; that of a tile's last row is the first of the next tile that has any."""
    group = Window.partitionBy(*keys).orderBy("_tile")
    rows = cut(rows)
    first = rows.groupBy(*keys, "_tile").agg(F.min("_pos").alias("_first"))
    first = first.select(*keys, "_tile", F.lead("_first").over(group).alias("_after"))
    inside = Window.partitionBy(*keys, "_tile").orderBy("_pos")
    return rows.join(first, [*keys, "_tile"]).withColumn("_to", F.coalesce(F.lead("_pos").over(inside), "_after")).drop("_after")


def sweep(df: DataFrame, keys: list[str], lo: str, hi: str, tile: int = 1 << 20) -> DataFrame:
    """keys, kind ('covered' or 'gap'), start0, end0; positions are whole numbers, ``tile`` positions make a tile."""
    turns = active(df, keys, lo, hi, tile).where((F.col("_n") == 0) | (F.col("_n") == F.col("_d"))).withColumn("_up", F.col("_n") > 0)
    out = followed(turns, keys).where(F.col("_to").isNotNull())
    return out.select(*keys, F.when(F.col("_up"), "covered").otherwise("gap").alias("kind"), F.col("_pos").alias("start0"), F.col("_to").alias("end0"))


def depth(df: DataFrame, keys: list[str], lo: str, hi: str, tile: int = 1 << 20) -> DataFrame:
    """keys, lo, hi, depth: stretches of equal depth above 0, as long as can be."""
    out = followed(active(df, keys, lo, hi, tile), keys).where((F.col("_n") > 0) & F.col("_to").isNotNull())
    return out.select(*keys, F.col("_pos").alias(lo), F.col("_to").alias(hi), F.col("_n").alias("depth"))
