"""Interval operators on keyed, half-open intervals: merge, depth, overlap joins, counts per window.

Overlap joins are equi-joins on key and tile: every interval is listed in each tile it touches, and a pair is kept
only in the tile where the later of its two starts lies, so it comes out once. A chromosome that holds a third of
all rows is spread over as many tasks as it has tiles; no side is broadcast by hand.
Null keys or ends drop out; touching intervals don't overlap but merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annulet.functions.scalars import reciprocal
from annulet.operators.interval_sweep import depth, sweep  # noqa: F401


def islands(df: DataFrame, keys: list[str], lo: str, hi: str, order: list[str], slack: int = 0, name: str = "island") -> DataFrame:
    """A number per island: a row opens a new one if its start is more than ``slack`` after every end before it.

    For keys with few rows, such as a query or a read; for whole chromosomes use ``merge``.
    """
    w = Window.partitionBy(*keys).orderBy(lo, *order)
    before = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("_open", F.when(before.isNull() | (F.col(lo) > before + slack), 1).otherwise(0))
    return opened.withColumn(name, F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_open")


def merge(df: DataFrame, keys: list[str], lo: str, hi: str, slack: int = 0) -> DataFrame:
    """keys, lo, hi, members of intervals that overlap, touch or lie no more than ``slack`` apart; empty intervals are left out.

    Stretches come from the tiled sweep over intervals longer by the slack, members from joining starts to stretches,
    so no task holds all intervals of a key.
    """
    rows = df.where(F.col(lo) < F.col(hi)).select(*keys, F.col(lo).alias("_m0"), (F.col(hi) + slack).alias("_m1"))
    found = sweep(rows, keys, "_m0", "_m1").where("kind = 'covered'").select(*keys, F.col("start0").alias(lo), F.col("end0").alias(hi))
    starts = rows.select(*keys, F.col("_m0").alias("_p0"), (F.col("_m0") + 1).alias("_p1"))
    counted = overlap_join(found, starts, keys, (lo, hi), ("_p0", "_p1"), tile=1 << 18).groupBy(*keys, lo, hi).agg(F.count("*").alias("members"))
    return counted.withColumn(hi, F.col(hi) - slack)


def _tiled(df: DataFrame, lo: str, hi: str, tile: int, name: str) -> DataFrame:
    first, last = F.floor(F.col(lo) / tile), F.floor((F.greatest(F.col(hi), F.col(lo) + 1) - 1) / tile)
    return df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).withColumn(name, F.explode(F.sequence(first, last)))


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], a_ends: tuple[str, str], b_ends: tuple[str, str], tile: int = 1 << 14, shared: int = 1, extra: Column | None = None) -> DataFrame:
    """Pairs of rows with equal keys that share ``shared`` positions or more; column names of a and b must differ but for the keys."""
    (a_lo, a_hi), (b_lo, b_hi) = a_ends, b_ends
    pairs = _tiled(a, a_lo, a_hi, tile, "_tile").join(_tiled(b, b_lo, b_hi, tile, "_tile"), [*keys, "_tile"])
    later = F.greatest(a_lo, b_lo)
    pairs = pairs.where((F.least(a_hi, b_hi) - later >= shared) & (F.floor(later / tile) == F.col("_tile")))
    pairs = pairs if extra is None else pairs.where(extra)
    return pairs.withColumn("overlap", F.least(a_hi, b_hi) - F.greatest(a_lo, b_lo)).drop("_tile")


def count_overlaps(a: DataFrame, windows: DataFrame, keys: list[str], a_key: str, a_ends: tuple[str, str], w_ends: tuple[str, str], name: str) -> DataFrame:
    """a with the number of windows each of its rows overlaps, 0 included."""
    hits = overlap_join(a.select(*keys, a_key, *a_ends), windows, keys, a_ends, w_ends).groupBy(a_key).agg(F.count("*").alias(name))
    return a.join(hits, a_key, "left").na.fill(0, [name])


def reciprocal_join(a: DataFrame, b: DataFrame, keys: list[str], a_ends: tuple[str, str], b_ends: tuple[str, str], share: float = 0.99, tolerance: int = 20) -> DataFrame:
    """Pairs with equal keys whose intervals match reciprocally (see ``scalars.reciprocal``).

    Both starts and lengths of such a pair are close, so rows meet by class of length (powers of two) and a cell of
    the start as wide as that class allows starts to differ; b is listed in the neighbouring cells and classes.
    """
    (a_lo, a_hi), (b_lo, b_hi) = a_ends, b_ends
    part = min(share, 1.0)  # above 1 only the tolerance counts
    size = lambda lo, hi: F.greatest(F.col(hi) - F.col(lo), F.lit(1)).cast("double")
    level = lambda n: F.floor(F.log2(F.greatest(n, F.lit(1.0)))).cast("int")
    width = lambda c: F.ceil(F.greatest(F.lit(float(tolerance + 1)), F.pow(F.lit(2.0), c + 1) * ((1 - part) / part) + tolerance + 1))
    left = a.withColumn("_class", level(size(a_lo, a_hi))).withColumn("_cell", F.floor(F.col(a_lo) / width(F.col("_class"))))
    n = size(b_lo, b_hi)
    right = b.withColumn("_class", F.explode(F.sequence(level((n - 2 * tolerance) * part), level((n + 2 * tolerance) / part))))
    right = right.withColumn("_cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.col(b_lo) / width(F.col("_class"))) + i)))
    same = reciprocal(F.col(a_lo), F.col(a_hi), F.col(b_lo), F.col(b_hi), share, tolerance)
    return left.join(right, [*keys, "_class", "_cell"]).where(same).drop("_class", "_cell")
