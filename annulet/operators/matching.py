"""Predictions against ground truth: greedy one-to-one matching, coverage matching, and the measures of both.

The greedy matching runs in rounds over the whole table of candidates; nothing is compared that shares neither a read
nor a place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annulet.operators import intervals as I
from annulet.session import cut


def candidates(preds: DataFrame, truths: DataFrame, keys: list[str], tolerance: int = 50, share: float = 0.8) -> DataFrame:
    """pred, truth, kind, score; both sides have keys, id, read, start0, end0. Kind 0: same read; 1: both ends near; 2: enough overlap of either."""
    p = preds.select(*keys, F.col("id").alias("pred"), F.col("read").alias("p_read"), F.col("start0").alias("p0"), F.col("end0").alias("p1"))
    t = truths.select(*keys, F.col("id").alias("truth"), F.col("read").alias("t_read"), F.col("start0").alias("t0"), F.col("end0").alias("t1"))
    reads = p.join(t, p["p_read"] == t["t_read"]).select("pred", "truth", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("score"))
    wide = p.withColumns({"x0": F.col("p0") - tolerance, "x1": F.col("p1") + tolerance})
    meets = I.overlap_join(wide, t, keys, ("x0", "x1"), ("t0", "t1"))
    shared = F.least("p1", "t1") - F.greatest("p0", "t0")
    near = (F.abs(F.col("p0") - F.col("t0")) <= tolerance) & (F.abs(F.col("p1") - F.col("t1")) <= tolerance)
    enough = (shared >= share * (F.col("t1") - F.col("t0"))) | (shared >= share * (F.col("p1") - F.col("p0")))
    places = meets.where(near | (enough & (shared > 0))).select("pred", "truth", F.when(near, 1).otherwise(2).alias("kind"), shared.alias("score"))
    return reads.unionByName(places)


def greedy(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """pred, truth: predictions in turn take, of the truths still free, the first on their read, else the first with both ends near, else the one that shares most.

    A prediction's choice is final once no earlier one that is still open could take the same truth. All such
    predictions choose at once, then go, with their truths; so no group of predictions is ever in one task, and the
    number of rounds is the longest chain of predictions that wait for each other, each with a smaller number.
    """
    prefer = F.struct("kind", F.when(F.col("kind") == 2, -F.col("score")).otherwise(0).alias("less"), "truth")
    left = cut(edges.groupBy("pred", "truth").agg(F.min(prefer).alias("p")))
    found = left.select("pred", "truth").limit(0)
    for _ in range(most_rounds):
        best = left.groupBy("pred").agg(F.min("p").alias("p")).select("pred", F.col("p.truth").alias("truth"))
        first = left.groupBy("truth").agg(F.min("pred").alias("pred"))
        done = cut(best.join(first, ["pred", "truth"]))
        if done.isEmpty():  # only if nothing is left: the first open prediction never waits
            return found
        found = found.unionByName(done)
        left = cut(left.join(done.select("pred"), "pred", "left_anti").join(done.select("truth"), "truth", "left_anti"))
    raise RuntimeError(f"predictions wait for each other over more than {most_rounds} rounds")


def coverage_candidates(preds: DataFrame, truths: DataFrame, keys: list[str], threshold: float, both: bool = True) -> DataFrame:
    """pred, truth, kind 2, score (parts per million) of molecules, sets of segments, that cover each other enough."""
    size = lambda df, name: df.groupBy("id").agg(F.sum(F.col("end0") - F.col("start0")).alias(name))
    p = preds.select(*keys, F.col("id").alias("pred"), F.col("start0").alias("p0"), F.col("end0").alias("p1"))
    t = truths.select(*keys, F.col("id").alias("truth"), F.col("start0").alias("t0"), F.col("end0").alias("t1"))
    shared = I.overlap_join(p, t, keys, ("p0", "p1"), ("t0", "t1")).groupBy("pred", "truth").agg(F.sum("overlap").alias("n"))
    shared = shared.join(size(preds, "pn").withColumnRenamed("id", "pred"), "pred").join(size(truths, "tn").withColumnRenamed("id", "truth"), "truth")
    of_t, of_p = F.col("n") / F.col("tn"), F.col("n") / F.col("pn")
    kept = shared.where((of_t >= threshold) & ((of_p >= threshold) if both else F.lit(True)))
    score = of_t + of_p if both else of_t
    return kept.select("pred", "truth", F.lit(2).alias("kind"), F.floor(score * 1e6).cast("bigint").alias("score"))


def union_segments(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each molecule's segments without overlaps, so that lengths add up."""
    return I.merge(df, ["id", *keys], "start0", "end0").drop("members")


def measures(tp: Column, predictions: Column, truths: Column) -> dict[str, Column]:
    """Recall, precision and F1, 0 where there is nothing to divide by."""
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    recall, precision = ratio(tp, truths), ratio(tp, predictions)
    return {"recall": recall, "precision": precision, "f1": ratio(2 * recall * precision, recall + precision)}


def score(matches: DataFrame, preds: DataFrame, truths: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, recall, precision, f1."""
    n = lambda df, c: df.agg(F.countDistinct(c)).scalar()
    out = matches.agg(F.count("*").alias("tp")).select("tp", (n(preds, "id") - F.col("tp")).alias("fp"), (n(truths, "id") - F.col("tp")).alias("fn"))
    return out.withColumns(measures(F.col("tp"), F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")))
