"""Seeded synthetic rings with ground truth, and the alignment rows an aligner would give for them.

Every number is drawn from a hash of the seed and the ring's number, so any part of the data can be made anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASES = np.frombuffer(b"ACGT", np.uint8)


def draw(name: str, low: int, high: int, seed: int) -> Column:
    """A whole number from low to high for each ``id`` and purpose."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "id"), F.lit(high - low + 1)) + low


def genome(spark: SparkSession, chromosomes: int, length: int, seed: int, chunk: int = 1 << 20, families: int = 0, unit: int = 300, repeats: int = 0, divergence: float = 0.0) -> DataFrame:
    """chr, start0, seq in chunks of random bases.

    With ``families``, ``repeats`` places of every chunk hold the sequence of one of so many repeat families, ``unit``
    bases long, of which each base of a copy differs with the probability ``divergence``.
    """

    def with_repeats(seq: np.ndarray, drawn: list[int]) -> np.ndarray:
        rng = np.random.default_rng([*drawn, 1])
        for _ in range(repeats if families and seq.size >= unit else 0):
            copy = BASES[np.random.default_rng([seed, int(rng.integers(families)), 2]).integers(0, 4, unit)]
            other = rng.random(unit) < divergence
            copy[other] = BASES[rng.integers(0, 4, int(other.sum()))]
            at = int(rng.integers(seq.size - unit + 1))
            seq[at : at + unit] = copy
        return seq

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            drawn = [[seed, c, s] for c, s in zip(rows["c"], rows["start0"])]
            seqs = [with_repeats(BASES[np.random.default_rng(d).integers(0, 4, min(chunk, length - d[2]))], d).tobytes().decode() for d in drawn]
            yield pa.RecordBatch.from_arrays([pa.array([f"chr{c}" for c in rows["c"]]), batch.column(1), pa.array(seqs)], ["chr", "start0", "seq"])

    per = -(-length // chunk)
    grid = spark.range(chromosomes * per).selectExpr(f"id div {per} + 1 as c", f"(id % {per}) * {chunk} as start0")
    return grid.mapInArrow(run, "chr string, start0 bigint, seq string")


def mutated(seq: Column, rate: float, seed: int, key: Column | None = None) -> Column:
    """Each base replaced by another one with this probability; the same for the same key (without one, the same sequence) and seed."""

    @F.pandas_udf("string")
    def change(s: pd.Series, keys: pd.Series) -> pd.Series:
        out = []
        for text, drawn in zip(s, keys):
            if not text:
                out.append(text)
                continue
            raw = np.frombuffer(text.encode(), np.uint8).copy()
            rng = np.random.default_rng([seed, drawn & (1 << 64) - 1])
            hit = np.flatnonzero(rng.random(len(raw)) < rate)
            raw[hit] = BASES[(np.searchsorted(BASES, raw[hit]) + rng.integers(1, 4, hit.size)) % 4]
            out.append(raw.tobytes().decode())
        return pd.Series(out)

    return change(seq, F.xxhash64(seq if key is None else key))


def truth(spark: SparkSession, n: int, seed: int, chromosomes: int = 3, length: int = 20_000_000, copies: int = 2) -> DataFrame:
    """id, kind, size, seg, start0 within the ring's pieces: ``n`` rings of each kind, one row per segment or copy.

    U: one place of 200 to 800 bases. M: a unit of 120 to 300 bases at several far places. C: two or three segments of
    120 to 260 bases, on different chromosomes.
    """
    third = length // 4
    ring = spark.range(3 * n).withColumn("kind", F.element_at(F.array(F.lit("Uecc"), F.lit("Mecc"), F.lit("Cecc")), (F.col("id") % 3 + 1).cast("int")))
    ring = ring.withColumns({"home": draw("chr", 1, chromosomes, seed), "at": draw("at", 1000, third, seed), "segs": draw("segs", 2, 3, seed)})
    size = F.when(F.col("kind") == "Uecc", draw("u", 200, 800, seed)).when(F.col("kind") == "Mecc", draw("m", 120, 300, seed))
    count = F.when(F.col("kind") == "Uecc", 1).when(F.col("kind") == "Mecc", copies).otherwise(F.col("segs")).cast("int")
    rows = ring.withColumn("seg", F.explode(F.sequence(F.lit(1), count)))
    piece = F.pmod(F.xxhash64(F.lit(seed), F.lit("piece"), "id", "seg"), F.lit(141)) + 120
    rows = rows.withColumn("len", F.coalesce(size, piece))
    rows = rows.withColumn("chr", F.concat(F.lit("chr"), ((F.col("home") - 1 + F.when(F.col("kind") == "Cecc", F.col("seg") - 1).otherwise(0)) % chromosomes + 1).cast("string")))
    rows = rows.withColumn("start0", F.col("at") + F.when(F.col("kind") == "Mecc", (F.col("seg") - 1) * third).otherwise(0))
    rows = rows.withColumn("strand", F.when(F.pmod(F.xxhash64(F.lit(seed), F.lit("strand"), "id", "seg"), F.lit(2)) == 0, "+").otherwise("-"))
    return rows.select("id", "kind", "seg", "chr", "start0", (F.col("start0") + F.col("len")).alias("end0"), "strand", F.col("len").alias("length"))


def alignments(segments: DataFrame) -> DataFrame:
    """Rows of the alignment table for U and M rings, without an aligner: each place explains the whole ring once."""
    rows = segments.where("kind <> 'Cecc'")
    plus = F.col("strand") == "+"
    return rows.select(
        (F.col("id") * 100 + F.col("seg")).alias("aln_id"), F.concat_ws("|", F.concat(F.lit("read"), F.col("id").cast("string")), F.lit("rep0"), F.col("length").cast("string"), F.lit("2.0"), F.lit("circular")).alias("query_id"),
        F.col("chr").alias("subject_id"), F.lit(100.0).alias("identity"), F.col("length").alias("alignment_length"), F.lit(1).cast("bigint").alias("q_start"), F.col("length").alias("q_end"),
        F.when(plus, F.col("start0") + 1).otherwise(F.col("end0")).alias("s_start"), F.when(plus, F.col("end0")).otherwise(F.col("start0") + 1).alias("s_end"), F.lit(100.0).alias("bit_score"),
        F.when(plus, "plus").otherwise("minus").alias("sstrand"), F.lit(60).alias("mapq"),
    )


def doubled_alignments(segments: DataFrame) -> DataFrame:
    """Alignments of the doubled sequences of C rings, for the chimeric detector."""
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("seg")
    rows = segments.where("kind = 'Cecc'").withColumns({"off": F.sum("length").over(w) - F.col("length"), "size": F.sum("length").over(Window.partitionBy("id")), "n": F.count("*").over(Window.partitionBy("id"))})
    rows = rows.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    qs = F.col("off") + F.col("turn") * F.col("size")
    return rows.select(
        F.concat(F.lit("read"), F.col("id").cast("string")).alias("query_id"), (F.col("id") * 100 + F.col("turn") * F.col("n") + F.col("seg")).alias("aln_id"), "chr", "start0", "end0", "strand",
        qs.alias("qs"), (qs + F.col("length")).alias("qe"), "size", F.lit(99.0).alias("identity"),
    )
