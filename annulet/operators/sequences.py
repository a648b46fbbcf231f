"""Ring sequences of classified rows, lookups with a fallback key, provisional numbers, and what is left over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.functions import rings, scalars as S
from annulet.operators.numbering import numbered


def looked_up(rows: DataFrame, key: str, library: DataFrame, columns: list[str]) -> DataFrame:
    """rows with ``columns`` of the library (id, ...) by the full key, else by its part before the first bar (the smallest id of that base)."""
    base = library.groupBy(S.base_id(F.col("id")).alias("_base")).agg(F.min(F.struct("id", *columns)).alias("_b"))
    full = library.select(F.col("id").alias(key), *(F.col(c).alias(f"_f_{c}") for c in columns))
    out = rows.join(full, key, "left").withColumn("_base", S.base_id(F.col(key))).join(base, "_base", "left")
    return out.withColumns({c: F.coalesce(f"_f_{c}", f"_b.{c}") for c in columns}).drop("_base", "_b", *(f"_f_{c}" for c in columns))


def ring_sequences(rows: DataFrame, library: DataFrame) -> DataFrame:
    """rows (query_id, q_start, size, ...) with ``ring`` cut from the library and ``ring_key``, the form equal rings share; '' where it can't be cut."""
    found = looked_up(rows, "query_id", library, ["seq"])
    found = found.withColumn("ring", F.coalesce(S.ring_substring(F.col("seq"), F.col("q_start"), F.col("size")), F.lit("")))
    return found.withColumn("ring_key", rings.canonical(F.col("ring"))).drop("seq")


def left_over(library: DataFrame, classified: DataFrame) -> DataFrame:
    """id, seq of sequences (id, seq) with no classified query: numbered along their id, half as long, as they were doubled."""
    rows = library.where("length(seq) > 0").join(classified.select(F.col("query_id").alias("id")).distinct(), "id", "left_anti")
    named = numbered(rows, ["id"], "_no")
    half = F.when(F.length("seq") > 1, F.substring("seq", F.lit(1), F.floor(F.length("seq") / 2).cast("int"))).otherwise(F.col("seq"))
    return named.select(S.safe_id(F.concat("id", F.lit("__X"), F.col("_no").cast("string"))).alias("id"), half.alias("seq"))


def provisional(rows: DataFrame, prefix: str) -> DataFrame:
    """rows with a non-empty ring, numbered by ring key: equal rings have one number."""
    kept = rows.where("ring_key <> ''")
    numbers = numbered(kept.select("ring_key").distinct(), ["ring_key"], "_no")
    return kept.join(numbers, "ring_key").withColumn("eccDNA_id", F.concat(F.lit(prefix), F.col("_no").cast("string"))).drop("_no")
