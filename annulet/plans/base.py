"""The domain tables, each record once in the version loaded last, and small helpers shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.session import table


def latest(df: DataFrame, keys: list[str], version: str = "loaded_at") -> DataFrame:
    """One row for each key, the one with the latest version (of equal versions the greatest row)."""
    rest = [c for c in df.columns if c not in keys and c != version]
    held = df.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_v"))
    return held.select(*(F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in df.columns))


KEYS = {"tandem": ["rec_id"], "alignments": ["aln_id"], "ecc_core": ["rec_id"], "split_overview": ["rec_id"], "inferred_simple": ["eccDNA_id"], "inferred_chimeric": ["circle_no", "seg_index"]}


def once(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """The table (or these columns and its key) without second deliveries."""
    df = table(spark, d, name)
    if columns:
        df = df.select(*KEYS[name], *(c for c in columns if c not in KEYS[name]), "loaded_at")
    return latest(df, KEYS[name])


def once_sql(name: str) -> str:
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {', '.join(KEYS[name])} ORDER BY loaded_at DESC) = 1)"


def fixed(c: Column, digits: int = 4) -> Column:
    """A double as a whole number of its last digit, the same in every engine."""
    return F.floor(c * 10**digits + 0.5).cast("bigint")


def fixed_sql(c: str, digits: int = 4) -> str:
    return f"CAST(floor(({c}) * {10**digits} + 0.5) AS BIGINT)"
