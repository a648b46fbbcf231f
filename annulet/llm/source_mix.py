"""Mixing sources to target weights, by size in tokens of a public tokenizer.

Tokens are added up per source; a source's repetition rate is its share of the mixture over its tokens. Each
document is emitted floor(rate) times, and once more if a number drawn from a hash of its id and a seed is below
the fraction, so the result is the same on every run and in every partitioning. Without a wanted total, the
mixture is the largest at which every source reaches its share within its ``max_repeats``; with one, rates are
cut at ``max_repeats`` and the report shows what shares that leaves.

Defined cases: documents without a source, or of one without target, are not used; targets without documents (or
with a null or non-positive share) leave their share to the others in proportion; a null max_repeats is 1; a
source named twice counts once, with its largest share; null and empty texts have no tokens and are emitted like
the rest of their source; empty tables give an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.llm import prefix_bpe
from annulet.session import cut

MOST_SOURCES = 10_000  # up to so many, their table is broadcast; more are joined as any two tables are


def sized(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens of the documents that a target names; kept, for two passes read it."""
    wanted = docs.where(F.col("source").isNotNull()).select("doc_id", "source", "text")
    wanted = wanted.join(_small(_targets(targets).select("source"), targets), "source", "left_semi")
    # The source travels as part of the key, so nothing has to be joined afterwards.
    keyed = wanted.select(F.struct("doc_id", "source").alias("k"), "text")
    return cut(prefix_bpe.encode(keyed, "k", "text", count_only=True).select("k.doc_id", "k.source", "n_tokens"))


def _targets(targets: DataFrame) -> DataFrame:
    listed = targets.where("source is not null and target_share > 0").groupBy("source")
    return listed.agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))


def _small(df: DataFrame, targets: DataFrame) -> DataFrame:
    """``df``, of no more rows than there are targets, marked for broadcast if these are few."""
    return F.broadcast(df) if targets.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES else df


def rates(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, tokens, rate: one row per target; rate 0 where there is nothing to repeat."""
    held = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    out = _targets(targets).join(held, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    out = out.withColumn("share", F.when(F.col("tokens") > 0, F.col("target_share") / out.agg(F.sum(F.when(F.col("tokens") > 0, F.col("target_share")))).scalar()))
    reach = out.agg(F.min(F.col("max_repeats") * F.col("tokens") / F.col("share"))).scalar()
    out = out.withColumn("size", F.lit(float(total_tokens)) if total_tokens is not None else reach)
    rate = F.least(F.col("share") * F.col("size") / F.nullif("tokens", F.lit(0)), F.col("max_repeats").cast("double"))
    rate = F.when(F.col("tokens") > 0, rate).otherwise(0.0)
    return out.select("source", "target_share", "max_repeats", "tokens", rate.alias("rate"))


def mix(sizes: DataFrame, rates: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, copy (from 1), n_tokens: one row for each time a document is used."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    copies = F.floor("rate") + F.when(drawn < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    used = sizes.join(_small(rates.select("source", "rate", "max_repeats"), rates), "source")
    used = used.withColumn("copies", F.least(copies, F.col("max_repeats")).cast("int")).where("copies > 0")
    return used.select("doc_id", "source", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), "n_tokens")


def shares(mixed: DataFrame, rates: DataFrame) -> DataFrame:
    """The report: per target its rate, the tokens it gave and the share reached."""
    given = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_records"), F.max("copy").alias("most_repeats"))
    out = rates.join(given, "source", "left").na.fill(0, ["mixed_tokens", "mixed_records", "most_repeats"])
    return out.withColumn("actual_share", F.col("mixed_tokens") / F.nullif(out.agg(F.sum("mixed_tokens")).scalar(), F.lit(0)))
