"""Alignment text formats to rows and back: PAF lines and MAF blocks, as column expressions over text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annulet.functions.scalars import cs_counts


def paf_line(rows: DataFrame) -> Column:
    """A PAF line with the twelve fixed fields for an alignment row."""
    text = lambda c: c.cast("string")
    low, high = F.least("s_start", "s_end"), F.greatest("s_start", "s_end")
    return F.concat_ws(
        "\t", "query_id", text(F.col("q_end")), text(F.col("q_start") - 1), text(F.col("q_end")), F.when(F.col("sstrand") == "plus", "+").otherwise("-"), "subject_id", text(high),
        text(low - 1), text(high), text(F.col("alignment_length") - F.col("mismatches")), text(F.col("alignment_length")), text(F.col("mapq")),
    )


def paf_rows(df: DataFrame, line: str) -> DataFrame:
    """The other columns of df with the alignment a PAF line holds; lines with fewer than twelve fields are left out.

    Identity comes from a ``de:f:`` tag if there is one, else from matches over length; mismatches and gap openings
    from a ``cs:Z:`` tag, else from what is no match. Positions are closed from 1; on the minus strand the subject's
    are exchanged.
    """
    f = F.split(line, "\t")
    whole = lambda i: f[i].try_cast("bigint")
    de = F.nullif(F.regexp_extract(line, r"\tde:f:([0-9.eE+-]+)", 1), F.lit("")).try_cast("double")
    cs = F.nullif(F.regexp_extract(line, r"\tcs:Z:(\S+)", 1), F.lit(""))
    plus = f[4] == "+"
    identity = F.coalesce((1 - de) * 100, whole(9) / F.nullif(whole(10), F.lit(0)) * 100)
    return df.where(F.size(f) >= 12).select(
        *(c for c in df.columns if c != line), f[0].alias("query_id"), f[5].alias("subject_id"), (F.rint(identity * 100) / 100).alias("identity"), whole(10).alias("alignment_length"),
        F.coalesce(cs_counts(cs)["mismatches"].cast("bigint"), whole(10) - whole(9)).alias("mismatches"), F.coalesce(cs_counts(cs)["gap_opens"].cast("bigint"), F.lit(0).cast("bigint")).alias("gap_opens"),
        (whole(2) + 1).alias("q_start"), whole(3).alias("q_end"), F.when(plus, whole(7) + 1).otherwise(whole(8)).alias("s_start"), F.when(plus, whole(8)).otherwise(whole(7) + 1).alias("s_end"),
        F.lit(0.0).alias("evalue"), F.lit(0.0).alias("bit_score"), F.when(plus, "plus").otherwise("minus").alias("sstrand"), whole(11).alias("mapq"),
    )


def maf_rows(blocks: DataFrame, block: str) -> DataFrame:
    """Alignments of MAF blocks (text from one ``a`` line to the next): the first ``s`` line is the reference, the second the query.

    Query places on the minus strand are counted from the other end; the identity of such splits is taken as 95.
    Blocks without two well-formed ``s`` lines are left out, a missing score is 0.
    """
    s_line = r"(?m)^s\s+(\S+)\s+(\d+)\s+(\d+)\s+([+-])\s+(\d+)\s+\S+"
    part = lambda i: F.regexp_extract_all(block, F.lit(s_line), F.lit(i))
    rows = blocks.select(F.nullif(F.regexp_extract(block, r"score=(-?\d+)", 1), F.lit("")).try_cast("bigint").alias("score"), *(part(i).alias(f"p{i}") for i in range(1, 6)))
    rows = rows.where("size(p1) >= 2")
    n = lambda p, i: F.col(p)[i].try_cast("bigint")
    q_start = F.when(F.col("p4")[1] == "-", n("p5", 1) - n("p2", 1) - n("p3", 1)).otherwise(n("p2", 1))
    return rows.select(
        F.col("p1")[0].alias("chr"), n("p2", 0).alias("ref_start"), (n("p2", 0) + n("p3", 0)).alias("ref_end"), F.col("p1")[1].alias("query_id"), q_start.alias("query_start"),
        (q_start + n("p3", 1)).alias("query_end"), n("p5", 1).alias("query_len"), F.coalesce("score", F.lit(0)).alias("score"), F.lit(95.0).alias("identity"), F.col("p4")[1].alias("strand"),
    )
