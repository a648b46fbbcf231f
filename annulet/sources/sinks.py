"""Writers: FASTA, BED, BEDPE and tables. Every one writes a folder of parts, or with ``single`` one part.

An empty result still has its header.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.sources import storage


def fasta_record(title: Column, seq: Column, width: int = 60) -> Column:
    """``>title`` and the sequence in lines of this width (0: one line); ``N`` where there is none."""
    body = F.coalesce(F.nullif(seq, F.lit("")), F.lit("N"))
    return F.concat(F.lit(">"), title, F.lit("\n"), F.regexp_replace(body, f"(.{{{width}}})(?=.)", "$1\n") if width else body)


def title_simple(id: Column, region: Column, strand: Column, length: Column, repeats: Column, reads: Column) -> Column:
    return F.concat(id, F.lit("|"), region, F.lit("("), strand, F.lit(")|length="), length.cast("string"), F.lit("|repeats="), repeats.cast("string"), F.lit("|reads="), reads.cast("string"))


def title_multi(id: Column, sites: Column, length: Column) -> Column:
    return F.concat(id, F.lit("|multi_loci:"), sites.cast("string"), F.lit("_sites|length="), length.cast("string"))


def title_chimeric(id: Column, segments: Column, chromosomes: Column, length: Column) -> Column:
    return F.concat(id, F.lit("|segments:"), segments.cast("string"), F.lit("|junctions:"), F.array_join(chromosomes, "-"), F.lit("|length="), length.cast("string"))


def write_fasta(df: DataFrame, path: str, title: Column | None = None, width: int = 60, append: bool = False) -> None:
    """From (id, seq)."""
    df.select(fasta_record(F.col("id") if title is None else title, F.col("seq"), width).alias("value")).write.mode("append" if append else "overwrite").text(path)


def write_table(df: DataFrame, path: str, sep: str = ",", header: bool = True, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep=sep, header=header, emptyValue="")


def write_bed(df: DataFrame, path: str, single: bool = False) -> None:
    """The columns as they come, tab-separated, without a header."""
    write_table(df, path, sep="\t", header=False, single=single)


def write_json(spark: SparkSession, stats: dict, path: str) -> None:
    """A small report of the driver, in any file system."""
    storage.write_text(spark, json.dumps(stats, indent=2, sort_keys=True, default=str), path)


def text_report(title: str, sections: dict[str, dict[str, object]]) -> str:
    """Sections of name and value, names aligned."""
    out = [title, "=" * len(title)]
    for name, facts in sections.items():
        wide = max([len(str(k)) for k in facts], default=0)
        out += ["", name, "-" * len(name), *(f"{str(k).ljust(wide)}  {v}" for k, v in facts.items())]
    return "\n".join(out) + "\n"


def html_report(title: str, sections: dict[str, dict[str, object]]) -> str:
    from html import escape

    body = "".join(
        f"<h2>{escape(name)}</h2><table>" + "".join(f"<tr><th>{escape(str(k))}</th><td>{escape(str(v))}</td></tr>" for k, v in facts.items()) + "</table>" for name, facts in sections.items()
    )
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{body}</body></html>"
