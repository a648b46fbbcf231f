"""Readers of sequence and alignment text as DataFrames, and what the driver may learn by a look at a file's head.

Each reader takes a path, a folder or a pattern. Records that span lines are cut by a record separator, so files are
split for parallel reading where the compression allows it; one record is one row.
"""

from __future__ import annotations

import csv
import gzip
import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions import scalars as S
from annulet.operators import alignment_text
from annulet.sources import sinks

# Columns of the headerless tables.
TANDEM = "readName string, repN string, copyNum double, readLen bigint, start bigint, end bigint, consLen bigint, aveMatch double, fullLen bigint, subPos string, consSeq string"
ALIGNMENT = "query_id string, subject_id string, identity double, alignment_length bigint, mismatches bigint, gap_opens bigint, q_start bigint, q_end bigint, s_start bigint, s_end bigint, evalue double, bit_score double, sstrand string, mapq bigint"


def head(path: str, n: int = 1 << 16) -> bytes:
    """The beginning of a file, unzipped; of a folder, or of one in another file system, its first lines, read by Spark."""
    if re.match(r"\w+:/", path) or os.path.isdir(path):
        rows = SparkSession.getActiveSession().read.text(path).limit(200).collect()
        return "\n".join(r["value"] for r in rows).encode()[:n]
    with open(path, "rb") as f:
        start = f.read(2)
    with gzip.open(path, "rb") if start == b"\x1f\x8b" else open(path, "rb") as f:
        return f.read(n)


def sniff(path: str) -> str:
    """'fasta', 'fastq', 'empty' or 'unknown' (also inside gzip), from the first lines."""
    lines = head(path).decode("utf-8", "replace").lstrip().splitlines()
    if not lines:
        return "empty"
    if lines[0].startswith(">"):
        return "fasta"
    return "fastq" if lines[0].startswith("@") and any(x.startswith("+") for x in lines[1:4]) else "unknown"


def delimiter(path: str) -> str:
    """The separator of a table with a header."""
    line = head(path).decode("utf-8", "replace").split("\n", 1)[0]
    try:
        return csv.Sniffer().sniff(line, ",;\t|").delimiter
    except csv.Error:
        return "\t" if "\t" in line else ","


def fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """id (first word), description, seq; blank lines and carriage returns are dropped, records without an id are left out."""
    # A record ends where a line begins with the mark; the first one of a file still has it in front.
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"\A\s*>?|\r", "").alias("r"))
    title = F.substring_index("r", "\n", 1)
    body = F.when(F.contains("r", F.lit("\n")), F.expr("substring(r, length(substring_index(r, '\n', 1)) + 2)")).otherwise("")
    rows = raw.select(F.regexp_extract(title, r"^(\S+)", 1).alias("id"), F.regexp_extract(title, r"^\S+\s+(.*)$", 1).alias("description"), F.regexp_replace(body, r"\s+", "").alias("seq"))
    return rows.where("id <> ''")


def with_base(records: DataFrame) -> DataFrame:
    """Adds ``base``: the id before its first bar, a second key for lookups."""
    return records.withColumn("base", S.base_id(F.col("id")))


def tandem(spark: SparkSession, path: str) -> DataFrame:
    """The eleven columns of a tandem table; values that don't fit their type are null."""
    return spark.read.csv(path, sep="\t", schema=TANDEM, mode="PERMISSIVE")


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows of 13 or 14 fields (mapq null where it is missing); a line of another width ends the query that reads it with an error."""
    wrong = F.raise_error(F.concat(F.lit("an alignment line has "), F.size("f").cast("string"), F.lit(" fields, not 13 or 14")))
    lines = spark.read.text(path).where("value <> ''").select(F.split("value", "\t").alias("f"))
    lines = lines.select(F.when(F.size("f").isin(13, 14), F.col("f")).otherwise(wrong).alias("f"))
    columns = [c.split() for c in ALIGNMENT.split(", ")]
    return lines.select(*(F.get("f", F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(columns)))


def paf(spark: SparkSession, path: str) -> DataFrame:
    return alignment_text.paf_rows(spark.read.text(path), "value")


def maf(spark: SparkSession, path: str) -> DataFrame:
    """One row per alignment block."""
    return alignment_text.maf_rows(spark.read.text(path, lineSep="\na").withColumnRenamed("value", "block"), "block")


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """id, cluster, is_representative from cluster text: the member whose line ends in ``*``, else the first, represents."""
    raw = spark.read.text(path, lineSep=">Cluster ").where(r"value rlike '^\\d+'").select(F.regexp_extract("value", r"^(\d+)", 1).alias("cluster"), F.split("value", "\n").alias("l"))
    rows = raw.select("cluster", F.posexplode("l").alias("n", "line")).where("line rlike '>'")
    rows = rows.select("cluster", "n", F.regexp_extract("line", r">(\S+?)(?:\.\.\.|\s|$)", 1).alias("id"), F.col("line").rlike(r"\*\s*$").alias("star"))
    first = rows.groupBy("cluster").agg(F.min_by("id", F.struct((~F.col("star")).alias("s"), "n")).alias("rep"))
    return rows.join(first, "cluster").select("id", "cluster", (F.col("id") == F.col("rep")).alias("is_representative"))


def cluster_table(spark: SparkSession, path: str) -> DataFrame:
    """The same from a table with a header (id, cluster and a flag or the representative's id); a blank cluster is one of its own."""
    df = spark.read.csv(path, header=True, sep=delimiter(path))
    df = df.toDF(*(c.strip().lower() for c in df.columns))
    cluster = F.when(F.trim("cluster") != "", F.trim("cluster")).otherwise(F.concat(F.lit("singleton:"), "id"))
    if "is_representative" in df.columns:
        rep = F.lower(F.trim("is_representative")).isin("true", "1", "yes")
    elif "representative" in df.columns:
        rep = F.col("representative") == F.col("id")
    else:
        rep = F.lit(False)
    return df.select("id", cluster.alias("cluster"), F.coalesce(rep, F.lit(False)).alias("is_representative"))


def table(spark: SparkSession, paths: list[str], sep: str | None = None) -> DataFrame | None:
    """Tables with headers, one below the other, missing columns null; files that don't exist or are empty are skipped."""
    out = None
    for p in paths:
        try:
            if not head(p).strip():
                continue
        except (FileNotFoundError, AnalysisException):  # no such path
            continue
        part = spark.read.csv(p, header=True, sep=sep or delimiter(p), inferSchema=True)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """readName, readClass; header names in any case, comma or tab."""
    df = spark.read.csv(path, header=True, sep=delimiter(path))
    names = {c.strip().lower(): c for c in df.columns}
    missing = {"readname", "readclass"} - names.keys()
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df.select(F.trim(F.col(f"`{names['readname']}`")).alias("readName"), F.trim(F.col(f"`{names['readclass']}`")).alias("readClass"))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error that names what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_width(path: str, least: int = 12, lines: int = 1000) -> None:
    """An error that shows up to five of the first lines of a headerless table with fewer than ``least`` fields, and counts the others."""
    bad = []
    with open(path, "rb") as f:
        zipped = f.read(2) == b"\x1f\x8b"
    with (gzip.open if zipped else open)(path, "rt", encoding="utf-8", errors="replace") as f:
        for number, line in enumerate(itertools.islice(f, lines), 1):
            fields = line.strip("\n").split("\t")
            if fields != [""] and len(fields) < least:
                bad.append(f"Line {number}: {len(fields)} fields < {least} required")
    if bad:
        more = [f"... and {len(bad) - 5} more errors"] if len(bad) > 5 else []
        raise ValueError("\n".join([f"too few fields in {path}:", *bad[:5], *more]))


def sizes(records: DataFrame) -> DataFrame:
    """id, length of the records: what an index of a reference tells besides places in the file."""
    return records.select("id", F.length("seq").cast("bigint").alias("length"))


CHUNK = 1 << 20  # bases of a chunk of the reference


def chunked(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """chr, start0, seq: chromosomes (id, seq) cut into pieces of ``size`` bases, so that no later row is longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for at in range(0, len(seq), size):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int64()), pa.array([seq[at : at + size]])], ["chr", "start0", "seq"])

    return records.where("id is not null and seq is not null").select("id", "seq").mapInArrow(run, "chr string, start0 bigint, seq string")


def from_reference(chunks: DataFrame, segments: DataFrame, size: int = CHUNK) -> DataFrame:
    """id, seq: the joined sequences of segments (id, seg, chr, start0, end0) from chunks (chr, start0, seq) of ``size`` bases; minus segments as they stand.

    A segment meets only the chunks it touches; what the reference lacks is left out.
    """
    tiles = chunks.select("chr", F.floor(F.col("start0") / size).alias("_tile"), F.col("start0").alias("_at"), "seq")
    rows = segments.where("end0 > start0 and start0 >= 0").withColumn("_tile", F.explode(F.sequence(F.floor(F.col("start0") / size), F.floor((F.col("end0") - 1) / size))))
    first = F.greatest(F.col("start0") - F.col("_at"), F.lit(0))
    part = F.substring("seq", (first + 1).cast("int"), (F.col("end0") - F.col("_at") - first).cast("int"))
    rows = rows.join(tiles, ["chr", "_tile"]).select("id", "seg", "_tile", part.alias("part"))
    return rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "_tile", "part"))), lambda x: x["part"]), "").alias("seq"))


def _titled(records: DataFrame) -> Column:
    return F.when(F.col("description") != "", F.concat_ws(" ", "id", "description")).otherwise(F.col("id"))


def copy_some(spark: SparkSession, path: str, ids: DataFrame, out: str, keep: bool = True, append: bool = False) -> None:
    """Records whose id, or its part before the first bar, is among ``ids`` (id), or with ``keep`` false is not, written or appended to ``out`` with their titles."""
    records = with_base(fasta(spark, path))
    wanted = ids.select(F.col("id").alias("_id")).where("_id is not null").distinct()
    named = _among(records, wanted, keep)
    sinks.write_fasta(named, out, _titled(named), append=append)


def _among(records: DataFrame, wanted: DataFrame, keep: bool) -> DataFrame:
    """Two equi-joins: by the whole id and by its base."""
    mark = lambda c, name: wanted.select(F.col("_id").alias(c), F.lit(True).alias(name))
    marked = records.join(mark("id", "_a"), "id", "left").join(mark("base", "_b"), "base", "left")
    here = F.coalesce("_a", "_b", F.lit(False))
    return marked.where(here if keep else ~here).drop("_a", "_b")


def concat(spark: SparkSession, paths: list[str], out: str) -> None:
    """The records of several files or folders, one after the other; a later record with an id that came before stays."""
    records = fasta(spark, paths)
    sinks.write_fasta(records, out, _titled(records))
