"""Readers and writers of text formats: whole tables are written as text into the shared folder, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.operators import alignment_text
from annulet.plans import cluster_queries, inferred_queries, scalar_queries, tandem_queries
from annulet.plans.base import fixed, once, once_sql
from annulet.plans.ring_queries import _LIB, _library
from annulet.session import scratch
from annulet.sources import sinks, text


def _letters(records: DataFrame) -> DataFrame:
    return records.select("id", F.length("seq").alias("letters"))


def _written_library(spark: SparkSession, d: str) -> str:
    path = scratch(spark, "library.fasta")
    sinks.write_fasta(_library(spark, d), path)
    return path


def _aligned_reads(spark: SparkSession, d: str) -> DataFrame:
    return once(spark, d, "alignments", "query_id").select(F.split("query_id", r"\|")[0].alias("id"))


def s1_fasta_scan(spark: SparkSession, d: str) -> DataFrame:
    """Doubled rings written in lines of 60 letters and read back, with the second key of each record."""
    return text.with_base(text.fasta(spark, _written_library(spark, d))).select("id", "base", "seq")


def s2_fasta_filter(spark: SparkSession, d: str) -> DataFrame:
    """The records of reads without alignments, FASTA to FASTA."""
    out = scratch(spark, "rest.fasta")
    text.copy_some(spark, _written_library(spark, d), _aligned_reads(spark, d), out, keep=False)
    return _letters(text.fasta(spark, out))


def s3_fasta_extract(spark: SparkSession, d: str) -> DataFrame:
    """The records of aligned reads, FASTA to FASTA."""
    out = scratch(spark, "some.fasta")
    text.copy_some(spark, _written_library(spark, d), _aligned_reads(spark, d), out)
    return _letters(text.fasta(spark, out))


def s4_fasta_append(spark: SparkSession, d: str) -> DataFrame:
    """The records of aligned reads, then those of the others appended."""
    path, out, reads = _written_library(spark, d), scratch(spark, "both.fasta"), _aligned_reads(spark, d)
    text.copy_some(spark, path, reads, out)
    text.copy_some(spark, path, reads, out, keep=False, append=True)
    return _letters(text.fasta(spark, out))


def s5_fasta_concat(spark: SparkSession, d: str) -> DataFrame:
    """The library twice, one after the other."""
    path, out = _written_library(spark, d), scratch(spark, "twice.fasta")
    text.concat(spark, [path, path], out)
    return _letters(text.fasta(spark, out))


def s6_sniffed(spark: SparkSession, d: str) -> DataFrame:
    """What the first lines tell of a FASTA and of a table."""
    path = scratch(spark, "classes.tsv")
    sinks.write_table(tandem_queries.a8_read_classes(spark, d), path, sep="\t")
    return spark.createDataFrame([(text.sniff(_written_library(spark, d)), text.delimiter(path))], "format string, delimiter string")


def s9_from_reference(spark: SparkSession, d: str) -> DataFrame:
    """Two segments of every consensus, fetched from chunks of 64 letters and joined."""
    rows = once(spark, d, "tandem", "consSeq").where("length(consSeq) > 150").select(F.col("rec_id").cast("string").alias("id"), F.col("consSeq").alias("seq"))
    one, two = (rows.select("id", F.lit(i).alias("seg"), F.col("id").alias("chr"), F.lit(s).cast("bigint").alias("start0"), F.lit(e).cast("bigint").alias("end0")) for i, s, e in ((0, 5, 150), (1, 0, 40)))
    return text.from_reference(text.chunked(rows, 64), one.unionByName(two), 64)


def s10_tandem_scan(spark: SparkSession, d: str) -> DataFrame:
    columns, path = [c.split()[0] for c in text.TANDEM.split(", ")], scratch(spark, "tandem.tsv")
    sinks.write_table(once(spark, d, "tandem", *columns).select(*columns), path, sep="\t", header=False)
    return text.tandem(spark, path)


def s11_alignment_scan(spark: SparkSession, d: str) -> DataFrame:
    columns, path = [c.split()[0] for c in text.ALIGNMENT.split(", ")], scratch(spark, "alignments.tsv")
    sinks.write_table(once(spark, d, "alignments", *columns).select(*columns), path, sep="\t", header=False)
    out = text.alignments(spark, path)
    return out.select("query_id", "subject_id", fixed(F.col("identity"), 3).alias("identity"), "alignment_length", "mismatches", "gap_opens", "q_start", "q_end", "s_start", "s_end", "sstrand", "mapq")


def s12_paf_scan(spark: SparkSession, d: str) -> DataFrame:
    rows, path = once(spark, d, "alignments").where("query_id is not null and mapq is not null"), scratch(spark, "a.paf")
    rows.select(alignment_text.paf_line(rows).alias("value")).write.text(path)
    out = text.paf(spark, path)
    return out.select(fixed(F.col("identity"), 2).alias("identity"), "alignment_length", "mismatches", "gap_opens", "q_start", "q_end", "s_start", "s_end", "sstrand", "mapq")


def s13_maf_scan(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as blocks, with places on the minus strand counted from the other end of the query."""
    rows, path = once(spark, d, "alignments").where("query_id is not null"), scratch(spark, "a.maf")
    plus, low = F.col("sstrand") == "plus", F.least("s_start", "s_end") - 1
    start = F.when(plus, F.col("q_start") - 1).otherwise(F.lit(10))
    line = lambda *c: F.concat_ws(" ", F.lit("s"), *(x.cast("string") for x in c), F.lit("ACGT"))
    ref = line(F.col("subject_id"), low, F.greatest("s_start", "s_end") - low, F.lit("+"), F.lit(1 << 40))
    query = line(F.col("query_id"), start, F.col("q_end") - F.col("q_start") + 1, F.when(plus, "+").otherwise("-"), F.col("q_end") + 10)
    block = F.concat(F.lit("a score="), F.col("alignment_length").cast("string"), F.lit("\n"), ref, F.lit("\n"), query, F.lit("\n"))
    rows.select(block.alias("value")).write.text(path)
    return text.maf(spark, path).drop("identity")


def s15_cluster_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """A cluster table with a flag: the smallest record of a cluster represents it."""
    core = cluster_queries._core(spark, d).select(F.col("rec_id").alias("id"), "cluster")
    first, path = core.groupBy("cluster").agg(F.min("id").alias("_rep")), scratch(spark, "clusters.csv")
    sinks.write_table(core.join(first, "cluster").select("id", "cluster", (F.col("id") == F.col("_rep")).alias("is_representative")), path)
    return text.cluster_table(spark, path)


def s17_tables_concat(spark: SparkSession, d: str) -> DataFrame:
    """Two tables of different columns and separators, and one that is not there, one below the other."""
    rows = once(spark, d, "split_overview", "circle_length", "segment_count", "num_split_reads")
    one, two = scratch(spark, "one.csv"), scratch(spark, "two.tsv")
    sinks.write_table(rows.where("rec_id % 2 = 0").select("rec_id", "circle_length", "segment_count"), one)
    sinks.write_table(rows.where("rec_id % 2 <> 0").select("rec_id", "circle_length", "num_split_reads"), two, sep="\t")
    out = text.table(spark, [one, scratch(spark, "none.csv"), two])
    return out.select(*(F.col(c).cast("bigint").alias(c) for c in ("rec_id", "circle_length", "segment_count", "num_split_reads")))


def s18_read_class_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "classes.csv")
    sinks.write_table(tandem_queries.a8_read_classes(spark, d).select(F.col("readClass").alias("READCLASS"), F.col("readName").alias("readname")), path)
    return text.read_classes(spark, path)


def s19_table_sink(spark: SparkSession, d: str) -> DataFrame:
    """The segments of chimeric circles as a table, written in parts and read back with their types."""
    rows, path = inferred_queries.segments(spark, d).select("id", "seg", "segs", "chr", "start0", "end0", "strand"), scratch(spark, "segments.csv")
    sinks.write_table(rows, path)
    return spark.read.csv(path, header=True, schema="id bigint, seg int, segs bigint, chr string, start0 bigint, end0 bigint, strand string")


QUERIES = {f.__name__: f for f in (
    s1_fasta_scan, s2_fasta_filter, s3_fasta_extract, s4_fasta_append, s5_fasta_concat, s6_sniffed, s9_from_reference, s10_tandem_scan, s11_alignment_scan, s12_paf_scan, s13_maf_scan,
    s15_cluster_table_scan, s17_tables_concat, s18_read_class_scan, s19_table_sink,
)}

_A, _T, _O = once_sql("alignments"), once_sql("tandem"), once_sql("split_overview")
_READS = f"(SELECT string_split(query_id, '|')[1] FROM {_A} WHERE query_id IS NOT NULL)"
_TANDEM = ", ".join(f'"{c.split()[0]}"' for c in text.TANDEM.split(", "))

SQL = {
    "s1_fasta_scan": f"WITH {_LIB} SELECT id, string_split(id, '|')[1] AS base, seq FROM lib",
    "s2_fasta_filter": f"WITH {_LIB} SELECT id, length(seq) AS letters FROM lib WHERE string_split(id, '|')[1] NOT IN {_READS}",
    "s3_fasta_extract": f"WITH {_LIB} SELECT id, length(seq) AS letters FROM lib WHERE string_split(id, '|')[1] IN {_READS}",
    "s4_fasta_append": f"WITH {_LIB} SELECT id, length(seq) AS letters FROM lib",
    "s5_fasta_concat": f"WITH {_LIB} SELECT id, length(seq) AS letters FROM lib UNION ALL SELECT id, length(seq) FROM lib",
    "s6_sniffed": "SELECT 'fasta' AS format, chr(9) AS delimiter",
    "s9_from_reference": f"SELECT CAST(rec_id AS VARCHAR) AS id, substr(consSeq, 6, 145) || substr(consSeq, 1, 40) AS seq FROM {_T} WHERE length(consSeq) > 150",
    "s10_tandem_scan": f"SELECT {_TANDEM} FROM {_T}",
    "s11_alignment_scan": f"""SELECT coalesce(query_id, '') AS query_id, subject_id, CAST(floor(identity * 1000 + 0.5) AS BIGINT) AS identity, alignment_length, CAST(mismatches AS BIGINT) AS mismatches, CAST(gap_opens AS BIGINT) AS gap_opens,
      q_start, q_end, s_start, s_end, sstrand, CAST(mapq AS BIGINT) AS mapq FROM {_A}""",
    "s12_paf_scan": f"SELECT * EXCLUDE (aln_id) FROM ({scalar_queries.SQL['a1_paf_rows']})",
    "s13_maf_scan": f"""SELECT subject_id AS chr, least(s_start, s_end) - 1 AS ref_start, greatest(s_start, s_end) AS ref_end, query_id, q_start - 1 AS query_start, q_end AS query_end, q_end + 10 AS query_len, alignment_length AS score,
      CASE WHEN sstrand = 'plus' THEN '+' ELSE '-' END AS strand FROM {_A} WHERE query_id IS NOT NULL""",
    "s15_cluster_table_scan": f"WITH {cluster_queries._CORE} SELECT CAST(rec_id AS VARCHAR) AS id, cluster, rec_id = min(rec_id) OVER (PARTITION BY cluster) AS is_representative FROM core",
    "s17_tables_concat": f"SELECT rec_id, circle_length, CASE WHEN rec_id % 2 = 0 THEN CAST(segment_count AS BIGINT) END AS segment_count, CASE WHEN rec_id % 2 <> 0 THEN CAST(num_split_reads AS BIGINT) END AS num_split_reads FROM {_O}",
    "s18_read_class_scan": tandem_queries.SQL["a8_read_classes"],
    "s19_table_sink": f"WITH {inferred_queries.CHIMERIC_SQL} SELECT id, CAST(seg AS INTEGER) AS seg, segs, chr, start0, end0, strand FROM seg",
}
