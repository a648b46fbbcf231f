"""Scalar functions on evidence, coordinates, regions and identifiers, all as column expressions.

Nulls give null unless a function says otherwise; text that is no number gives null (never an error).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of evidence.
MAPQ_CAP, IDENTITY_FLOOR, IDENTITY_SPAN, LOW_MAPQ, LOW_IDENTITY = 60.0, 90.0, 10.0, 20, 95.0

# Complements of IUPAC codes, both cases.
IUPAC_FROM = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv"
IUPAC_TO = "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"


def clamp(c: Column, low: float, high: float) -> Column:
    """The nearest value within the bounds; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def clamp01(c: Column) -> Column:
    return clamp(c.cast("double"), 0.0, 1.0)


def as_fraction(c: Column) -> Column:
    """Values above 1 are per cent."""
    return F.when(c > 1, c / 100.0).otherwise(c.cast("double"))


def norm_mapq(c: Column) -> Column:
    return clamp01(c / MAPQ_CAP)


def norm_identity(c: Column) -> Column:
    return clamp01((c - IDENTITY_FLOOR) / IDENTITY_SPAN)


def match_degree(gap_percent: Column) -> Column:
    return clamp(100.0 - gap_percent, 0.0, 100.0)


def geometric_mean(*terms: Column) -> Column:
    """Of terms clamped to 0..1; 0 if any is 0."""
    parts = [F.coalesce(clamp01(t), F.lit(0.0)) for t in terms]
    product = parts[0]
    for p in parts[1:]:
        product = product * p
    return F.when(F.least(*parts) <= 0, F.lit(0.0)).otherwise(F.pow(product, F.lit(1.0 / len(parts))))


def to_double(c: Column, default: float | None = None) -> Column:
    v = c.try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def to_bigint(c: Column) -> Column:
    """Whole numbers, also if written as decimals; anything else is null."""
    v = c.try_cast("double")
    return F.when(v == F.floor(v), v.try_cast("bigint"))


def strand(c: Column) -> Column:
    """``+`` or ``-`` from the usual spellings, null otherwise."""
    v = F.lower(F.trim(c.cast("string")))
    return F.when(v.isin("+", "plus", "1", "+1", "forward"), "+").when(v.isin("-", "minus", "-1", "reverse"), "-")


def flipped(c: Column) -> Column:
    return F.translate(c, "+-", "-+")


def query_interval(q_start: Column, q_end: Column, zero_based: Column) -> Column:
    """struct(s, e), half-open from 0; ends in the wrong order are exchanged."""
    low = F.least(q_start, q_end) - F.when(zero_based, 0).otherwise(1)
    return F.struct(low.alias("s"), F.greatest(q_start, q_end).alias("e"))


def ring_projection(s: Column, e: Column, size: Column) -> Column:
    """Pieces [0, size) of a half-open interval on a ring of this size; empty for an empty interval or ring."""
    piece = lambda a, b: F.struct(a.cast("bigint").alias("s"), b.cast("bigint").alias("e"))
    u, v, zero = F.pmod(s, size), F.pmod(e, size), F.lit(0)
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return (
        F.when((size <= 0) | (e <= s) | size.isNull() | s.isNull() | e.isNull(), none)
        .when((e - s >= size) | (u == v), F.array(piece(zero, size)))
        .when(u < v, F.array(piece(u, v)))
        .when(v == 0, F.array(piece(u, size)))
        .otherwise(F.array(piece(u, size), piece(zero, v)))
    )


def union_length(pieces: Column) -> Column:
    """Positions covered by an array of (s, e), overlaps counted once."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-(1 << 62)).cast("bigint").alias("to"))
    step = lambda a, p: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("bigint"), p["e"] - F.greatest(p["s"], a["to"]))).alias("n"), F.greatest(a["to"], p["e"]).alias("to")
    )
    return F.aggregate(F.array_sort(pieces), start, step, lambda a: a["n"])


def ring_substring(seq: Column, q_start: Column, size: Column) -> Column:
    """``size`` letters from the 1-based place q_start on, going round once."""
    at = F.pmod(q_start - 1, F.length(seq)) + 1
    return F.when((F.length(seq) > 0) & (q_start > 0) & (size > 0), F.substring(F.concat(seq, seq), at.cast("int"), F.least(size, F.length(seq)).cast("int"))).otherwise("")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC_FROM, IUPAC_TO))


def circularised(seq: Column) -> Column:
    return F.concat(seq, seq)


def ring_id(read: Column, rep: Column, size: Column, copies: Column) -> Column:
    return F.concat_ws("|", read, rep, size.cast("string"), F.rint(copies).cast("bigint").cast("string"))


def base_id(c: Column) -> Column:
    """The part of a FASTA id before the first blank and bar."""
    return F.regexp_extract(c, r"^>?([^\s|]*)", 1)


def safe_id(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9._|:-]+", "_")


def region(chr_: Column, start0: Column, end0: Column) -> Column:
    return F.concat(chr_, F.lit(":"), start0.cast("string"), F.lit("-"), end0.cast("string"))


def parse_region(c: Column) -> Column:
    """struct(chr, s, e) of ``chr:s-e`` with an optional ``_strand``; its fields are null if it isn't one."""
    part = lambda i: F.nullif(F.regexp_extract(c, r"^\s*([^:\s]+):(\d+)-(\d+)(?:_[+-])?\s*$", i), F.lit(""))
    return F.struct(part(1).alias("chr"), part(2).try_cast("bigint").alias("s"), part(3).try_cast("bigint").alias("e"))


def locus_code(chr_: Column, s: Column, e: Column, strand_: Column) -> Column:
    return F.concat_ws("_", chr_, s.cast("string"), e.cast("string"), strand_)


def parse_locus(c: Column) -> Column:
    """struct(chr, s, e, strand) of ``chr_s_e_strand``; the chromosome may hold underscores."""
    part = lambda i: F.nullif(F.regexp_extract(c, r"^(.+)_(\d+)_(\d+)_([+-])$", i), F.lit(""))
    return F.struct(part(1).alias("chr"), part(2).try_cast("bigint").alias("s"), part(3).try_cast("bigint").alias("e"), part(4).alias("strand"))


def read_names(c: Column) -> Column:
    """Distinct non-blank names of a ``;`` list, sorted; an empty array for null."""
    names = F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.array_sort(F.array_distinct(names)), F.array().cast("array<string>"))


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Closed ranges that share a position."""
    return (s1 <= e2) & (s2 <= e1)


def both_within(s1: Column, e1: Column, s2: Column, e2: Column, tolerance: int) -> Column:
    return (F.abs(s1 - s2) <= tolerance) & (F.abs(e1 - e2) <= tolerance)


def reciprocal(s1: Column, e1: Column, s2: Column, e2: Column, share: float = 0.99, tolerance: int = 20) -> Column:
    """Half-open intervals that overlap, with both ends within the tolerance or this share of each covered."""
    shared = F.least(e1, e2) - F.greatest(s1, s2)
    floor = lambda n: F.greatest(n, F.lit(1))
    near = both_within(s1, e1, s2, e2, tolerance) if tolerance else F.lit(False)
    return (shared > 0) & (near | ((shared / floor(e1 - s1) >= share) & (shared / floor(e2 - s2) >= share)))


def cs_counts(cs: Column) -> Column:
    """struct(mismatches, gap_opens) of a short cs string."""
    return F.struct(F.regexp_count(cs, F.lit(r"\*")).alias("mismatches"), F.regexp_count(cs, F.lit("[-+~]")).alias("gap_opens"))


def abundance(coverage: Column) -> Column:
    return F.least(coverage / 100.0, F.lit(1.0))


def copies_or_one(c: Column) -> Column:
    return F.when(c > 0, c.cast("double")).otherwise(1.0)
