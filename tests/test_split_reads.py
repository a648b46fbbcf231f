import pytest

from annulet.functions.read_trim import Hit, merged
from annulet.operators import curate, split_reads
from annulet.plans import config, pipeline

ALIGNMENT = "query_id string, subject_id string, q_start bigint, q_end bigint, s_start bigint, s_end bigint, alignment_length bigint, mismatches int, sstrand string, mapq int, aln_id bigint"


def reads(*circles, n=6):
    """Reads that begin inside the circle's last segment and go round once; closed places from 1."""
    rows = []
    for c, segs in enumerate(circles):
        for r in range(n):
            chrom, s, e = segs[-1]
            hits, q = [(chrom, (s + e) // 2 + 10 * r, e)] + list(segs), 1
            for chrom, s, e in hits:
                size = e - s + 1
                rows.append((f"r{c}_{r}", chrom, q, q + size - 1, s, e, size, 0, "plus", 60, len(rows)))
                q += size
    return rows


def test_circles_come_out_at_their_places(spark):
    one, two = [("chr1", 1000, 2000)], [("chr2", 5001, 5600), ("chr_3", 901, 1500)]
    hits = pipeline._split_hits(spark.createDataFrame(reads(one, two), ALIGNMENT), 30)
    found = split_reads.circles(hits, min_depth=3.0)
    rows = {r["merge_region"]: r for r in found.collect()}
    assert rows.keys() == {"chr1:1000-2000_+", "chr2:5001-5600_+,chr_3:901-1500_+"}
    assert rows["chr1:1000-2000_+"]["ctc"] and rows["chr1:1000-2000_+"]["merge_len"] == 1001 and rows["chr1:1000-2000_+"]["numreads"] == 6
    over = {r["regions"]: (r["segment_count"], r["circle_length"], r["prob_present"]) for r in split_reads.overview(found).collect()}
    assert over == {"chr1:1000-2000": (1, 1001, 0.95), "chr2:5001-5600;chr_3:901-1500": (2, 1200, 0.95)}
    curated = pipeline._curated(found, config.from_dict({"curate": {"min_segments": 2}}))
    assert sorted((r["chr"], r["start0"], r["end0"]) for r in curated.collect()) == [("chr1", 999, 2000), ("chr2", 5000, 5600), ("chr_3", 900, 1500)]


def test_overview_skips_what_is_no_region(spark):
    row = "select 'x' id, {!r} merge_region, 10L merge_len, 1L num_region, true ctc, 3L numreads, 5L totalbase, '0.50' coverage"
    df = spark.sql(" union all ".join(row.format(x) for x in ("chr1:5-9_+", "chr1_5_9_+", "a:1-2_-;b:3-4_+")))
    assert {r["regions"] for r in split_reads.overview(df).collect()} == {"chr1:5-9", "a:1-2;b:3-4"}
    assert split_reads.overview(df.limit(0)).count() == 0 and curate.simple(split_reads.overview(df).selectExpr("*", "1L rec_id")).count() == 0


def hit(q0, q1, r0, r1, ref="a", strand=1, mapq=7):
    return Hit(q0, q1, ref, r0, r1, r1 - r0, r1 - r0 + 2, mapq, strand)


@pytest.mark.parametrize("second, want", [
    (hit(80, 190, 700, 790, mapq=9), [(0, 190, 500, 790, 9)]),  # deep overlap, near: fused
    (hit(80, 190, 9000, 9090), [(0, 100, 500, 600, 7), (80, 190, 9000, 9090, 7)]),  # deep, far on one sequence: kept
    (hit(80, 190, 700, 790, "b"), [(80, 190, 700, 790, 7)]),  # deep, elsewhere: the longer one
    (hit(80, 120, 700, 740, "b"), [(0, 100, 500, 600, 7)]),
    (hit(95, 190, 700, 790), [(0, 100, 500, 600, 7), (95, 190, 700, 790, 7)]),  # touching: kept
    (hit(110, 190, 700, 790), [(0, 190, 500, 790, 7)]),  # within the gap, near: fused
    (hit(110, 190, 700, 790, "a", -1), [(0, 100, 500, 600, 7), (110, 190, 700, 790, 7)]),
    (hit(111, 190, 700, 790), [(0, 100, 500, 600, 7)]),  # further away: dropped
])
def test_fold_of_neighbouring_hits(second, want):
    assert [(h.q_start, h.q_end, h.r_start, h.r_end, h.mapq) for h in merged([hit(0, 100, 500, 600), second])] == want
