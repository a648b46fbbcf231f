import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annulet.functions import rings, scalars as S
from annulet.operators import chimeric, classify, matching, simulate, unify


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0] if values else spark.range(1).select(column).first()[0]


def test_ring_geometry(spark):
    p = lambda s, e, n: [(x["s"], x["e"]) for x in one(spark, S.ring_projection(F.lit(s), F.lit(e), F.lit(n)))]
    assert p(10, 20, 100) == [(10, 20)] and p(90, 110, 100) == [(90, 100), (0, 10)] and p(0, 100, 100) == [(0, 100)] and p(5, 5, 100) == [] and p(150, 160, 100) == [(50, 60)] and p(90, 100, 100) == [(90, 100)]
    pieces = F.array(*(F.struct(F.lit(a).cast("bigint").alias("s"), F.lit(b).cast("bigint").alias("e")) for a, b in ((5, 9), (0, 6), (8, 8), (20, 21))))
    assert one(spark, S.union_length(pieces)) == 10
    cut = lambda q, n: one(spark, S.ring_substring(F.lit("ABCDEF"), F.lit(q), F.lit(n)))
    assert cut(1, 3) == "ABC" and cut(5, 4) == "EFAB" and cut(8, 2) == "BC" and cut(0, 2) == ""


def test_strings(spark):
    rnd = random.Random(3)
    for _ in range(200):
        s = "".join(rnd.choice("AB") for _ in range(rnd.randrange(1, 12)))
        at = rings.least_rotation(s)
        assert s[at:] + s[:at] == min(s[i:] + s[:i] for i in range(len(s)))
    df = spark.createDataFrame([("gatt",), ("aatc",), ("ATTG",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(rings.canonical(df.s)).collect()]
    assert got[0] == got[1] == "AATC" and got[3] is None and got[4] == ""
    assert one(spark, S.reverse_complement(F.lit("ACGTNrk"))) == "mYNACGT".replace("mY", "my")


def test_reciprocal_overlap(spark):
    r = lambda *x, **k: one(spark, S.reciprocal(*map(F.lit, x), **k))
    assert r(100, 200, 115, 190) and not r(100, 200, 121, 200) and r(0, 10_000, 50, 10_000) and not r(0, 10, 10, 20) and not r(100, 200, 115, 190, tolerance=0)


def test_loci_against_brute_force():
    rnd = random.Random(4)
    for _ in range(40):
        rows = sorted((a, a + rnd.choice([10, 60, 200, 210])) for a in [rnd.randrange(400) for _ in range(15)])
        s, e = (np.array(x) for x in zip(*rows))
        root = list(range(len(rows)))
        find = lambda x: x if root[x] == x else find(root[x])
        for i in range(len(rows)):
            for j in range(i):
                near = abs(s[i] - s[j]) <= 50 and abs(e[i] - e[j]) <= 50
                ov = max(0, min(e[i], e[j]) - max(s[i], s[j]))
                if near or ov >= 0.95 * min(e[i] - s[i], e[j] - s[j]):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
        assert list(classify.linked(s, e, 50, 0.95)) == [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("seed", [42, 43])
def test_simulated_rings_are_found(spark, seed):
    truth = simulate.truth(spark, 25, seed)
    decided = classify.classify(simulate.alignments(truth)).select(F.regexp_extract("query_id", r"^read(\d+)", 1).cast("bigint").alias("id"), "class").join(truth.select("id", "kind").distinct(), "id")
    assert decided.where("class = kind").count() == decided.count() == 50
    found = chimeric.detect(simulate.doubled_alignments(truth))
    segs = found.select(F.regexp_extract("query_id", r"(\d+)$", 1).cast("bigint").alias("id"), "chr", "start0", "end0")
    assert segs.exceptAll(truth.where("kind = 'Cecc'").select("id", "chr", "start0", "end0")).count() == 0 and segs.select("id").distinct().count() == 25
    assert found.where("abs(match_degree - 100) < 1e-9 and closed").count() == segs.count()


def test_negative_control_is_low_confidence(spark):
    rows = simulate.alignments(simulate.truth(spark, 50, 1).where("kind = 'Uecc'")).withColumn("mapq", F.lit(0))
    got = classify.classify(rows)
    assert got.where("class = 'Uecc'").count() == 50 and got.where("conf >= 0.8 or mapq_best >= 20").count() == 0


def test_genome_and_mutations(spark):
    g = simulate.genome(spark, 2, 2500, 7, chunk=1000)
    sizes = {(r["chr"], r["start0"]): len(r["seq"]) for r in g.collect()}
    assert sizes == {(c, s): n for c in ("chr1", "chr2") for s, n in ((0, 1000), (1000, 1000), (2000, 500))}
    rate = g.select(F.expr("seq").alias("a"), simulate.mutated(F.col("seq"), 0.1, 3).alias("b")).collect()
    changed = sum(x != y for r in rate for x, y in zip(r["a"], r["b"]))
    assert 350 < changed < 650 and all(set(r["b"]) <= set("ACGT") for r in rate)


def test_repeat_families(spark):
    g = simulate.genome(spark, 1, 40_000, 7, chunk=10_000, families=2, unit=50, repeats=20)
    seqs = [r["seq"] for r in g.orderBy("start0").collect()]
    count = {}
    for s in seqs:
        for i in range(len(s) - 49):
            count[s[i : i + 50]] = count.get(s[i : i + 50], 0) + 1
    common = sorted(count.values(), reverse=True)
    assert common[0] >= 25 and common[1] >= 25 and common[0] + common[1] <= 80
    plain = simulate.genome(spark, 1, 40_000, 7, chunk=10_000)
    assert max(map(len, seqs)) == 10_000 and plain.count() == len(seqs)


def in_turn(edges):
    """Predictions one by one."""
    taken, out = set(), set()
    for pred in sorted({e[0] for e in edges}):
        free = [e for e in edges if e[0] == pred and e[1] not in taken]
        if free:
            best = min(free, key=lambda e: (e[2], -e[3] if e[2] == 2 else 0, e[1]))
            taken.add(best[1])
            out.add((pred, best[1]))
    return out


def test_greedy_matching_against_sequential(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(30), rnd.randrange(25), rnd.choice([0, 1, 2, 2]), rnd.randrange(50)) for _ in range(60)]
    edges = list({(p, t): (p, t, k, s) for p, t, k, s in edges}.values())
    got = {tuple(r) for r in matching.greedy(spark.createDataFrame(edges, "pred bigint, truth bigint, kind int, score bigint")).collect()}
    assert got == in_turn(edges)
    assert len({t for _, t in got}) == len(got) == len({p for p, _ in got})


def test_measures(spark):
    m = spark.range(1).select(*(c.alias(n) for n, c in matching.measures(F.lit(8), F.lit(10), F.lit(16)).items())).first()
    assert (m["recall"], m["precision"]) == (0.5, 0.8) and abs(m["f1"] - 8 / 13) < 1e-12
    zero = spark.range(1).select(*(c.alias(n) for n, c in matching.measures(F.lit(0), F.lit(0), F.lit(0)).items())).first()
    assert tuple(zero) == (0.0, 0.0, 0.0)


def test_chimeric_redundancy(spark):
    make = lambda i, *segs: [(i, k, len(segs), *s) for k, s in enumerate(segs)]
    a, b, c = ("chr1", 100, 900, "+"), ("chr2", 5000, 6000, "-"), ("chr3", 7, 77, "+")
    flip = lambda s: (*s[:3], "-" if s[3] == "+" else "+")
    rows = make(1, a, b, c) + make(2, b, c, a) + make(3, flip(c), flip(b), flip(a)) + make(4, a, c) + make(5, flip(a), c) + make(6, a, c, b)
    df = spark.createDataFrame(rows, "id bigint, seg int, segs int, chr string, start0 bigint, end0 bigint, strand string")
    pairs = unify.segment_matches(df, df).where("id <> match")
    full = {tuple(r) for r in unify.full_matches(pairs).where("id < match").collect()}
    assert full == {(1, 2), (1, 3), (2, 3)}
    assert {tuple(r) for r in unify.full_matches(pairs, stranded=False).where("id < match").collect()} == {(1, 2), (3, 6), (4, 5)}
    assert {tuple(r) for r in unify.part_matches(pairs).collect()} == {(4, 1), (4, 2), (4, 3), (4, 6)}
    with pytest.raises(ValueError, match="nothing"):
        unify.redundant("nothing", df, df)
