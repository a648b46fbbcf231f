import random

from annulet.operators import interval_sweep as S
from annulet.operators import intervals as I


def brute(rows):
    groups, out = {}, set()
    for s, c, a, b in rows:
        if None not in (s, c, a, b) and a != b:
            groups.setdefault((s, c), set()).update(range(min(a, b), max(a, b)))
    for key, places in groups.items():
        runs, places = [], sorted(places)
        for p in places:
            if runs and runs[-1][1] == p:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        out |= {(*key, "covered", a, b) for a, b in runs} | {(*key, "gap", x[1], y[0]) for x, y in zip(runs, runs[1:])}
    return out


def test_sweep_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None]), rnd.choice(["1", "2", None]), rnd.choice([None, *[rnd.randrange(-50, 400)] * 9]), rnd.randrange(-50, 400)) for _ in range(120)]
    rows = [(s, c, a, a + rnd.randrange(0, 9) if a is not None and rnd.random() < 0.8 else b) for s, c, a, b in rows]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + rows[:20]], "sample string, chr string, start0 bigint, end0 bigint, _tile int, kind string")
    for tile in (1, 7, 64, 1 << 20):
        got = [tuple(r) for r in S.sweep(df, ["sample", "chr"], "start0", "end0", tile).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert S.sweep(df.limit(0), ["sample", "chr"], "start0", "end0").count() == 0


def test_chromosomes(spark):
    df = spark.createDataFrame([(x,) for x in (" chr7", "CHR7 ", "7", "chrx", "Chr X", "", "  ", "chr", None)], "c string")
    assert [r[0] for r in df.select(S.chromosome(df.c)).collect()] == ["chr7", "chr7", "chr7", "chrX", "chrX", None, None, None, None]


def intervals(spark, rnd, n, names):
    rows = [(i, rnd.choice("xy"), a, a + rnd.choice([1, 5, 90, 2000])) for i in range(n) for a in [rnd.randrange(3000)]]
    return rows, spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(names, ("bigint", "string", "bigint", "bigint"))))


def test_overlap_and_reciprocal_joins(spark):
    rnd = random.Random(6)
    a, left = intervals(spark, rnd, 60, ("i", "k", "s1", "e1"))
    b, right = intervals(spark, rnd, 60, ("j", "k", "s2", "e2"))
    got = [(r["i"], r["j"], r["overlap"]) for r in I.overlap_join(left, right, ["k"], ("s1", "e1"), ("s2", "e2"), tile=64).collect()]
    want = {(x[0], y[0], min(x[3], y[3]) - max(x[2], y[2])) for x in a for y in b if x[1] == y[1] and min(x[3], y[3]) > max(x[2], y[2])}
    assert len(got) == len(set(got)) and set(got) == want
    c = [(i, k, s + rnd.randrange(-25, 26), e + rnd.randrange(-25, 26)) for i, k, s, e in a]
    right = spark.createDataFrame(c, "j bigint, k string, s2 bigint, e2 bigint")

    def same(x, y):
        ov = min(x[3], y[3]) - max(x[2], y[2])
        return ov > 0 and (abs(x[2] - y[2]) <= 20 and abs(x[3] - y[3]) <= 20 or ov >= 0.99 * max(1, x[3] - x[2]) and ov >= 0.99 * max(1, y[3] - y[2]))

    got = [(r["i"], r["j"]) for r in I.reciprocal_join(left, right, ["k"], ("s1", "e1"), ("s2", "e2")).collect()]
    assert len(got) == len(set(got)) and set(got) == {(x[0], y[0]) for x in a for y in c if x[1] == y[1] and same(x, y)}
