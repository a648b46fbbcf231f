import random

import numpy as np
import pytest

from annulet.llm import ring_join, ring_kernel as K


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def close(a, b):
    a, b = sorted((a, b), key=len)
    k = len(b) * 6 // 100
    return len(b) - len(a) <= k and any(distance(a[t:] + a[:t], b) <= k for t in range(len(a)))


def changed(s, edits, rnd):
    s = list(s)
    for _ in range(edits):
        i, how = rnd.randrange(len(s)), rnd.random()
        if how < 0.4:
            s[i] = rnd.choice("ACGT")
        elif how < 0.7:
            s.insert(i, rnd.choice("ACGT"))
        elif len(s) > 2:
            del s[i]
    r = rnd.randrange(len(s))
    return "".join(s[r:] + s[:r])


def family(rnd, letters="ACGT"):
    n = rnd.choice([1, 3, 12, 17, 20, 34, 50, 80, 100])
    base = "".join(rnd.choice(letters) for _ in range(n))
    return [base] + [changed(base, rnd.choice([0, 1, n * 6 // 100, n * 6 // 100 + 1]), rnd) for _ in range(3)]


@pytest.mark.parametrize("trial", range(12))
def test_kernel_against_brute_force(trial):
    rnd = random.Random(trial)
    rings = sorted(set(K.canonical([s.encode() for _ in range(6) for s in family(rnd, ["ACGTN", "AC", "ACGT"][trial % 3])])))
    assert all(s == min(s[i:] + s[:i] for i in range(len(s))) for s in rings)
    want = {(i, j) for i in range(len(rings)) for j in range(i + 1, len(rings)) if close(rings[i], rings[j])}
    n = np.array([len(s) for s in rings])
    for most in (8, 10, 13):
        h, ring, context = K.keys(rings, 6, most)
        a, b = K.meeting(h, n[ring], ring, context)
        good = K.close([rings[i] for i in a], [rings[j] for j in b])
        assert {(int(i), int(j)) for i, j in zip(a[good], b[good])} == want


def test_many_rings_that_are_alike(monkeypatch):
    rnd = random.Random(3)
    base = "".join(rnd.choice("ACGT") for _ in range(120))
    rings = K.canonical([changed(base, 2, rnd).encode() for _ in range(150)])
    h, ring, context = K.keys(rings, 6, 9)
    n, num = np.array([len(s) for s in rings])[ring], (1 << 40) - 7 * ring
    want = set(zip(*(x.tolist() for x in K.meeting(h, n, num, context))))
    monkeypatch.setattr(K, "TESTS_AT_ONCE", 500)
    got = list(zip(*(x.tolist() for x in K.meeting(h, n, num, context))))
    assert set(got) == want and len(got) == len(want) == 150 * 149 // 2


def test_every_ring_has_room_for_its_shingles():
    for most in (8, 9, 12, 13):
        n = np.arange(16, 5000)
        for longer in (n, K.longest_partner(n)):
            assert (K.shingle_length(longer, 6, most) * (K.edits(K.longest_partner(n)) + 1) <= n).all()


def test_contexts_differ_by_one_edit_at_most():
    rnd = random.Random(1)
    number = lambda v: sum(c << 2 * (7 - i) for i, c in enumerate(v))
    rows = []
    for _ in range(1500):
        a = [rnd.randrange(4) for _ in range(8)]
        b = a + [rnd.randrange(4)]
        for _ in range(rnd.randrange(3)):
            i, how = rnd.randrange(8), rnd.random()
            b[i : i + (how > 0.3)] = [rnd.randrange(4)] if how < 0.7 else []
        rows.append((a, (b + [0] * 8)[:8]))
    got = K.alike(*(np.array([number(r[i]) for r in rows], np.uint16) for i in (0, 1)))
    ends = [(8, y) for y in (7, 8)] + [(7, 8)]
    assert got.tolist() == [any(distance(a[:x], b[:y]) <= 1 for x, y in ends) for a, b in rows]


def test_least_edits_inside_a_text():
    rnd = random.Random(4)
    for _ in range(100):
        a, b = ("".join(rnd.choice("AC") for _ in range(rnd.randrange(1, n))) for n in (9, 16))
        assert K.least_inside(a.encode(), b.encode()) == min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))


def test_rings_that_repeat_themselves():
    a, b = b"AC" * 400, b"AC" * 380 + b"GT" * 20
    c = b"AC" * 300 + b"TG" * 90 + b"CC" * 10
    assert K.close([a, a, b], [b, c, c]).tolist() == [close("AC" * 400, b.decode()), False, False]


def test_packing_keeps_rings():
    rnd = random.Random(1)
    for n in range(1, 60):
        for letters in ("ACGT", "ACGTN"):
            s = "".join(rnd.choice(letters) for _ in range(n)).encode()
            assert K.unpack(K.pack(s), n) == s


@pytest.mark.parametrize("part, task, letters", [(10**6, 10**6, 10**6), (20, 10**6, 300), (200, 60, 10**6)])
def test_ring_pairs_of_a_table(spark, monkeypatch, part, task, letters):
    monkeypatch.setattr(ring_join, "ENTRIES_PER_PART", part)
    monkeypatch.setattr(ring_join, "ENTRIES_PER_TASK", task)
    monkeypatch.setattr(ring_join, "LETTERS_AT_ONCE", letters)
    rnd = random.Random(2)
    seqs = [s for _ in range(12) for s in family(rnd)] + ["acgtacgtaacc", "ACGTAACCACGT", None, "", "ÄCGT", "A" * 3000, "A" * 3000]
    rows = [(i, s, i, "x") for i, s in enumerate(seqs)]
    df = spark.createDataFrame(rows + rows[:5], "id bigint, seq string, n int, ring string")
    got = {(r["id_a"], r["id_b"]) for r in ring_join.ring_pairs(df).collect()}
    good = {i: s.upper() for i, s in enumerate(seqs) if s and s.isascii() and len(s) < 2000}
    want = {(i, j) for i in good for j in good if i < j and close(good[i], good[j])} | {(len(seqs) - 2, len(seqs) - 1)}
    assert got == want
    check_groups(ring_join.ring_groups(df), want, {i for i, s in enumerate(seqs) if s and s.isascii()})
    assert ring_join.ring_pairs(df.limit(0)).count() == ring_join.ring_groups(df.limit(0)).count() == 0


def check_groups(df, pairs, ids):
    """One row an id; its links are its pairs, its group what pairs connect, its class inside its group."""
    rows = {r["id"]: r for r in df.collect()}
    assert rows.keys() == ids and df.count() == len(ids)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    for i, r in rows.items():
        assert r["links"] == sum(i in p for p in pairs) and r["group_id"] == find(i) and find(r["class_id"]) == find(i)


SEGS = "circle_no bigint, seg_index int, chr string, start0 bigint, end0 bigint, strand string, loaded_at timestamp, segs string, n int"


def circle(no, *segs):
    return [(no, i, c, s, e, st, None, "x", 1) for i, (c, s, e, st) in enumerate(segs, 1)]


def test_circle_pairs(spark):
    a, b, c = ("chr1", 1000, 2000, "+"), ("CHR2 ", 5010, 6000, "-"), ("3", 250, 300, "+")
    near = lambda s, d: (s[0].strip().lower(), s[1] + d, s[2] - d, s[3])
    rows = circle(1, a, b, c) + circle(2, near(b, 20), near(c, 3), near(a, 0)) + circle(3, near(c, 9), near(a, 9)) + circle(4, near(b, 21), c, a) + circle(5, b, a)
    rows += circle(6, a) + circle(7, near(a, 5), b) + circle(8, a, (None, 1, 2, "+")) + circle(9, a, ("chr2", 5010, 6000, "+"), c) + circle(10, c, a, b) + circle(2, near(b, 20))
    df = spark.createDataFrame(rows, SEGS)
    got = {(r["id_a"], r["id_b"]) for r in ring_join.circle_pairs(df).collect()}
    assert got == {(x, y) for x in range(1, 11) for y in range(x + 1, 11) if alike(rows, x, y)}
    assert {(1, 2), (1, 3), (1, 5), (1, 7), (1, 10), (6, 7)} <= got and not {p for p in got if 8 in p}
    check_groups(ring_join.circle_groups(df), got, {1, 2, 3, 4, 5, 6, 7, 9, 10})
    assert ring_join.circle_pairs(df.limit(0)).count() == 0


def test_long_circles_are_turned_alike(spark):
    """Circles of very many segments, also with repeated ones, are one class wherever they start."""
    a, b = [("chr1", 100 * i, 100 * i + 50, "+") for i in range(90)], [("chr2", 10, 90, "+"), ("chr2", 500, 900, "-")] * 50
    rows = circle(1, *a) + circle(2, *a[70:], *a[:70]) + circle(3, *b) + circle(4, *b[51:], *b[:51])
    found = {r["id"]: r["class_id"] for r in ring_join.circle_groups(spark.createDataFrame(rows, SEGS)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3}


def alike(rows, *pair):
    """The definition itself."""
    segs = [[(r[2], r[5], r[3], r[4]) for r in sorted(set(rows), key=lambda r: r[1]) if r[0] == p] for p in pair]
    if any(c is None for s in segs for c, *_ in s):
        return False
    x, y = sorted(([(c.strip().lower().replace("chr", ""), *rest) for c, *rest in s] for s in segs), key=len)
    like = lambda s, t: s[:2] == t[:2] and abs(s[2] - t[2]) <= 20 and abs(s[3] - t[3]) <= 20
    cuts = [y] if len(x) == len(y) else [y[:i] + y[i + 1 :] for i in range(len(y))]
    return len(y) - len(x) <= 1 and any(all(like(s, z[(i + o) % len(z)]) for i, s in enumerate(x)) for z in cuts for o in range(len(z)))
