import random

from annulet.functions import read_trim as R
from annulet.operators import graph
from annulet.operators.numbering import numbered


def test_components_against_union_find(spark):
    rnd = random.Random(8)
    for n, m in ((40, 25), (60, 60), (30, 0)):
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(40)] + [(None, 3)]
        nodes = list(range(n)) + list(range(100, 131)) + list(range(200, 240))
        root = {x: x for x in nodes}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            if a is not None:
                a, b = sorted((find(a), find(b)))
                root[b] = a
        got = graph.components(spark.createDataFrame([(x,) for x in nodes], "node bigint"), spark.createDataFrame(edges, "src bigint, dst bigint"))
        assert {r["node"]: r["component"] for r in got.collect()} == {x: find(x) for x in nodes}


def test_circles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "d"), ("f", "g"), ("h", "h"), ("i", "j"), ("j", "k")], "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in "abcdefghijkl"], "node string")
    members = graph.components(nodes, edges)
    got = {r["component"]: (r["nodes"], r["cyclic"]) for r in graph.circular(members, edges).collect()}
    assert got == {"a": (3, True), "d": (2, True), "f": (2, False), "h": (1, True), "i": (3, False), "l": (1, False)}


def hit(q, e, ref="c", r=0, s=1):
    return R.Hit(q, e, ref, r, r + e - q, e - q, e - q, 60, s)


def test_tandem_copies_and_merging():
    copies = [hit(0, 100, r=1000), hit(100, 200, r=5000), hit(200, 300, r=1010), hit(300, 400, r=4990)]
    kept, size, ctc = R.trimmed(copies)
    assert (len(kept), size, ctc) == (4, 400, True)
    assert R.pattern(list("xabab")) == ["a", "b"] and R.pattern(list("abc")) == [] and R.pattern(list("aaa")) == ["a"] and list(R.longest_run(list("ababxab"), ["a", "b"])) == [0, 1, 2, 3]
    near = R.merged([hit(0, 100, r=0), hit(105, 200, r=105)])
    assert len(near) == 1 and (near[0].q_start, near[0].q_end) == (0, 200)
    assert len(R.merged([hit(0, 100), hit(150, 200, r=150)])) == 1  # beyond the gap: dropped
    assert len(R.merged([hit(0, 100), hit(96, 200, ref="d")])) == 2  # a small overlap
    assert R.merged([hit(0, 100), hit(50, 300, ref="d")])[0].ref == "d"  # the longer one stays


def test_walks():
    t = {("a", "b"): ["+_+"], ("b", "c"): ["+_-"], ("c", "a"): ["-_+"]}
    assert R.resolved(["a", "b", "c"], t, {})[0] == ["a_+", "b_+", "c_-"] and R.resolved(["a", "b", "c"], t, {})[3]
    assert R.resolved(["a", "b"], {("a", "b"): ["+_-"], ("b", "a"): ["-_+"]}, {}) == (["a_+", "b_-"], True, False, True)
    assert R.resolved(["a", "b"], {("a", "b"): ["+_-"]}, {})[3] is False
    assert R.resolved(["a"], {("a", "a"): ["-_-"]}, {}) == (["a_-"], True, True, True)
    star = {("a", "b"): ["+_+"], ("a", "c"): ["+_+"], ("a", "d"): ["+_+"]}
    assert R.resolved(list("abcd"), star, {"b": "-"}) == (["a_+", "b_-", "c_+", "d_+"], False, False, False)


def test_numbers_run_along_the_order(spark):
    df = spark.range(1000).selectExpr("id", "cast(id * 7919 % 1009 as string) as k")
    got = [(r["k"], r["id"], r["n"]) for r in numbered(df, ["k", "id"], "n", 5).collect()]
    assert [n for *_, n in sorted(got)] == list(range(5, 1005))
