import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from annulet.operators import packed_values as P


def by_buffer(texts):
    parent, pos, values = P.split_buffer(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for i, p, v in zip(parent.tolist(), pos.tolist(), values.to_pylist()):
        out[i].append((p, v))
    return [sorted(x) for x in out]


def test_definition():
    for text, want in {
        "a;b,c|d": [(1, "a"), (2, "b"), (3, "c"), (4, "d")], " a \t b ": [(1, "a"), (2, "b")], "a ; ;b": [(1, "a"), (3, "b")], ";a;": [(2, "a")], "": [], "  ": [], ";;": [],
        '"a;b" c': [(1, "a;b"), (2, "c")], '"a ""x"""': [(1, 'a "x"')], '"";a': [(2, "a")], "NA": [(1, "NA")], 'a"b;c': [(1, 'a"b'), (2, "c")], '"a;b': [(1, '"a'), (2, "b")],
        '"a"b;c': [(1, '"a"b'), (2, "c")], "é;环 状": [(1, "é"), (2, "环"), (3, "状")], "a\nb": [(1, "a\nb")],
    }.items():
        assert P.split_one(text) == want and by_buffer([text]) == [want], text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet='ab;,| \t"é', max_size=14)), max_size=6))
def test_buffer_follows_definition(texts):
    assert by_buffer(texts) == [P.split_one(t) if t is not None else [] for t in texts]


def test_slices_and_long_texts():
    whole = pa.array(["x;y", None, "a b", '"q;r"'])
    parent, pos, values = P.split_buffer(whole.slice(1))
    assert list(zip(parent.tolist(), pos.tolist(), values.to_pylist())) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "q;r")]
    long = ";".join(map(str, range(200_000)))
    assert by_buffer([long, ""])[0][-1] == (200_000, "199999")


def test_table(spark):
    df = spark.sql("select * from values (1L, 'a;b', null, timestamp'2024-01-01', 'x'), (1L, 'c', 'd', timestamp'2024-02-01', 'x'), (2L, null, ' ', null, 'y') as t(rec_id, reads, copies, loaded_at, packed)")
    got = sorted(map(tuple, P.unpack(P.stack_fields(df, "rec_id", ["reads", "copies"], "loaded_at")).collect()))
    assert got == [("copies", 1, 1, "d"), ("reads", 1, 1, "c")]
    assert P.unpack(P.stack_fields(df.limit(0), "rec_id", ["reads"], "loaded_at")).count() == 0


def test_long_fields_are_read_in_pieces(spark, monkeypatch):
    rows = [("f", i, ";".join(f"v{j}" for j in range(n))) for i, n in enumerate((3, 0, 500, 1, 900, 2))] + [("f", 9, None)]
    df = spark.createDataFrame(rows, "field string, rec_id bigint, packed string").coalesce(1)
    monkeypatch.setattr(P, "BYTES_AT_ONCE", 100)
    got = {}
    for r in P.unpack(df).collect():
        got.setdefault(r["rec_id"], []).append((r["pos"], r["val"]))
    assert {k: sorted(v) for k, v in got.items()} == {i: [(j + 1, x) for j, x in enumerate(t.split(";"))] for _, i, t in rows if t}
