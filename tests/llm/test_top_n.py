import math
import random

from annulet.llm import top_n

SCHEMA = "aln_id bigint, query_id string, bit_score double, identity double, loaded_at timestamp, rank int, _bin string, _floor string"


def rows(data):
    return [(a, q, s, i, None, 9, "x", "y") for a, q, s, i in data]


def brute(data, n):
    groups = {}
    for a, q, s, i in data:
        if q is not None and s is not None and not math.isnan(s):
            groups.setdefault(q, []).append((-s, i is None or math.isnan(i), -(i or 0), a))
    return {(q, x[3]) for q, xs in groups.items() for x in sorted(xs)[:n]}


def test_hot_group_ties_nulls_and_clashing_columns(spark):
    rnd = random.Random(3)
    data = [(k, rnd.choice(["hot", "hot", "hot", "a", "b", None]), rnd.choice([None, math.nan, 0.0, -5.0, math.inf, 50.0, 50.0, rnd.random() * 900]), rnd.choice([None, 90.0, 99.5])) for k in range(3000)]
    df = spark.createDataFrame(rows(data), SCHEMA)
    for heavy in (1, 2, 2048):
        got = {(r["query_id"], r["aln_id"]) for r in top_n.top_n(df, "query_id", "bit_score", ["identity"], "aln_id", 3, heavy=heavy).collect()}
        assert got == brute(data, 3)


def test_fewer_rows_than_n_and_empty_table(spark):
    df = spark.createDataFrame(rows([(1, "a", 1.0, None)]), SCHEMA)
    assert [(r["aln_id"], r["rank"]) for r in top_n.top_n(df, "query_id", "bit_score", ["identity"], "aln_id", 3).collect()] == [(1, 1)]
    assert top_n.top_n(df.limit(0), "query_id", "bit_score", ["identity"], "aln_id", 3).count() == 0


def test_latest_version_counts(spark):
    df = spark.sql("select * from values (1L, 'a', 9.0D, 1.0D, timestamp'2024-01-01'), (1L, 'a', 2.0D, 1.0D, timestamp'2024-02-01'), (2L, 'a', 5.0D, 1.0D, null) as t(aln_id, query_id, bit_score, identity, loaded_at)")
    got = top_n.latest(df, "aln_id", "loaded_at", ["query_id", "bit_score", "identity"])
    assert {(r["aln_id"], r["bit_score"]) for r in got.collect()} == {(1, 2.0), (2, 5.0)}


def test_bins_never_fall(spark):
    values = [-math.inf, -1e9, -3.0, -0.5, 0.0, 0.2, 1.0, 7.0, 8.0, 1e5, 1e308, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bins = [r[0] for r in df.select(top_n.score_bin(df.v)).collect()]
    assert bins == sorted(bins)
