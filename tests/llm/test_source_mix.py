from pyspark.sql import functions as F

from annulet.llm import source_mix as M

DOCS = "doc_id bigint, text string, source string, rate double, copy int"


def corpus(spark):
    rows = [(i, "word " * 20, "big", 1.0, 1) for i in range(600)] + [(1000 + i, "word " * 20, "small", 1.0, 1) for i in range(60)]
    rows += [(2000, "x", None, 1.0, 1), (2001, "x", "unlisted", 1.0, 1), (2002, None, "small", 1.0, 1), (2003, "", "big", 1.0, 1)]
    return spark.createDataFrame(rows, DOCS)


def targets(spark, *rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    goal = targets(spark, ("big", 0.6, 1), ("small", 0.4, 4), ("nobody", 0.5, 9), (None, 0.1, 1), ("small", 0.3, 4))
    sizes = M.sized(corpus(spark), goal)
    assert sizes.where("source is null or source = 'unlisted'").count() == 0
    rates = M.rates(sizes, goal)
    by = {r["source"]: r for r in rates.collect()}
    assert by["small"]["rate"] == 4.0 and abs(by["big"]["rate"] - 0.6) < 1e-9 and by["nobody"]["rate"] == 0.0
    mixed = M.mix(sizes, rates)
    copies = {r["source"]: (r["n"], r["m"]) for r in mixed.groupBy("source").agg(F.count("doc_id").alias("n"), F.max("copy").alias("m")).collect()}
    assert copies["small"] == (61 * 4, 4) and copies["big"][1] == 1 and 300 < copies["big"][0] < 420
    again = sorted(map(tuple, mixed.collect()))
    assert again == sorted(map(tuple, M.mix(sizes.repartition(7), rates).collect()))
    report = {r["source"]: r for r in M.shares(mixed, rates).collect()}
    assert abs(sum(r["actual_share"] for r in report.values()) - 1) < 1e-9 and abs(report["small"]["actual_share"] - 0.4) < 0.05


def test_wanted_total_is_capped(spark):
    goal = targets(spark, ("big", 0.5, 1), ("small", 0.5, None))
    sizes = M.sized(corpus(spark), goal)
    by = {r["source"]: r["rate"] for r in M.rates(sizes, goal, total_tokens=10**9).collect()}
    assert by == {"big": 1.0, "small": 1.0}
    assert sizes.count() == M.mix(sizes, M.rates(sizes, goal, 10**9)).count()


def test_empty_tables(spark):
    goal = targets(spark, ("big", 0.5, 1))
    sizes = M.sized(corpus(spark).limit(0), goal)
    assert M.mix(sizes, M.rates(sizes, goal)).count() == 0
    assert M.sized(corpus(spark), goal.limit(0)).count() == 0
