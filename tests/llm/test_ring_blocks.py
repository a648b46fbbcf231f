"""Rings in many parts: the same pairs, entries in proportion to letters, and no task with more than it should hold."""

import random

import pytest
from pyspark.sql import functions as F

from annulet.llm import ring_join
from tests.llm.test_rings import changed, close


def table(spark, seqs):
    return spark.createDataFrame(list(enumerate(seqs)), "id bigint, seq string").repartition(3)


@pytest.mark.parametrize("n, part, task", [(50, 20, 10**6), (16, 40, 50), (90, 10**6, 150)])
def test_pairs_in_many_parts(spark, monkeypatch, n, part, task):
    monkeypatch.setattr(ring_join, "ENTRIES_PER_PART", part)
    monkeypatch.setattr(ring_join, "ENTRIES_PER_TASK", task)
    rnd = random.Random(5)
    bases = ["".join(rnd.choice("ACGT") for _ in range(n)) for _ in range(max(4, 300 // n))]
    seqs = [changed(s, rnd.choice([0, 1, 2, 3]), rnd) for s in bases for _ in range(5)]
    want = {(i, j) for j in range(len(seqs)) for i in range(j) if close(seqs[i], seqs[j])}
    assert sorted((r["id_a"], r["id_b"]) for r in ring_join.ring_pairs(table(spark, seqs)).collect()) == sorted(want) and len(want) > 10


def test_entries_grow_with_letters_and_a_frequent_shingle_is_split(spark, monkeypatch):
    """A third of the rings share one long stretch."""
    monkeypatch.setattr(ring_join, "LETTERS_AT_ONCE", 5000)
    rnd = random.Random(3)
    letters = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    shared = letters(40)
    share = []
    for rings in (600, 2400):
        seqs = [shared * (i % 3 == 0) + letters(260 - 40 * (i % 3 == 0)) for i in range(rings)]
        reps = ring_join.classes(table(spark, seqs))[0]
        held = ring_join._entries(reps, 6, 9, 20 * rings // 600, {}).groupBy("part").agg(F.sum("entries").alias("n")).collect()
        share.append(sum(r["n"] for r in held) / sum(map(len, seqs)))
        most = max(r["n"] for r in held)
        blocks = {r["part"]: 4 for r in held if r["n"] == most}
        split = ring_join._entries(reps, 6, 9, 20 * rings // 600, blocks).groupBy("part", "i", "j").agg(F.sum("entries").alias("n")).collect()
        assert max(r["n"] for r in split if r["part"] in blocks) < 0.9 * most
    assert share[1] < 1.05 * share[0] and share[0] < 0.3
