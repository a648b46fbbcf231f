"""Orders hold every row: held against the SQL of what they order."""

import pytest

from annulet.operators import tandem
from annulet.plans import registry
from tests.oracle import ROOT, connect
from tests.test_queries import needs_data


@needs_data
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_all_reads_by_priority(spark, size):
    sql = lambda name: connect(f"{ROOT}/{size}").execute(registry.oracle_sql()[name])
    classes = sql("a8_read_classes").df()
    reads = sorted(zip(classes["readName"], classes["readClass"]), key=lambda r: (tandem.CLASSES.index(r[1]), r[0]))
    rows = registry.queries()["t8_by_priority"](spark, f"{ROOT}/{size}").collect()
    assert sorted((r["place"], r["readName"], r["readClass"]) for r in rows) == [(i, *r) for i, r in enumerate(reads, 1)]
    assert len(reads) > 100
