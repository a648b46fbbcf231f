"""Every query with SQL gives what the SQL gives, on the smallest tables; the others run."""

import os

import pytest

import __spark_entry__ as entry
from annulet.plans import registry
from tests.oracle import ROOT, compare

SF = f"{ROOT}/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@needs_data
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, name):
    assert compare(spark, SF, registry.queries()[name], registry.oracle_sql()[name]) == ""


@needs_data
@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_runs(spark, name):
    df = registry.queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns) and df.count() >= 0


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert registry.oracle_sql().keys() <= registry.queries().keys()
