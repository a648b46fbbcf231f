"""All queries outside the ``llm`` subpackage, gathered from the modules that define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annulet.plans import alignment_queries, cluster_queries, data_quality, inferred_queries, interval_queries, more_queries, ring_queries, scalar_queries, split_read_queries, tandem_queries, text_queries, walk_queries

MODULES = (data_quality, alignment_queries, tandem_queries, interval_queries, inferred_queries, cluster_queries, scalar_queries, split_read_queries, ring_queries, walk_queries, text_queries, more_queries)
FLAGSHIP = "q2_summary"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
