"""Alignments as a stream: second deliveries dropped, windowed counts with late data, best hits kept per query.

What needs all reads at once (numbering, components, clustering) stays in batch; a stream hands it finished
micro-batches through ``foreachBatch``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.operators import classify


def stream(spark: SparkSession, d: str, name: str, files_per_batch: int = 8) -> DataFrame:
    """A table of parquet files as a stream, whether it is one file or a folder of them."""
    path = os.path.join(d, f"{name}.parquet")
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path) if os.path.isdir(path) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)


def once(df: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key once within the time that events may be late."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts(df: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """window_start, keys, n of tumbling windows."""
    out = df.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n")


def best_hits(df: DataFrame) -> DataFrame:
    """query_id and its best hit so far (score, then identity, then the smallest aln_id)."""
    rows = df.where("query_id is not null and bit_score is not null and not isnan(bit_score)")
    best = rows.groupBy("query_id").agg(F.max(F.struct("bit_score", F.coalesce("identity", F.lit(-1.0)).alias("identity"), (-F.col("aln_id")).alias("minus"))).alias("b"))
    return best.select("query_id", (-F.col("b.minus")).alias("aln_id"), F.col("b.bit_score").alias("bit_score"))


def prepared(df: DataFrame) -> DataFrame:
    """The stateless part of classification works on a stream as it is."""
    return classify.prepared(df)


def run(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is there now, through the stream into a table in memory (for small results and tests)."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands every micro-batch of what is there now to a batch function, once each."""
    df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
