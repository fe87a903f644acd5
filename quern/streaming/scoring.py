"""Incremental scoring: new query files against a static pool, each micro-batch ranked by itself.

The checkpoint holds which files are done, so a restarted run goes on where it stopped; a batch's output goes to a folder of
its own number, so a batch that runs again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quern.schema import ENTITY


def score_files(spark: SparkSession, source: str, out: str, checkpoint: str, make: Callable[[DataFrame], DataFrame], schema: T.StructType = ENTITY, files_per_batch: int = 64) -> int:
    """make(queries) -> results, for all files that are there; returns the number of batches."""
    stream = spark.readStream.schema(schema).options(sep="\t", header=True, escape='"', maxFilesPerTrigger=files_per_batch).csv(source)
    batches = []

    def write(batch: DataFrame, number: int) -> None:
        batches.append(number)
        make(batch.fillna("")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(batches)
