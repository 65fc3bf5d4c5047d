"""Annotate episodes as their files land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def follow_episodes(spark: SparkSession, pattern: str, schema, checkpoint: str, each: Callable[[DataFrame], None]) -> StreamingQuery:
    """Hand each batch of new episode rows to ``each``; progress is in the
    checkpoint folder, and ``each`` must overwrite by episode."""
    rows = spark.readStream.schema(schema).parquet(pattern)
    return rows.writeStream.foreachBatch(lambda batch, _: each(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
