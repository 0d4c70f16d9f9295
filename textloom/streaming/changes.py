"""Streaming form of keyed updates and of the stateless text steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.upserts import current_records


def append_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a change stream to a Parquet log, exactly once per micro-batch.

    Each batch costs its own size; nothing already written is rewritten.
    """
    keyed = stream.withColumn("day", F.to_date(F.timestamp_seconds("ts")))
    return (
        keyed.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_records(spark, path: str) -> DataFrame:
    """Current records according to the log written so far."""
    return current_records(spark.read.parquet(path).drop("day"))


def transform_stream(
    stream: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Run a stateless step (cleaning, tokenising, assembling) over a stream."""
    return (
        step(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def encode_stream(
    stream: DataFrame,
    encode_batch: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Steps that look at distinct words run per micro-batch.

    A batch is written under its own number, so a repeated batch overwrites
    itself instead of adding rows twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        encode_batch(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
