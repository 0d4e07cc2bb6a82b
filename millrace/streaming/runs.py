"""Incremental runs: new files in, accepted and rejected rows out, a table of seen prompts between runs.

A checkpoint holds what was read, so a run resumes where the last one ended; each micro-batch is the batch operators'
work on new rows against the seen table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import text as T
from millrace.operators.dedup import add_new

SEEN = "prompt_key string, first_prompt string, first_source string, topic string, created_at string"


def seen_prompts(spark: SparkSession, path: str) -> DataFrame:
    """The table of seen prompts with the batch that wrote each; empty before the first run."""
    try:
        return spark.read.schema(f"{SEEN}, batch long").parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{SEEN}, batch long")


def accept_stream(stream: DataFrame, seen: str, accepted: str, rejected: str, checkpoint: str, order: str, judge: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Run over what is new and stop. judge adds `reason` to a batch; rows that are `ok` and new are accepted.

    Each batch writes folders of its own (`batch=N`) under accepted, rejected and seen, and is compared with what other
    batches wrote. So a batch that runs again, because its commit was lost, finds the same rows new and replaces its
    folders by the same content. A table of prompts known beforehand goes under `batch=-1` (see `start_with`)."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        told = judge(rows).persist()
        try:
            good = told.filter("reason = 'ok'").drop("reason")
            others = seen_prompts(spark, seen).filter(F.col("batch") != number)
            fresh = add_new(others, good, T.fold(F.col("prompt")), order).persist()
            fresh.drop("prompt_key").write.mode("overwrite").parquet(f"{accepted}/batch={number}")
            told.filter("reason <> 'ok'").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
            index = fresh.select("prompt_key", F.col("prompt").alias("first_prompt"), F.col("source").alias("first_source"), "topic", "created_at")
            index.write.mode("overwrite").parquet(f"{seen}/batch={number}")
            fresh.unpersist()
        finally:
            told.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_with(index: DataFrame, seen: str) -> None:
    """Begin the table of seen prompts with an index, for instance of `dedup.bootstrap_index`."""
    index.select("prompt_key", "first_prompt", "first_source", "topic", "created_at").write.mode("overwrite").parquet(f"{seen}/batch=-1")


def first_seen_stream(stream: DataFrame, text: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """A stream without prompts repeated within `delay` of event time. State is dropped when the watermark passes it, so it
    doesn't grow for ever; a repeat after that is let through (`accept_stream` keeps all prompts in a table instead)."""
    keyed = stream.withWatermark(event_time, delay).withColumn("prompt_key", T.fold(F.col(text)))
    return keyed.dropDuplicatesWithinWatermark(["prompt_key"])
