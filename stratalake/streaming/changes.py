"""Change events as a stream: validated, repeats dropped, each topic's batch handed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "schema string, topic string, at timestamp"


def change_stream(spark: SparkSession, path: str, schemas: list[str], late: str = "1 hour") -> DataFrame:
    """(schema, topic, at, reason) of JSON events in a folder; reason is null for good ones, of which repeats are dropped."""
    raw = spark.readStream.schema(f"{EVENT}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    reason = F.when(F.col("_corrupt_record").isNotNull() | F.col("at").isNull(), "malformed").when(~F.col("schema").isin(schemas), "unknown schema").when(~F.coalesce(F.col("topic"), F.lit("")).rlike("^[a-z_][a-z0-9_]*$"), "bad topic")
    return raw.withColumn("reason", reason).withWatermark("at", late).dropDuplicatesWithinWatermark(["schema", "topic", "reason"]).select("schema", "topic", "at", "reason")


def run_changes(events: DataFrame, checkpoint: str, ingest: Callable[[DataFrame, int], None], skipped: Callable[[DataFrame, int], None] | None = None) -> None:
    """Hand each batch's good events to `ingest`, a topic once and in one batch at a time, and the others with their reasons to `skipped`, until what is there now is done.

    A batch may come again after a failure: `ingest` is told its number and should be idempotent.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good = batch.filter("reason is null").groupBy("schema", "topic").agg(F.max("at").alias("at"))
        ingest(good, number)
        if skipped:
            skipped(batch.filter("reason is not null"), number)
        batch.unpersist()

    events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
