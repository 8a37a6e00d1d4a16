"""Streaming scoring of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import models
from millrace.plans.registry import query, table
from millrace.runtime import work_path
from millrace.streaming import scoring


def prepared(events):
    """Inputs of the event model, for batch and stream alike."""
    return events.withColumns(
        {
            "hour": F.hour("ts").cast("double"),
            "user": (F.col("user_id") % 10).cast("double"),
            "label": (F.col("value") + F.col("event_id") % 10 > 12).cast("int"),
        }
    )


def event_model(spark, sf):
    return models.classifier_stages("logistic", ["hour", "user", "value"]).fit(prepared(table(spark, sf, "events")))


@query("M17_score_stream")
def _(spark, sf):
    model = event_model(spark, sf)
    stream = scoring.read_file_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    out, marks = work_path(spark, "scored"), work_path(spark, "scored_checkpoint")
    scoring.score_stream(prepared(stream), model, ["event_id"], out, marks)
    return spark.read.parquet(out).withColumn("pd", F.round("pd", 6))


@query("M17_stream_is_batch", "SELECT event_id, TRUE AS same FROM events")
def _(spark, sf):
    """Of every event whether the stream's score is that of the same model in one batch, and whether it came once."""
    model = event_model(spark, sf)
    stream = scoring.read_file_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    out, marks = work_path(spark, "scored"), work_path(spark, "scored_checkpoint")
    scoring.score_stream(prepared(stream), model, ["event_id"], out, marks)
    batch = models.score_batch(model, prepared(table(spark, sf, "events")), ["event_id"]).select("event_id", F.col("pd").alias("b"))
    both = spark.read.parquet(out).select("event_id", F.col("pd").alias("s")).join(batch, "event_id", "full")
    return both.select("event_id", (F.col("s") == F.col("b")).alias("same"))
