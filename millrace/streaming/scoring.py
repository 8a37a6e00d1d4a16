"""The batch model applied to a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.operators.models import score_batch


def read_file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    """Parquet files that land in a folder, or one file, as a stream."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    # as a pattern of one name: a plain path would have to be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{parent}/{{{name}}}")


def score_stream(stream: DataFrame, model, key: Sequence[str], output: str, checkpoint: str) -> None:
    """Score everything available and stop. Stateless, restartable from its checkpoint."""
    scored = score_batch(model, stream, key)
    run = (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
