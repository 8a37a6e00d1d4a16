"""Readers and writers. Paths are URIs (file, hdfs, object store); schemas are explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a known schema, so no inference scan. Quotes are doubled inside fields."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_raw_rows(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """All fields as text under the given names; cast by name afterwards."""
    schema = StructType([StructField(n, StringType()) for n in names])
    return read_delimited(spark, path, schema, sep=sep)


def write_delimited(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """One header per part file; text fields keep their outer blanks."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_json_records(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """JSON lines, or one array of records per file with ``multiline``."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_json_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_uri(spark: SparkSession, uri: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """Read straight from a storage URI; credentials belong to the session's Hadoop settings."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(uri)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Text vectors ``word f1 … fn`` -> (word, vector). The optional "count dim" line is skipped."""
    fields = F.split(F.col("value"), " ")
    return (
        spark.read.text(path)
        .where(F.size(fields) > 2)
        .select(
            fields[0].alias("word"),
            F.transform(F.slice(fields, 2, F.size(fields) - 1), lambda x: x.cast("float")).alias("vector"),
        )
    )


def write_embeddings(df: DataFrame, path: str, word: str = "word", vector: str = "vector") -> None:
    """(word, vector) -> text lines ``word f1 … fn``."""
    numbers = F.array_join(F.transform(F.col(vector), lambda x: x.cast("string")), " ")
    df.select(F.concat_ws(" ", F.col(word), numbers).alias("value")).write.mode("overwrite").text(path)


def save_table(df: DataFrame, name: str, path: str) -> None:
    """Parquet table registered in the catalog, data at an explicit shared path."""
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(name)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name and size of the files under a folder, content not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"))
    )
