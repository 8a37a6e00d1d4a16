"""Records embedded in landed page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def script_argument(text: Column, name: str) -> Column:
    """Argument of the first ``name(<digits>);`` call as a number, NULL when absent."""
    return F.regexp_extract(text, rf"{name}\((\d+)\);", 1).try_cast("bigint")


def page_title(text: Column) -> Column:
    return F.regexp_extract(text, r"<title>([^<]*)</title>", 1)


def assigned_json(text: Column, variable: str) -> Column:
    """Right side of ``variable = {...};`` with the bare literal ``undefined`` turned into null."""
    found = F.regexp_extract(text, rf"{variable}\s=\s(.*);", 1)
    return F.replace(found, F.lit("undefined"), F.lit("null"))


def extract_embedded_json(df: DataFrame, key: str, text: str, variable: str, schema: str, records: str) -> DataFrame:
    """One row per element of the array ``records`` inside the JSON assigned to ``variable``."""
    parsed = df.select(key, F.from_json(assigned_json(F.col(text), variable), schema).alias("doc"))
    return parsed.select(key, "doc", F.posexplode(F.col(f"doc.{records}")).alias("pos", "record"))
