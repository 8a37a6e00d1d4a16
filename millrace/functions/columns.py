"""Whole-frame projections: renaming, suffixing, typing and column discovery."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def sanitize_columns(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace a character sequence in every column name."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def to_snake_case(df: DataFrame) -> DataFrame:
    names = {c: re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", c).lower() for c in df.columns}
    return df.withColumnsRenamed(names)


def suffix_columns(df: DataFrame, suffix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keep})


def select_by_regex(df: DataFrame, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[c for c in df.columns if c in keep or re.search(pattern, c)])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def element(col: Column, index: int) -> Column:
    """0-based element of an array."""
    return F.get(col, F.lit(index))


def label_map(col: Column, classes: list[str]) -> Column:
    """Class -> map of every class name to whether it is the row's class."""
    pairs = [x for c in classes for x in (F.lit(c), col == c)]
    return F.create_map(*pairs)


def one_hot_array(col: Column, classes: list) -> Column:
    return F.array(*[(col == c).cast("int") for c in classes])
