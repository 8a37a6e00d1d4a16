"""Column expressions for cleaning amounts, codes, names, dates and bins. No UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_amount(text: Column, units: Sequence[str] = ("$", ",", "km")) -> Column:
    """Strip currency, separators and units; unreadable text becomes NULL."""
    out = text
    for unit in units:
        out = F.replace(out, F.lit(unit), F.lit(""))
    return F.trim(out).try_cast("bigint")


def title_of(name: Column) -> Column:
    """Text between the first comma and the next full stop."""
    return F.trim(F.split_part(F.split_part(name, F.lit(","), F.lit(2)), F.lit("."), F.lit(1)))


def part_count(text: Column) -> Column:
    """Number of space-separated parts, 0 for NULL."""
    return F.when(text.isNull(), 0).otherwise(F.size(F.split(text, " ", -1)))


def first_letter(text: Column) -> Column:
    """First character; a missing value counts as letter n."""
    return F.coalesce(F.substring(text, 1, 1), F.lit("n"))


def is_numeric(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9]+$"), F.lit(False)).cast("int")


def code_prefix(text: Column) -> Column:
    """All but the last space token joined without blanks, '.' and '/', lower case; '0' when there is none."""
    parts = F.split(text, " ", -1)
    head = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "")
    return F.when(F.size(parts) > 1, F.lower(F.translate(head, "./", ""))).otherwise("0")


def parse_minute(text: Column) -> Column:
    """``m/d/yyyy h:mm`` text to a timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm"))


def parse_day(text: Column) -> Column:
    """``m/d/yyyy`` text to a date, NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date")


def score_to_class(score: Column) -> Column:
    """Half-star score 0.5..5.0 to class 0..4."""
    return F.ceil(score).cast("int") - 1


def clip(col: Column, low, high) -> Column:
    """Bound a value on both sides; NULL stays NULL."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def bin_by_edges(col: Column, edges: Sequence[float], labels: Sequence[str], right_closed: Sequence[bool], missing: str) -> Column:
    """First bin whose upper edge holds the value; ``right_closed[i]`` says whether edge i belongs below."""
    expr = F.when(col.isNull(), missing)
    for edge, label, closed in zip(edges, labels, right_closed):
        expr = expr.when(col <= edge if closed else col < edge, label)
    return expr.otherwise(labels[-1])
