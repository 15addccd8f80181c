"""Column functions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, zero_division: float) -> Column:
    """numerator / denominator, or zero_division where the denominator is 0."""
    return F.when(denominator > 0, numerator / F.nullif(denominator, F.lit(0))).otherwise(F.lit(float(zero_division)))


def nullable_text(column: Column) -> Column:
    """column as text, with what stands for null in exported tables as null."""
    text = column.cast("string")
    return F.when(~text.isin("nan", "None", "<NA>", ""), text)


def first_column(columns: list[str], wanted: tuple[str, ...]) -> str | None:
    """The first of wanted that is among columns."""
    return next((c for c in wanted if c in columns), None)
