"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps may use any number of times.

    A plain projection would be merged into the filters and projections above it, repeating the
    expression at every use; a one-row ``inline`` keeps its result.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
