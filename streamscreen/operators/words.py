"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_words(words: DataFrame, column: str = "word") -> DataFrame:
    """Occurrences of each value, one word per row; batch or streaming."""
    return words.groupBy(F.col(column).alias("word")).agg(F.count(F.lit(1)).alias("cnt"))


def split_words(lines: DataFrame, column: str = "value", separator: str = r"\s+") -> DataFrame:
    """One row per non-empty word of each line."""
    return (lines.select(F.explode(F.split(F.col(column), separator)).alias("word"))
            .where(F.col("word") != ""))


def count_words_in_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return count_words(split_words(lines, column))
