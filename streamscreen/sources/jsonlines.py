"""JSON-lines and plain-text files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_lines(spark: SparkSession, path: str, *, streaming: bool = False,
               files_per_batch: int | None = None) -> DataFrame:
    """Trimmed non-blank lines as ``value``."""
    if streaming:
        reader = spark.readStream
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
        lines = reader.text(path)
    else:
        lines = spark.read.text(path)
    return lines.select(F.trim("value").alias("value")).where(F.col("value") != "")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, *,
                    streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Typed rows of a JSON-lines file; lines that do not parse give null columns."""
    lines = read_lines(spark, path, streaming=streaming, files_per_batch=files_per_batch)
    return lines.select(F.from_json("value", schema).alias("_row")).select("_row.*")


def append_json_lines(df: DataFrame, path: str, checkpoint: str,
                      trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start appending rows of a stream to JSON-lines files."""
    return (df.writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint).option("ignoreNullFields", "false")
            .trigger(**(trigger or {"processingTime": "30 seconds"}))
            .outputMode("append").start())


def print_rows(df: DataFrame, n: int = 20) -> StreamingQuery | None:
    """Show a result on the console; a stream goes to the console sink, and its query is returned."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", str(n)).outputMode("update").start()
    df.show(n, truncate=False)
    return None
