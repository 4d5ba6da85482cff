"""Topic records: building, decoding, reading and writing.

A topic is either a Kafka topic or a folder of Parquet files with the Kafka source's columns; both
give and take the same DataFrame. The Kafka connector is not part of every Spark installation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamscreen import schemas


@dataclass(frozen=True)
class Topic:
    """Where the records of a topic live: ``servers`` for Kafka, else ``folder``."""

    name: str
    folder: str | None = None
    servers: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def path(self) -> str:
        if self.folder is None:
            raise ValueError(f"topic {self.name} has neither servers nor folder")
        return f"{self.folder.rstrip('/')}/{self.name}"


def kafka_options(topic: Topic, starting: str = "earliest", max_per_batch: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": topic.servers, "subscribe": topic.name,
               "startingOffsets": starting, "includeHeaders": "true", **topic.options}
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_stream(spark: SparkSession, topic: Topic, starting: str = "earliest",
                max_per_batch: int | None = None) -> DataFrame:
    """Unbounded read from the earliest or latest record.

    ``max_per_batch`` bounds a micro-batch: records for Kafka, files for a folder. A folder is always
    read from its earliest file.
    """
    if topic.servers:
        reader = spark.readStream.format("kafka").options(**kafka_options(topic, starting, max_per_batch))
        return reader.load()
    if starting != "earliest":
        raise ValueError("a folder topic can only be read from its earliest record")
    reader = spark.readStream.schema(schemas.TOPIC_RECORD).options(**topic.options)
    if max_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_per_batch))
    return reader.parquet(topic.path)


def read_batch(spark: SparkSession, topic: Topic) -> DataFrame:
    """Everything the topic holds now."""
    if topic.servers:
        return spark.read.format("kafka").options(**kafka_options(topic)).load()
    # Parts are sub-folders.
    return (spark.read.schema(schemas.TOPIC_RECORD).option("recursiveFileLookup", "true").options(**topic.options)
            .parquet(topic.path))


def peek(spark: SparkSession, topic: Topic, n: int) -> DataFrame:
    """The first ``n`` records of the topic by partition and offset, decoded."""
    return decode(read_batch(spark, topic)).orderBy("topic", "partition", "offset").limit(n)


def decode(records: DataFrame) -> DataFrame:
    """Key and value as UTF-8 text (or null) beside topic, partition and offset.

    Bytes that are not UTF-8 come out as replacement characters.
    """
    return records.select(
        F.col("topic"), F.col("partition"), F.col("offset"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def header(headers: Column, name: str, default: str = "?") -> Column:
    """Text of the first header called ``name``."""
    first = F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))
    return F.coalesce(first["value"].cast("string"), F.lit(default))


def unique_headers(headers: Column) -> Column:
    """Headers without null keys or values; of equal keys the last one stays."""
    kept = F.filter(headers, lambda h, i: h["key"].isNotNull() & h["value"].isNotNull() & ~F.exists(
        F.slice(headers, i + 2, F.size(headers)),
        lambda later: later["key"].eqNullSafe(h["key"]) & later["value"].isNotNull()))
    return F.coalesce(kept, F.array().cast(schemas.HEADERS))


def header_map(headers: Column) -> Column:
    """Headers as a map; null keys or values are left out, the last of equal keys wins."""
    return F.map_from_entries(unique_headers(headers))


def add_headers(headers: Column, extra: Mapping[str, Column]) -> Column:
    """Append headers in the given order."""
    added = F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "UTF-8").alias("value"))
                      for k, v in extra.items()])
    return F.concat(F.coalesce(headers, F.array().cast(schemas.HEADERS)), added)


def record(df: DataFrame, *, key: Column | None, value: Column, topic: str | Column,
           headers: Mapping[str, Column] | None = None) -> DataFrame:
    """One keyed JSON record per row."""
    body = F.to_json(value, {"ignoreNullFields": "false"})
    return df.select(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (F.lit(None).cast("binary") if key is None else F.encode(key.cast("string"), "UTF-8")).alias("key"),
        F.encode(body, "UTF-8").alias("value"),
        add_headers(F.lit(None).cast(schemas.HEADERS), headers or {}).alias("headers")
        if headers else F.array().cast(schemas.HEADERS).alias("headers"))


def by_key(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Fixed number of partitions, equal keys together."""
    return df.repartition(partitions, *keys)


def single_partition(df: DataFrame) -> DataFrame:
    """One output partition, as a one-partition topic has. Only for small results."""
    return df.coalesce(1)


def numbered(records: DataFrame, partitions: int, offset: Column, timestamp: Column) -> DataFrame:
    """Give records partition (by key hash), offset and timestamp, as a broker would."""
    return records.select(
        "key", "value", "topic",
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"), timestamp.alias("timestamp"),
        F.lit(0).alias("timestampType"), "headers")


def write_batch(records: DataFrame, topic: Topic) -> None:
    """Append records to a topic. For a folder they must have all topic-record columns."""
    if topic.servers:
        (records.write.format("kafka").option("kafka.bootstrap.servers", topic.servers)
         .option("includeHeaders", "true").options(**topic.options).save())
    else:
        records.select(*schemas.TOPIC_RECORD.fieldNames()).write.mode("append").parquet(topic.path)


def replace_part(records: DataFrame, topic: Topic, part: str) -> None:
    """Write records as a named part of a topic; in a folder they replace what the part held, so a repeated writer sends them once."""
    if topic.servers:
        write_batch(records, topic)
    else:
        records.select(*schemas.TOPIC_RECORD.fieldNames()).write.mode("overwrite").parquet(f"{topic.path}/{part}")


def write_stream(records: DataFrame, checkpoint: str, *, servers: str | None = None,
                 folder: str | None = None, trigger: Mapping[str, object] | None = None,
                 options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start writing records to the topics their ``topic`` column names.

    A folder gets one sub-folder per topic. Spark's checkpoint and the file sink's log make a
    restart neither lose nor repeat files; Kafka output is at least once.
    """
    writer = records.writeStream.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"processingTime": "30 seconds"}))
    writer = writer.options(**(options or {}))
    if servers:
        writer = (writer.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("includeHeaders", "true"))
    else:
        writer = writer.format("parquet").option("path", folder).partitionBy("topic")
    return writer.outputMode("append").start()


def parse_json(records: DataFrame, schema: T.StructType, key_column: str | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of each record's JSON value.

    ``key_column`` is read from the record key, or from the value where the record has no key.
    ``keep`` names record columns (such as ``timestamp``) to carry along.
    """
    parsed = records.withColumn("_row", F.from_json(F.col("value").cast("string"), schema))
    columns = []
    for name in schema.fieldNames():
        column = F.col(f"_row.{name}")
        if name == key_column:
            column = F.coalesce(F.col("key").cast("string").cast(schema[name].dataType), column)
        columns.append(column.alias(name))
    return parsed.select(*columns, *[F.col(c).alias(f"record_{c}") for c in keep])


def offsets_by_partition(records: DataFrame) -> DataFrame:
    """First and last offset and record count per topic partition."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("records"))


def lag_behind(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Records not yet consumed per topic partition.

    ``committed``: topic, partition and ``next_offset``, the first offset still to be read.
    """
    ends = offsets_by_partition(records).select("topic", "partition", "last_offset")
    return (ends.join(committed, ["topic", "partition"], "left")
            .select("topic", "partition", "last_offset",
                    F.coalesce("next_offset", F.lit(0)).alias("next_offset"),
                    F.greatest(F.col("last_offset") + 1 - F.coalesce("next_offset", F.lit(0)), F.lit(0))
                    .alias("lag")))


def progress_report(query: StreamingQuery) -> DataFrame:
    """Per-source offsets and row counts of a running query's last micro-batch."""
    progress = query.lastProgress
    rows = [] if progress is None else [
        (s["description"], str(s["startOffset"]), str(s["endOffset"]), int(s["numInputRows"]))
        for s in progress["sources"]]
    return SparkSession.active().createDataFrame(
        rows, "source string, start_offset string, end_offset string, rows long")
