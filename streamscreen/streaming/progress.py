"""What a stream has done, whole: its progress as rows, and the watermarks and offsets of every batch from its checkpoint."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from streamscreen.sources.topics import Topic, read_batch

_PROGRESS = ("id string, runId string, batchId long, timestamp string, numInputRows long, eventTime struct<watermark:string>, "
             "stateOperators array<struct<operatorName:string,numRowsTotal:long,numRowsDroppedByWatermark:long>>, "
             "sources array<struct<description:string,startOffset:string,endOffset:string,numInputRows:long>>")


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every micro-batch of the session's queries to ``path``, one small file each.

    A query itself remembers its last hundred. To be registered with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        jvm, progress = self._spark._jvm, event.progress
        file = jvm.org.apache.hadoop.fs.Path(f"{self._path}/{progress.runId}-{progress.batchId:012d}.json")
        out = file.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(file, True)
        out.write((progress.json.replace("\n", " ") + "\n").encode())
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60) -> None:
        """Wait until all progress of an ended run is written: events come after the fact, in order."""
        if not self._end_of(run).wait(seconds):
            raise TimeoutError(f"no end of run {run} within {seconds} seconds")


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """All progress written by a ``ProgressLog``, one row per run and batch."""
    return spark.read.schema(_PROGRESS).json(path)


def dropped_by_watermark(progress: DataFrame) -> DataFrame:
    """Rows that stateful operators refused as late: query id, batch, dropped."""
    return progress.select("id", "batchId", F.explode("stateOperators").alias("op")).groupBy("id", "batchId").agg(
        F.sum("op.numRowsDroppedByWatermark").alias("dropped"))


def batch_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch, watermark_ms (that it ran with), offsets (JSON text of each source, the end it read to) and committed, from a checkpoint."""
    def files(folder: str) -> DataFrame:
        return spark.read.option("pathGlobFilter", "[0-9]*").text(f"{checkpoint}/{folder}", wholetext=True).select(
            F.split("value", "\n").alias("lines"), F.col("_metadata.file_name").cast("bigint").alias("batch"))

    begun = files("offsets").select(
        "batch", F.get_json_object(F.get("lines", F.lit(1)), "$.batchWatermarkMs").cast("bigint").alias("watermark_ms"),
        F.filter(F.slice("lines", 3, F.size("lines")), lambda line: F.length(line) > 0).alias("offsets"))
    done = files("commits").select(F.col("batch").alias("_done"))
    return begun.join(done, F.col("batch") == F.col("_done"), "left").select(
        "batch", "watermark_ms", "offsets", F.col("_done").isNotNull().alias("committed"))


def late_rows(rows: DataFrame, log: DataFrame, at: Column) -> DataFrame:
    """The rows (with their ``batch``) that a stateful operator refuses: behind the watermark with which the batch before theirs ran."""
    marks = log.select((F.col("batch") + 1).alias("_batch"), "watermark_ms")
    # A row per micro-batch; joined by shuffle or broadcast as Spark sees fit.
    return rows.join(marks, F.col("batch") == F.col("_batch")).where(
        (F.col("watermark_ms") > 0) & (at <= F.timestamp_millis("watermark_ms"))).select(*rows.columns)


def committed_offsets(spark: SparkSession, checkpoint: str, topic: Topic, source: int = 0) -> DataFrame:
    """topic, partition and next_offset that a query has committed, by its own checkpoint.

    For Kafka these are the offsets in the log. For a folder the log names files: those read by committed batches
    are found in the source's file log, and their records give the offsets.
    """
    last = batch_log(spark, checkpoint).where("committed").agg(F.max_by("offsets", "batch").alias("_o"))
    own = F.get("_o", F.lit(source))
    if topic.servers:
        by_topic = F.from_json(own, "map<string,map<string,bigint>>")
        return last.select(F.explode(by_topic).alias("topic", "_p")).select(
            "topic", F.explode("_p").alias("partition", "next_offset")).withColumn("partition", F.col("partition").cast("int"))
    upto = last.select(F.get_json_object(own, "$.logOffset").cast("bigint")).first()[0]
    named = spark.read.option("pathGlobFilter", "[0-9]*").text(f"{checkpoint}/sources/{source}").select(
        F.from_json("value", "path string, batchId bigint").alias("_f")).where(
        F.col("_f.path").isNotNull() & (F.col("_f.batchId") <= (-1 if upto is None else upto)))
    read = named.select(F.element_at(F.split("_f.path", "/"), -1).alias("_read")).distinct()
    records = read_batch(spark, topic).select("topic", "partition", "offset", F.col("_metadata.file_name").alias("_file"))
    return records.join(read, F.col("_file") == F.col("_read"), "left_semi").groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"))
