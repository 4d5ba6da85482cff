"""Database tables as topics: full snapshots, new rows only, and partitioned reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamscreen.operators.tables import snapshot_changes
from streamscreen.sources.manifest import delete, exists
from streamscreen.sources.topics import Topic, record, replace_part, write_batch


@dataclass(frozen=True)
class Database:
    """Connection of a JDBC source."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000


def topic_name(table: str, prefix: str = "postgres-") -> str:
    return f"{prefix}{table}"


def read_options(db: Database, table: str, *, partition_column: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int = 1) -> dict[str, str]:
    """Reader options; with a partition column the table is read by ``partitions`` parallel queries."""
    options = {"url": db.url, "dbtable": table, "fetchsize": str(db.fetch_size), **db.properties}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        options |= {"partitionColumn": partition_column, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def read_table(spark: SparkSession, db: Database, table: str, **partitioning) -> DataFrame:
    """The whole table as it is now."""
    return spark.read.format("jdbc").options(**read_options(db, table, **partitioning)).load()


def above(rows: DataFrame, column: str, last: int | None) -> DataFrame:
    """Rows past a high-water mark; the filter reaches the database on a JDBC read."""
    return rows if last is None else rows.where(F.col(column) > last)


def high_water_mark(rows: DataFrame, column: str) -> int | None:
    return rows.agg(F.max(column)).first()[0]


def as_records(rows: DataFrame, table: str, prefix: str = "postgres-", key: Column | None = None) -> DataFrame:
    """One JSON record per table row."""
    return record(rows, key=key, value=F.struct(*rows.columns), topic=topic_name(table, prefix))


def publish_snapshot(read: Callable[[str], DataFrame], tables: Sequence[str], target: Callable[[str], Topic],
                     prefix: str = "postgres-", key: Column | None = None,
                     number: Callable[[DataFrame], DataFrame] = lambda r: r) -> None:
    """Publish every row of the listed tables once; ``number`` gives folder topics their positions."""
    for table in tables:
        write_batch(number(as_records(read(table), table, prefix, key)), target(topic_name(table, prefix)))


def publish_snapshots(spark: SparkSession, read: Callable[[str], DataFrame], tables: Mapping[str, Column | None],
                      target: Callable[[str], Topic], checkpoint: str, *, interval: str = "5 seconds", prefix: str = "postgres-",
                      number: Callable[[DataFrame, int], DataFrame] = lambda r, _: r) -> StreamingQuery:
    """Publish every row of the ``tables`` (name to key column) each ``interval``; every poll sends all rows again.

    ``read`` may be ``partial(read_table, spark, db)`` or any other reader of a table's name. Polls are numbered by ticks that are
    replayed after a failure. What a poll has read is kept until the next one, so a poll that is repeated
    sends the same records, and in a folder topic they replace those sent before.
    """
    def poll(_ticks: DataFrame, batch: int) -> None:
        for table, key in tables.items():
            kept = f"{checkpoint}-polls/poll={batch}/{table}"
            if not exists(spark, f"{kept}/_SUCCESS"):
                read(table).write.mode("overwrite").parquet(kept)
            records = number(as_records(spark.read.parquet(kept), table, prefix, key), batch)
            replace_part(records, target(topic_name(table, prefix)), f"poll-{batch:012d}")
        delete(spark, f"{checkpoint}-polls/poll={batch - 1}")

    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").option("numPartitions", "1").load())
    return (ticks.writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())


def capture_changes(spark: SparkSession, read: Callable[[], DataFrame], key: str, checkpoint: str, path: str, *,
                    interval: str = "5 seconds") -> StreamingQuery:
    """Write what changed in a table with a unique ``key`` since the poll before to ``path``/poll=<number>, each ``interval``.

    The first poll gives every row as an insert; deletes carry the row's last values. Polls are numbered by ticks that are
    replayed after a failure, and the last two that were read are kept: a poll that is repeated compares the same rows and replaces what it
    had written, and a restart goes on from the rows that were seen last. A column that is new is null in the rows before.
    """
    def kept(number: int) -> str:
        return f"{checkpoint}-polls/poll={number}"

    def poll(_ticks: DataFrame, batch: int) -> None:
        if not exists(spark, f"{kept(batch)}/_SUCCESS"):
            read().write.mode("overwrite").parquet(kept(batch))
        new = spark.read.parquet(kept(batch))
        old = new.where("false") if batch == 0 else spark.read.schema(new.schema).parquet(kept(batch - 1))
        snapshot_changes(old, new, key).write.mode("overwrite").parquet(f"{path}/poll={batch}")
        # The poll before is committed, so nobody compares with what came before it.
        delete(spark, kept(batch - 2))

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").option("numPartitions", "1").load()
    return (ticks.writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())


def publish_new(spark: SparkSession, rows: DataFrame, table: str, column: str, target: Topic, marks: str, *,
                prefix: str = "postgres-", key: Column | None = None,
                number: Callable[[DataFrame], DataFrame] = lambda r: r) -> int | None:
    """Publish the rows whose ``column`` is above the stored mark, then store the new one; returns it.

    The mark is stored after the rows, so a failure in between sends them again and loses none.
    """
    try:
        last = spark.read.schema("mark long").parquet(marks).agg(F.max("mark")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    upto = high_water_mark(rows, column)
    if upto is None or (last is not None and upto <= last):
        return last
    # Rows that arrive meanwhile are above the new mark and left for the next run.
    fresh = above(rows, column, last).where(F.col(column) <= upto)
    write_batch(number(as_records(fresh, table, prefix, key)), target)
    spark.range(1).select(F.lit(upto).cast("long").alias("mark")).write.mode("append").parquet(marks)
    return upto
