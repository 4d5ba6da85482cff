"""The given tables read as the jobs' inputs.

``events`` stand in for transactions, sensor readings and forecasts, ``orders`` for payments and
``customer`` for users, so every registered query grows with the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamscreen.functions.units import epoch_ms
from streamscreen.operators.rules import Limits
from streamscreen.schemas import PAYMENT
from streamscreen.session import new_path
from streamscreen.sources.manifest import exists

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
# The events of one user are hours apart, so windows are scaled up to give the rules rows to fire on.
SCALED = Limits(velocity_ms=12 * 3_600_000, spend_window="1 day", spend_limit=20_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Forecasts are the events, issued for this much later: no reading meets a forecast made of itself.
FORECAST_LEAD_MS = 17 * 60_000
#: A closing row comes this much after the last event.
CLOSING_MS = 3 * 86_400_000


def event_parts(spark: SparkSession, sf_dir: str, parts: int) -> list[DataFrame]:
    """The events in ``parts`` slices of equal length of time, oldest first."""
    events = table(spark, sf_dir, "events")
    ms = epoch_ms(events, "ts")
    first, last = events.agg(F.min(ms), F.max(ms)).first()
    if first is None:
        return [events] * parts
    cuts = [first + (last - first) * i // parts for i in range(1, parts)]
    lower, upper = [None, *cuts], [*cuts, None]
    every = F.lit(True)
    return [events.where((every if a is None else ms > a) & (every if z is None else ms <= z))
            for a, z in zip(lower, upper, strict=True)]


def closing_row(spark: SparkSession, sf_dir: str, after_ms: int = CLOSING_MS) -> DataFrame:
    """One event of a known user well after all others, without value: it moves the watermark past every open window.

    Its own window stays open, so it is in no result of an append-mode window.
    """
    events = table(spark, sf_dir, "events")
    at = F.max("ts") + F.expr(f"INTERVAL {after_ms // 1000} SECONDS")
    return events.agg(at.alias("ts"), F.min("user_id").alias("user_id")).select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", "user_id", F.lit("close").alias("event_type"),
        F.lit(0.0).alias("value"), F.lit('{"k": 0}').alias("props"))


def write_events(events: DataFrame, path: str) -> None:
    events.select("event_id", "ts", "user_id", "event_type", "value", "props").write.mode("append").parquet(path)


#: Rows of a file of a slice.
FILE_ROWS = 500_000


def write_slices(slices: list[DataFrame], path: str, write: Callable[[DataFrame], None] | None = None,
                 file_rows: int = FILE_ROWS) -> int:
    """Append slices to a folder, each as the same number of files, which is returned: a stream that takes that many files at a
    time has a micro-batch for each slice, however large they are.

    The files of a slice share its time, so a watermark must not move between them. ``write`` appends rows to the folder
    (default: as events); a slice of fewer rows than files is filled up with empty files.
    """
    spark = slices[0].sparkSession
    write = write or (lambda rows: write_events(rows, path))
    files = max(1, *(-(-part.count() // file_rows) for part in slices))
    wanted = len(spark.read.parquet(path).inputFiles()) if exists(spark, path) else 0
    for part in slices:
        write(part.repartition(files) if files > 1 else part.coalesce(1))
        wanted += files
        for _ in range(wanted - len(spark.read.parquet(path).inputFiles())):
            write(spark.createDataFrame([], part.schema).coalesce(1))
    return files


def read_event_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of event files as a stream, ``ts`` as an instant of time; micro-batches are bounded by files."""
    events = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", str(files_per_batch)).parquet(path))
    return events.withColumn("ts", F.timestamp_millis(epoch_ms(events, "ts")))


def event_stream(spark: SparkSession, sf_dir: str, *, parts: int = 3, closed: bool = False) -> DataFrame:
    """All events as a stream of several micro-batches; ``closed`` adds the closing row as a last one."""
    path = new_path(spark, "event-files")
    files = write_slices([*event_parts(spark, sf_dir, parts), *([closing_row(spark, sf_dir)] if closed else [])], path)
    return read_event_stream(spark, path, files)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Home city of each customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            .select("c_custkey", "n_name", F.col("c_nationkey").cast("string").alias("n_state")))


def _placed(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    home = places(spark, sf_dir)
    return events.join(home, events["user_id"] == home["c_custkey"])


def whole_tens(value: Column) -> Column:
    return F.round(value * 10) * 10


def transactions(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    ms = epoch_ms(events, "ts")
    return _placed(events, spark, sf_dir).select(
        F.concat(F.lit("TXN-"), F.col("event_id")).alias("transaction_id"),
        F.concat(F.lit("C"), F.col("user_id")).alias("customer_id"),
        whole_tens(F.col("value")).alias("amount"), F.col("event_type").alias("merchant"),
        F.col("n_name").alias("city"), ms.alias("event_time"),
        F.floor(F.pmod(ms, F.lit(86_400_000)) / 3_600_000).cast("int").alias("hour"),
        F.col("ts").alias("event_ts"))


def sensors(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("int")
    return _placed(events, spark, sf_dir).select(
        F.col("user_id").cast("string").alias("sensor_id"), F.col("n_name").alias("location"),
        F.col("n_state").alias("state"), epoch_ms(events, "ts").cast("string").alias("timestamp"),
        ((F.col("value") - 32) * 5 / 9).alias("temperature_celsius"),
        F.col("value").alias("temperature_fahrenheit"), k.cast("double").alias("humidity_percent"),
        (F.col("value") + 900).alias("pressure_hpa"), (k * 4).alias("air_quality_index"),
        F.col("event_type").alias("air_quality_status"), F.col("ts").alias("event_ts"))


def weather(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    lead = F.expr(f"INTERVAL {FORECAST_LEAD_MS // 60_000} MINUTES")
    return _placed(events, spark, sf_dir).select(
        F.col("n_name").alias("city"), F.col("n_state").alias("state"),
        (epoch_ms(events, "ts") + FORECAST_LEAD_MS).cast("string").alias("timestamp"),
        F.floor("value").cast("int").alias("temperature_f"),
        ((F.floor("value") - 32) * 5 / 9).alias("temperature_c"), F.lit("F").alias("temperature_unit"),
        F.concat((F.floor("value") % 30).cast("string"), F.lit(" mph")).alias("wind_speed"),
        F.lit("N").alias("wind_direction"), F.col("props").alias("short_forecast"),
        F.col("event_type").alias("period_name"), (F.col("ts") + lead).alias("event_ts"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") >= 0, F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.col("n_name").alias("city"), F.col("c_nationkey").cast("string").alias("state"))


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """A table of fewer files than cores, dealt over them: what is made of its rows costs more than the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed payments; customers in debt pay zero."""
    orders, customer = _dealt(table(spark, sf_dir, "orders"), "o_orderkey"), table(spark, sf_dir, "customer")
    key = F.col("c_nationkey")

    def country(n: Column) -> Column:
        return F.when(n == 3, "NG").when(n == 7, "RU").otherwise(F.concat(F.lit("N"), n.cast("string")))

    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.col("o_custkey").cast("string").alias("card_id"),
        F.col("c_name").alias("user_id"), F.col("o_orderpriority").alias("merchant_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "CRYPTO")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "GIFT_CARDS")
         .otherwise(F.col("c_mktsegment")).alias("merchant_category"),
        F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.col("o_totalprice") / 500).alias("amount"),
        F.lit("USD").alias("currency"), country(key).alias("country"),
        country(F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(3)).otherwise(key)).alias("ip_country"),
        F.when(F.col("o_orderstatus") == "O", "POS").when(F.col("o_orderstatus") == "F", "ECOM")
         .otherwise("ATM").alias("channel"),
        epoch_ms(orders, "o_orderdate").cast("string").alias("ts_utc"))


def payment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as raw topic records. Faults follow the order's priority: HIGH has a quoted amount,
    MEDIUM an unknown channel and LOW, where the customer is not in debt, an extra key."""
    paid = payments(spark, sf_dir).withColumn(
        "channel", F.when(F.col("merchant_id") == "3-MEDIUM", "WEB").otherwise(F.col("channel")))
    names = PAYMENT.fieldNames()
    quoted = F.struct(*[F.col(c).cast("string").alias(c) for c in names])
    value = (F.when(F.col("merchant_id") == "2-HIGH", F.to_json(quoted))
             .when((F.col("merchant_id") == "5-LOW") & (F.col("amount") > 0),
                   F.to_json(F.struct(*names, F.lit("x").alias("note"))))
             .otherwise(F.to_json(F.struct(*names))))
    return paid.select(
        F.encode("card_id", "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"),
        F.lit("payments.raw").alias("topic"),
        F.pmod(F.col("card_id").cast("long"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.timestamp_millis(F.col("ts_utc").cast("long")).alias("timestamp"), F.lit(0).alias("timestampType"),
        F.array(F.struct(F.lit("source").alias("key"), F.encode(F.lit("orders"), "UTF-8").alias("value")),
                F.struct(F.lit("excel_row").alias("key"), F.encode("event_id", "UTF-8").alias("value")))
        .alias("headers"))
