"""Ingest of tabular payment files with row-number lineage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamscreen.operators.intervals import small_enough
from streamscreen.schemas import PAYMENT
from streamscreen.session import durable

FIELDS = tuple(PAYMENT.fieldNames())


def check_header(found: Sequence[str], expected: Sequence[str] = FIELDS) -> None:
    """The first columns must be the expected ones, in order; further columns are ignored."""
    if list(found[:len(expected)]) != list(expected):
        raise ValueError(f"header {list(found)} does not start with {list(expected)}")


def _physical_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))


def _blocks(lines: DataFrame, *more: Column) -> DataFrame:
    """Number of the line before each file block; written, and broadcast if it is measured small."""
    blocks = lines.groupBy("source", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), *more)
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), "file-blocks")
    return F.broadcast(starts) if small_enough(starts) else starts


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with ``source`` (file path) and ``row`` (1-based line number in the file).

    Files may be split over tasks: each task counts its own block, and block totals, one row per
    file block, give the number to start from.
    """
    lines = _physical_lines(spark, path)
    return (lines.join(_blocks(lines), ["source", "_block"])
            .select("value", "source", (F.col("_id") - F.col("_first") + F.col("_start") + 1).alias("row")))


def line_map(value: Column, separator: str = ",") -> tuple[Column, Column]:
    """Whether a quoted field is open after a line: if none was open before it, and if one was.

    A field is quoted if it begins with a quote; quotes inside it are doubled. Quotes elsewhere are plain text.
    """
    sep = "\\" + separator if not separator.isalnum() else separator
    inner = r'[^"]*+(?:""[^"]*+)*+'
    field = rf'(?:"{inner}"[^{sep}]*+|[^"{sep}][^{sep}]*+|)'
    quote = value.contains('"')
    opens = value.rlike(rf'^(?:{field}{sep})*+"{inner}$')
    stays = value.rlike(rf'^{inner}$')
    reopens = value.rlike(rf'^{inner}"[^{sep}]*+{sep}(?:{field}{sep})*+"{inner}$')
    return quote & opens, ~quote | stays | reopens


def _state_after(closed: Column, opened: Column, ordered: Window) -> tuple[Column, Column]:
    """The composition of the line maps of all rows up to this one: open after it, for either state before the first.

    A map that does not depend on the state before it settles the state; maps after it only turn it round or keep it. So the
    last settling map and the number of turns since give the state, and both are running aggregates.
    """
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum((closed & ~opened).cast("long")).over(upto)
    settled = F.when(closed == opened, F.struct(closed.alias("open"), turns.alias("turns")))
    return turns, settled


def _open_before(turns: Column, settled: Column, start: Column) -> Column:
    odd = F.when(settled.isNull(), turns).otherwise(turns - settled["turns"]) % 2 == 1
    return F.coalesce(settled["open"], start) != odd


def numbered_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Records of CSV files as ``value``, with ``source`` and ``row``, the number of their first line.

    A record goes on over line breaks in quoted fields (given as ``\\n``). Whether a quote is open where a task's block begins
    depends on all blocks before it. Each line is a map from (open before) to (open after); maps are composed within
    blocks, in parallel, then over the blocks, one row each, and then every task knows where records begin. Files in which no line opens a
    quote are read line by line; only the others are put in order. A quote that is never closed makes the rest of its file one record.
    """
    lines = _physical_lines(spark, path)
    closed, opened = line_map(F.col("value"), separator)
    starts = _blocks(lines, F.max(closed).alias("_opens"))
    multi = starts.groupBy("source").agg(F.max("_opens").alias("_multi"))
    marked = lines.join(starts.drop("_opens"), ["source", "_block"]).join(F.broadcast(multi) if small_enough(multi) else multi, "source")
    row = (F.col("_id") - F.col("_first") + F.col("_start") + 1).alias("row")
    plain = marked.where(~F.col("_multi")).select("value", "source", row)
    if multi.where("_multi").limit(1).count() == 0:
        return plain

    # One shuffle brings the lines of a block together, in order.
    block = Window.partitionBy("source", "_block").orderBy("row")
    mapped = marked.where("_multi").select("value", "source", "_block", row).withColumn("_closed", closed).withColumn("_opened", opened)
    turns, settled = _state_after(F.col("_closed"), F.col("_opened"), block)
    composed = mapped.withColumn("_turns", turns).withColumn("_own", settled)
    composed = durable(composed.withColumn("_settled", F.last("_own", ignorenulls=True).over(
        block.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_own"), "csv-lines")
    whole = composed.groupBy("source", "_block").agg(
        F.max_by(F.struct("_turns", "_settled"), "row").alias("_m")).select(
        "source", "_block", _open_before(F.col("_m._turns"), F.col("_m._settled"), F.lit(False)).alias("_closed"),
        _open_before(F.col("_m._turns"), F.col("_m._settled"), F.lit(True)).alias("_opened"))
    # The same over the blocks of a file, one row each.
    blocks = Window.partitionBy("source").orderBy("_block")
    turns, settled = _state_after(F.col("_closed"), F.col("_opened"), blocks)
    chained = whole.withColumn("_turns", turns).withColumn("_own", settled).withColumn(
        "_settled", F.last("_own", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    begins = chained.select("source", "_block", F.coalesce(F.lag(
        _open_before(F.col("_turns"), F.col("_settled"), F.lit(False))).over(blocks), F.lit(False)).alias("_begins_open"))
    begins = durable(begins, "csv-blocks")
    known = composed.join(F.broadcast(begins) if small_enough(begins) else begins, ["source", "_block"])
    before = F.coalesce(F.lag(_open_before(F.col("_turns"), F.col("_settled"), F.col("_begins_open"))).over(block), F.col("_begins_open"))
    first = F.last(F.when(~before, F.col("row")), ignorenulls=True).over(block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = known.select("source", "_block", "row", "value", first.alias("_record"))
    # Lines before the first record of a block belong to the last record of an earlier one.
    last = placed.groupBy("source", "_block").agg(F.max("_record").alias("_last"))
    carried = durable(last.select("source", "_block", F.max("_last").over(
        blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried")), "csv-carried")
    joined = placed.join(F.broadcast(carried) if small_enough(carried) else carried, ["source", "_block"])
    records = joined.groupBy("source", F.coalesce("_record", "_carried").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("row").alias("at"), "value"))).alias("_lines"))
    return plain.unionByName(records.select(F.concat_ws("\n", "_lines.value").alias("value"), "source", "row"))


def numbered_through(rows: DataFrame, spark: SparkSession, path: str, of: Column) -> DataFrame:
    """``rows`` (source, row) of files that are parts of one, in the order of their names: ``row`` counts on from part to part.

    ``of`` tells from ``source`` which file a part belongs to. Totals are one row for each part.
    """
    totals = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("source")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_of").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(totals.withColumn("_of", of).select(
        F.col("source").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "file-starts")
    joined = rows.join(F.broadcast(starts) if small_enough(starts) else starts, F.col("source") == F.col("_part"))
    return joined.withColumn("row", F.col("row") + F.col("_start")).select(*rows.columns)


def read_payment_rows(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Rows of CSV files, each field as text, with ``source`` and ``row``, the number of a row's first line.

    Every file must start with the expected header; quoted fields may hold separators, quotes (doubled) and line breaks.
    """
    lines = numbered_records(spark, path, separator)
    # The first line of a file is the first of the block that starts it; the other blocks are not looked at.
    heads = _physical_lines(spark, path).where(F.col("_block") == 0).groupBy("source").agg(
        F.min_by("value", "_id").alias("_first")).select(
        F.transform(F.split("_first", separator), lambda c: F.trim(c)).alias("names"))
    good = F.slice("names", 1, len(FIELDS)) == F.array(*map(F.lit, FIELDS))
    wrong = heads.where(~good).take(1)
    if wrong:
        check_header(wrong[0]["names"])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])
    row = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"sep": separator, "escape": "\""})
    return (lines.where(F.col("row") > 1)
            .select(row.alias("_row"), "source", "row").select("_row.*", "source", "row"))


def _all_null(fields: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f).isNull() for f in fields))


def keep_complete(rows: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Rows with every field, ``amount`` as double; blank and incomplete rows are left out."""
    return rows.dropna("any", subset=list(fields)).withColumn("amount", F.col("amount").try_cast("double"))


def skipped_rows(rows: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Report of incomplete rows: lineage columns and the ``missing`` fields. Blank rows are not reported."""
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    lineage = [c for c in rows.columns if c not in fields]
    return (rows.where(~_all_null(fields)).select(*lineage, missing.alias("missing"))
            .where(F.size("missing") > 0))
