"""Lines that many documents share: levelled sorted runs of line hashes, and texts without those lines.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; it is known by two 64-bit hashes
(of different seeds). ``LineRuns`` keeps, for each key, in how many documents it was found:

- A run is a partition (h1, h2, n) of one table, with one row per key, bucketed by the hashes and sorted within buckets, so runs
  meet bucket by bucket and are never shuffled again.
- A new batch of documents is counted, partly before its one shuffle, and merge-anti-joined with the runs: keys that one run
  alone shows in ``min_docs`` documents are settled and need no further counting. What is left becomes a run of level 0.
- ``fan`` runs of a level are merged into one of the next level, so a key is rewritten once per level: log(batches) times.
- A manifest names the current runs. It is replaced after a run is complete, so a job that died leaves at most a run that
  nobody names, and a store can be opened again by another session.

``drop_lines`` removes the lines of the found keys. Which lines go is worked out on hashes alone; texts are shuffled once, to meet
the positions of their lines. Everything is an expression or a join; the keys found are broadcast only if counted and few.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` are never dropped; a text whose lines all go is
''; a document is a row, so repeated rows (also of one doc_id) count each; rows with a null doc_id are treated like others; an empty
table gives no rows; other columns are kept, and columns named ``text``, ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamscreen.llm.common import join_counted
from streamscreen.session import discard, durable, new_path
from streamscreen.sources.manifest import Manifest, delete

MIN_DOCS, MIN_CHARS = 10, 1
#: Batches of one pass over a table; runs of a level that are merged.
BATCHES, FAN = 8, 3
_SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["h1", "h2"]


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """For each line of the text its key as (h1, h2), null where the key is shorter than ``min_chars``."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    keys = F.transform(F.split(lower, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)))
    return F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, F.struct(
        F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(2), k).alias("h2"))))


class LineRuns:
    """Document counts of line keys, in levels of sorted runs below ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 fan: int = FAN, buckets: int | None = None):
        """Open the store, or begin one. The settings of a store are those it was begun with."""
        self._spark, self._path, self._manifest = spark, path, Manifest(spark, path)
        self._version, state = self._manifest.read()
        self._state = state or {"min_docs": min_docs, "min_chars": min_chars, "fan": fan, "levels": [],
                                "table": f"line_runs_{uuid.uuid4().hex}",
                                "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))}

    @property
    def levels(self) -> list[list[str]]:
        """Names of the runs, level by level."""
        return [list(level) for level in self._state["levels"]]

    def _runs(self, names: list[str]) -> DataFrame:
        """The rows of some runs. Files of a bucket, whatever their run, are read by one task."""
        table = self._state["table"]
        if not self._spark.catalog.tableExists(table):
            self._spark.sql(
                f"CREATE TABLE {table} (h1 BIGINT, h2 BIGINT, n BIGINT, run STRING) USING parquet PARTITIONED BY (run) "
                f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self._state['buckets']} BUCKETS LOCATION '{self._path}/runs'")
            self._spark.catalog.recoverPartitions(table)
        return self._spark.table(table).where(F.col("run").isin(names))

    def _write(self, counts: DataFrame) -> str:
        name = uuid.uuid4().hex
        (counts.select(*_KEY, "n", F.lit(name).alias("run")).write.mode("append").partitionBy("run")
         .bucketBy(self._state["buckets"], *_KEY).sortBy(*_KEY).option("path", f"{self._path}/runs")
         .saveAsTable(self._state["table"]))
        return name

    def _merge(self, names: list[str]) -> DataFrame:
        # Buckets meet where they lie: no shuffle.
        return self._runs(names).groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def add(self, docs: DataFrame) -> None:
        """Count the lines of further documents (text)."""
        self.add_keys(docs.select(F.explode(F.array_distinct(F.array_compact(
            line_keys(F.col("text"), self._state["min_chars"])))).alias("k")).select("k.h1", "k.h2"))

    def add_keys(self, keys: DataFrame) -> None:
        """Count further keys (h1, h2), one row for each document and key."""
        counts = keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).repartition(self._state["buckets"], *_KEY)
        levels = self.levels or [[]]
        known = [name for level in levels for name in level]
        if known:
            settled = self._runs(known).where(F.col("n") >= self._state["min_docs"]).select(*_KEY)
            counts = counts.join(settled.hint("merge"), _KEY, "left_anti")
        levels[0].append(self._write(counts))
        old: list[str] = []
        for number, level in enumerate(levels):
            if len(level) < self._state["fan"]:
                break
            merged = self._write(self._merge(level))
            old += level
            level.clear()
            if number + 1 == len(levels):
                levels.append([])
            levels[number + 1].append(merged)
        state = {**self._state, "levels": levels}
        self._manifest.replace(self._version, state)
        self._version, self._state = self._version + 1, state
        self._forget(old)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents."""
        known = [name for level in self.levels for name in level]
        if not known:
            return self._spark.createDataFrame([], "h1 bigint, h2 bigint")
        return self._merge(known).where(F.col("n") >= self._state["min_docs"]).select(*_KEY)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self._spark.sql(f"ALTER TABLE {self._state['table']} DROP IF EXISTS PARTITION (run = '{name}')")
            delete(self._spark, f"{self._path}/runs/run={name}")

    def close(self) -> None:
        """Delete the store."""
        self._spark.sql(f"DROP TABLE IF EXISTS {self._state['table']}")
        delete(self._spark, self._path)


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the sorted positions ``dropped``: the slices between them, each copied once."""
    ends = F.concat(dropped, F.array(F.size(lines)))

    def gap(end: Column, at: Column) -> Column:
        start = F.when(at == 0, 0).otherwise(F.get(dropped, at - 1) + 1)
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(ends, gap))


def drop_lines(docs: DataFrame, hashed: DataFrame, frequent: DataFrame) -> DataFrame:
    """``docs`` with ``text`` freed of the lines whose keys are in ``frequent``, n_lines (before) and n_dropped.

    ``hashed`` holds (t1, t2, keys) of every text, as ``hash_lines`` writes it.
    """
    places = hashed.select("t1", "t2", F.posexplode("keys").alias("at", "k")).select(
        "t1", "t2", "at", "k.h1", "k.h2").where(F.col("h1").isNotNull())
    found = frequent.select(F.col("h1").alias("_f1"), F.col("h2").alias("_f2"))
    hits = join_counted(places, found, (F.col("h1") == F.col("_f1")) & (F.col("h2") == F.col("_f2")), "inner")
    # Copies of a text share its positions; the set is as long as one text at most.
    marks = hits.groupBy(F.col("t1").alias("_t1"), F.col("t2").alias("_t2")).agg(
        F.array_sort(F.collect_set("at")).alias("_dropped"))
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce("text", F.lit("")).alias("text"))
    joined = keyed.join(marks.hint("shuffle_hash"), (_text_key(F.col("text"))[0] == F.col("_t1"))
                        & (_text_key(F.col("text"))[1] == F.col("_t2")), "left")
    lines, dropped = F.split("text", "\n"), F.coalesce("_dropped", F.array().cast("array<int>"))
    kept = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(_without(lines, dropped), "\n"))
    return joined.select(*[F.col(f"`{c}`") for c in own], kept.alias("text"), F.size(lines).cast("long").alias("n_lines"),
                         F.size(dropped).cast("long").alias("n_dropped"))


def _text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(2), text)


def hash_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(t1, t2, keys) of every text and the batch it is dealt to, written; a batch is a partition of its own."""
    t1, t2 = _text_key(F.coalesce("text", F.lit("")))
    made = docs.select(t1.alias("t1"), t2.alias("t2"), line_keys(F.col("text"), min_chars).alias("keys"),
                       F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(batches)).alias("batch"))
    path = new_path(docs.sparkSession, "line-hashes")
    made.write.partitionBy("batch").parquet(path)
    kept = docs.sparkSession.read.schema(made.schema).parquet(path)
    kept.durable_path = path
    return kept


def deduplicate_lines(docs: DataFrame, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                      fan: int = FAN) -> DataFrame:
    """``docs`` (doc_id, text and others) without the lines whose keys stand in ``min_docs`` documents or more.

    The table is read twice: once for the hashes, which ``batches`` batches bring to the runs one after the other, and once for the texts.
    """
    spark = docs.sparkSession
    hashed = hash_lines(docs, batches, min_chars)
    runs = LineRuns(spark, new_path(spark, "line-runs"), min_docs=min_docs, min_chars=min_chars, fan=fan)
    for number in range(batches):
        own = hashed.where(F.col("batch") == number)
        runs.add_keys(own.select(F.explode(F.array_distinct(F.array_compact("keys"))).alias("k")).select("k.h1", "k.h2"))
    frequent = durable(runs.frequent(), "frequent-lines")
    runs.close()
    return drop_lines(docs, hashed, frequent)
