"""Tables kept by streams: one row per key, written as changes and folded while they are read.

Every micro-batch puts down its changed rows as a run of its own. Runs grow like the digits of a counter: whenever the run before
is no more than ``RATIO`` times as large as the one after it, both are folded into one that holds the newest row of each key. A table of n rows is
thus read from about log(n) runs however many batches wrote it, and a row is rewritten about log(n) times.

The manifest names the current runs. A run is complete before it is named, readers see one version as a whole, and runs that are no longer
named stay for a while for readers that began earlier. A batch that is written again replaces what it had written: only runs of earlier
batches, which the stream has committed, are folded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamscreen.sources.manifest import Manifest, delete

RATIO = 2
BATCH = "batch"


class KeptTable:
    """The newest row of each key, kept below ``path`` by one writer."""

    #: Versions for which a run that is no longer named stays in place.
    GRACE = 3

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self._spark, self._path, self._keys = spark, path.rstrip("/"), list(keys)
        self._manifest = Manifest(spark, self._path)

    def runs(self) -> list[dict]:
        """The current runs, oldest first: folder, first and last batch, rows."""
        return self._manifest.read()[1].get("runs", [])

    def _rows(self, runs: Sequence[dict], schema: T.StructType) -> DataFrame:
        return self._spark.read.schema(schema).parquet(*[f"{self._path}/{r['folder']}" for r in runs])

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in self._keys]
        newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in values]), BATCH).alias("_row")
        return rows.groupBy(*self._keys).agg(newest).select(*self._keys, "_row.*").select(*rows.columns)

    def _put(self, rows: DataFrame, first: int, last: int) -> dict:
        folder = f"run-{last:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self._path}/{folder}")
        count = self._spark.read.schema(rows.schema).parquet(f"{self._path}/{folder}").count()
        return {"folder": folder, "first": first, "last": last, "rows": count}

    def write(self, changed: DataFrame, batch: int) -> None:
        """Put down the changed rows of a batch, which has at most one row per key; written again, they replace the earlier ones."""
        version, state = self._manifest.read()
        runs = state.get("runs", [])
        if any(r["last"] > batch or r["first"] < batch == r["last"] for r in runs):
            raise ValueError(f"batch {batch} is folded already: a later one was written after it")
        gone = [r for r in runs if r["last"] == batch]
        runs = [r for r in runs if r["last"] != batch]
        marked = changed.select(*[c for c in changed.columns if c != BATCH], F.lit(batch).cast("bigint").alias(BATCH))
        while len(runs) > 1 and runs[-2]["rows"] <= RATIO * runs[-1]["rows"]:
            pair, runs = runs[-2:], runs[:-2]
            runs.append(self._put(self._newest(self._rows(pair, marked.schema)), pair[0]["first"], pair[1]["last"]))
            gone += pair
        runs.append(self._put(marked, batch, batch))
        retired = state.get("retired", []) + [[version + 1, r["folder"]] for r in gone]
        over = [folder for number, folder in retired if number <= version - self.GRACE]
        self._manifest.replace(version, {
            "runs": runs, "schema": marked.schema.json(), "retired": [r for r in retired if r[0] > version - self.GRACE]})
        for folder in over:
            delete(self._spark, f"{self._path}/{folder}")

    def read(self, upto: int | None = None) -> DataFrame | None:
        """The newest row of each key, without the batch numbers; None before the first batch.

        ``upto`` leaves out later batches, so that a batch that is repeated finds what it found before.
        """
        _, state = self._manifest.read()
        runs = [r for r in state.get("runs", []) if upto is None or r["last"] <= upto]
        if not state:
            return None
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if not runs:
            return self._spark.createDataFrame([], schema).drop(BATCH)
        rows = self._rows(runs, schema)
        return (rows if len(runs) == 1 else self._newest(rows)).drop(BATCH)


def keep(df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, *, mode: str = "update",
         trigger: Mapping[str, object]) -> StreamingQuery:
    """Keep the rows of a stream as a table; each micro-batch has one row per key at most."""
    table = KeptTable(df.sparkSession, path, keys)
    return (df.writeStream.foreachBatch(lambda batch, number: table.write(batch, number))
            .option("checkpointLocation", checkpoint).outputMode(mode).trigger(**trigger).start())
