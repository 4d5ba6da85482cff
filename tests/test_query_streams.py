"""Registered streams over tables of several files: micro-batches follow the slices of time, not the files."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from streamscreen.operators import windows
from streamscreen.plans import bindings, job_queries, queries
from streamscreen.sources.catalog import current_table, persist_table
from streamscreen.streaming import jobs
from tests.conftest import rows


def events(spark, tmp_path, n=40, files=4):
    """Events a minute apart, dealt over files that each hold rows of the whole time."""
    made = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 2, "click", 1.0, '{"k": 1}') for i in range(n)]
    for f in range(files):
        spark.createDataFrame(made[f::files], bindings.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def batches(stream, path):
    """Rows of each micro-batch."""
    query = jobs.run_idempotent(stream, f"{path}/cp", f"{path}/rows", trigger=jobs.UNTIL_DRAINED)
    jobs.drain(query)
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_a_micro_batch_for_each_slice(spark, tmp_path):
    sf = events(spark, tmp_path)
    assert sum(batches(bindings.event_stream(spark, sf, parts=2), tmp_path / "a")) == 40
    assert batches(bindings.event_stream(spark, sf, parts=2), tmp_path / "b") == [20, 20]


def test_slices_of_several_files_stay_one_micro_batch(spark, tmp_path):
    slices, folder = bindings.event_parts(spark, events(spark, tmp_path), 2), str(tmp_path / "in")
    slices[1:1] = [slices[0].where("event_id = 3")]
    files = bindings.write_slices(slices, folder, file_rows=8)
    assert files == 3
    assert batches(bindings.read_event_stream(spark, folder, files), tmp_path) == [20, 1, 20]


def test_no_row_of_a_slice_is_late(spark, tmp_path):
    stream = bindings.event_stream(spark, events(spark, tmp_path), parts=2).withWatermark("ts", "1 second")
    counted = windows.tumbling(stream, ["event_type"], "ts", "5 minutes", [F.count(F.lit(1)).alias("n")])
    out = str(tmp_path / "out")
    jobs.drain(persist_table(counted, ["event_type", "window_start"], f"{out}/rows", f"{out}/cp", trigger=jobs.UNTIL_DRAINED))
    assert [r["n"] for r in current_table(spark, f"{out}/rows", ["event_type", "window_start"]).collect()] == [5] * 8


def test_bucket_counts_of_a_stream(spark, tmp_path):
    sf = events(spark, tmp_path)
    for name, made in (("customer", "SELECT 0 AS c_custkey, 0 AS c_nationkey UNION ALL SELECT 1, 0"),
                       ("nation", "SELECT 0 AS n_nationkey, 'N' AS n_name")):
        spark.sql(made).write.parquet(f"{sf}/{name}.parquet")
    day = 1_704_067_200_000
    assert rows(job_queries.streamed_bucket_counts(spark, sf)) == [("C0", day, 20), ("C1", day, 20)]


def test_words_of_a_table_of_several_files(spark, tmp_path):
    docs = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(1, "to be", "en", "s", 5), (2, "or not to be", "en", "s", 12)], docs).repartition(2).write.parquet(
        f"{tmp_path}/documents.parquet")
    assert rows(queries.streamed_word_counts(spark, str(tmp_path))) == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]


def test_customers_are_sent_in_runs(spark, tmp_path):
    spark.sql("SELECT id AS c_custkey, concat('n', id) AS c_name FROM range(1, 6)").write.parquet(f"{tmp_path}/customer.parquet")
    assert rows(job_queries.new_customers_sent(spark, str(tmp_path)), "run", "key") == [
        (1, "1"), (1, "2"), (1, "3"), (2, "4"), (2, "5")]


def test_lines_are_numbered_through_the_files_of_a_language(spark, tmp_path, monkeypatch):
    docs = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    made = [(i, 'a "b"\n\nc' if i % 3 else "d", "en" if i % 4 else None, "s", 1) for i in range(60)]
    spark.createDataFrame(made, docs).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(job_queries, "new_path", lambda _spark, _label: f"{tmp_path}/csv")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = rows(job_queries.quoted_line_breaks(spark, str(tmp_path)), "file", "doc_id", "row")
    finally:
        spark.conf.unset(coalesce)
    assert len(spark.read.text(f"{tmp_path}/csv").inputFiles()) > 2
    expected, lines = [], {}
    for i, text, lang, *_ in made:
        file = lang or "none"
        expected.append((file, i, lines.get(file, 0) + 1))
        lines[file] = lines.get(file, 0) + text.count("\n") + 1
    assert got == sorted(expected, key=repr)


def paired(spark, tmp_path, monkeypatch):
    """Two groups of 20 events at one instant each, a forecast's lead apart; the folder where the queries write is given too."""
    made = [(i, datetime(2024, 1, 1) + timedelta(minutes=17 * (i // 20)), i % 2, "click", 1.0, '{"k": 1}') for i in range(40)]
    spark.createDataFrame(made, bindings.EVENTS_SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT id AS c_custkey, id * 0 AS c_nationkey, concat('n', id) AS c_name, 1.0D AS c_acctbal FROM range(2)").write.parquet(
        f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 0L AS n_nationkey, 'N' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    monkeypatch.setattr(queries, "new_path", lambda _spark, label: f"{tmp_path}/{label}")
    return str(tmp_path), f"{tmp_path}/streamed/rows"


def test_streamed_dashboard_writes_blocks_not_pairs(spark, tmp_path, monkeypatch):
    sf, out = paired(spark, tmp_path, monkeypatch)
    assert queries.streamed_dashboard(spark, sf).count() == 1600
    assert spark.read.parquet(out).count() <= 16


def test_streamed_comparison_writes_blocks_not_pairs(spark, tmp_path, monkeypatch):
    sf, out = paired(spark, tmp_path, monkeypatch)
    assert queries.streamed_sensor_against_forecast(spark, sf).count() == 400
    assert spark.read.parquet(out).count() <= 16
