import json

import pytest
from pyspark.sql import functions as F

from streamscreen import schemas
from streamscreen.operators import words
from streamscreen.plans import people
from streamscreen.sources import catalog, forecasts, jsonlines, relational, topics
from streamscreen.sources.topics import Topic
from tests.conftest import rows

PEOPLE = [("u1", "Alice", 16), ("u2", "Ben", 17), ("u3", "Chen", 16), ("u4", "Dina", 18), ("u5", "Evan", 17)]


def users_records(spark, keyed):
    df = spark.createDataFrame(PEOPLE, schemas.APP_USER)
    made = topics.record(df, key=F.col("user_id") if keyed else None,
                         value=F.struct("name", "age") if keyed else F.struct("user_id", "name", "age"),
                         topic="users")
    offset = F.get_json_object(F.col("value").cast("string"), "$.age")
    return topics.numbered(made, 3, offset, F.timestamp_millis(F.lit(0)))


@pytest.mark.parametrize("keyed", [True, False])
def test_users_of_age(spark, tmp_path, keyed):
    topic = Topic("users", folder=str(tmp_path))
    topics.write_batch(users_records(spark, keyed), topic)
    view = catalog.declare(spark, "users_stream", catalog.Stream(topic, schemas.APP_USER, "user_id"), streaming=False)
    assert view.columns == ["user_id", "name", "age", "record_timestamp"]
    assert rows(people.users_of_age(spark.table("users_stream"))) == [
        ("u2", "Ben", 17), ("u4", "Dina", 18), ("u5", "Evan", 17)]
    assert topics.peek(spark, topic, 2).count() == 2
    assert rows(topics.offsets_by_partition(topics.read_batch(spark, topic)).agg(F.sum("records"))) == [(5,)]


def test_derived_stream_restarts_without_duplicates(spark, tmp_path):
    topic = Topic("users", folder=str(tmp_path / "topics"))
    topics.write_batch(users_records(spark, True), topic)
    stream = catalog.Stream(topic, schemas.APP_USER, "user_id")

    def run():
        df = people.users_of_age(catalog.declare(spark, "s", stream))
        catalog.persist_stream(df, str(tmp_path / "out"), str(tmp_path / "cp"), partitions=1,
                               trigger={"availableNow": True}).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    assert run().count() == 3
    assert run().count() == 3
    topics.write_batch(users_records(spark, True), topic)
    assert run().count() == 6


def test_routed_stream_writes_topic_folders(spark, tmp_path):
    topic = Topic("in", folder=str(tmp_path))
    topics.write_batch(users_records(spark, True).withColumn("topic", F.lit("in")), topic)
    out = topics.read_stream(spark, topic, max_per_batch=1).withColumn(
        "topic", F.when(F.col("offset") >= 17, "old").otherwise("young"))
    query = topics.write_stream(out, str(tmp_path / "cp"), folder=str(tmp_path / "out"),
                                trigger={"availableNow": True})
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).groupBy("topic").count()) == [("old", 3), ("young", 2)]
    report = topics.progress_report(query)
    assert report.columns == ["source", "start_offset", "end_offset", "rows"] and report.count() == 1


def test_folder_topics_have_no_latest(spark, tmp_path):
    with pytest.raises(ValueError):
        topics.read_stream(spark, Topic("x", folder=str(tmp_path)), starting="latest")


def test_kafka_options():
    topic = Topic("t", servers="h:1", options={"failOnDataLoss": "false"})
    assert topics.kafka_options(topic, "latest", 10) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
        "includeHeaders": "true", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10"}


def test_tolerant_decode_and_lag(spark):
    df = spark.createDataFrame([(b"k", b"a\xff", "t", 0, 4, None, 0, None), (None, None, "t", 0, 9, None, 0, None)],
                               schemas.TOPIC_RECORD)
    got = topics.decode(df).orderBy("offset").collect()
    assert got[0]["value"].startswith("a") and got[1]["key"] is None and got[1]["value"] is None
    done = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, next_offset long")
    assert rows(topics.lag_behind(df, done)) == [("t", 0, 9, 7, 3)]


def test_partitioning(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    parted = topics.by_key(df, 4, "k").withColumn("p", F.spark_partition_id())
    assert parted.groupBy("k").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0
    assert topics.single_partition(df).rdd.getNumPartitions() == 1


def test_word_counts(spark, tmp_path):
    (tmp_path / "w.txt").write_text("hello\nworld\n\nhello\nspark\n spark\nspark\n")
    lines = jsonlines.read_lines(spark, str(tmp_path)).withColumnRenamed("value", "word")
    assert rows(words.count_words(lines)) == [("hello", 2), ("spark", 3), ("world", 1)]
    df = spark.createDataFrame([("to be  or not",), ("to be",), ("",)], "value string")
    assert rows(words.count_words_in_lines(df)) == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]


def test_json_lines_stream_append(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"user_id":"u1","age":3}\n\n  {"user_id":"u2"}  \n')
    df = jsonlines.read_json_lines(spark, str(source), schemas.APP_USER, streaming=True, files_per_batch=1)
    jsonlines.append_json_lines(df, str(tmp_path / "out"), str(tmp_path / "cp"),
                                trigger={"availableNow": True}).awaitTermination()
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(map(json.loads, lines), key=str) == [
        {"user_id": "u1", "name": None, "age": 3}, {"user_id": "u2", "name": None, "age": None}]


def test_forecast_documents(spark):
    docs = [("A", '{"properties":{"periods":[{"name":"Tonight","temperature":50,"temperatureUnit":"F","windSpeed":"5 mph",'
                  '"windDirection":"N","shortForecast":"Clear","detailedForecast":"d","isDaytime":false,"icon":"i"},{"name":"x"}]}}'),
            ("B", '{"properties":{"periods":[{}]}}'), ("C", '{"properties":{"periods":[]}}'), ("D", "{}"), ("E", "bad{")]
    got = forecasts.flatten_forecasts(spark.createDataFrame(docs, "city string, body string"), "body", F.lit("t"))
    assert rows(got) == [
        ("A", "t", 50, 10.0, "F", "5 mph", "N", "Clear", "d", False, "Tonight", "i"),
        ("B", "t", 0, -17.78, "F", "N/A", "N/A", "N/A", "", True, "Current", "")]


def test_database_reads():
    db = relational.Database("jdbc:x", {"user": "u"}, fetch_size=5)
    assert relational.read_options(db, "users") == {"url": "jdbc:x", "dbtable": "users", "fetchsize": "5", "user": "u"}
    parted = relational.read_options(db, "users", partition_column="user_id", bounds=(1, 100), partitions=4)
    assert parted["partitionColumn"] == "user_id" and parted["numPartitions"] == "4"
    with pytest.raises(ValueError):
        relational.read_options(db, "users", partition_column="user_id")


def test_incremental_rows_and_table_records(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "user_id int, name string")
    assert rows(relational.above(df, "user_id", 2)) == [(3, "c")]
    assert relational.above(df, "user_id", None).count() == 3
    assert relational.high_water_mark(df, "user_id") == 3
    got = relational.as_records(df, "users").first()
    assert got["topic"] == "postgres-users" and json.loads(bytes(got["value"])) == {"user_id": 1, "name": "a"}
