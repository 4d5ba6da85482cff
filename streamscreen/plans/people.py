"""User and person events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamscreen.schemas import PERSON_RULES
from streamscreen.sources.topics import record
from streamscreen.sources.validate import check_records, check_rows, rejected, valid_events


def users_of_age(users: DataFrame, least: int = 17) -> DataFrame:
    return users.where(F.col("age") >= least).select("user_id", "name", "age")


def publish_people(people: DataFrame, topic: str = "demo") -> tuple[DataFrame, DataFrame]:
    """Records of valid person events, keyed by name, and the rejected rows."""
    checked = check_rows(people, PERSON_RULES)
    good = valid_events(checked)
    return (record(good, key=F.col("name"), value=F.struct(*good.columns), topic=topic),
            rejected(checked))


def read_people(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events with their record position, and the rejected records."""
    checked = check_records(records, PERSON_RULES)
    good = checked.where(F.col("error").isNull()).select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), "event.*")
    return good, rejected(checked)
