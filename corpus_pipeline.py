"""From documents to token ids, in stages that each read what the one before wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Rules,
n-gram sets, windows and identifiers are those of the stage's own input, all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamscreen.llm import decontaminate, near_duplicates, pieces, pii, quality_rules
from streamscreen.llm.common import table
from streamscreen.llm.queries import may_learn
from streamscreen.session import arrow_rows, discard, durable, temporary_tables


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from the labelled ones, does not reject."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, may_learn(spark, sf_dir, "quality")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the pieces of each text."""
    made = pieces.encode(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", "n_pieces", "ids", "restored")
    with arrow_rows(spark):
        return durable(made, "pipeline-pieces")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("SentencePiece encoding", encode),
]

#: SQL can express neither the trained classifier nor the piece search; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage written; what only a stage or the one after it needed is deleted."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        with temporary_tables(spark):
            made = durable(stage(spark, docs, sf_dir), f"pipeline-{number}", outlives=True)
        discard(docs)
        docs = made
    return docs
