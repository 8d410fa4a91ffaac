"""From raw documents to token ids: toxicity, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet to the shared
folder and read again as the next one's docs. All but the last return the columns of documents.
A lost executor costs its tasks, a lost driver the stage that ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm import decontaminate, mix, neardup, tokens, toxicity
from feedlake.llm.common import stored, table
from feedlake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the severity that is rejected; the model is fitted on the labels."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles overlap by 80 % or more, over links."""
    return neardup.deduplicated(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: each document as often as the mix takes it."""
    return mix.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids in range-coded files, and what reading them back gives for each document."""
    path = scratch_path(spark, "pipeline-ids")
    tokens.write_ids(docs, path, tokens.default_tokenizer())
    return tokens.read_summary(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The toxicity model is trained and the mix draws at random: SQL can't express them. The tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
