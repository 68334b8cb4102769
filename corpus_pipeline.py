"""The corpus pipeline: documents to a deduplicated, decontaminated, mixed and tokenized training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a stage's rows are written and read again before the
next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontaminate, mixing, quality, queries, simhash, sst
from framelake.llm.common import dropped, scratch, scratch_dir, table, tidy


@tidy
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to which the classifier, learned outside the held-out third, gives a probability of 0.5 or more.

    A null or empty text gets the score of no tokens; repeated rows are scored alike. Labels are read by id.
    """
    scored = quality.with_score(docs, queries.quality_model(spark, docs, sf_dir), out="__score")
    return scored.where("__score >= 0.5").drop("__score")


@tidy
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose five-word shingles are alike to 0.8 or more, the one with the least id.

    Texts without words, null ones too, are one group; rows with a null id stay only where no other does.
    """
    return simhash.one_of_each(docs)


@tidy
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; a null or empty text has none, and stays."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents as often, and as much of them, as the mix takes.

    Null ids stay null, a null source is a source of its own, and texts without words are no part of a mix.
    """
    return mixing.mixed_documents(docs)


@tidy
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back: a row a document, in ascending order of id, null first. The shards stay."""
    path = f"{scratch_dir(spark)}/token-shards-{uuid.uuid4().hex}"
    sst.write_shards(docs, path, queries.tokenizer_path())
    return sst.digests(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [("quality", good_quality), ("near-duplicates", one_of_each), ("decontamination", uncontaminated), ("mixing", mixed), ("tokens", tokens)]

#: Fitted models, XXH64 and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with scratch(spark):  # what a stage kept on the side goes once its rows are written
            step(spark, docs, sf_dir).write.parquet(path)
        dropped(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
