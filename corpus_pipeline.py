"""Corpus pipeline: documents to training shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what its stage keeps, with the columns of ``documents`` (the last
one returns the index of the token sequences it has written).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm.decontaminate import clean
from matchlake.llm.jaccard_join import one_per_class
from matchlake.llm.mixing import mixed_rows
from matchlake.llm.store import documents, stored
from matchlake.llm.token_output import write_tokens
from matchlake.llm.toxicity import fit, reject_toxic


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores as toxic go."""
    return reject_toxic(docs, fit(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: word 5-grams, Jaccard 0.8."""
    return one_per_class(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document may stand several times."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; returns their index."""
    return write_tokens(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", tokens),
]

#: No stage but the mixing can be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
