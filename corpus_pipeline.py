"""A training-data pipeline over `documents`, one stage per operator.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is
written to the shared folder and read again as the next stage's `docs`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from zonalake.llm import decontam, mixing, neardup, quality, tokens
from zonalake.llm.files import settled_alone
from zonalake.llm.queries import table, tokenizer_path
from zonalake.session import BATCH_CONF, limit_batches

#: Rows that a Python worker is sent at once. A row is a whole text, so 10,000 of them (Spark's default) take
#: some 40 MB, in the JVM's buffers and in the worker, for each running task.
BATCH_ROWS = 1_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with at most BATCH_ROWS rows a batch, unless the session has fewer. The setting stays, as the
    stage's rows are made after it returns."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted_rows(docs, table(spark, sf_dir, "labels"))


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.first_of_groups(docs)


@in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mix_rows(docs)


@in_small_batches
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as binary shards of token ids; a row per document read back from them."""
    return tokens.token_report(docs, tokenizer_path())


STAGES = [
    ("quality classifier", accepted),
    ("near-duplicate removal", without_near_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("token output", token_output),
]

#: The classifier, the near-duplicate search and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole of `documents`. What a stage wrote for itself goes when its rows are
    written, and its rows go when the next stage's are."""

    def upto(last: int) -> DataFrame:
        name, stage = STAGES[last]

        def rows() -> DataFrame:
            docs = upto(last - 1) if last else table(spark, sf_dir, "documents")
            return stage(spark, docs, sf_dir)

        return settled_alone(spark, "stage-" + name.replace(" ", "-"), rows)

    return upto(len(STAGES) - 1)
