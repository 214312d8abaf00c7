"""The corpus pipeline: documents to a mix, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its Parquet is the next one's ``docs``.
All but the last return the columns of ``documents``. Missing values, repeated rows and empty tables are
treated as the operators say.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import decontaminate, lang_id, mixture, simhash, suffix_dedup
from formline.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Whole documents pass through Python here, so Arrow batches stay small however long the texts are.
BATCHES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"


def bounded(stage: Stage) -> Stage:
    """``stage`` in a session with small Arrow batches, which stay set, since its result is computed later."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCHES, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those that are undetermined or hardly like any language go."""
    return lang_id.keep_identified(docs)


@bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: four-word shingles, at most four differing bits."""
    return simhash.without_near_duplicates(docs, shingle=4, max_distance=4)


@bounded
def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 200-byte strings that occur more than once; ``n_chars`` follows the text."""
    return suffix_dedup.without_repeats(docs, length=200).withColumn("n_chars", F.length("text").cast("bigint"))


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@bounded
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes of it."""
    return mixture.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]

#: No stage but the counting in the last can be said in SQL; the tests check each by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = spark.conf.get(BATCHES)
    try:
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # written as well, so that nothing runs later under the settings of the stages
        return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline-mix")
    finally:
        spark.conf.set(BATCHES, held)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
