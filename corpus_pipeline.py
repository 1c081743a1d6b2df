"""A corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; ``run`` writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import decontaminate, langid, minhash, mixing, pii
from bazaar.llm.shared import id_remainder, materialise, read_table, set_aside
from bazaar.session import configure

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: a text whose best language has a posterior below this is rejected
MIN_LANGUAGE_SCORE = 0.5


def stage(fn):
    """Columns beside those of documents are out of the stage's way and come back as they were, whatever their names."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe, restore = set_aside(docs, COLUMNS)
        return restore(fn(spark, safe, sf_dir))
    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language, labelled with it; undetermined ones go."""
    trees = langid.train(docs.where((id_remainder(5) != 0) & F.col("lang").isNotNull()))
    found = langid.identify(docs, trees).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return minhash.drop_near_duplicates(docs)


@stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced in the text, and n_chars to match."""
    out = pii.pseudonymise(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, numbered in copy_no (a column of that name that was there before stays instead)."""
    return mixing.emit_copies(mixing.mix_sources(docs), docs.columns)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages), ("pseudonyms", pseudonyms), ("mixture", mixture)]

#: trained models, MinHash and Feistel rounds have no SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = materialise(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
