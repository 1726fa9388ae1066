"""From raw documents to token shards: every stage reads what the one before it kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, with the columns of ``documents`` for all stages but the last. ``run`` writes each result
as Parquet into the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listlake.llm import decontam, mixing, near_dup, quality, token_store
from listlake.llm.common import saved, table
from listlake.llm.queries import END_ID, tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, fitted on ``labels``, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at 80 % Jaccard or more over five-word shingles: the smallest key."""
    return near_dup.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of ``benchmark``."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of sources takes it, none to three times."""
    return mixing.mix_rows(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of all rows, as read back from its files."""
    return token_store.token_output(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_shards),
]

#: A fitted classifier, alignments, sampling and a tokenizer are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("/", ""))
    return STAGES[-1][1](spark, docs, sf_dir)
