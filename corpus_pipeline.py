"""A corpus pipeline: toxic documents and copies go, sources are mixed to weights, texts become ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkweave.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from linkweave.sources.storage import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay; the model is learned from the labelled documents of this
    stage's own input. Null and empty texts are scored like texts without any toxic word, repeated rows alike."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z the largest id stays, with every row that has it; null
    texts count as empty."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Links at a similarity of 0.8 or more on shingles of five words; the smallest id of a group stays.
    Null and empty texts are linked with nothing and stay; so do rows without an id."""
    return near_dedup.drop_near(docs, least=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, by shard and in its order; repeated rows each count, a null source is
    a source, and rows without words are taken as often as their block is."""
    return mixing.shuffled(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of every row, repeated ones too; a null text has no ids."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Toxicity and near dedup are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
