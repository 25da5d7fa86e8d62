"""Training-data pipeline over ``documents``: each stage is one operator of ``tillroll.llm``.

Every stage works on all rows that the stage before kept, and its decisions take
effect. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll import session
from tillroll.llm import bpe, mixing, quality, simhash, toxicity
from tillroll.llm.common import scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the texts of the others go on without the
    lines that are common in their host."""
    return quality.keep_good(docs)


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is trained on the stage's own input."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes the sources to their target weights."""
    return mixing.mixture(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, and each document's place in the
    mixture."""
    return bpe.digests(bpe.encode(mixing.written_places(docs), keep=("mix_file", "mix_row")))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", clean_of_toxicity),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources", mixing_sources),
    ("BPE encoding and decoding", bpe_encoding),
]

#: The toxicity stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read again. What a stage
    stored on its way goes when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            docs = session.stored(result, name.replace(" ", "-"))
    return docs
