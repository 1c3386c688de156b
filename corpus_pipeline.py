"""Training-corpus pipeline: five stages over ``documents``.

Each stage works on all rows its predecessor kept and is written as Parquet
before the next one reads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from propspark.llm import bagminhash, bpe, exact_sort, spaced_seeds, toxicity
from propspark.llm.tables import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_sort.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the row with the least doc_id stays."""
    return bagminhash.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return spaced_seeds.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token identifiers of the remaining documents, and the texts decoded
    from them."""
    return bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id", "lang", "source"],
                            outputs=("n_tokens", "ids", "decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: The first stage scores texts with a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``, each written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
