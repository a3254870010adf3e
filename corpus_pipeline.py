"""A corpus made ready for training, in five stages; each takes and returns documents, the last returns packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthline.llm import jaccard_join, mixing, packing, pii, toxicity
from hearthline.llm.common import small_batches
from hearthline.session import written

TOXIC = 0.7
TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None  # learned scores and a tokenizer are not for SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7, learned from the labels that are not held out."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"NOT {toxicity.HELD_OUT}")
    return toxicity.below(docs, toxicity.fit(docs, labels), TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles, similarity 0.8, the one of smallest id."""
    return jaccard_join.first_of_each(docs, n=5, percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix of the sources with weights 1, 2, 3 by name uses them."""
    return mixing.mixed_documents(docs, sources="source")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), length=2048, end=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written to the shared folder and read again."""
    docs = small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
