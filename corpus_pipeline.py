"""A training-corpus pipeline over ``documents``: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turbilux.llm import exact_dedup, length_buckets, order_minhash, phrase_index, toxic_segments
from turbilux.llm.shipping import ship_package
from turbilux.llm.storage import staged

# probability of the toxic label from which a document is rejected: the operator's own decision
REJECT_FROM = toxic_segments.THRESHOLD


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected as toxic; labels of doc_ids whose crc32 mod 4 is 2 stay unseen."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    marks = labels.where("crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id", F.col("toxic").alias("label"))
    model = toxic_segments.fit(docs, marks)
    return toxic_segments.drop_toxic(docs, model, REJECT_FROM)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest doc_id of each group of equal texts."""
    ship_package(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate class."""
    ship_package(spark)
    return order_minhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    ship_package(spark)
    return phrase_index.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents, in tokens, with their buckets, batches and slots."""
    import public_tokenizers

    ship_package(spark)
    return length_buckets.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]

# the learnt and iterative stages cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
