"""The corpus pipeline: five stages over documents, each reading what the last one wrote."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricewave.llm import decontaminate, exact_dedup, pack_dp, quality_fm, simhash_neardup
from pricewave.llm.common import shared_folder
from pricewave.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_fm.keep_good(docs, quality_fm.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays."""
    return simhash_neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 1024 tokens."""
    return pack_dp.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminated), ("packing", packed)]

#: No SQL: training, tokenizing and packing have no SQL form. Held against brute force on small fixtures in tests/llm are exact dedup with
#: repeated and null ids, near dedup (exact Jaccard of all pairs), decontamination (alignment of all pairs) and packing (round trip and the
#: program's optimum); of quality, the margins and the held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each result being written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
