"""The corpus pipeline: quality, near-duplicates, repeated passages, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps of ``docs`` in the columns of ``documents`` (the last
one returns packed pieces). ``run`` applies them one after another, writing
each result as Parquet under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import packing, quality, simhash_dedup, suffix_dedup
from patronage.llm.common import checkpointed, prepare, remove_path, scratch_path, table

#: A repeated passage of this many bytes is cut: what 50 words have at least.
PASSAGE_BYTES = 200


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to ``labels``, doesn't reject."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash_dedup.keep_one(docs, words=3, max_bits=3)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that also stand anywhere else."""
    return suffix_dedup.remove(docs, PASSAGE_BYTES, chars_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left in sequences of 1024 tokens; one row per piece."""
    return packing.digest(packing.pack(docs, capacity=1024, end_id=0))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack),
]

#: Classifier fitting, fingerprint components and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of what the stages keep of ``documents``."""
    prepare(spark)
    docs, paths = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        paths.append(path)
    out = checkpointed(docs)
    for path in paths:
        remove_path(spark, path)
    return out
