"""The corpus pipeline: documents to packed training sequences.

Toxic documents go, repeated lines go (short ones too), one document of each group of near
copies stays, sources are mixed to target weights in training order, and the
mix is packed into sequences that follow that order. Every stage is written as Parquet in the shared
folder and read again by the next, so a lost executor costs at most a stage's
tasks.

Defined results: each stage's own (see its module); documents without words
pass the filters; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import jaccard, line_dedup, mixing, packing, toxicity
from statflow.llm.store import release
from statflow.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: Models, sketches and packing are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs, labels).filter("NOT toxic").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)  # what the stage before has shuffled
    return line_dedup.deduped_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)  # what the stage before has shuffled
    return jaccard.distinct_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)  # what the stage before has shuffled
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix stands in training order in its files: the order of a row is its
    file's number and its place there."""
    release(spark)
    part = F.regexp_extract("_metadata.file_name", r"part-([0-9]+)", 1).cast("long")
    placed = docs.select("*", part.alias("_part"), F.col("_metadata.file_name").alias("_file"),
                         F.col("_metadata.row_index").alias("_row"))
    return packing.pack_in_order(placed, TOKENIZER, ["_part", "_file", "_row"])


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: one per piece of a document of the mix."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
