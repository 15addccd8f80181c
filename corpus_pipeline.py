"""A training-data pipeline over documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the docs of the next one. All but the last return
the columns of documents. Null and empty texts go with the language stage; a
stage that gets an empty table returns an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm import op1_language, op2_decontaminate, op5_secrets, op7_pack, op9_simhash
from cellscore.plans.lineage import checkpoint_folder

#: Share of a text's n-grams that its language's filter must hold.
LEAST_COVERAGE = 0.1
#: Parts that a worker's encoder keeps, and bytes of text that it takes at once: workers go on from stage to stage, so that little memory is better than speed.
MOST_PARTS, ENCODED_BYTES = 100_000, 1 << 19


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters, learnt from the labelled rows of docs, know."""
    found = op1_language.identify(docs, op1_language.fit(docs))
    return found.where((F.col("lang_pred") != op1_language.UND) & (F.col("coverage") >= LEAST_COVERAGE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of similar texts (five-word shingles, 0.8)."""
    return op9_simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return op2_decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets, encoded ones included, blacked out."""
    found = op5_secrets.scan(docs, redacted=True)
    hit = F.size("secrets") > 0
    return found.withColumn("n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 ids, with the ids and their checksum."""
    pieces = op7_pack.pack(docs, most_parts=MOST_PARTS, step_bytes=ENCODED_BYTES)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: The n-gram filters, the decoding of layers and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between two is written to the shared checkpoint folder."""
    checkpoint_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
