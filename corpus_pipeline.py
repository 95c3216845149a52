"""The training-corpus pipeline: each stage reads all documents that the one before kept.

Toxic documents go, one document of each group of near copies stays,
contaminated documents go, personal data is masked, and the remaining texts are
encoded as SentencePiece ids.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import decontaminate, jaccard_join, pii_bootstrap, sentencepiece_viterbi, toxicity
from staylens.llm.queries import table
from staylens.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.clean(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_bootstrap.clean(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode(docs, keep=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("SentencePiece", encode),
]

#: The stages have no SQL form.  Tests compare near copies, contaminated documents, personal data and ids with
#: brute-force versions; toxicity is judged by held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
