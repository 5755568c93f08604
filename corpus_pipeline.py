"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``docs``. Stages are
meant to be written and read again in between, as ``run`` does through Parquet in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.llm.common import free_name, read_table
from dayrisk.llm.exact_dedup import drop_exact_duplicates
from dayrisk.llm.near_dedup import drop_near_duplicates
from dayrisk.llm.packing import pack_documents
from dayrisk.llm.quality import QualityModel
from dayrisk.llm.toxicity import ToxicityModel
from dayrisk.session import ensure_checkpoint_dir


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under one half.

    Null and empty texts have no feature and stay; repeated rows and null or tied ids are scored each on their own. An empty table stays empty.
    """
    score = free_name(docs, "_toxicity")
    scored = ToxicityModel.learn(docs, read_table(spark, sf_dir, "labels")).add_scores(docs, score)
    return scored.where(F.col(score) < 0.5).drop(score)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees.

    Null and empty texts have no words and go; repeated rows and null or tied ids are judged each on their own. An empty table stays empty.
    """
    prefix = free_name(docs, "_quality_") + "_"
    judged = QualityModel.learn(docs, read_table(spark, sf_dir, "labels")).add_verdict(docs, prefix=prefix)
    return judged.where(F.col(prefix + "kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id.

    Null counts as an empty text, a null id as the smallest; of rows with one id and text one stays. An empty table stays empty.
    """
    return drop_exact_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest id.

    Texts without words are near only to the same text, null being empty; a null id is the smallest; of rows with one id and text one stays. An
    empty table stays empty.
    """
    return drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 2048 tokens.

    Null and empty texts are one id each; rows with one id are documents of their own. An empty table gives no piece.
    """
    return pack_documents(docs)


STAGES = [
    ("toxicity", not_toxic), ("quality_rules", good_quality), ("exact_dedup", no_exact_copies), ("minhash_near_dedup", no_near_copies), ("best_fit_packing", packed),
]
#: The stages fit models and compare multisets of hashed shingles, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the result of each but the last is written as Parquet and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
