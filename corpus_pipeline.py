"""A training-data pipeline of five of the operators over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared folder and
read again as the next stage's docs. All stages but the last return the columns of ``documents``.

Where a document's id is null it is kept by the filtering stages and forms a group of its own in deduplication. An empty
table gives an empty one at every stage. Columns may have any names: a stage's own are never beside them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.llm import language_id, minhash_dedup, packing, secrets, toxicity
from armlens.llm.common import shared_folder

#: Least calibrated probability of the predicted language.
MIN_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language with a probability of MIN_LANGUAGE_SCORE, go."""
    model = language_id.fit(docs)
    found = docs.select(F.struct(*docs.columns).alias("doc"), language_id.predict(docs, model).alias("found"))
    return found.where((F.col("found.lang") != language_id.UNDETERMINED) & (F.col("found.score") >= MIN_LANGUAGE_SCORE)).select("doc.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = docs.select(F.struct(*docs.columns).alias("doc"), toxicity.score(docs, model).alias("found"))
    return found.where(~F.col("found.toxic")).select("doc.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.85 of the shingles) one row stays: that with the smallest id, of rows that share
    it the one with the least hash of its text. Rows that are nobody's near duplicate stay, also where ids repeat."""
    return minhash_dedup.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by [SECRET]; the documents stay."""
    text = secrets.redacted(docs, "text")
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: a row for each piece."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("minhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Model fits and similarity links can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
