"""The registered queries of the training-data operators, thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, hilbert_ann, language_id, licenses, minhash_dedup, packing, quality, repeated_windows, secrets, sentencepiece_scan, simhash, toxicity, whitening
from .common import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.predict(docs, model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.score(docs, model).alias("t")).select("doc_id", "t.*")


def op1_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_scan.encode(_table(spark, sf_dir, "documents"), with_ids=False)


def op3_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns: n_scored, how many candidates were scored for the query."""
    return hilbert_ann.search(_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("sentences", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns: n_within_3, how many documents (itself included) have a fingerprint within 3 bits,
    for the documents whose id is divisible by 50; null for others.

    Rows whose id is null have no place in the order: they have n_chars and a fingerprint, and count in n_within_3, but
    what needs a next document is null."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    unplaced = rows.where("doc_id is null").select("doc_id", F.length("text").cast("long").alias("n_chars"), "text")
    unplaced = cut(simhash.fingerprints(unplaced, ["text"], ["doc_id", "n_chars"]).withColumnRenamed("text", "fp"))
    pairs = simhash.with_next(rows.where("doc_id is not null"), "doc_id", ["text"])
    # A text's hash tells rows apart that share an id.
    keys = [F.xxhash64("text").alias("key"), F.xxhash64("next_text").alias("next_key")]
    pairs = pairs.select("doc_id", "next_id", *keys, "text", simhash.edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    pairs = pairs.select("doc_id", "next_id", "key", "next_key", F.length("text").cast("long").alias("n_chars"), *simhash.as_longs(F.sha2("edited", 256)), "text", "edited")
    prints = simhash.fingerprints(pairs, ["text", "edited"], ["doc_id", "next_id", "key", "next_key", "n_chars", *[f"sha{k}" for k in range(4)]])
    base = cut(prints.select("doc_id", "next_id", "key", "next_key", "n_chars", simhash.from_longs().alias("edited_sha256"), F.col("text").alias("fp"), F.col("edited").alias("edited_fp")))
    index = base.select("fp").union(unplaced.select("fp")).groupBy(F.col("fp").alias("print")).agg(F.count("*").alias("n"))
    asked = base.where("doc_id % 50 = 0").select(F.col("fp").alias("query")).distinct()
    # Everything here grows with the documents, so nothing is broadcast.
    met = simhash.near(asked, index.select("print")).join(index.hint("merge"), "print").groupBy(F.col("query").alias("fp")).agg(F.sum("n").alias("n_within_3"))
    nexts = base.select(F.col("doc_id").alias("next_id"), F.col("key").alias("next_key"), F.col("fp").alias("next_fp")).distinct()
    full = base.join(nexts.hint("merge"), ["next_id", "next_key"]).unionByName(unplaced, allowMissingColumns=True).join(met.hint("merge"), "fp", "left")
    return full.select(
        "doc_id", "n_chars", "edited_sha256", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), simhash.hexadecimal(F.col("edited_fp")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("n_within_3")).alias("n_within_3"),
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(_table(spark, sf_dir, "documents"))


def op12_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_windows.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_kneser_ney, op2_sentencepiece, op3_hilbert_ann, op4_best_fit_packing, op5_language_id, op6_secret_scan, op7_license_scan, op8_minhash_dedup, op9_toxicity, op10_simhash, op11_tokenizer_alignment, op12_repeated_windows, op13_embedding_whitening]
    return {f.__name__: f for f in found}


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op7_license_scan": licenses.oracle_sql()}
