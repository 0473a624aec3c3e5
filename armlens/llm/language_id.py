"""Language identification.

Sparse multinomial logistic regression on TF-IDF weighted character n-grams (1 to 3 characters of the
lower-cased text, hashed into ``2 ** bits`` features), trained by follow-the-regularised-leader with an
elastic-net penalty, then calibrated with one temperature.

* Document frequencies come from every learnable document: each task sums its own, Spark adds them up.
* Training uses at most ``per_class`` documents of each language (the smallest hashes of their ids); shards of
  them are trained in parallel and their weights averaged.
* Prediction is one pass over the scan: no shuffle, and the model has ``2 ** bits`` rows at most for each language.

Defined results: a text that is null or has no letter gets ``und`` with score 0; extra columns are ignored; rows
that occur twice are predicted twice; without any learnable row every text gets ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_batches

#: Weights are dense by language, so their number is bounded.
MAX_LANGUAGES = 512
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20  # characters hashed at once


def _term_counts(text: str, bits: int) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text."""
    counts = np.zeros(1 << bits, dtype=np.int64)
    text = text.lower()
    shift = np.uint32(32 - bits)
    for begin in range(0, len(text), _CHUNK):
        # Two characters before the chunk are taken along, so that no n-gram is lost at its edge.
        lead = min(begin, 2)
        code = np.frombuffer(text[begin - lead : begin + _CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        one = (code + np.uint32(1)) * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (code[1:] + np.uint32(7))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (code[2:] + np.uint32(31))) * np.uint32(0xC2B2AE35)
        grams = np.concatenate((one[lead:], two[max(lead - 1, 0) :], three))
        grams ^= grams >> np.uint32(15)
        grams *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(grams >> shift, minlength=1 << bits)
    return counts


@dataclass
class LanguageModel:
    """``weights``: a row for each feature, a column for each language; ``idf`` as long as ``weights``."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    bits: int

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return _features(text, self.idf, self.bits)

    def logits(self, text: str) -> np.ndarray:
        at, value = self.features(text)
        return value @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k]))


def _features(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    counts = _term_counts(text, bits)
    at = counts.nonzero()[0]
    value = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(value @ value)
    return at, value / norm if norm else value


def document_frequencies(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """feature, df: in how many texts of ``docs`` each feature occurs. At most ``2 ** bits`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += _term_counts(text, bits) > 0
        at = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["feature", "df"])

    counted = docs.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(count, "feature int, df long")
    return counted.groupBy("feature").agg(F.sum("df").alias("df"))


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, epochs: int, alpha: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; the last feature row is the unpenalised bias."""
    z, n = np.zeros((n_features + 1, n_classes)), np.zeros((n_features + 1, n_classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        w = -(zs - np.sign(zs) * l1) / ((1 + np.sqrt(ns)) / alpha + l2)
        w[np.abs(zs) <= l1] = 0
        w[-1] = -zs[-1] / ((1 + np.sqrt(ns[-1])) / alpha)
        return w

    for _ in range(epochs):
        for at, value, label in rows:
            at, value = np.append(at, n_features), np.append(value, 1.0)
            w = weights(at)
            score = value @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1
            g = np.outer(value, p)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(n_features + 1))
    return w[:-1], w[-1]


def _calibrate(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), label]))

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, bits: int = 16, per_class: int = 1000, shards: int = 8, epochs: int = 4, alpha: float = 0.5, l1: float = 1e-3, l2: float = 1e-2,
) -> LanguageModel:
    """Learn from rows of ``labelled`` with text and language.

    ``per_class`` bounds the rows of each language that are fitted; a fifth of them is kept for the calibration.
    Document frequencies and the set of languages (at most MAX_LANGUAGES, or ValueError) come from all rows.
    """
    text_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    idf = np.zeros(1 << bits)
    frequencies = document_frequencies(rows, "text", bits).toPandas()
    # Rows count as one where id and text are equal, so a language of one text, or of one id, is learnt as well.
    rows = rows.withColumn("h", F.xxhash64("id", "text"))
    classes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("distinct"), F.min("h").alias("least")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(classes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages, n_docs = [r["lang"] for r in classes], sum(r["n"] for r in classes)
    if not languages:
        return LanguageModel([], idf, np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    idf[frequencies["feature"]] = np.log((1 + n_docs) / (1 + frequencies["df"])) + 1
    order = Window.partitionBy("lang").orderBy("h")
    # By its hash each language's rows are thinned to about four times what is needed, so that little is shuffled.
    of_lang = lambda f: F.create_map(*[x for r in classes for x in (F.lit(r["lang"]), F.lit(f(r)))])[F.col("lang")]
    share = of_lang(lambda r: 4.0 * per_class / max(1, r["distinct"]))
    sample = rows.where((F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)) | (F.col("h") == of_lang(lambda r: r["least"]))).dropDuplicates(["lang", "h"])
    sample = sample.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_class)
    sample = sample.withColumn("shard", F.when(F.col("rank") % 5 == 0, F.lit(-1)).otherwise(F.pmod("rank", F.lit(shards)))).drop("id", "h")
    index = {lang: k for k, lang in enumerate(languages)}

    def train(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """Shard -1 is not trained on: its features are returned as they are needed for the calibration."""
        pdf = pdf.sort_values("rank", kind="stable")
        rows = [(*_features(text, idf, bits), index[lang]) for text, lang in zip(pdf["text"], pdf["lang"], strict=True)]
        if key[0] == -1:
            return pd.DataFrame({"row": np.arange(len(rows)), "label": [r[2] for r in rows], "feature": [r[0] for r in rows], "value": [r[1] for r in rows]})
        w, b = _ftrl(rows, 1 << bits, len(languages), epochs, alpha, l1, l2)
        found = [(w[:, k].nonzero()[0], k) for k in range(len(languages))]
        return pd.DataFrame({"row": -1, "label": [k for _, k in found], "feature": [np.append(at, 1 << bits) for at, _ in found], "value": [np.append(w[at, k], b[k]) for at, k in found]})

    trained = sample.groupBy("shard").applyInPandas(train, "row long, label int, feature array<int>, value array<double>").toPandas()
    parts = trained[trained["row"] < 0]
    weights, n_parts = np.zeros(((1 << bits) + 1, len(languages))), max(1, len(parts) // len(languages))
    for label, at, value in zip(parts["label"], parts["feature"], parts["value"], strict=True):
        weights[at, label] += np.asarray(value) / n_parts
    model = LanguageModel(languages, idf, weights[:-1], weights[-1], 1.0, bits)
    held = trained[trained["row"] >= 0]
    if len(held):
        logits = np.stack([np.asarray(value) @ model.weights[at] + model.bias for at, value in zip(held["feature"], held["value"], strict=True)])
        model.temperature = _calibrate(logits, held["label"].to_numpy())
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """A struct column (lang string, score double) for the texts of ``docs``."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return of.asNondeterministic()(F.col(text_col))
