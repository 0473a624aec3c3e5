"""Toxicity severity by cumulative-link ordinal regression.

Labels say toxic or not; severity grades are derived from them. Features that speak for toxicity in the sample are
markers; toxic documents are graded 1 to ``grades`` by the quantiles of their sum of markers, others are grade 0. The model has one weight for each word feature, shared by all thresholds:

    P(grade > k) = sigmoid(w . x - theta_k),   theta_0 < theta_1 < ...

Features are the lower-cased words without punctuation and their first 4 and 5 letters (insults are inflected), hashed
into ``2 ** bits``; x are log(1 + how often they occur in the whole text). Only features that speak for
toxicity in the sample get a weight, so long clean texts add nothing. The expected severity is the sum of P(grade > k); a document is toxic if P(grade > 0) >= 0.5.

Fitting uses at most ``per_class`` labelled documents of either label (smallest hashes of ids), so one task can do it. Scoring is one pass over the scan without a shuffle.

Defined results: null, empty and wordless texts have severity 0; labels of documents that don't exist, and documents
without labels, take no part in fitting; without both labels nothing is toxic; repeated rows are scored twice.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BoundedCache, cut, text_batches

#: How much oftener toxic documents must have a feature that gets a weight.
LIFT = 8
_EDGES = "\"'`.,;:!?()[]{}<>|*_#~-…«»“”‘’„¡¿"


def normal_word(word: str) -> str:
    return word.strip(_EDGES).lower()


def word_features(word: str) -> list[str]:
    """The word, and its first letters where it has more."""
    word = normal_word(word)
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)] if word else []


class Features:
    """Numbers the words of texts, and keeps the hashed features of the words it has seen."""

    def __init__(self, bits: int, limit: int = 150_000):
        self.bits, self.limit = bits, limit
        self._forget()

    def _forget(self) -> None:
        self.number = BoundedCache(self._add, limit=1 << 62)
        self.rows: list[list[int]] = []
        self.table = np.zeros((0, 3), np.int64)

    def _add(self, word: str) -> int:
        none = 1 << self.bits  # an unused last feature
        found = [zlib.crc32(f.encode("utf-8", "surrogatepass")) >> (32 - self.bits) for f in word_features(word)]
        self.rows.append((found + [none] * 3)[:3])
        return len(self.rows) + len(self.table) - 1

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features of the whole text and log(1 + how often they occur)."""
        if len(self.number) > self.limit:
            self._forget()
        words = text.split()
        word, counts = np.unique(np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words)), return_counts=True)
        if self.rows:
            self.table, self.rows = np.concatenate((self.table, np.array(self.rows, np.int64))), []
        rows = self.table[word]
        used = rows[:, 0] < 1 << self.bits
        rows, counts = rows[used], counts[used]
        at, which = np.unique(rows, return_inverse=True)
        tf = np.bincount(which.ravel(), weights=np.repeat(counts, 3), minlength=len(at))
        inside = at < 1 << self.bits
        return at[inside], np.log1p(tf[inside])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class SeverityModel:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def exceeding(self, text: str | None, features: Features) -> np.ndarray:
        """P(grade > k) for each threshold."""
        if not text or not len(self.thresholds):
            return np.zeros(max(1, len(self.thresholds)))
        at, value = features.of(text)
        return _sigmoid(value @ self.weights[at] - self.thresholds) if len(at) else np.zeros(len(self.thresholds))


def _train(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, grades: int, steps: int, rate: float, l2: float, screen: float) -> tuple[np.ndarray, np.ndarray]:
    """Full-batch Adam on the mean of -log P(grade) + l2 / 2 * |w| ** 2; thresholds stay in order by positive gaps.

    Only features that speak for toxicity get a weight: of a toxic and b other documents that have one (both kinds
    scaled to the same number), a - b must exceed ``screen`` times the square root of a + b, and a must be LIFT times b.
    """
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    at, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    grade = np.array([r[2] for r in rows])
    # Copies count as one document: those with equal whole sets of features share its weight.
    sets = np.array([hashlib.blake2b(np.asarray(r[0], np.int64).tobytes(), digest_size=16).hexdigest() for r in rows])
    _, same, size = np.unique(sets, return_inverse=True, return_counts=True)
    share = 1.0 / size[same.ravel()]
    toxic, n_toxic = grade[row] > 0, max(1e-9, share[grade > 0].sum())
    of = lambda which: np.bincount(at[which], weights=share[row[which]], minlength=n_features)
    a, b = of(toxic), of(~toxic) * (n_toxic / max(1e-9, share[grade == 0].sum()))
    telling = ((a - b > screen * np.sqrt(a + b)) & (a > LIFT * b))[at]
    row, at, value = row[telling], at[telling], value[telling]
    evidence = np.bincount(row, weights=value, minlength=len(grade))
    if (grade > 0).any() and grades > 1:
        edges = np.quantile(evidence[grade > 0], np.arange(1, grades) / grades)
        grade = np.where(grade > 0, 1 + np.searchsorted(edges, evidence, side="left"), 0)
    names, at = np.unique(at, return_inverse=True)
    # Both kinds of documents weigh the same.
    weight = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    p = np.zeros(len(names) + grades)  # weights, the first threshold, logarithms of the gaps
    p[len(names)] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    each = np.arange(len(grade))
    for step in range(1, steps + 1):
        w, gaps = p[: len(names)], np.exp(p[len(names) + 1 :])
        theta = p[len(names)] + np.append(0.0, gaps.cumsum())
        s = np.bincount(row, weights=value * w[at], minlength=len(grade))[:, None] - theta
        up = np.column_stack((np.ones(len(grade)), _sigmoid(s), np.zeros(len(grade))))  # P(grade >= k)
        slope = up * (1 - up)
        prob = np.maximum(up[each, grade] - up[each, grade + 1], 1e-9)
        d = np.zeros_like(up)
        d[each, grade] = -slope[each, grade] / prob
        d[each, grade + 1] += slope[each, grade + 1] / prob
        d = d[:, 1:-1] * weight[:, None]  # of the loss by s_k
        by_theta = -d.sum(axis=0)[::-1].cumsum()[::-1]
        g = np.concatenate((np.bincount(at, weights=value * d.sum(axis=1)[row], minlength=len(names)) + l2 * w, by_theta[:1], by_theta[1:] * gaps))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        p[len(names) + 1 :] = np.clip(p[len(names) + 1 :], -3, 3)
    w = np.zeros(n_features)
    w[names] = p[: len(names)]
    return w, p[len(names)] + np.append(0.0, np.exp(p[len(names) + 1 :]).cumsum())


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, bits: int = 18, per_class: int = 2000, grades: int = 3, steps: int = 400, rate: float = 0.05, l2: float = 1e-5, screen: float = 3.5,
) -> SeverityModel:
    """Fit on at most ``per_class`` documents of either label."""
    spark = docs.sparkSession
    text_batches(spark)
    by_hash = Window.partitionBy("y").orderBy("h", "id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("id"))
    # Only labels that have a text count. They are thinned by hash to about twice what is needed before they are ranked.
    known = cut(known.join(texts.select("id").distinct().hint("merge"), "id", "left_semi"))
    n_of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n_of) < 2:
        return SeverityModel(np.zeros(1 << bits), np.zeros(0), bits)
    share = F.when(F.col("y") == 1, min(1.0, 2.0 * per_class / n_of[1])).otherwise(min(1.0, 2.0 * per_class / n_of[0]))
    chosen = known.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= per_class).drop("r")
    # At most 2 * per_class rows: broadcast. Of texts that share an id the one with the least hash stands for it.
    found = texts.join(F.broadcast(chosen), "id").groupBy("y", "id", "h").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    if found.groupBy("y").count().count() < 2:
        return SeverityModel(np.zeros(1 << bits), np.zeros(0), bits)

    def train(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        features = Features(bits)
        rows = [(*features.of(text), y) for text, y in pdf.sort_values(["h", "id"])[["text", "y"]].itertuples(index=False)]
        w, theta = _train(rows, 1 << bits, grades, steps, rate, l2, screen)
        at = w.nonzero()[0]
        return pd.DataFrame({"feature": [at], "value": [w[at]], "theta": [theta]})

    # At most 2 * per_class rows: one task fits them.
    parts = found.groupBy(F.lit(0).alias("all")).applyInPandas(train, "feature array<int>, value array<double>, theta array<double>").toPandas()
    weights = np.zeros(1 << bits)
    for at, value in zip(parts["feature"], parts["value"], strict=True):
        weights[at] += np.asarray(value)
    return SeverityModel(weights, np.mean(np.stack(parts["theta"].to_list()), axis=0), bits)


def score(docs: DataFrame, model: SeverityModel, text_col: str = "text") -> Column:
    """A struct column (severity double, p_toxic double, grade int, toxic boolean) for the texts of ``docs``."""
    spark = docs.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept: list[Features] = []

    @F.pandas_udf("severity double, p_toxic double, grade int, toxic boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        if not kept:
            kept.append(Features(model.bits))
        up = [model.exceeding(t, kept[0]) for t in texts]
        return pd.DataFrame({"severity": [float(p.sum()) for p in up], "p_toxic": [float(p[0]) for p in up], "grade": [int((p >= 0.5).sum()) for p in up], "toxic": [bool(p[0] >= 0.5) for p in up]})

    return of.asNondeterministic()(F.col(text_col))
