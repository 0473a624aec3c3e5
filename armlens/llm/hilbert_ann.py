"""Approximate nearest neighbours by several Hilbert orderings of projected vectors.

* Equal vectors are one class (with its smallest ids), so a vector that many rows share is compared once.
* For each of ``curves`` orderings the vectors are projected to a few dimensions by a random rotation of their
  principal axes (found on a bounded sample), shifted, and numbered along a Hilbert curve. Positions are quantiles of
  the sample's curve keys; ranges of positions are the blocks that Spark deals out.
* A query meets the vectors whose position on some curve is within a window of its own. Queries are put into strata by
  how alone they are (the distance to the fifth nearest of a bounded sample), and a stratum's window is the smallest that
  would have caught ``target`` of the true neighbours of its probes: rows in clusters have narrow windows, rows without
  company wide ones.
* Blocks are sorted by position, so a query's window is a slice. A pair is scored on the first curve on which it meets
  (positions on all curves travel with the vectors); the best of all slices are merged.

Fitted on bounded samples: the axes and quantiles (``sample_rows`` vectors), the strata (32 * ``probe_queries`` queries)
and the windows (half of ``probe_queries`` for each stratum, each against all rows). Everything else covers all rows.

Defined results: vectors that are null, zero, hold null or non-finite components, or are not as long as most, take no
part. Rows that share id and vector are one; an id with several vectors is a row for each of them, none of which is a
candidate of a query with that id. Equal scores are in the order of ids. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import cut


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of integer cells (n rows, d columns, ``bits`` bits each)."""
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # inverse undo (Skilling's transform)
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


#: Shares of the queries, from the least alone to the most, at which strata end; each has a window of its own.
STRATA = (0.5, 0.75, 0.9, 0.95, 0.98)
#: Vectors of the sample that tell how alone a query is.
ANCHORS = 2048


class Windows:
    """How alone queries are (the distance to the fifth nearest anchor), and the half-width of window for each stratum."""

    def __init__(self, anchors: np.ndarray, edges: np.ndarray, widths: np.ndarray):
        self.anchors, self.edges, self.widths = anchors, edges, widths

    def alone(self, v: np.ndarray) -> np.ndarray:
        squares = (v * v).sum(axis=1)[:, None] - 2 * (v @ self.anchors.T) + (self.anchors * self.anchors).sum(axis=1)
        m = min(5, squares.shape[1] - 1)
        return np.sqrt(np.maximum(np.partition(squares, m, axis=1)[:, m], 0))

    def stratum(self, v: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, self.alone(v), "left")

    def of(self, v: np.ndarray) -> np.ndarray:
        return self.widths[self.stratum(v)]


class Curves:
    """The fitted projections and the quantiles of their keys."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.bits, self.mean = bits, sample.mean(axis=0)
        _, _, axes = np.linalg.svd(sample - self.mean, full_matrices=False)
        axes = axes[: max(dims, 4 * dims)]
        self.maps, self.low, self.high, self.shift, self.keys = [], [], [], [], []
        for _ in range(curves):
            rotation, _ = np.linalg.qr(random.normal(size=(len(axes), len(axes))))
            to = (rotation[:dims] @ axes).T
            p = (sample - self.mean) @ to
            self.maps.append(to)
            self.low.append(np.quantile(p, 0.001, axis=0))
            self.high.append(np.quantile(p, 0.999, axis=0) + 1e-12)
            self.shift.append(random.uniform(0, 0.25, size=to.shape[1]))
        for k in range(curves):
            self.keys.append(np.sort(self._key(sample, k)))

    def _key(self, v: np.ndarray, k: int) -> np.ndarray:
        unit = ((v - self.mean) @ self.maps[k] - self.low[k]) / (self.high[k] - self.low[k])
        cells = np.clip((unit * 0.75 + self.shift[k]) * (1 << self.bits), 0, (1 << self.bits) - 1).astype(np.int64)
        return hilbert_keys(cells, self.bits)

    def positions(self, v: np.ndarray) -> np.ndarray:
        """A row for each vector: its position in [0, 1) on each curve. Equal keys are spread by the vector's values."""
        spread = (np.abs(v).sum(axis=1) * 1e6) % 1.0
        out = np.empty((len(v), len(self.maps)))
        for k, keys in enumerate(self.keys):
            key = self._key(v, k)
            left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            out[:, k] = (left + spread * np.maximum(1, right - left)) / (len(keys) + 1)
        return np.minimum(out, 1 - 1e-6).astype(np.float32)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    clean = clean.where(fine)
    usual = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return clean.where(F.size("v") == (usual["n"] if usual else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _vectors(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)


def search(
    vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 20, curves: int = 8, dims: int = 8, bits: int = 7, target: float = 0.95, sample_rows: int = 8192, probe_queries: int = 128, block_rows: int = 32_768, queries_per_task: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score, n_scored: the ``k`` nearest rows found for each row whose id meets ``is_query(id)``,
    and how many candidates (classes of equal vectors) were scored for the query."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col).distinct()
    # Single precision travels as such.
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType, ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else "<f8"
    # Classes of equal vectors, with the k + 1 smallest ids: a query's own id may be among them.
    first = Window.partitionBy("v").orderBy("id")
    ranked = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = cut(ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("class", F.col("ids")[0]).withColumn("number", F.monotonically_increasing_id()))
    n = classes.count()
    schema = "query_id long, rank int, vec_id long, score double, n_scored long"
    if not n:
        return spark.createDataFrame([], schema)
    sample = _matrix(classes.orderBy(F.xxhash64("v"), "class").select("v").limit(sample_rows).toPandas()["v"])
    fitted = spark.sparkContext.broadcast(Curves(sample, curves, min(dims, sample.shape[1], max(1, len(sample) - 1)), bits))
    queries = rows.where(is_query(F.col("id")))
    n_queries = queries.count()
    windows = _windows(classes, queries, fitted, sample[:ANCHORS], k, probe_queries, target)
    shared = spark.sparkContext.broadcast(windows)
    blocks = max(1, -(-n // block_rows))
    mean_window = float(np.diff([0.0, *STRATA, 1.0]) @ windows.widths)
    parts = max(1, int(-(-n_queries * min(1.0, 2 * mean_window + 1 / blocks) // queries_per_task)))

    def place(batches, asking=False):
        for pdf in batches:
            if not len(pdf):
                continue
            v = _matrix(pdf["v"])
            at = fitted.value.positions(v)
            out = pdf.drop(columns="v").assign(vector=[x.tobytes() for x in v.astype(kind)], places=[x.tobytes() for x in at])
            if asking:
                out = out.assign(window=shared.value.of(v))
            for c in range(at.shape[1]):
                yield out.assign(curve=c, at=at[:, c].astype(np.float64))

    def ask(batches):
        return place(batches, asking=True)

    # A class of one row can't be a candidate of that row.
    placed = classes.select("class", "number", (F.size("ids") == 1).alias("single"), "v").mapInPandas(place, "class long, number long, single boolean, vector binary, places binary, curve int, at double")
    placed = placed.select("*", F.floor(F.col("at") * blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asked = queries.mapInPandas(ask, "id long, vector binary, places binary, window double, curve int, at double")
    edge = lambda x: F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(1 - 1e-9)) * blocks).cast("int")
    reach = F.col("window") + 1e-9
    asked = asked.select("*", F.explode(F.sequence(edge(F.col("at") - reach), edge(F.col("at") + reach))).alias("block"), F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int").alias("part"))

    def rank(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            c = int(key[0])
            left, right = left.sort_values(["at", "class"]), right.sort_values(["window", "at", "id"])
            v, name, number, single = _vectors(left["vector"], kind), left["class"].to_numpy(), left["number"].to_numpy(), left["single"].to_numpy()
            q, ids, wide = _vectors(right["vector"], kind), right["id"].to_numpy(), right["window"].to_numpy()
            at, q_at = _vectors(left["places"], "<f4"), _vectors(right["places"], "<f4")
            slack = 1e-12 * max(1e-300, np.abs(v).max() * v.shape[1])
            for begin in range(0, len(ids), 128):
                some = slice(begin, min(begin + 128, len(ids)))
                w = wide[some, None]
                lo = int(np.searchsorted(at[:, c], (q_at[some, c] - wide[some]).min(), "left"))
                hi = int(np.searchsorted(at[:, c], (q_at[some, c] + wide[some]).max(), "right"))
                s = q[some] @ v[lo:hi].T
                s[np.abs(q_at[some, None, c] - at[None, lo:hi, c]) > w] = -np.inf
                s[(name[None, lo:hi] == ids[some, None]) & single[None, lo:hi]] = -np.inf
                for earlier in range(c):
                    s[np.abs(q_at[some, None, earlier] - at[None, lo:hi, earlier]) <= w] = -np.inf
                scored = (s > -np.inf).sum(axis=1)
                for row in range(len(s)):
                    if not scored[row]:
                        continue
                    m = min(k, int(scored[row]))
                    # All that may be among the k best, then their scores again one by one, so that ties are ties.
                    least = np.partition(s[row], len(s[row]) - m)[len(s[row]) - m]
                    picks = np.flatnonzero(s[row] >= least - slack * np.abs(q[begin + row]).max())
                    exact = (v[lo + picks] * q[begin + row]).sum(axis=1)
                    order = np.lexsort((name[lo + picks], -exact))[:k]
                    n_scored = np.zeros(len(order), np.int64)
                    n_scored[0] = scored[row]
                    out.append((np.full(len(order), ids[begin + row]), number[lo + picks][order], name[lo + picks][order], exact[order], n_scored))
        names = ("query_id", "number", "class", "score", "n_scored")
        if not out:
            return pd.DataFrame({x: [] for x in names}).astype({"query_id": "int64", "number": "int64", "class": "int64", "score": "float64", "n_scored": "int64"})
        return pd.DataFrame(dict(zip(names, (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    keys = ["curve", "block", "part"]
    found = placed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(rank, "query_id long, number long, class long, score double, n_scored long")
    of_query = Window.partitionBy("query_id")
    found = found.withColumn("r", F.row_number().over(of_query.orderBy(F.desc("score"), "class"))).withColumn("n_scored", F.sum("n_scored").over(of_query)).where(F.col("r") <= k).drop("r")
    # Classes to rows, without the query's own.
    members = found.join(classes.select("number", "ids"), "number").select("query_id", "score", "n_scored", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    last = of_query.orderBy(F.desc("score"), "vec_id")
    return members.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "n_scored")


def _windows(classes: DataFrame, queries: DataFrame, fitted, anchors: np.ndarray, k: int, probes: int, target: float) -> Windows:
    """For each stratum the half-width, as a share of a curve, that catches ``target`` of its probes' true neighbours.

    Strata are cut at quantiles of how alone queries are, over those with the least hashes (at most 32 * ``probes`` of
    them); each has up to ``probes`` / 2 probes. So rows far from all others have wide windows and don't widen the rest's."""
    windows = Windows(anchors, np.zeros(len(STRATA)), np.zeros(len(STRATA) + 1))
    asked = queries.orderBy(F.xxhash64("id"), "id").limit(32 * probes).toPandas()
    if not len(asked):
        return windows
    some = _matrix(asked["v"])
    alone = windows.alone(some)
    windows.edges = np.quantile(alone, STRATA)
    stratum = np.searchsorted(windows.edges, alone, "left")
    chosen = np.concatenate([np.flatnonzero(stratum == s)[: max(1, probes // 2)] for s in range(len(STRATA) + 1)])
    q, of = some[chosen], stratum[chosen]
    q_at = fitted.value.positions(q)
    names = ["probe", "score", "class", "near"]

    def best(batches):
        top: list[list[np.ndarray]] = [[] for _ in range(len(q))]
        for pdf in batches:
            if len(pdf):
                v, name = _matrix(pdf["v"]), pdf["class"].to_numpy()
                s = np.round(q @ v.T, 12)
                at = fitted.value.positions(v)
                for row in range(len(q)):
                    m = np.lexsort((name, -s[row]))[: k + 1]
                    near = np.abs(at[m] - q_at[row]).min(axis=1)
                    top[row].append(np.column_stack((np.full(len(m), row), s[row, m], name[m], near)))
        for row in top:
            if row:
                both = np.concatenate(row)
                yield pd.DataFrame(both[np.lexsort((both[:, 2], -both[:, 1]))[: k + 1]], columns=names).astype({"probe": "int32", "class": "int64"})

    best_of = classes.select("class", "v").mapInPandas(best, "probe int, score double, class long, near double")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "class")
    true = best_of.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    # At most k + 1 rows for each probe.
    found = true.select("probe", "near").toPandas()
    near, at = found["near"].to_numpy(float), of[found["probe"].to_numpy(int)]
    widest = float(np.quantile(near, target)) if len(near) else 0.0
    windows.widths = np.array([min(1.0, (float(np.quantile(near[at == s], target)) if (at == s).any() else widest) + 1e-6) for s in range(len(STRATA) + 1)])
    return windows
