"""Shares of cell types in mixed samples, from marker genes, with an ensemble over draws of markers.

For each draw the markers' values are averaged per sample and type in Spark. One scale for each type is then found, so
that the scaled signals add up to 1 in every sample as nearly as non-negative scales can, and shares are normalised. A
type whose scale is 0 in a draw says nothing there, so that draw is left out for it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

AGGREGATORS = ("median", "mean", "scaled_mean")


def non_negative_least_squares(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The x >= 0 with the least |a @ x - y|, by Lawson and Hanson's active sets.

    One column after another joins the free ones, the one along which the error falls most steeply; a free one that would
    go below 0 is stopped there and leaves. Each step solves the free columns only, so the number of columns isn't bound
    by trying out their subsets."""
    k = a.shape[1]
    x, free = np.zeros(k), np.zeros(k, bool)
    scale = np.sqrt((a * a).sum(axis=0))
    unit = a / np.where(scale > 0, scale, 1)
    tol = 1e-12 * max(1e-300, float(np.sqrt(y @ y)))
    for _ in range(10 * k + 10):
        slope = unit.T @ (y - unit @ x)
        slope[free | (scale == 0)] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tol:
            break
        free[j] = True
        while True:
            s = np.zeros(k)
            s[free] = np.linalg.lstsq(unit[:, free], y, rcond=None)[0]
            if (s[free] > 0).all():
                x = s
                break
            if s[j] <= 0 and x[j] == 0:  # rounding: the column that was to join can't
                free[j] = False
                scale[j] = 0
                break
            down = free & (s <= 0)
            step = (x[down] / (x[down] - s[down])).min()
            x = x + step * (s - x)
            free &= ~(down & (x <= 1e-14 * max(1.0, x.max())))
            x[~free] = 0
    norm = np.sqrt((a * a).sum(axis=0))
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Ensemble:
    """``proportions``: sample, cell, aggregator, estimator, proportion, proportion_sd. ``stability``: cell, median_r, min_r,
    n_degenerate, stable. ``markers``: cell, gene of the representative draw, whose number is ``representative``."""

    proportions: DataFrame
    stability: DataFrame
    markers: DataFrame
    representative: int


def marker_pools(rows: DataFrame, markers: DataFrame, *, pool: int = 500) -> DataFrame:
    """cell, gene: the first ``pool`` markers of each type by rank, of these the genes with a value above 0."""
    first = markers.withColumn("_r", F.row_number().over(Window.partitionBy("cell").orderBy("rank", "gene"))).where(F.col("_r") <= pool).select("cell", "gene")
    positive = rows.groupBy("gene").agg(F.avg("value").alias("_m")).where("_m > 0").select("gene")
    return first.join(positive, "gene", "left_semi").select("cell", "gene")


def marker_draws(pools: DataFrame, *, draws: int = 100, size: int = 100, seed: int = 1) -> DataFrame:
    """draw, cell, gene: ``size`` genes of each pool for each draw, those with the least hashes."""
    each = pools.select("cell", "gene", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    order = Window.partitionBy("draw", "cell").orderBy(F.xxhash64(F.lit(seed), "draw", "cell", "gene"), "gene")
    return each.withColumn("_d", F.row_number().over(order)).where(F.col("_d") <= size).select("draw", "cell", "gene")


def draw_proportions(rows: DataFrame, drawn: DataFrame, aggregators: tuple[str, ...] = AGGREGATORS) -> DataFrame:
    """draw, aggregator, sample, cell, scale, proportion. A (gene, sample) without a row has the value 0."""
    samples = rows.select("sample").distinct()
    # Zeros aren't rows: sums are divided by the number of markers, and a median counts the missing ones below the others.
    size = drawn.groupBy("draw", "cell").agg(F.count("*").alias("k"))
    n = samples.count()
    means = rows.groupBy("gene").agg((F.sum("value") / n).alias("_mean"))
    j = rows.join(means, "gene").join(drawn, "gene")
    seen = j.groupBy("draw", "cell", "sample").agg(F.sum("value").alias("s"), F.sum(F.col("value") / F.col("_mean")).alias("z"), F.array_sort(F.collect_list(F.when(F.col("value") > 0, F.col("value")))).alias("v"))
    full = size.join(seen, ["draw", "cell"])
    zeros = F.col("k") - F.size("v")
    at = lambda i: F.when(i <= zeros, F.lit(0.0)).otherwise(F.get("v", (i - zeros - 1).cast("int")))
    median = (at(F.floor((F.col("k") + 1) / 2)) + at(F.floor(F.col("k") / 2) + 1)) / 2
    value = {"median": median, "mean": F.col("s") / F.col("k"), "scaled_mean": F.col("z") / F.col("k")}
    signal = full.select("draw", "cell", "sample", F.explode(F.array(*[F.struct(F.lit(a).alias("aggregator"), value[a].cast("double").alias("value")) for a in aggregators])).alias("a")).select("draw", "cell", "sample", "a.*")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        """A cohort's rows: one for each sample, a column for each type."""
        wide = pdf.pivot(index="sample", columns="cell", values="value").fillna(0.0)
        o = wide.to_numpy(float)
        g = non_negative_least_squares(o, np.ones(len(o)))
        p = o * g
        total = p.sum(axis=1, keepdims=True)
        p = np.divide(p, total, out=np.full_like(p, np.nan), where=total > 0)
        out = pd.DataFrame({"sample": np.repeat(wide.index.to_numpy(), o.shape[1]), "cell": np.tile(wide.columns.to_numpy(), len(o)), "scale": np.tile(g, len(o)), "proportion": p.ravel()})
        return out.assign(draw=pdf["draw"].iloc[0], aggregator=pdf["aggregator"].iloc[0])[["draw", "aggregator", "sample", "cell", "scale", "proportion"]]

    kinds = dict(signal.dtypes)
    found = signal.groupBy("draw", "aggregator").applyInPandas(fit, f"draw int, aggregator string, sample {kinds['sample']}, cell {kinds['cell']}, scale double, proportion double")
    return found.withColumn("proportion", F.nanvl("proportion", F.lit(None).cast("double")))


def draw_stability(proportions: DataFrame, aggregator: str) -> DataFrame:
    """cell, draw, used (the type varies over samples), mean_r (with the other used draws), median_r, min_r (of all pairs
    of used draws), n_degenerate: Pearson's correlations over samples, a type's draws in one task (draws times cohort)."""
    kinds = dict(proportions.dtypes)

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.pivot(index="sample", columns="draw", values="proportion").sort_index(axis=1)
        v = m.to_numpy(float)
        used = np.isfinite(v).all(axis=0)
        used &= np.where(used, np.nanstd(np.where(np.isfinite(v), v, 0), axis=0), 0) > 0
        k, mean_r, median, least = int(used.sum()), np.full(v.shape[1], np.nan), np.nan, np.nan
        if k >= 2:
            r = np.corrcoef(v[:, used], rowvar=False)
            upper = r[np.triu_indices(k, 1)]
            median, least = float(np.median(upper)), float(upper.min())
            mean_r[used] = (r.sum(axis=1) - 1) / (k - 1)
        return pd.DataFrame({"cell": pdf["cell"].iloc[0], "draw": m.columns.to_numpy(), "used": used, "mean_r": mean_r, "median_r": median, "min_r": least, "n_degenerate": int((~used).sum())})

    one = proportions.where(F.col("aggregator") == aggregator).groupBy("cell").applyInPandas(pairs, f"cell {kinds['cell']}, draw int, used boolean, mean_r double, median_r double, min_r double, n_degenerate long")
    return one.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("mean_r", "median_r", "min_r")})


def ensemble(
    rows: DataFrame, markers: DataFrame, *, draws: int = 100, size: int = 100, pool: int = 500, seed: int = 1, aggregators: tuple[str, ...] = AGGREGATORS, stability_min: float = 0.9, estimate: str = "auto",
) -> Ensemble:
    """Proportions by each aggregator, over all draws or from the representative one.

    ``rows``: gene, sample, value; ``markers``: cell, gene, rank. The first aggregator decides on stability: a type is
    stable where the median correlation of its draws reaches ``stability_min``. ``estimate``: ``ensemble`` takes means and
    deviations over the draws that say something about a type, ``representative`` the draw whose proportions agree best
    with those of others, and ``auto`` the ensemble if all types are stable. Fewer than two types, pools of fewer than
    ``size`` genes, and types that are 0 in every draw are errors."""
    if estimate not in ("auto", "ensemble", "representative"):
        raise ValueError(f"estimate {estimate!r}")
    pools = stored(marker_pools(rows, markers, pool=pool))
    thin = {r["cell"]: r["n"] for r in pools.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    missing = {r["cell"] for r in markers.select("cell").distinct().collect()} - set(thin)
    if len(thin) < 2 or missing or min(thin.values()) < size:
        raise ValueError(f"at least two types with {size} usable markers each are needed: {sorted((str(c), n) for c, n in (thin | dict.fromkeys(missing, 0)).items() if n < size) or sorted(thin)}")
    drawn = stored(marker_draws(pools, draws=draws, size=size, seed=seed))
    each = stored(draw_proportions(rows, drawn, aggregators))
    primary = aggregators[0]
    dead = [r["cell"] for r in each.where(F.col("aggregator") == primary).groupBy("cell").agg(F.max("scale").alias("s")).where("s <= 0").collect()]
    if dead:
        raise ValueError(f"types that are 0 in every draw can't be told from the others: {sorted(map(str, dead))}")
    pairs = stored(draw_stability(each, primary))
    stability = pairs.groupBy("cell").agg(*[F.max(c).alias(c) for c in ("median_r", "min_r", "n_degenerate")]).withColumn("stable", F.coalesce(F.col("median_r") >= stability_min, F.lit(False)))
    # A row for each type, and one for each draw.
    best = pairs.groupBy("draw").agg(F.avg("mean_r").alias("r")).where("r IS NOT NULL").orderBy(F.desc("r"), "draw").first()
    if best is None:
        raise ValueError("no draw has a usable estimate")
    use_ensemble = estimate == "ensemble" or (estimate == "auto" and stability.where("NOT stable").isEmpty())
    if use_ensemble:
        varies = each.groupBy("draw", "aggregator", "cell").agg((F.coalesce(F.stddev_pop("proportion"), F.lit(0.0)) > 0).alias("used")).where("used")
        mean = each.join(varies, ["draw", "aggregator", "cell"], "left_semi").groupBy("sample", "cell", "aggregator").agg(F.avg("proportion").alias("m"), F.stddev_samp("proportion").alias("proportion_sd"))
        total = F.sum("m").over(Window.partitionBy("sample", "aggregator"))
        out = mean.select("sample", "cell", "aggregator", F.lit("ensemble").alias("estimator"), F.try_divide("m", total).alias("proportion"), "proportion_sd")
    else:
        one = each.where(F.col("draw") == best["draw"])
        out = one.select("sample", "cell", "aggregator", F.lit("representative").alias("estimator"), "proportion", F.lit(None).cast("double").alias("proportion_sd"))
    return Ensemble(out, stability, drawn.where(F.col("draw") == best["draw"]).select("cell", "gene"), best["draw"])
