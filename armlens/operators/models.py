"""Models per group: comparisons, associations, least squares and penalised likelihood over many groups at once.

Sums are made in Spark. Where a small linear system or an iteration is left, it is solved per group from the group's
sufficient statistics or its cohort rows (as many as there are individuals), in parallel over groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import two_sided_normal_sql
from ..functions.tails import chi2_upper, f_upper, t_two_sided
from .ranks import benjamini_hochberg, rank_sums
from .tests import _normal_p, spearman


def group_comparison(values: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Medians, quartiles, ratio, change in per cent, Wilcoxon's p, the shift (median of pairwise differences) and Cliff's
    delta of case against ref. A key has a value for each individual, so its arms are a cohort at most."""
    arm = {"case": F.col("condition") == "case", "ref": F.col("condition") == "ref"}
    q = lambda c, p: F.percentile(F.when(c, F.col(value)), p)
    stats = values.groupBy(key).agg(*[f.alias(f"{n}_{k}") for k, c in arm.items() for n, f in (("n", F.count(F.when(c, F.col(value)))), ("median", q(c, 0.5)), ("q1", q(c, 0.25)), ("q3", q(c, 0.75)))])
    by, tie = Window.partitionBy(key), Window.partitionBy(key, value)
    r = values.select(key, "condition", (F.rank().over(by.orderBy(value)) + (F.count("*").over(tie) - 1) / 2.0).alias("r"), F.count("*").over(tie).alias("t"))
    sums = r.groupBy(key).agg(F.count_if(arm["case"]).alias("n1"), F.count_if(arm["ref"]).alias("n2"), F.sum(F.when(arm["case"], F.col("r"))).alias("r1"), F.sum(F.col("t") * F.col("t") - 1).cast("double").alias("ties"))
    p = _normal_p(sums).select(key, "p_value", (F.lit(0.0) - F.col("rbc")).alias("cliffs_delta"))
    shift = location_shift(values, key, value)
    out = stats.join(p, key).join(shift, key, "left").withColumn("ratio", F.try_divide("median_case", "median_ref"))
    return benjamini_hochberg(out.withColumn("pct_change", 100 * (F.col("ratio") - 1)))


def median_difference(x: np.ndarray, y: np.ndarray) -> float:
    """The median of all differences x - y (the mean of the two middle ones), without making them.

    The sorted arms are a matrix of differences with sorted rows and columns. Every step takes the weighted median of what
    the rows have left, counts the differences below and up to it by two searches, and drops what can't hold the median:
    a quarter at least. Memory is that of the arms."""
    x, y = np.sort(x), np.sort(y)[::-1]  # x[i] - y[j] rises with i and with j
    n, m = len(x), len(y)
    if not n or not m:
        return float("nan")
    neg = -y  # rising

    def kth(k: int) -> float:
        """The k-th smallest difference, from 0."""
        lo, hi = np.zeros(n, np.int64), np.full(n, m, np.int64)
        while True:
            left = hi - lo
            some = left > 0
            middle = x[some] + neg[(lo[some] + hi[some]) // 2]
            order = np.argsort(middle, kind="stable")
            weight = left[some][order].cumsum()
            pivot = middle[order][np.searchsorted(weight, (weight[-1] + 1) // 2)]
            below, up_to = _counts(x, neg, pivot)
            if below.sum() <= k < up_to.sum():
                return float(pivot)
            if k < below.sum():
                hi = np.minimum(hi, below)
            else:
                lo = np.maximum(lo, up_to)

    total = n * m
    return kth(total // 2) if total % 2 else (kth(total // 2 - 1) + kth(total // 2)) / 2


def _counts(x: np.ndarray, neg: np.ndarray, pivot: float) -> tuple[np.ndarray, np.ndarray]:
    """For each x how many of x + neg are below the pivot, and how many are at most it, as floats round their sums."""
    guess = np.searchsorted(neg, pivot - x, "left")
    m = len(neg)
    below, up_to = guess.copy(), guess.copy()
    for at, inside in ((below, np.less), (up_to, np.less_equal)):
        while True:  # pivot - x may be rounded by an ulp, so the edge is walked to
            back = (at > 0) & ~inside(x + neg[np.maximum(at - 1, 0)], pivot)
            on = (at < m) & inside(x + neg[np.minimum(at, m - 1)], pivot)
            if not (back | on).any():
                break
            value = neg[np.clip(np.where(on, at, at - 1), 0, m - 1)]
            # Equal values are passed at once.
            at[on] = np.searchsorted(neg, value[on], "right")
            at[back & ~on] = np.searchsorted(neg, value[back & ~on], "left")
    return below, up_to


def location_shift(values: DataFrame, key: str, value: str = "value") -> DataFrame:
    """key, shift: the median of all pairwise differences of case and ref; keys without either arm are left out."""
    arm = lambda c: F.collect_list(F.when(F.col("condition") == c, F.col(value).cast("double"))).alias(c)
    arms = values.groupBy(key).agg(arm("case"), arm("ref")).where((F.size("case") > 0) & (F.size("ref") > 0))

    @F.pandas_udf("double")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([median_difference(np.asarray(x, float), np.asarray(y, float)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return arms.select(key, of("case", "ref").alias("shift"))


def continuous_association(pairs: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Spearman's rho with an interval of 1.06 / sqrt(n - 3) on its arc tangent; null below five rows."""
    s = spearman(pairs, keys, x, y, least=5)
    width = 1.959964 * F.sqrt(F.lit(1.06)) / F.sqrt(F.col("n") - 3)
    inner = (F.abs("rho") < 1) & (F.col("n") > 3)
    return s.withColumn("ci_low", F.when(inner, F.tanh(F.atanh("rho") - width))).withColumn("ci_high", F.when(inner, F.tanh(F.atanh("rho") + width)))


def partial_spearman(pairs: DataFrame, keys: list[str], x: str, y: str, group: str = "condition") -> DataFrame:
    """Correlation of ranks after each group's mean rank is taken off, beside the plain one."""
    by = Window.partitionBy(*keys)
    rank = lambda v: F.rank().over(by.orderBy(v)) + (F.count("*").over(Window.partitionBy(*keys, v)) - 1) / 2.0
    r = pairs.select(*keys, group, rank(x).alias("rx"), rank(y).alias("ry"))
    inside = Window.partitionBy(*keys, group)
    d = r.select(*keys, "rx", "ry", (F.col("rx") - F.avg("rx").over(inside)).alias("dx"), (F.col("ry") - F.avg("ry").over(inside)).alias("dy"))
    c = lambda a, b: F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return d.groupBy(*keys).agg(F.count("*").alias("n"), c("rx", "ry").alias("rho"), c("dx", "dy").alias("partial_rho"))


def grouped_ols(rows: DataFrame, key: str, y: str, xs: list[str]) -> DataFrame:
    """Least squares with an intercept per key: coefficients, r2, adj_r2, F and its p-value, adjusted over keys.

    The sums of products are aggregated in Spark; a system of len(xs) + 1 equations is left for each key.
    """
    terms = ["1", *xs]
    product = lambda a, b: F.sum((F.lit(1.0) if a == "1" else F.col(a)) * (F.lit(1.0) if b == "1" else F.col(b)))
    sums = [product(a, b).cast("double").alias(f"x{i}_{j}") for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j]
    sums += [product(a, y).cast("double").alias(f"y_{i}") for i, a in enumerate(terms)] + [F.sum(F.col(y) * F.col(y)).alias("yy")]
    g = rows.dropna(subset=[key, y, *xs]).groupBy(key).agg(*sums)
    k, names = len(terms), [f"b_{t}" for t in ("intercept", *xs)]

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                a = np.array([[row[f"x{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
                v, n = np.array([row[f"y_{i}"] for i in range(k)]), row["x0_0"]
                full = n > k and np.linalg.matrix_rank(a) == k
                b = np.linalg.solve(a, v) if full else np.full(k, np.nan)
                total = row["yy"] - v[0] ** 2 / n
                r2 = 1 - (row["yy"] - b @ v) / total if full and total > 1e-12 else np.nan
                out.append((row[key], int(n), *b, r2, 1 - (1 - r2) * (n - 1) / (n - k) if full else np.nan, r2 / (k - 1) / ((1 - r2) / (n - k)) if full and r2 < 1 else np.nan))
            yield pd.DataFrame(out, columns=[key, "n", *names, "r2", "adj_r2", "f_stat"])

    kind = dict(rows.dtypes)[key]
    fitted = g.mapInPandas(solve, f"{key} {kind}, n long, " + ", ".join(f"{n} double" for n in names) + ", r2 double, adj_r2 double, f_stat double")
    clean = fitted.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in fitted.dtypes])
    return benjamini_hochberg(clean.withColumn("p_value", f_upper("f_stat", F.lit(float(k - 1)), (F.col("n") - k).cast("double"))))


def kruskal_wallis(values: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """h, dof and p_value per key, corrected for ties."""
    by, tie = Window.partitionBy(*keys), Window.partitionBy(*keys, value)
    r = values.select(*keys, group, (F.rank().over(by.orderBy(value)) + (F.count("*").over(tie) - 1) / 2.0).alias("r"), F.count("*").over(tie).alias("t"))
    per = r.groupBy(*keys, group).agg(F.count("*").cast("double").alias("n"), F.sum("r").alias("s"), F.sum(F.col("t") * F.col("t") - 1).alias("ties"))
    g = per.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum("ties").alias("ties"))
    h = F.try_divide(12 / (F.col("n") * (F.col("n") + 1)) * F.col("q") - 3 * (F.col("n") + 1), 1 - F.try_divide(F.col("ties"), F.col("n") * F.col("n") * F.col("n") - F.col("n")))
    return g.select(*keys, F.when(F.col("k") > 1, h).alias("h"), (F.col("k") - 1).alias("dof")).withColumn("p_value", chi2_upper("h", F.col("dof").cast("double")))


def directional_wilcoxon(values: DataFrame, keys: list[str], group: str, value: str, high: str, low: str, *, least: int = 3) -> DataFrame:
    """Per key: the smaller of the two one-sided p-values that ``high`` lies above or below ``low``, its direction, and
    the adjustment over keys. Null where either group has fewer than ``least`` values."""
    two = values.where(F.col(group).isin(high, low))
    g = rank_sums(two, keys, F.col(group) == high, value)
    g = g.withColumn("u", F.expr("r1 - n1 * (n1 + 1) / 2e0")).withColumn("s", F.expr("sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1) - ties / nullif(CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1), 0e0)))"))
    side = lambda sign: F.expr(f"(({sign}) * (u - n1 * n2 / 2e0) - 0.5e0) / nullif(s, 0e0)")
    g = g.withColumns({"z_greater": side("1"), "z_less": side("-1")})
    g = g.withColumns({"tail_greater": F.expr(two_sided_normal_sql("abs(z_greater)")) / 2, "tail_less": F.expr(two_sided_normal_sql("abs(z_less)")) / 2})
    upper = lambda k: F.when(F.col(f"z_{k}") >= 0, F.col(f"tail_{k}")).otherwise(1 - F.col(f"tail_{k}"))
    ok = (F.col("n1") >= least) & (F.col("n2") >= least) & (F.col("s") > 0)
    g = g.withColumn("p_greater", F.when(ok, upper("greater"))).withColumn("p_less", F.when(ok, upper("less")))
    direction = F.when(F.col("p_greater") < F.col("p_less"), F.lit(f"{high} > {low}")).when(ok, F.lit(f"{high} < {low}"))
    return benjamini_hochberg(g.select(*keys, "p_greater", "p_less", F.least("p_greater", "p_less").alias("p_directional"), direction.alias("direction")), "p_directional", "adj_directional")


def marker_check(rows: DataFrame, groups: DataFrame, genes: DataFrame) -> DataFrame:
    """gene, median_case, median_ref, ratio of the given genes' values, for the genes that are there."""
    j = rows.join(genes.select("gene").distinct(), "gene", "left_semi").join(groups, "sample")
    median = lambda c: F.percentile(F.when(F.col("condition") == c, F.col("value")), 0.5).alias(f"median_{c}")
    return j.groupBy("gene").agg(median("case"), median("ref")).withColumn("ratio", F.try_divide("median_case", "median_ref"))


def covariate_correlations(wide: DataFrame, covariates: list[str], targets: list[str]) -> DataFrame:
    """covariate, target, n, rho, p_value: Spearman's correlation of each covariate with each target."""
    each = lambda cs, k: F.explode(F.array(*[F.struct(F.lit(c).alias(k), F.col(c).cast("double").alias(f"{k}_value")) for c in cs]))
    long = wide.select(*targets, each(covariates, "covariate").alias("x")).select(*targets, "x.*").select("covariate", "covariate_value", each(targets, "target").alias("y")).select("covariate", "covariate_value", "y.*")
    return spearman(long.dropna(subset=["covariate_value", "target_value"]), ["covariate", "target"], "covariate_value", "target_value")


def bootstrap_median_difference(values: DataFrame, value: str, *, replicates: int = 2000, margin: float = 0.10, seed: int = 1) -> DataFrame:
    """The median difference of case and ref with a 95 % interval from resampled arms, and whether it lies within the
    margin. Draws are hashes of (replicate, place), so the result is the same at every partitioning."""
    by = Window.partitionBy("condition").orderBy(value)
    arms = values.select("condition", value, (F.row_number().over(by) - 1).alias("at"), F.count("*").over(Window.partitionBy("condition")).alias("n"))
    # Each place of each replicate draws one row of its arm: replicates * rows draws, spread over tasks by replicate.
    draws = arms.select("condition", "n", "at", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    drawn = draws.select("condition", "replicate", F.pmod(F.xxhash64(F.lit(seed), "condition", "replicate", "at"), F.col("n")).cast("int").alias("at")).join(arms.select("condition", "at", value), ["condition", "at"])
    med = lambda c: F.percentile(F.when(F.col("condition") == c, F.col(value)), 0.5)
    each = drawn.groupBy("replicate").agg((med("case") - med("ref")).alias("d"))
    seen = values.agg((med("case") - med("ref")).alias("difference"))
    ends = each.agg(F.percentile("d", 0.025).alias("ci_low"), F.percentile("d", 0.975).alias("ci_high"))
    return seen.join(ends, F.lit(True)).withColumn("equivalent", (F.col("ci_low") > -margin) & (F.col("ci_high") < margin))


def _firth(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, bool]:
    """Coefficients, standard errors and convergence of logistic regression with Jeffreys' penalty."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-10)
        info = x.T @ (x * w[:, None])
        inverse = np.linalg.pinv(info)
        hat = w * np.einsum("ij,jk,ik->i", x, inverse, x)
        step = inverse @ (x.T @ (y - p + hat * (0.5 - p)))
        step *= min(1.0, 5 / max(1e-12, np.abs(step).max()))
        b = b + step
        if np.abs(step).max() < 1e-8:
            return b, np.sqrt(np.diag(inverse)), True
    return b, np.sqrt(np.diag(inverse)), False


def presence_models(rows: DataFrame, key: str, present: str, terms: list[str], *, least: int = 5) -> DataFrame:
    """Per key, presence (0 or 1) on is-case alone and with further terms: both coefficients, and by how many per cent the
    first shrinks. A key has a row for each individual; those with fewer than ``least`` on a side are left out."""
    sides = rows.groupBy(key).agg(F.sum(present).alias("_a"), F.count("*").alias("_n")).where((F.col("_a") >= least) & (F.col("_n") - F.col("_a") >= least))
    kept = rows.join(sides.select(key), key, "left_semi").select(key, "is_case", present, *terms).dropna()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y, one = pdf[present].to_numpy(float), np.ones(len(pdf))
        plain, _, ok0 = _firth(np.column_stack((one, pdf["is_case"])), y)
        full, se, ok1 = _firth(np.column_stack((one, pdf[["is_case", *terms]].to_numpy(float))), y)
        small = abs(plain[1]) < 1e-3
        return pd.DataFrame({key: pdf[key].iloc[:1], "n": [len(pdf)], "b_plain": [plain[1]], "b_full": [full[1]], "se_full": [se[1]], "attenuation": [None if small else 100 * (1 - abs(full[1]) / abs(plain[1]))], "converged": [bool(ok0 and ok1)]})

    kind = dict(rows.dtypes)[key]
    return kept.groupBy(key).applyInPandas(fit, f"{key} {kind}, n long, b_plain double, b_full double, se_full double, attenuation double, converged boolean")


def site_models(rows: DataFrame, keys: list[str], *, least: int = 20) -> DataFrame:
    """Per site, a quasi-binomial model of alternate against other reads on is-case: coefficient, dispersion, z, p-value
    and whether an arm is at a boundary. Sites with fewer than ``least`` carriers in either arm are left out before."""
    n = lambda c: F.count_if(F.col("is_case") == c)
    enough = rows.where("dp > 0").groupBy(*keys).agg(n(1).alias("_a"), n(0).alias("_b")).where((F.col("_a") >= least) & (F.col("_b") >= least)).select(*keys)
    # With one binary term the fit is closed: each arm's pooled share. So sums are all that is needed.
    k = rows.where("dp > 0").join(enough, keys, "left_semi").withColumn("p", F.sum("a1_ad").over(Window.partitionBy(*keys, "is_case")) / F.sum("dp").over(Window.partitionBy(*keys, "is_case")).cast("double"))
    inner = (F.col("p") > 0) & (F.col("p") < 1)
    pearson = F.when(inner, F.pow(F.col("a1_ad") - F.col("dp") * F.col("p"), 2) / (F.col("dp") * F.col("p") * (1 - F.col("p")))).otherwise(0.0)
    arm = lambda c, x: F.sum(F.when(F.col("is_case") == c, F.col(x)))
    g = k.withColumn("_x", pearson).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("_x").alias("x2"), F.max((~inner).cast("int")).alias("boundary"), *[f.cast("double").alias(a) for a, f in (("a1", arm(1, "a1_ad")), ("d1", arm(1, "dp")), ("a0", arm(0, "a1_ad")), ("d0", arm(0, "dp")))])
    ok = F.col("boundary") == 0
    logit = lambda a, d: F.ln(F.col(a) / (F.col(d) - F.col(a)))
    g = g.withColumn("b", F.when(ok, logit("a1", "d1") - logit("a0", "d0"))).withColumn("dispersion", F.col("x2") / (F.col("n") - 2))
    var = sum((F.lit(1.0) / F.col(a) + 1 / (F.col(d) - F.col(a)) for a, d in (("a1", "d1"), ("a0", "d0"))), F.lit(0.0))
    g = g.withColumn("z", F.when(ok & (F.col("dispersion") > 0), F.col("b") / F.sqrt(F.col("dispersion") * var)))
    g = g.withColumn("p_value", F.expr(f"CASE WHEN z IS NOT NULL THEN {two_sided_normal_sql('z')} END"))
    # There may be millions of sites.
    return benjamini_hochberg(g.select(*keys, "n", "b", "dispersion", "z", "p_value", "boundary"), parts=64)


def risk_set_sensitivity(genes: DataFrame, expression: str, quantiles: list[float], measure: str) -> DataFrame:
    """quantile, cutoff, n_genes and the measure's median over genes at or above each expression quantile."""
    cuts = genes.agg(F.array(*[F.struct(F.lit(q).alias("quantile"), F.percentile(expression, q).alias("cutoff")) for q in quantiles]).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    met = genes.join(F.broadcast(cuts), F.col(expression) >= F.col("cutoff"))
    return met.groupBy("quantile", "cutoff").agg(F.count("*").alias("n_genes"), F.percentile(measure, 0.5).alias("median"))


def covariate_screen(wide: DataFrame, covariates: list[str], *, group: str = "condition") -> DataFrame:
    """covariate, kind, n, p_value: binary covariates by Fisher's test against the group, others by Wilcoxon's; constant
    ones and those that are the group itself are named as such. A row for each covariate."""
    from .tests import fisher_exact_sql

    long = wide.select(group, F.explode(F.array(*[F.struct(F.lit(c).alias("covariate"), F.col(c).cast("double").alias("v")) for c in covariates])).alias("x")).select(F.col(group).alias("condition"), "x.*").where("v IS NOT NULL")
    case = F.col("condition") == "case"
    g = long.groupBy("covariate").agg(
        F.count("*").alias("n"), F.count_distinct("v").alias("values"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.count_distinct(F.when(case, F.col("v"))).alias("vc"), F.count_distinct(F.when(~case, F.col("v"))).alias("vr"), F.min(F.when(case, F.col("v"))).alias("c0"), F.min(F.when(~case, F.col("v"))).alias("r0"),
    )
    top = long.join(F.broadcast(g.select("covariate", "high")), "covariate").withColumn("top", F.col("v") == F.col("high"))
    cells = top.groupBy("covariate").agg(*[F.count_if(c & t).alias(n) for n, c, t in (("a", case, F.col("top")), ("b", case, ~F.col("top")), ("c", ~case, F.col("top")), ("d", ~case, ~F.col("top")))])
    fisher = cells.withColumn("fisher", F.expr(fisher_exact_sql("a", "b", "c", "d"))).select("covariate", "fisher")
    by, tie = Window.partitionBy("covariate"), Window.partitionBy("covariate", "v")
    r = long.select("covariate", "condition", (F.rank().over(by.orderBy("v")) + (F.count("*").over(tie) - 1) / 2.0).alias("r"), F.count("*").over(tie).alias("t"))
    sums = r.groupBy("covariate").agg(F.count_if(case).alias("n1"), F.count_if(~case).alias("n2"), F.sum(F.when(case, F.col("r"))).alias("r1"), F.sum(F.col("t") * F.col("t") - 1).cast("double").alias("ties"))
    wilcoxon = _normal_p(sums).select("covariate", F.col("p_value").alias("wilcoxon"))
    same = (F.col("vc") == 1) & (F.col("vr") == 1) & (F.col("c0") != F.col("r0"))
    kind = F.when(F.col("values") < 2, "constant").when(same, "collinear").when(F.col("values") == 2, "binary").otherwise("continuous")
    out = g.join(fisher, "covariate").join(wilcoxon, "covariate").withColumn("kind", kind)
    p = F.when(F.col("kind") == "constant", F.lit(None).cast("double")).when(F.col("values") == 2, F.col("fisher")).otherwise(F.col("wilcoxon"))
    return out.select("covariate", "kind", "n", p.alias("p_value"))


def class_crosstab(rows: DataFrame, group: str, resolution: str, usable: list[str], *, spread: float = 0.10) -> DataFrame:
    """Per class: counts, how many are usable, their share, the spread of shares over classes and whether it is too wide."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col(resolution).isin(usable)).alias("n_usable")).withColumn("share", F.col("n_usable") / F.col("n"))
    wide = g.agg((F.max("share") - F.min("share")).alias("spread"))
    return g.join(F.broadcast(wide), F.lit(True)).withColumn("warn", F.col("spread") > spread)


def _shares(g: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Non-negative scales s that bring o @ s nearest to 1 over all sets of active columns (few types)."""
    best, error = np.zeros(o.shape[1]), np.inf
    for mask in range(1, 1 << o.shape[1]):
        on = [k for k in range(o.shape[1]) if mask >> k & 1]
        s, *_ = np.linalg.lstsq(o[:, on], g, rcond=None)
        if (s >= 0).all() and (e := float(((o[:, on] @ s - g) ** 2).sum())) < error - 1e-15:
            best, error = np.zeros(o.shape[1]), e
            best[on] = s
    return best


def proportion_ensemble(rows: DataFrame, markers: DataFrame, *, draws: int = 100, size: int = 100, pool: int = 500, seed: int = 1) -> DataFrame:
    """draw, sample, cell, proportion: for each draw, hashed samples of each type's markers are averaged per sample in
    Spark; the small fit of one scale per type is solved for each draw, and shares are normalised."""
    first = markers.withColumn("_r", F.row_number().over(Window.partitionBy("cell").orderBy("rank", "gene"))).where(F.col("_r") <= pool).select("cell", "gene")
    each = first.select("cell", "gene", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    order = Window.partitionBy("draw", "cell").orderBy(F.xxhash64(F.lit(seed), "draw", "cell", "gene"))
    drawn = each.withColumn("_d", F.row_number().over(order)).where(F.col("_d") <= size)
    signal = rows.join(drawn, "gene").groupBy("draw", "sample", "cell").agg(F.avg("value").alias("value"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index="sample", columns="cell", values="value").fillna(0.0)
        o = wide.to_numpy(float) / np.maximum(1e-12, wide.to_numpy(float).mean(axis=0))
        p = o * _shares(np.ones(len(o)), o)
        p = p / np.maximum(1e-12, p.sum(axis=1, keepdims=True))
        out = pd.DataFrame(p, index=wide.index, columns=wide.columns).stack().rename("proportion").reset_index()
        return out.assign(draw=pdf["draw"].iloc[0])[["draw", "sample", "cell", "proportion"]]

    kinds = dict(signal.dtypes)
    return signal.groupBy("draw").applyInPandas(fit, f"draw int, sample {kinds['sample']}, cell {kinds['cell']}, proportion double")


def ensemble_summary(proportions: DataFrame) -> DataFrame:
    """sample, cell, mean, sd over draws."""
    return proportions.groupBy("sample", "cell").agg(F.avg("proportion").alias("mean"), F.stddev_samp("proportion").alias("sd"))


def burden_composition(values: DataFrame, part: str, burden: str, share: str, group: str = "condition") -> DataFrame:
    """Per part (of a composition): n, Spearman's rho of burden and share with p-value, the same of ranks less their
    group's mean rank (rho_partial), and both p-values adjusted over parts. ``values``: a row for each part and individual.
    Below five rows all are null."""
    rows = values.dropna(subset=[burden, share])
    marginal = spearman(rows, [part], burden, share, least=5)
    partial = partial_spearman(rows, [part], burden, share, group).select(part, F.when(F.col("n") >= 5, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round("partial_rho", 12)))).alias("rho_partial"))
    j = marginal.join(partial, part).withColumn("df", (F.col("n") - 2).cast("double"))
    r = F.col("rho_partial")
    t = F.when(F.abs(r) < 1, F.abs(r) * F.sqrt(F.col("df") / (1 - r * r)))
    j = j.withColumn("p_partial", F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(t_two_sided(t, F.col("df")))).drop("df")
    return benjamini_hochberg(benjamini_hochberg(j, "p_value", "fdr"), "p_partial", "fdr_partial")


def burden_contrast(values: DataFrame, burden: str) -> DataFrame:
    """One row: each condition's number of individuals and mean burden, the ratio of the means, Wilcoxon's p-value and the
    shift."""
    one = values.dropna(subset=[burden]).withColumn("all", F.lit(1))
    arm = lambda c: F.avg(F.when(F.col("condition") == c, F.col(burden))).alias(f"mean_{c}")
    means = one.groupBy("all").agg(arm("case"), arm("ref"))
    return group_comparison(one, "all", burden).select("all", "n_case", "n_ref", "p_value", "shift").join(means, "all").select("n_case", "n_ref", "mean_case", "mean_ref", F.try_divide("mean_case", "mean_ref").alias("ratio"), "shift", "p_value")
