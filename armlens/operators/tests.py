"""Two-condition tests over many groups at once: ranks and sums are shuffled by group, p-values are expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.special import lgamma_sql, two_sided_normal_sql
from ..functions.tails import chi2_upper, t_two_sided
from .ranks import benjamini_hochberg

#: Where either arm has at most so many and there are no ties, the test is exact.
EXACT_MAX = 8


#: Values of tables of the exact test that a task keeps: 64 MB.
TABLE_VALUES = 1 << 23
_TABLES: dict[tuple[int, int], np.ndarray] = {}


def exact_half(n1: int, n2: int) -> np.ndarray:
    """The exact two-sided p-value of each U from 0 to n1 * n2 / 2; it is the same for n1 * n2 - U.

    U is the sum of n1 parts of at most n2, so its counts are the coefficients of a Gaussian binomial: a product of
    (1 - x ** (n2 + k)) / (1 - x ** k). Only the lower half is tabulated, in floats: there the differences lose few digits
    (the relative error is below 1e-11 for n1 up to EXACT_MAX, as tested against whole numbers)."""
    key = min(n1, n2), max(n1, n2)
    if key in _TABLES:
        return _TABLES[key]
    n1, n2 = key
    half = n1 * n2 // 2
    counts = np.zeros(half + 1)
    counts[0] = 1
    for k in range(1, n1 + 1):
        if n2 + k <= half:
            counts[n2 + k :] -= counts[: half + 1 - n2 - k].copy()
        for r in range(min(k, half + 1)):
            counts[r::k] = np.add.accumulate(counts[r::k])
    p = np.minimum(1.0, 2 * np.add.accumulate(counts) / math.comb(n1 + n2, n1))
    if sum(map(len, _TABLES.values())) + len(p) > TABLE_VALUES:
        _TABLES.clear()
    _TABLES[key] = p
    return p


def exact_tail(n1: int, n2: int) -> list[float]:
    """The exact two-sided p-value of each U from 0 to n1 * n2."""
    p, top = exact_half(n1, n2), n1 * n2
    return [float(p[min(u, top - u)]) for u in range(top + 1)]


def _exact_p(n1: Column, n2: Column, u: Column) -> Column:
    """Exact p-values, null where the arguments are. An arm has at most EXACT_MAX values."""

    @F.pandas_udf("double")
    def of(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
        p = lambda a, b, x: exact_half(a, b)[min(x, a * b - x)]
        return pd.Series([p(int(a), int(b), int(round(x))) if x == x and x is not None else None for a, b, x in zip(n1, n2, u, strict=True)], dtype="float64")

    return of(n1, n2, u)


def _exact_where_small(tested: DataFrame) -> DataFrame:
    small = (F.least("n1", "n2") > 0) & (F.least("n1", "n2") <= EXACT_MAX) & (F.col("ties") == 0) & F.col("u_stat").isNotNull()
    exact = _exact_p(*[F.when(small, F.col(c).cast("double")) for c in ("n1", "n2", "u_stat")])
    return tested.withColumn("p_value", F.when(small, exact).otherwise(F.col("p_value")))


def _normal_p(sums: DataFrame) -> DataFrame:
    """u_stat, p_value, rbc from n1, n2, r1 (rank sum of the case arm) and ties (sum of t ** 3 - t)."""
    d = sums.withColumn("u_stat", F.expr("r1 - n1 * (n1 + 1) / 2e0"))
    d = d.withColumn("_s", F.expr("CASE WHEN n1 > 0 AND n2 > 0 THEN sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1) - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1)))) END"))
    d = d.withColumn("_z", F.expr("CASE WHEN _s > 0 THEN (greatest(u_stat, n1 * n2 - u_stat) - n1 * n2 / 2e0 - 0.5e0) / _s END"))
    upper = "(CASE WHEN _z >= 0 THEN " + two_sided_normal_sql("_z") + " ELSE 1e0 END)"
    return d.withColumn("p_value", F.expr(f"CASE WHEN _z IS NOT NULL THEN {upper} END")).withColumn("rbc", F.expr("CASE WHEN n1 > 0 AND n2 > 0 THEN 1 - 2 * u_stat / (n1 * n2) END")).drop("_s", "_z")


def mannwhitney_padded(totals: DataFrame, key: str, n1: int, n2: int, value: str = "total") -> DataFrame:
    """One value per individual and key, padded by zeros to the cohort's n1 cases and n2 references.

    The padding isn't made: values are not negative, so observed zeros and padding are one block of ties below all
    others, and the ranks of these are shifted by its size. Keys of which all values are zero get nulls.
    """
    case = F.col("condition") == "case"
    per = totals.groupBy(key, "condition").agg(F.count("*").alias("n"))
    seen = per.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("condition") == c, F.col("n"))), F.lit(0)).alias(f"n_{c}_observed") for c in ("case", "ref")])
    pos = totals.where(F.col(value) > 0)
    by, tie = Window.partitionBy(key), Window.partitionBy(key, value)
    ranked = pos.select(key, case.alias("c"), F.count("*").over(by).alias("m"), (F.rank().over(by.orderBy(value)) + (F.count("*").over(tie) - 1) / 2.0).alias("r"), F.count("*").over(tie).alias("t"))
    # Each of t equal values adds t ** 2 - 1, so all of them t ** 3 - t.
    sums = ranked.groupBy(key).agg(F.max("m").alias("m"), F.sum(F.when(F.col("c"), F.col("r"))).alias("r"), F.count_if("c").alias("k"), F.sum(F.col("t") * F.col("t") - 1).alias("ties"))
    z = F.lit(n1 + n2) - F.col("m")
    full = sums.select(
        key, F.lit(n1).alias("n1"), F.lit(n2).alias("n2"), (F.coalesce("r", F.lit(0.0)) + F.col("k") * z + (n1 - F.col("k")) * (z + 1) / 2.0).alias("r1"), (F.col("ties") + z * z * z - z).cast("double").alias("ties"),
    )
    tested = _normal_p(full)
    tested = _exact_where_small(tested) if min(n1, n2) <= EXACT_MAX else tested
    out = seen.join(tested.select(key, "u_stat", "p_value", "rbc"), key, "left")
    return out.withColumn("n_case_padded", F.greatest(F.lit(n1) - F.col("n_case_observed"), F.lit(0))).withColumn("n_ref_padded", F.greatest(F.lit(n2) - F.col("n_ref_observed"), F.lit(0)))


def mannwhitney_pooled(values: DataFrame, keys: list[str], value: str = "weighted") -> DataFrame:
    """Unpadded values of either arm; an empty arm gives nulls. ``higher_prop`` is the arm with the greater mean."""
    case = F.col("condition") == "case"
    by, tie = Window.partitionBy(*keys), Window.partitionBy(*keys, value)
    ranked = values.select(*keys, case.alias("c"), F.col(value).alias("v"), (F.rank().over(by.orderBy(value)) + (F.count("*").over(tie) - 1) / 2.0).alias("r"), F.count("*").over(tie).alias("t"))
    sums = ranked.groupBy(*keys).agg(F.count_if("c").alias("n1"), F.count_if(~F.col("c")).alias("n2"), F.sum(F.when(F.col("c"), F.col("r"))).alias("r1"), F.sum(F.col("t") * F.col("t") - 1).cast("double").alias("ties"), F.avg(F.when(F.col("c"), F.col("v"))).alias("m1"), F.avg(F.when(~F.col("c"), F.col("v"))).alias("m2"))
    tested = _exact_where_small(_normal_p(sums))
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    p = F.when(both, F.col("p_value"))
    higher = F.when(~both, F.when(F.col("n1") > 0, "case").otherwise("ref")).when(F.col("m1") > F.col("m2"), "case").otherwise("ref")
    return tested.select(*keys, F.when(both, F.col("u_stat")).alias("prop_u_stat"), p.alias("prop_p_value"), higher.alias("higher_prop"))


def welch_t(per_individual: DataFrame, keys: list[str], value: str = "proportion", *, extra: dict[str, Column] | None = None) -> DataFrame:
    """n, means, t_stat, df and p_value of Welch's test over carriers; arms of one, and equal means without variance,
    give nulls. ``extra``: further aggregates of the same rows, by name."""
    arm = {"case": F.col("condition") == "case", "ref": F.col("condition") == "ref"}
    g = per_individual.groupBy(*keys).agg(*[f(F.when(c, F.col(value))).alias(f"{n}_{k}") for k, c in arm.items() for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))], *[f.alias(n) for n, f in (extra or {}).items()])
    ok = "n_case > 1 AND n_ref > 1"
    a, b = "var_case / n_case", "var_ref / n_ref"
    g = g.withColumn("_se", F.expr(f"CASE WHEN {ok} THEN {a} + {b} END"))
    g = g.withColumn("t_stat", F.expr("CASE WHEN _se > 0 THEN (mean_case - mean_ref) / sqrt(_se) END"))
    g = g.withColumn("df", F.expr(f"CASE WHEN _se > 0 THEN _se * _se / (({a}) * ({a}) / (n_case - 1) + ({b}) * ({b}) / (n_ref - 1)) END"))
    none = F.expr(f"{ok} AND _se = 0 AND mean_case <> mean_ref")
    return g.withColumn("p_value", F.when(none, F.lit(0.0)).otherwise(t_two_sided("t_stat", "df"))).drop("_se")


def log_factorial_sql(n: str) -> str:
    return lgamma_sql(f"({n} + 1e0)")


def fisher_exact_sql(a: str, b: str, c: str, d: str) -> str:
    """Spark SQL: the two-sided p-value of a 2 x 2 table, as the sum of tables no likelier than it. For result tables of
    some tens of rows."""
    logp = lambda k: f"-({log_factorial_sql(k)}) - ({log_factorial_sql(f'({a} + {b} - {k})')}) - ({log_factorial_sql(f'({a} + {c} - {k})')}) - ({log_factorial_sql(f'({d} - {a} + {k})')})"
    const = f"({log_factorial_sql(f'({a} + {b})')}) + ({log_factorial_sql(f'({c} + {d})')}) + ({log_factorial_sql(f'({a} + {c})')}) + ({log_factorial_sql(f'({b} + {d})')}) - ({log_factorial_sql(f'({a} + {b} + {c} + {d})')})"
    seen = f"exp({const} + ({logp(a)}))"
    each = f"exp({const} + ({logp('k')}))"
    ks = f"sequence(greatest(0, {a} - {d}), least({a} + {b}, {a} + {c}))"
    return f"least(1e0, aggregate({ks}, 0e0, (s, k) -> s + CASE WHEN {each} <= {seen} * (1e0 + 1e-7) THEN {each} ELSE 0e0 END))"


def fisher_p(a: int, b: int, c: int, d: int) -> float:
    """The same of large tables: of all tables with these sums only those are made whose probability, over the likeliest
    one's, isn't 0 in doubles. Their number grows with the root of the counts; the others would add nothing."""
    n1, n2, k1 = a + b, c + d, a + c
    low, high = max(0, k1 - n2), min(n1, k1)
    g = math.lgamma
    log = lambda k: -g(k + 1) - g(n1 - k + 1) - g(k1 - k + 1) - g(n2 - k1 + k + 1)
    mode = min(max((n1 + 1) * (k1 + 1) // (n1 + n2 + 2), low), high)

    def edge(inside: int, outside: int) -> int:
        """The last table from the likeliest one to the end that isn't 0."""
        if log(outside) - log(mode) > -746:
            return outside
        while abs(outside - inside) > 1:
            middle = (inside + outside) // 2
            inside, outside = (middle, outside) if log(middle) - log(mode) > -746 else (inside, middle)
        return inside

    first, last = edge(mode, low), edge(mode, high)
    k = np.arange(first, last, dtype=float)
    steps = np.log(n1 - k) + np.log(k1 - k) - np.log(k + 1) - np.log(n2 - k1 + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    p = np.exp(logs - logs[mode - first])
    seen = p[a - first] if first <= a <= last else 0.0
    return float(min(1.0, p[p <= seen * (1 + 1e-7)].sum() / p.sum()))


@F.pandas_udf(DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """The two-sided p-value of each 2 x 2 table."""
    return pd.Series([fisher_p(*map(int, x)) for x in zip(a, b, c, d, strict=True)], dtype="float64")


def chi2_independence(counts: DataFrame, keys: list[str], row: str, column: str, n: str = "n") -> DataFrame:
    """chi2, dof, p_value, cramers_v per key. Empty rows and columns go; less than 2 x 2 is null; Yates' correction only
    at one degree of freedom."""
    w = lambda *c: F.sum(n).over(Window.partitionBy(*keys, *c))
    m = counts.withColumn("_r", w(row)).withColumn("_c", w(column)).withColumn("_n", w()).where("_r > 0 AND _c > 0")
    e = F.col("_r") * F.col("_c") / F.col("_n").cast("double")
    gap = F.abs(F.col(n) - e)
    g = m.groupBy(*keys).agg(F.count_distinct(row).alias("rows"), F.count_distinct(column).alias("columns"), F.sum(gap * gap / e).alias("x"), F.sum(F.pow(gap - F.least(gap, F.lit(0.5)), 2) / e).alias("y"), F.first("_n").alias("total"))
    dof = (F.col("rows") - 1) * (F.col("columns") - 1)
    some = (F.col("rows") > 1) & (F.col("columns") > 1)
    chi2 = F.when(some, F.when(dof == 1, F.col("y")).otherwise(F.col("x")))
    g = g.withColumn("chi2", chi2).withColumn("dof", F.when(some, dof))
    v = F.when(some, F.sqrt(F.col("chi2") / (F.col("total") * (F.least("rows", "columns") - 1))))
    return g.select(*keys, "chi2", "dof", v.alias("cramers_v")).withColumn("p_value", chi2_upper("chi2", "dof"))


def spearman(pairs: DataFrame, keys: list[str], x: str, y: str, least: int = 4) -> DataFrame:
    """n, rho and p_value (t with n - 2 degrees of freedom) per key; null below ``least`` rows or where either is constant."""
    by = Window.partitionBy(*keys)
    rank = lambda v: F.rank().over(by.orderBy(v)) + (F.count("*").over(Window.partitionBy(*keys, v)) - 1) / 2.0
    r = pairs.select(*keys, rank(x).alias("rx"), rank(y).alias("ry"))
    g = r.groupBy(*keys).agg(F.count("*").alias("n"), F.try_divide(F.covar_pop("rx", "ry"), F.stddev_pop("rx") * F.stddev_pop("ry")).alias("c0"), F.min("rx").alias("x0"), F.max("rx").alias("x1"), F.min("ry").alias("y0"), F.max("ry").alias("y1"))
    g = g.withColumn("c", F.round("c0", 12))  # so that 1 is 1
    ok = (F.col("n") >= least) & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    g = g.select(*keys, "n", F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c")))).alias("rho"))
    t = F.when(F.abs("rho") < 1, F.abs("rho") * F.sqrt((F.col("n") - 2) / (1 - F.col("rho") * F.col("rho"))))
    return g.withColumn("p_value", F.when(F.abs("rho") >= 1, F.lit(0.0)).otherwise(t_two_sided(t, (F.col("n") - 2).cast("double"))))


def fisher_z_difference(wide: DataFrame) -> DataFrame:
    """diff_pvalue and its adjustment from rho and n of both arms (rho_case, n_case, rho_ref, n_ref)."""
    ok = "n_case > 3 AND n_ref > 3 AND abs(rho_case) < 1 AND abs(rho_ref) < 1"
    z = wide.withColumn("_z", F.expr(f"CASE WHEN {ok} THEN (atanh(rho_case) - atanh(rho_ref)) / sqrt(1e0 / (n_case - 3) + 1e0 / (n_ref - 3)) END"))
    return benjamini_hochberg(z.withColumn("diff_pvalue", F.expr(f"CASE WHEN _z IS NOT NULL THEN {two_sided_normal_sql('_z')} END")).drop("_z"), "diff_pvalue", "diff_adj_pvalue")
