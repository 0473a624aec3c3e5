"""Tails of Student's t, F and chi-squared distributions, vectorised over Arrow batches.

Only small result tables (a row for each test) pass through here, after all grouping is done in Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """The regularised incomplete beta function by Lentz's continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    y = np.clip(y, 0.0, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
    front = np.where(y <= 0, 0.0, front)
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps):
        for even in (True, False):
            t = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)) if even else -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
            d, c = 1 + t * d, 1 + t / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
    out = front * h
    return np.where(swap, 1 - out, out)


def gamma_q(a: np.ndarray, x: np.ndarray, steps: int = 400) -> np.ndarray:
    """The regularised upper incomplete gamma function."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    safe = np.maximum(x, 1e-300)
    front = np.exp(a * np.log(safe) - safe - _lgamma(a))
    term = 1 / a
    series = term.copy()
    for n in range(1, steps):
        term = term * safe / (a + n)
        series = series + term
    b = safe + 1 - a
    c, d = np.full_like(b, 1e300), 1 / b
    h = d.copy()
    for n in range(1, steps):
        an = -n * (n - a)
        b = b + 2
        d = 1 / (an * d + b)
        c = b + an / c
        h = h * d * c
    return np.where(x <= 0, 1.0, np.where(x < a + 1, 1 - front * series, front * h))


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(|T| >= |t|); null where t or df is null."""
    ok = t.notna() & df.notna()
    out = pd.Series(np.nan, index=t.index)
    if ok.any():
        tv, dv = t[ok].to_numpy(float), df[ok].to_numpy(float)
        out[ok] = np.where(np.isinf(tv), 0.0, beta_inc(dv / 2, 0.5, dv / (dv + np.where(np.isinf(tv), 0, tv) ** 2)))
    return out.astype(object).where(ok, None)


@F.pandas_udf(DoubleType())
def f_upper(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    ok = f.notna() & d1.notna() & d2.notna()
    out = pd.Series(np.nan, index=f.index)
    if ok.any():
        fv, a, b = (s[ok].to_numpy(float) for s in (f, d1, d2))
        out[ok] = beta_inc(b / 2, a / 2, b / (b + a * fv))
    return out.astype(object).where(ok, None)


@F.pandas_udf(DoubleType())
def chi2_upper(x: pd.Series, dof: pd.Series) -> pd.Series:
    ok = x.notna() & dof.notna()
    out = pd.Series(np.nan, index=x.index)
    if ok.any():
        out[ok] = gamma_q(dof[ok].to_numpy(float) / 2, x[ok].to_numpy(float) / 2)
    return out.astype(object).where(ok, None)
