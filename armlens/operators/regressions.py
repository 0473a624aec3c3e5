"""Binomial regressions of many small groups: sites over their carriers, genes over a cohort.

Spark gathers each group's rows into arrays (a row for each individual, so a cohort's size bounds them) and tasks solve
whole Arrow batches of groups at once: groups of about the same size are stacked, every Newton step is one batched
solution of all systems, and groups that have settled are left out of the next step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import beta_inc
from .ranks import benjamini_hochberg
from .stored import dealt

#: Cells (rows times terms) that are stacked at once.
STACKED = 1 << 20

_erfc = np.vectorize(math.erfc, otypes=[float])


def _t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-values of Student's t; NaN where there is no degree of freedom."""
    out = np.full(len(t), np.nan)
    ok = (df > 0) & ~np.isnan(t)
    out[ok] = beta_inc(df[ok] / 2, np.full(ok.sum(), 0.5), df[ok] / (df[ok] + t[ok] ** 2))
    return out


def _chi2_one_upper(x: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(x), np.nan, _erfc(np.sqrt(np.maximum(np.nan_to_num(x), 0) / 2)))


def independent_columns(x: np.ndarray, used: np.ndarray, tol: float = 1e-7) -> np.ndarray:
    """Which columns of each (n, p) matrix aren't combinations of the columns before them, over its used rows."""
    left = np.where(used[:, :, None], x, 0.0)
    size = np.sqrt((left**2).sum(axis=1))
    ok = np.zeros(size.shape, bool)
    for j in range(x.shape[2]):
        norm = np.sqrt((left[:, :, j] ** 2).sum(axis=1))
        ok[:, j] = norm > tol * np.maximum(size[:, j], 1e-300)
        unit = np.where(ok[:, j, None], left[:, :, j] / np.where(norm > 0, norm, 1)[:, None], 0.0)
        for _ in range(2):
            left[:, :, j + 1 :] -= unit[:, :, None] * np.einsum("sn,snk->sk", unit, left[:, :, j + 1 :])[:, None, :]
    return ok


def _solve(info: np.ndarray, score: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Batched solutions; columns that aren't ``ok`` get nought."""
    a = np.where(ok[:, :, None] & ok[:, None, :], info, 0.0)
    d = np.arange(a.shape[1])
    a[:, d, d] = np.where(ok, a[:, d, d], 1.0)
    scale = 1 / np.sqrt(np.maximum(a[:, d, d], 1e-300))
    scaled = a * scale[:, :, None] * scale[:, None, :]
    scaled[:, d, d] += 1e-14
    return np.linalg.solve(scaled, (np.where(ok, score, 0.0) * scale)[:, :, None])[:, :, 0] * scale


def _inverse(info: np.ndarray, ok: np.ndarray) -> np.ndarray:
    p = info.shape[1]
    return np.stack([_solve(info, np.broadcast_to(np.eye(p)[j], (len(info), p)), ok) for j in range(p)], axis=2)


def binomial_glm(x: np.ndarray, y: np.ndarray, m: np.ndarray, *, steps: int = 25, tol: float = 1e-8) -> dict[str, np.ndarray]:
    """Maximum likelihood of y successes in m trials on x (groups, rows, terms), by iteratively reweighted least squares.

    Rows with m = 0 count for nothing. Returns b, se (for dispersion 1), fitted, converged, pearson (dispersion), df and
    ok (terms that are estimated; others are combinations of terms before them)."""
    used = m > 0
    ok, share = independent_columns(x, used), y / np.maximum(m, 1)
    eta = np.log((y + 0.5) / (m - y + 0.5))
    b = np.zeros((len(x), x.shape[2]))
    converged, before = np.zeros(len(x), bool), np.full(len(x), np.inf)
    open_ = np.arange(len(x))
    for _ in range(steps):
        xs, mu = x[open_], 1 / (1 + np.exp(-np.clip(eta[open_], -700, 700)))
        v = np.maximum(mu * (1 - mu), 1e-300)
        w = m[open_] * v
        z = eta[open_] + (share[open_] - mu) / np.maximum(v, 1e-15)
        info, score = np.einsum("snj,sn,snk->sjk", xs, w, xs), np.einsum("snj,sn->sj", xs, w * z)
        b[open_] = _solve(info, score, ok[open_])
        eta[open_] = np.where(used[open_], np.einsum("snj,sj->sn", xs, b[open_]), 0.0)
        now = _deviance(y[open_], m[open_], eta[open_])
        settled = np.abs(now - before[open_]) / (np.abs(now) + 0.1) < tol
        before[open_] = now
        converged[open_[settled]] = True
        open_ = open_[~settled]
        if not len(open_):
            break
    mu = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
    w = m * np.maximum(mu * (1 - mu), 1e-300)
    cov = _inverse(np.einsum("snj,sn,snk->sjk", x, w, x), ok)
    df = used.sum(axis=1) - ok.sum(axis=1)
    pearson = np.where(used, (y - m * mu) ** 2 / np.maximum(w, 1e-300), 0.0).sum(axis=1) / np.where(df > 0, df, np.nan)
    d = np.arange(x.shape[2])
    return {"b": b, "se": np.sqrt(np.maximum(cov[:, d, d], 0)), "fitted": np.where(used, mu, 0.5), "converged": converged, "pearson": pearson, "df": df, "ok": ok}


def _deviance(y: np.ndarray, m: np.ndarray, eta: np.ndarray) -> np.ndarray:
    """Twice the log-likelihood's distance from a perfect fit's."""
    log_p, log_q = -np.logaddexp(0, -eta), -np.logaddexp(0, eta)
    with np.errstate(divide="ignore", invalid="ignore"):
        best = np.where(y > 0, y * np.log(y / np.maximum(m, 1)), 0.0) + np.where(m - y > 0, (m - y) * np.log((m - y) / np.maximum(m, 1)), 0.0)
    return 2 * (best - y * log_p - (m - y) * log_q).sum(axis=1)


def firth(x: np.ndarray, y: np.ndarray, used: np.ndarray, free: np.ndarray, *, steps: int = 200, tol: float = 1e-9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """b, penalised log-likelihood and convergence of logistic regression with Jeffreys' penalty.

    ``free``: the terms that are fitted; others stay 0, but the penalty is that of all terms, so two such fits are
    nested. Groups whose terms are not independent are NaN."""
    full = independent_columns(x, used).all(axis=1)
    s, p = len(x), x.shape[2]
    b, ok = np.zeros((s, p)), np.ones((s, p), bool)

    def at(b: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        eta = np.einsum("snj,sj->sn", x[k], b)
        mu = 1 / (1 + np.exp(-np.clip(eta, -500, 500)))
        w = np.where(used[k], np.maximum(mu * (1 - mu), 1e-300), 0.0)
        info = np.einsum("snj,sn,snk->sjk", x[k], w, x[k])
        log_p = np.where(used[k], -np.where(y[k] > 0, np.logaddexp(0, -eta), np.logaddexp(0, eta)), 0.0).sum(axis=1)
        return mu, w, info, log_p + 0.5 * np.linalg.slogdet(info)[1]

    like, converged = np.full(s, -np.inf), np.zeros(s, bool)
    open_ = np.flatnonzero(full)
    if len(open_):
        like[open_] = at(b[open_], open_)[3]
    for _ in range(steps):
        if not len(open_):
            break
        mu, w, info, _ = at(b[open_], open_)
        hat = w * np.einsum("snj,sjk,snk->sn", x[open_], _inverse(info, ok[open_]), x[open_])
        score = np.einsum("snj,sn->sj", x[open_], np.where(used[open_], y[open_] - mu + hat * (0.5 - mu), 0.0))
        step = _solve(info, score, np.broadcast_to(free, (len(open_), p)))
        step *= np.minimum(1.0, 5 / np.maximum(np.abs(step).max(axis=1), 1e-300))[:, None]
        new = b[open_] + step
        found = at(new, open_)[3]
        for _ in range(30):  # half steps while the likelihood would fall
            worse = found < like[open_] - 1e-12
            if not worse.any():
                break
            step[worse] /= 2
            new[worse] = b[open_][worse] + step[worse]
            found[worse] = at(new[worse], open_[worse])[3]
        b[open_], like[open_] = new, found
        settled = (np.abs(step).max(axis=1) < tol) | (np.abs(np.where(free, score, 0)).max(axis=1) < tol)
        converged[open_[settled]] = True
        open_ = open_[~settled]
    b[~full], like[~full] = np.nan, np.nan
    return b, like, converged


def _batched(groups: DataFrame, solve: Callable[[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch], dict[str, np.ndarray]], columns: int, keys: list[str], out: dict[str, str]) -> DataFrame:
    """``groups``: keys and ``rows`` (array of arrays of doubles, all ``columns`` long). ``solve`` gets the stacked rows
    (groups, rows, columns), which of them are there, how many each group has, and returns a column of each of ``out``."""
    kinds = dict(groups.dtypes)
    shown = [c for c in groups.columns if c != "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            n = rows.value_lengths().to_numpy()
            flat = rows.flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)
            begin = np.concatenate([[0], n.cumsum()])
            order, at = np.argsort(n, kind="stable"), 0
            while at < len(order):
                # Of rising sizes as many as fit, and none of less than half the largest.
                end = at + 1
                while end < len(order) and n[order[end]] * (end + 1 - at) * columns <= STACKED and n[order[end]] <= 2 * n[order[at]] + 8:
                    end += 1
                some = order[at:end]
                most = int(n[some].max())
                place = begin[some][:, None] + np.arange(most)
                there = np.arange(most) < n[some][:, None]
                stacked = np.where(there[:, :, None], flat[np.where(there, place, 0)], 0.0)
                found = solve(stacked, there, n[some], batch)
                part = batch.select(shown).take(pa.array(some))
                types = {"double": pa.float64(), "boolean": pa.bool_(), "long": pa.int64()}
                arrays = [pa.array(found[c], types[t], from_pandas=True) for c, t in out.items()]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*shown, *out])
                at = end

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in shown] + [f"`{c}` {t}" for c, t in out.items()])
    return groups.mapInArrow(run, schema)


def _attenuation(b0: Column, b1: Column) -> Column:
    """By how many per cent a coefficient shrinks; null where there is next to nothing that could."""
    return F.when(F.abs(b0) >= 1e-3, 100 * (1 - F.abs(b1) / F.abs(b0)))


def adjusted_site_models(rows: DataFrame, keys: list[str], terms: list[str], *, min_n: int = 20, parts: int = 64) -> DataFrame:
    """Per site a quasi-binomial model of alternate (a1_ad) against other reads (dp) on is_case alone, and with further
    terms (composition): coefficients of is_case, their p-values by t, whether the site is at a boundary, by how many per
    cent the coefficient shrinks, and p-values adjusted over sites that aren't at one.

    Rows without depth, or with a null among the terms, don't count. Sites with fewer than ``min_n`` rows, or rows of one
    condition only, are left out before. At a boundary are sites whose fit doesn't settle, has a share within 1e-8 of 0 or
    1, or a coefficient beyond 10. ``parts``: adjusted p-values are ranked by ranges, as there may be millions of sites."""
    kept = rows.where("dp > 0 AND a1_ad IS NOT NULL").dropna(subset=["is_case", *terms])
    values = F.array(*[F.col(c).cast("double") for c in ("a1_ad", "dp", "is_case", *terms)])
    case = F.count_if(F.col("is_case") == 1)
    g = kept.groupBy(*keys).agg(F.count("*").alias("n"), case.alias("n_case"), F.array_sort(F.collect_list(values)).alias("rows"))
    g = g.where((F.col("n") >= min_n) & (F.col("n_case") > 0) & (F.col("n_case") < F.col("n"))).drop("n_case")

    def solve(r: np.ndarray, there: np.ndarray, n: np.ndarray, _) -> dict[str, np.ndarray]:
        y, m, one = np.minimum(r[:, :, 0], r[:, :, 1]), r[:, :, 1], there.astype(float)
        x = np.concatenate([one[:, :, None], r[:, :, 2:]], axis=2)
        out, at_bound = {}, np.zeros(len(r), bool)
        for name, design in (("naive", x[:, :, :2]), ("comp", x)):
            f = binomial_glm(design, y, m)
            at_bound |= ~f["converged"] | ((f["fitted"] < 1e-8) | (f["fitted"] > 1 - 1e-8)).any(axis=1) | (np.abs(f["b"]) > 10).any(axis=1)
            known = f["ok"][:, 1]
            se = f["se"][:, 1] * np.sqrt(f["pearson"])
            out[f"beta_{name}"] = np.where(known, f["b"][:, 1], np.nan)
            with np.errstate(divide="ignore", invalid="ignore"):
                out[f"p_{name}"] = _t_two_sided(np.where(known & (se > 0), f["b"][:, 1] / se, np.nan), f["df"].astype(float))
        return out | {"boundary": at_bound}

    found = _batched(g, solve, 3 + len(terms), keys, {"beta_naive": "double", "p_naive": "double", "beta_comp": "double", "p_comp": "double", "boundary": "boolean"})
    found = found.withColumn("pct_attenuation", _attenuation(F.col("beta_naive"), F.col("beta_comp")))
    for name in ("naive", "comp"):
        p = f"_p_{name}"
        found = benjamini_hochberg(found.withColumn(p, F.when(~F.col("boundary"), F.col(f"p_{name}"))), p, f"fdr_{name}", parts=parts).drop(p)
    return found.select(*keys, "n", "boundary", "beta_naive", "p_naive", "beta_comp", "p_comp", "pct_attenuation", "fdr_naive", "fdr_comp")


def call_models(rows: DataFrame, key: str, terms: list[str], *, estimator: str = "firth", min_carriers: int = 5, parts: int | None = 64) -> DataFrame:
    """Per key (gene), presence of any call in an individual on is_case by three nested models: alone (naive), with
    ``terms`` (comp), and with log2 of expression + 1 and of library size as well (det).

    ``rows``: key, is_case, present (0 or 1), expression, lib_size and the terms, a row for each individual. Keys with
    fewer than ``min_carriers`` on either side are left out.

    ``firth``: penalised likelihood; p-values compare it with the fit that has the coefficient at 0 under the same
    penalty, by chi-squared. ``ml``: maximum likelihood with Wald's p-values, and ``separated`` where a fitted share is
    within 1e-6 of 0 or 1 or a coefficient is beyond 20; these keys take no part in the adjustment. det is null where
    expression doesn't vary; a model whose terms depend on each other is null under firth and loses the later ones under
    ml. ``parts``: adjusted p-values are ranked by ranges, as there may be millions of keys."""
    kept = rows.dropna(subset=[key, "is_case", "present", "expression", "lib_size", *terms])
    values = F.array(*[F.col(c).cast("double") for c in ("present", "is_case", *terms)], F.log2(F.col("expression") + 1), F.log2("lib_size"))
    groups = kept.groupBy(key).agg(F.min("expression").cast("double").alias("min_expression"), F.array_sort(F.collect_list(values)).alias("rows"))
    return _nested_models(groups, key, terms, estimator, min_carriers, parts)


def cohort_call_models(carriers: DataFrame, expression: DataFrame, cohort: DataFrame, key: str, terms: list[str], *, individual: str = "individualID", estimator: str = "firth", min_carriers: int = 5, parts: int | None = 64) -> DataFrame:
    """``call_models`` of all keys of ``carriers`` (key, individual) over the whole ``cohort`` (individual, is_case, lib_size
    and the terms), with ``expression`` (key, individual, expression); what is absent is 0.

    A key's rows are filled up from the cohort where it is modelled: the cohort is one row that goes along with each key,
    and no grid of keys and individuals is joined."""
    need = ["is_case", "lib_size", *terms]
    one = cohort.dropna(subset=[individual, *need]).dropDuplicates([individual]).agg(F.array_sort(F.collect_list(F.struct(individual, *need))).alias("_cohort"))
    # Both are dealt by key into one number of partitions, so they meet without a further shuffle.
    size = max(carriers.count(), expression.count())
    seen = dealt(carriers.select(key, individual), size, key).distinct().groupBy(key).agg(F.collect_list(individual).alias("_present"))
    amounts = dealt(expression.select(key, individual, "expression"), size, key).groupBy(key, individual).agg(F.sum("expression").cast("double").alias("e")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(individual, "e"))).alias("_amount"))
    # One row: it is as long as a single key's rows have to be.
    met = seen.join(amounts, key, "left").join(F.broadcast(one), F.lit(True))
    of = lambda i: F.coalesce(F.try_element_at("_amount", i[individual]), F.lit(0.0))
    row = lambda i: F.array(F.array_contains("_present", i[individual]).cast("double"), i["is_case"].cast("double"), *[i[t].cast("double") for t in terms], F.log2(of(i) + 1), F.log2(i["lib_size"]))
    groups = met.select(key, F.array_min(F.transform("_cohort", of)).alias("min_expression"), F.array_sort(F.transform("_cohort", row)).alias("rows"))
    return _nested_models(groups, key, terms, estimator, min_carriers, parts)


def _nested_models(groups: DataFrame, key: str, terms: list[str], estimator: str, min_carriers: int, parts: int | None) -> DataFrame:
    if estimator not in ("firth", "ml"):
        raise ValueError(f"estimator {estimator!r} is neither firth nor ml")
    count = lambda test: F.size(F.filter("rows", test)).cast("long")
    g = groups.select(
        key, F.size("rows").cast("long").alias("n"), count(lambda r: r[0] == 1).alias("n_carriers"), count(lambda r: (r[0] == 1) & (r[1] == 1)).alias("n_carriers_case"),
        count(lambda r: (r[0] == 1) & (r[1] == 0)).alias("n_carriers_ref"), "min_expression", "rows",
    )
    g = g.where((F.col("n_carriers") >= min_carriers) & (F.col("n") - F.col("n_carriers") >= min_carriers))

    def solve(r: np.ndarray, there: np.ndarray, n: np.ndarray, _) -> dict[str, np.ndarray]:
        y = r[:, :, 0]
        x = np.concatenate([there.astype(float)[:, :, None], r[:, :, 1:]], axis=2)
        spread = np.where(there, r[:, :, -2], -np.inf).max(axis=1) > np.where(there, r[:, :, -2], np.inf).min(axis=1)
        out, separated = {}, np.zeros(len(r), bool)
        for name, p in (("naive", 2), ("comp", 2 + len(terms)), ("det", 4 + len(terms))):
            design, fits = x[:, :, :p], spread if name == "det" else np.ones(len(r), bool)
            if estimator == "firth":
                b, like, done = firth(design, y, there, np.ones(p, bool))
                _, null, null_done = firth(design, y, there, np.arange(p) != 1)
                known = done & null_done & fits
                beta, prob = b[:, 1], _chi2_one_upper(2 * (like - null))
            else:
                f = binomial_glm(design, y, there.astype(float))
                known = f["ok"][:, 1] & fits
                beta = f["b"][:, 1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    prob = _chi2_one_upper((beta / f["se"][:, 1]) ** 2)
                separated |= fits & (((f["fitted"] < 1e-6) | (f["fitted"] > 1 - 1e-6)).any(axis=1) | (np.abs(f["b"]) > 20).any(axis=1))
            out[f"beta_{name}"], out[f"p_{name}"] = np.where(known, beta, np.nan), np.where(known, prob, np.nan)
        return out | {"separated": separated}

    found = _batched(g, solve, 4 + len(terms), [key], {f"{c}_{m}": "double" for m in ("naive", "comp", "det") for c in ("beta", "p")} | {"separated": "boolean"})
    found = found.withColumn("estimator", F.lit(estimator)).withColumn("att_comp", _attenuation(F.col("beta_naive"), F.col("beta_comp"))).withColumn("att_det", _attenuation(F.col("beta_naive"), F.col("beta_det")))
    for name in ("naive", "comp", "det"):
        p = f"_p_{name}"
        found = benjamini_hochberg(found.withColumn(p, F.when(~F.col("separated"), F.col(f"p_{name}"))), p, f"fdr_{name}", parts=parts).drop(p)
    return found


def model_summary(models: DataFrame, naive: str, adjusted: list[str], attenuations: list[str], excluded: str, *, alpha: float = 0.05) -> DataFrame:
    """One row: how many groups were fitted, excluded, significant by each model, and the median attenuations over all and
    over the naively significant ones (which are selected on the very effect they divide by)."""
    used, sig = ~F.col(excluded), ~F.col(excluded) & (F.col(naive) < alpha)
    medians = [F.percentile(F.when(w, F.col(a)), 0.5).alias(f"median_{a}{s}") for a in attenuations for w, s in ((used, ""), (sig, "_significant"))]
    return models.agg(F.count("*").alias("n_fitted"), F.count_if(F.col(excluded)).alias("n_excluded"), F.count_if(sig).alias("n_naive"), *[F.count_if(used & (F.col(a) < alpha)).alias(f"n_{a.removeprefix('fdr_')}") for a in adjusted], *medians)
