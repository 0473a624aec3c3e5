from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from armlens.operators import deconvolution, models, regressions


def dense_glm(x, y, m):
    """Newton's method on the log-likelihood of one group; coefficients, covariance and Pearson's dispersion."""
    b = np.zeros(x.shape[1])
    for _ in range(200):
        mu = 1 / (1 + np.exp(-x @ b))
        w = m * mu * (1 - mu)
        step = np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (y - m * mu))
        b = b + step * min(1, 2 / max(1e-300, abs(step).max()))
        if abs(step).max() < 1e-13:
            break
    mu = 1 / (1 + np.exp(-x @ b))
    w = m * mu * (1 - mu)
    return b, np.linalg.inv(x.T @ (x * w[:, None])), ((y - m * mu) ** 2 / w).sum() / (len(y) - x.shape[1])


def t_tail(t, df, steps=200_000):
    """Two-sided, by summing the density."""
    u = (np.arange(steps) + 0.5) / steps * math.pi / 2  # x = |t| + tan(u)
    x = abs(t) + np.tan(u)
    density = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi) * (1 + x * x / df) ** (-(df + 1) / 2)
    return 2 * (density / np.cos(u) ** 2).sum() * math.pi / 2 / steps


def adjusted(p):
    p = np.asarray(p, float)
    order = np.argsort(p)
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    out = np.empty(len(p))
    out[order] = np.minimum(1, q)
    return out


@pytest.fixture(scope="module")
def sites():
    rng = np.random.default_rng(5)
    rows = []
    for site in range(14):
        n = 24 + 3 * site
        case, t1, t2 = np.arange(n) % 2, rng.normal(size=n), rng.random(n)
        dp = rng.integers(20, 300, n)
        mu = 1 / (1 + np.exp(-(-1 + 0.5 * case * (site % 3) + 0.4 * t1)))
        ad = rng.binomial(dp, np.clip(mu + rng.normal(size=n) * 0.03, 0.01, 0.99))
        rows += [(f"s{site}", int(c), int(a), int(d), float(x), float(z)) for c, a, d, x, z in zip(case, ad, dp, t1, t2, strict=True)]
    return rows


SITE = "site string, is_case int, a1_ad long, dp long, t1 double, t2 double"


def test_site_models_against_dense_fits(spark, sites):
    # One arm without alternate reads; too few rows; one condition only; rows without depth or with a null term.
    odd = [("bound", k % 2, 0 if k % 2 else 9, 40, 0.1 * k, 1.0 / (k + 1)) for k in range(30)] + [("few", k % 2, 3, 9, 0.0, 0.0) for k in range(8)] + [("one", 1, 3, 9, 0.1 * k, 0.2) for k in range(40)]
    odd += [("s0", 1, 0, 0, 5.0, 5.0), ("s0", 1, 4, 9, None, 5.0), ("s1", None, 4, 9, 1.0, 5.0)]
    # A term that is a sum of the others changes nothing.
    df = spark.createDataFrame(sites + odd, SITE).repartition(3)
    out = {r["site"]: r for r in regressions.adjusted_site_models(df, ["site"], ["t1", "t2"], min_n=20).collect()}
    assert set(out) == {f"s{k}" for k in range(14)} | {"bound"} and out["bound"]["boundary"] and out["bound"]["fdr_naive"] is None
    names = [f"s{k}" for k in range(14)]
    p = {"naive": [], "comp": []}
    for name in names:
        r = np.array([x[1:] for x in sites if x[0] == name], float)
        one = np.ones(len(r))
        for model, x in (("naive", np.column_stack([one, r[:, 0]])), ("comp", np.column_stack([one, r[:, 0], r[:, 3:]]))):
            b, cov, phi = dense_glm(x, r[:, 1], r[:, 2])
            assert out[name][f"beta_{model}"] == pytest.approx(b[1], rel=1e-6, abs=1e-9)
            want = t_tail(b[1] / math.sqrt(cov[1, 1] * phi), len(r) - x.shape[1])
            assert out[name][f"p_{model}"] == pytest.approx(want, rel=2e-4, abs=1e-12)
            p[model].append(out[name][f"p_{model}"])
        assert out[name]["n"] == len(r) and not out[name]["boundary"]
        assert out[name]["pct_attenuation"] == pytest.approx(100 * (1 - abs(out[name]["beta_comp"]) / abs(out[name]["beta_naive"])))
    for model, values in p.items():
        assert [out[n][f"fdr_{model}"] for n in names] == pytest.approx(list(adjusted(values)))


def test_dependent_terms_are_left_out(spark, sites):
    df = spark.createDataFrame(sites, SITE).selectExpr("*", "t1 + 2 * is_case AS t3")
    a = {r["site"]: r for r in regressions.adjusted_site_models(df, ["site"], ["t1", "t3"]).collect()}
    b = {r["site"]: r for r in regressions.adjusted_site_models(df, ["site"], ["t1"]).collect()}
    for k, r in b.items():
        assert a[k]["beta_comp"] == pytest.approx(r["beta_comp"], rel=1e-6) and a[k]["p_comp"] == pytest.approx(r["p_comp"], rel=1e-5)
    assert regressions.adjusted_site_models(df.limit(0), ["site"], ["t1"]).count() == 0


def penalised(x, y, b):
    mu = 1 / (1 + np.exp(-x @ b))
    return (y * np.log(mu) + (1 - y) * np.log(1 - mu)).sum() + 0.5 * np.linalg.slogdet(x.T @ (x * (mu * (1 - mu))[:, None]))[1]


def climb(x, y, free):
    """The greatest penalised likelihood by a pattern search, which needs no derivative."""
    b, step = np.zeros(x.shape[1]), 1.0
    best = penalised(x, y, b)
    while step > 1e-7:
        moved = False
        for j in free:
            for s in (step, -step):
                c = b.copy()
                c[j] += s
                if (v := penalised(x, y, c)) > best + 1e-15:
                    b, best, moved = c, v, True
        step *= 1 if moved else 0.5
    return b, best


def chi2_tail(x):
    return math.erfc(math.sqrt(max(0.0, x) / 2))


@pytest.fixture(scope="module")
def genes():
    rng = np.random.default_rng(8)
    n = 30
    case, t1, lib = np.arange(n) % 2, rng.normal(size=n), rng.integers(10**6, 10**7, n)
    rows = []
    for g in range(6):
        expression = rng.lognormal(2, 1, n) if g != 4 else np.full(n, 3.0)
        present = (rng.random(n) < 1 / (1 + np.exp(-(0.3 + (g - 2) * case + 0.5 * t1)))).astype(int)
        if g == 5:
            present = case  # separated
        rows += [(f"g{g}", int(c), int(p), float(e), int(v), float(t)) for c, p, e, v, t in zip(case, present, expression, lib, t1, strict=True)]
    return rows + [("few", int(k % 2), int(k == 0), 1.0 + k, 10**6, 0.1 * k) for k in range(n)]


GENE = "gene string, is_case int, present int, expression double, lib_size long, t1 double"


def test_penalised_models_against_a_search(spark, genes):
    out = {r["gene"]: r for r in regressions.call_models(spark.createDataFrame(genes, GENE).repartition(2), "gene", ["t1"]).collect()}
    assert set(out) == {f"g{k}" for k in range(6)}
    for name, got in out.items():
        r = np.array([x[1:] for x in genes if x[0] == name], float)
        one, y = np.ones(len(r)), r[:, 1]
        full = np.column_stack([one, r[:, 0], r[:, 4], np.log2(r[:, 2] + 1), np.log2(r[:, 3])])
        assert got["n"] == 30 and got["n_carriers"] == y.sum() and got["n_carriers_case"] == (y * r[:, 0]).sum() and got["min_expression"] == r[:, 2].min()
        assert not got["separated"] and got["estimator"] == "firth"
        for model, p in (("naive", 2), ("comp", 3)):
            x = full[:, :p]
            b, best = climb(x, y, range(p))
            _, null = climb(x, y, [j for j in range(p) if j != 1])
            assert got[f"beta_{model}"] == pytest.approx(b[1], abs=1e-5)
            assert got[f"p_{model}"] == pytest.approx(chi2_tail(2 * (best - null)), abs=1e-6)
        assert (got["beta_det"] is None) == (name == "g4")
    # Of two groups the penalised odds ratio adds a half to each cell.
    assert out["g5"]["beta_naive"] == pytest.approx(2 * math.log(15.5 / 0.5), rel=1e-6)
    names = sorted(out)
    assert [out[n]["fdr_naive"] for n in names] == pytest.approx(list(adjusted([out[n]["p_naive"] for n in names])))
    summary = regressions.model_summary(regressions.call_models(spark.createDataFrame(genes, GENE), "gene", ["t1"]), "fdr_naive", ["fdr_comp", "fdr_det"], ["att_comp", "att_det"], "separated").first()
    assert summary["n_fitted"] == 6 and summary["n_excluded"] == 0 and summary["n_naive"] == sum(out[n]["fdr_naive"] < 0.05 for n in names)


def test_models_of_a_cohort_fill_up_absent_rows(spark, genes):
    """Only carriers and expressed rows are given; the rest comes from the cohort."""
    rows = [(g, k % 30, *r) for k, (g, *r) in enumerate(genes)]
    rows = [(g, i, c, p, 0.0 if i % 7 == 3 else e, v, t) for g, i, c, p, e, v, t in rows]
    df = spark.createDataFrame(rows, "gene string, individualID int, is_case int, present int, expression double, lib_size long, t1 double")
    want = {r["gene"]: r for r in regressions.call_models(df, "gene", ["t1"]).collect()}
    one = df.where("gene = 'g0'").select("individualID", "is_case", "lib_size", "t1")
    same = [n for n in want if n != "few"]
    got = {r["gene"]: r for r in regressions.cohort_call_models(df.where("present = 1"), df.where("expression > 0").select("gene", "individualID", "expression"), one, "gene", ["t1"]).collect()}
    assert set(got) == set(same)
    for n in same:
        assert {k: pytest.approx(v, rel=1e-6) if isinstance(v, float) else v for k, v in want[n].asDict().items()} == got[n].asDict()


def test_separated_genes_leave_the_family_of_maximum_likelihood(spark, genes):
    out = {r["gene"]: r for r in regressions.call_models(spark.createDataFrame(genes, GENE), "gene", [], estimator="ml").collect()}
    assert out["g5"]["separated"] and out["g5"]["fdr_naive"] is None
    rest = [n for n in sorted(out) if not out[n]["separated"]]
    assert len(rest) >= 3 and [out[n]["fdr_naive"] for n in rest] == pytest.approx(list(adjusted([out[n]["p_naive"] for n in rest])))
    for name in rest:
        r = np.array([x[1:] for x in genes if x[0] == name], float)
        b, cov, _ = dense_glm(np.column_stack([np.ones(30), r[:, 0]]), r[:, 1], np.ones(30))
        assert out[name]["beta_naive"] == pytest.approx(b[1], rel=1e-6) and out[name]["p_naive"] == pytest.approx(chi2_tail(b[1] ** 2 / cov[1, 1]), rel=1e-5)
    with pytest.raises(ValueError):
        regressions.call_models(spark.createDataFrame(genes, GENE), "gene", [], estimator="other")


def by_subsets(a, y):
    """Every set of columns is tried."""
    best, error = np.zeros(a.shape[1]), float(y @ y)
    for size in range(1, a.shape[1] + 1):
        for on in itertools.combinations(range(a.shape[1]), size):
            s = np.linalg.lstsq(a[:, on], y, rcond=None)[0]
            if (s >= 0).all() and (e := float(((a[:, on] @ s - y) ** 2).sum())) < error - 1e-12:
                best, error = np.zeros(a.shape[1]), e
                best[list(on)] = s
    return best, error


@pytest.mark.parametrize("seed", range(12))
def test_non_negative_least_squares_against_all_subsets(seed):
    rng = np.random.default_rng(seed)
    a = rng.lognormal(size=(20, 6)) * 10.0 ** rng.integers(-3, 4, 6)
    if seed % 3 == 1:
        a[:, 3] = a[:, 1] + a[:, 2]  # two ways to the same error
    if seed % 3 == 2:
        a[:, 5] = 0
    y = np.ones(20) if seed % 2 else rng.normal(size=20)
    x, (want, error) = deconvolution.non_negative_least_squares(a, y), by_subsets(a, y)
    assert (x >= 0).all() and ((a @ x - y) ** 2).sum() <= error * (1 + 1e-8) + 1e-12
    if seed % 3 != 1:
        assert np.allclose(x * np.linalg.norm(a, axis=0), want * np.linalg.norm(a, axis=0), atol=1e-7)


def mixture(types=3, per=20, samples=14, noise=0.05):
    rng = np.random.default_rng(2)
    share = rng.dirichlet(np.ones(types), samples)
    rows = []
    for g in range(types * per):
        value = share[:, g // per] * rng.lognormal(3, 0.5) * np.exp(rng.normal(size=samples) * noise)
        rows += [(g, s, float(v)) for s, v in enumerate(value) if v > 1e-9]
    return share, rows, [(f"t{g // per}", g, g % per) for g in range(types * per)]


def test_ensemble_finds_the_mixture(spark):
    share, rows, marks = mixture()
    rows, marks = spark.createDataFrame(rows, "gene long, sample long, value double"), spark.createDataFrame(marks, "cell string, gene long, rank long")
    found = deconvolution.ensemble(rows, marks, draws=8, size=10, pool=20)
    out = found.proportions.toPandas()
    assert set(out["estimator"]) == {"ensemble"} and set(out["aggregator"]) == set(deconvolution.AGGREGATORS) and len(out) == 3 * 3 * 14
    for _, part in out.groupby("aggregator"):
        p = part.pivot(index="sample", columns="cell", values="proportion").to_numpy()
        assert np.abs(p - share).max() < 0.15 and np.allclose(p.sum(axis=1), 1)
    stable = {r["cell"]: r for r in found.stability.collect()}
    assert all(r["stable"] and r["n_degenerate"] == 0 and r["min_r"] <= r["median_r"] <= 1 for r in stable.values())
    assert found.markers.groupBy("cell").count().where("count <> 10").count() == 0
    # From the draws themselves: pairwise correlations, and the draw that agrees best with the others.
    pools = deconvolution.marker_pools(rows, marks, pool=20)
    drawn = deconvolution.marker_draws(pools, draws=8, size=10)
    each = deconvolution.draw_proportions(rows, drawn).toPandas()
    one = each[each["aggregator"] == "median"]
    score = np.zeros(8)
    for cell, part in one.groupby("cell"):
        r = np.corrcoef(part.pivot(index="sample", columns="draw", values="proportion").to_numpy(), rowvar=False)
        assert stable[cell]["median_r"] == pytest.approx(np.median(r[np.triu_indices(8, 1)])) and stable[cell]["min_r"] == pytest.approx(r.min())
        score += (r.sum(axis=1) - 1) / 7 / 3
    assert found.representative == int(score.argmax())
    single = deconvolution.ensemble(rows, marks, draws=8, size=10, pool=20, estimate="representative").proportions.toPandas()
    assert set(single["estimator"]) == {"representative"} and single["proportion_sd"].isna().all()


def test_medians_and_means_count_missing_values_as_zero(spark):
    rows = spark.createDataFrame([(g, s, float(g + s)) for g in range(1, 7) for s in range(3) if (g + s) % 3], "gene long, sample long, value double")
    drawn = spark.createDataFrame([(0, "a", 1), (0, "a", 2), (0, "a", 3), (0, "b", 4), (0, "b", 5), (0, "b", 6)], "draw int, cell string, gene long")
    got = deconvolution.draw_proportions(rows, drawn, ("median", "mean")).toPandas()
    v = np.array([[float(g + s) if (g + s) % 3 else 0.0 for s in range(3)] for g in range(1, 7)])
    for name, f in (("median", np.median), ("mean", np.mean)):
        o = np.column_stack([f(v[:3], axis=0), f(v[3:], axis=0)])
        x, _ = by_subsets(o, np.ones(3))
        want = o * x / (o * x).sum(axis=1, keepdims=True)
        part = got[got["aggregator"] == name].pivot(index="sample", columns="cell", values="proportion").to_numpy()
        assert np.allclose(part, want)


def test_types_that_say_nothing_are_left_out_or_refused(spark):
    share, rows, marks = mixture(types=2)
    twin = [(g + 100, s, 0.0) for g, s, _ in rows]
    rows_df = spark.createDataFrame(rows + twin, "gene long, sample long, value double")
    with pytest.raises(ValueError, match="usable markers"):
        deconvolution.ensemble(rows_df, spark.createDataFrame(marks + [("dead", g + 100, r) for _, g, r in marks[:20]], "cell string, gene long, rank long"), draws=3, size=10, pool=20)
    flat = [(g + 200, s, 1.0) for g in range(20) for s in range(14)]
    both = deconvolution.draw_stability(deconvolution.draw_proportions(spark.createDataFrame(rows + flat, "gene long, sample long, value double"), deconvolution.marker_draws(spark.createDataFrame([(c, g) for c, g, _ in marks] + [("flat", g + 200) for g in range(20)], "cell string, gene long"), draws=4, size=10), ("mean",)), "mean")
    assert {r["cell"] for r in both.collect()} == {"t0", "t1", "flat"}


@pytest.mark.parametrize("seed", range(8))
def test_shift_is_the_median_of_all_differences(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 40, 2)
    x, y = (rng.normal(size=k) if seed % 2 else rng.integers(0, 5, k) / 10 for k in (n, m))
    assert models.median_difference(np.asarray(x, float), np.asarray(y, float)) == pytest.approx(float(np.median(np.subtract.outer(x, y))), abs=1e-15)


def test_shift_of_large_arms_needs_no_pairs():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=200_001) + 0.5, rng.normal(size=150_000)
    got = models.median_difference(x, y)
    below, up_to = ((np.searchsorted(np.sort(y), x - got, side)).sum() for side in ("left", "right"))
    assert abs(len(x) * len(y) / 2 - (len(x) * len(y) - (below + up_to) / 2)) < 1e6 and abs(got - 0.5) < 0.02


def test_adjusted_p_values_of_many_keys_are_ranked_by_ranges(spark):
    """A window over all keys would be one task."""
    people = spark.createDataFrame([(i, i % 2, 100.0 + i) for i in range(20)], "individualID long, is_case int, lib_size double")
    seen = spark.range(240).select((F.col("id") % 12).alias("gene"), F.expr("id div 12").alias("individualID")).where("(individualID * (gene + 3)) % 7 < 3")
    made = regressions.cohort_call_models(seen, seen.withColumn("expression", F.lit(1.0)), people, "gene", [])
    assert "isnull(_p_" not in made._jdf.queryExecution().optimizedPlan().toString().lower()
    assert made.count() > 0
