from __future__ import annotations

import numpy as np
import pytest

from armlens.operators import expression, models


def test_ols_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(a), float(b), float(1 + 2 * a - b + rng.normal())) for g in "xy" for a, b in rng.normal(size=(30, 2))]
    out = {r["g"]: r for r in models.grouped_ols(spark.createDataFrame(rows, "g string, a double, b double, y double"), "g", "y", ["a", "b"]).collect()}
    for g in "xy":
        part = np.array([r[1:] for r in rows if r[0] == g])
        want = np.linalg.lstsq(np.column_stack((np.ones(30), part[:, :2])), part[:, 2], rcond=None)[0]
        assert [out[g][c] for c in ("b_intercept", "b_a", "b_b")] == pytest.approx(list(want), rel=1e-8)
        assert 0 <= out[g]["p_value"] < 1e-6 and 0.5 < out[g]["r2"] <= 1


def test_firth_shrinks_separation(spark):
    rows = [("s", int(i < 10), int(i < 10)) for i in range(20)] + [("n", int(i < 10), i % 2) for i in range(20)] + [("few", int(i < 10), int(i == 0)) for i in range(20)]
    out = {r["k"]: r for r in models.presence_models(spark.createDataFrame(rows, "k string, is_case int, present int"), "k", "present", []).collect()}
    assert set(out) == {"s", "n"} and out["s"]["converged"] and 2 < out["s"]["b_full"] < 10 and abs(out["n"]["b_full"]) < 1e-6 and out["n"]["attenuation"] is None
    # With one binary term the penalised fit adds a half to each cell.
    assert out["s"]["b_full"] == pytest.approx(2 * np.log(10.5 / 0.5), rel=1e-6)


def test_site_models(spark):
    rows = [("a", c, 10 + (i % 3) + 5 * c, 40) for c in (0, 1) for i in range(20)] + [("b", c, 0 if c else 5, 40) for c in (0, 1) for i in range(20)] + [("few", 1, 1, 2)]
    out = {r["k"]: r for r in models.site_models(spark.createDataFrame(rows, "k string, is_case int, a1_ad long, dp long"), ["k"]).collect()}
    assert set(out) == {"a", "b"} and out["b"]["boundary"] == 1 and out["b"]["p_value"] is None
    share = [sum(r[2] for r in rows if r[:2] == ("a", c)) / (20 * 40) for c in (0, 1)]
    assert out["a"]["b"] == pytest.approx(np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0])))


def test_bootstrap_is_the_same_at_every_partitioning(spark):
    rows = spark.createDataFrame([("case" if i % 2 else "ref", float(i % 7)) for i in range(30)], "condition string, v double")
    a, b = (models.bootstrap_median_difference(rows.repartition(n), "v", replicates=200).first() for n in (1, 5))
    assert a == b and a["ci_low"] <= a["difference"] <= a["ci_high"]


def test_tmm_undoes_scale(spark):
    rng = np.random.default_rng(0)
    base = rng.lognormal(3, 1, 300)
    rows = [(g, s, float(base[g] * k)) for s, k in (("a", 1.0), ("b", 3.0), ("c", 0.5)) for g in range(300)]
    factors = [r["factor"] for r in expression.tmm_factors(spark.createDataFrame(rows, "gene int, sample string, value double")).collect()]
    assert factors == pytest.approx([1.0, 1.0, 1.0])


def test_group_comparison(spark):
    rows = [("k", "case", 3.0), ("k", "case", 5.0), ("k", "case", 7.0), ("k", "ref", 1.0), ("k", "ref", 2.0), ("k", "ref", 3.0)]
    r = models.group_comparison(spark.createDataFrame(rows, "k string, condition string, value double"), "k").first()
    assert (r["median_case"], r["median_ref"], r["ratio"], r["shift"]) == (5.0, 2.0, 2.5, 3.0) and r["cliffs_delta"] == pytest.approx(8.0 / 9)


def test_all_markers_of_two_types(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=(60, 12))
    rows = spark.createDataFrame([(g, s, float(x[g, s])) for g in range(60) for s in range(12)], "gene long, sample long, value double")
    markers = spark.createDataFrame([("ab"[g % 2], g, g) for g in range(60)], "cell string, gene long, rank long")
    got = {(r["gene_a"], r["gene_b"]): (r["cell_a"], r["cell_b"], r["r"]) for r in expression.marker_correlations(rows, markers).collect()}
    want = np.corrcoef(np.log2(x + 1))
    assert set(got) == {(a, b) for b in range(60) for a in range(b)}
    assert all((ca, cb) == ("ab"[a % 2], "ab"[b % 2]) and r == pytest.approx(want[a, b]) for (a, b), (ca, cb, r) in got.items())


def test_ensemble_has_the_draws_of_the_reference(spark):
    rows = spark.createDataFrame([(g, s, float(1 + (g * 7 + s * 3) % 11)) for g in range(8) for s in range(3)], "gene long, sample long, value double")
    markers = spark.createDataFrame([("ab"[g % 2], g, g) for g in range(8)], "cell string, gene long, rank long")
    assert models.proportion_ensemble(rows, markers).select("draw").distinct().count() == 100


def test_directional_wilcoxon_of_few_rows_is_null(spark):
    rows = [("one", "up", 1.0), ("tied", "up", 2.0), ("tied", "up", 2.0), ("tied", "up", 2.0), ("tied", "down", 2.0), ("tied", "down", 2.0), ("tied", "down", 2.0)]
    got = models.directional_wilcoxon(spark.createDataFrame(rows, "k string, side string, v double"), ["k"], "side", "v", "up", "down").collect()
    assert sorted(r["k"] for r in got) == ["one", "tied"] and all(r["p_greater"] is None and r["direction"] is None for r in got)


def _same_components(got, centred, k):
    u, d, _ = np.linalg.svd(centred, full_matrices=False)
    for i in range(k):
        mine = got[f"pc{i + 1}"].to_numpy()
        assert np.allclose(np.abs(mine), np.abs(u[:, i] * d[i]), atol=1e-6) and mine[np.abs(mine).argmax()] > 0
        assert np.allclose(got[f"pct{i + 1}"], 100 * d[i] ** 2 / (d**2).sum())


def test_sample_components_are_those_of_the_dense_matrix(spark):
    x = np.random.default_rng(3).integers(0, 4, (9, 30)) * np.random.default_rng(4).random((9, 30)) * 50
    rows = [(f"g{j:02d}", i, float(x[i, j])) for i in range(9) for j in range(30) if x[i, j] > 0]
    got = expression.sample_components(spark.createDataFrame(rows, "gene string, sample long, value double"), genes=12).toPandas().sort_values("sample")
    z = np.log2(x + 1)
    z = z[:, np.argsort(-z.var(axis=0, ddof=1))[:12]]
    _same_components(got, (z - z.mean(axis=0)) / z.std(axis=0, ddof=1), 3)


def test_composition_axis(spark):
    x = np.random.default_rng(5).random((8, 4))
    rows = [(i, f"p{j}", float(x[i, j])) for i in range(8) for j in range(4)]
    got = expression.composition_axis(spark.createDataFrame(rows, "individualID long, part string, clr double")).toPandas().sort_values("individualID")
    _same_components(got, x - x.mean(axis=0), 1)


def test_components_and_contrast_of_nothing(spark):
    none = spark.createDataFrame([], "gene long, sample long, value double")
    assert expression.sample_components(none).count() == 0 and expression.sex_contrast(none, [1], 2).count() == 0
    some = spark.createDataFrame([(9, 1, 4.0), (2, 2, 4.0)], "gene long, sample long, value double")
    assert [r["sex_call"] for r in expression.sex_contrast(some, [1], 2).collect()] == [None, None]


@pytest.mark.parametrize("samples,genes", [(9, 60), (40, 25), (30, 30)])
def test_components_of_any_shape_against_a_dense_decomposition(spark, samples, genes):
    rng = np.random.default_rng(samples)
    x = np.round(rng.lognormal(1, 1, (genes, samples)), 3) * (rng.random((genes, samples)) < 0.8)
    rows = [(g, s, float(x[g, s])) for g in range(genes) for s in range(samples) if x[g, s]]
    got = expression.sample_components(spark.createDataFrame(rows, "gene long, sample long, value double").repartition(3), genes=20).toPandas().sort_values("sample")
    z = np.log2(x + 1)
    z = z[np.argsort(-z.var(axis=1, ddof=1), kind="stable")[:20]]
    z = ((z - z.mean(axis=1, keepdims=True)) / z.std(axis=1, ddof=1, keepdims=True)).T
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    for k in range(3):
        want = u[:, k] * s[k]
        want *= np.sign(want[np.abs(want).argmax()])
        assert np.allclose(got[f"pc{k + 1}"], want, atol=1e-7) and np.allclose(got[f"pct{k + 1}"], 100 * s[k] ** 2 / (s**2).sum())


def test_leading_pairs_of_close_and_equal_values():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    values = np.r_[5.0, 5.0, 4.999, np.linspace(4, 0, 117)]
    a = q * values @ q.T
    found, vectors = expression._leading(lambda b: a @ b, 120, 4)
    assert np.allclose(found, values[:4], atol=1e-9) and np.abs(a @ vectors - vectors * found).max() < 1e-8


def test_similarity_in_blocks_of_samples(spark, monkeypatch):
    """Blocks of three give what one block gives, and what ranks correlated over shared genes give."""
    rng = np.random.default_rng(1)
    x = rng.lognormal(size=(40, 8)) + 0.01
    x[rng.random((40, 8)) < 0.2] = 0
    rows = spark.createDataFrame([(g, s, float(x[g, s])) for g in range(40) for s in range(8) if x[g, s]], "gene long, sample long, value double")
    one = {r["sample"]: r["median_rho"] for r in expression.sample_similarity(rows).collect()}
    monkeypatch.setattr(expression, "SAMPLES_TOGETHER", 3)
    many = {r["sample"]: r["median_rho"] for r in expression.sample_similarity(rows).collect()}
    rank = np.zeros((40, 8))
    for s in range(8):
        has = x[:, s] > 0
        rank[has, s] = np.argsort(np.argsort(x[has, s])) + 1
    for s in range(8):
        want = np.median([np.corrcoef(rank[(x[:, s] > 0) & (x[:, t] > 0)][:, [s, t]].T)[0, 1] for t in range(8) if t != s])
        assert one[s] == pytest.approx(want) and many[s] == pytest.approx(want)
