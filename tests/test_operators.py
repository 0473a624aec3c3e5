from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from armlens.operators import aggregates, joins, ranks, tests


def rank_sums(case, ref):
    values = sorted(case + ref)
    rank = {v: (values.index(v) + 1 + len(values) - values[::-1].index(v)) / 2 for v in values}
    return sum(rank[v] for v in case) - len(case) * (len(case) + 1) / 2


def test_padded_mannwhitney(spark):
    rng, rows, n1, n2, expected = random.Random(3), [], 12, 11, {}
    for g in range(30):
        case = [float(rng.choice([0, 0, 1, 2, 3.5, 4])) for _ in range(rng.randint(1, n1))]
        ref = [float(rng.choice([0, 1, 2, 7])) for _ in range(rng.randint(1, n2))]
        rows += [(g, "case", i, v) for i, v in enumerate(case)] + [(g, "ref", 100 + i, v) for i, v in enumerate(ref)]
        full = (case + [0.0] * (n1 - len(case)), ref + [0.0] * (n2 - len(ref)))
        expected[g] = rank_sums(*full) if any(full[0] + full[1]) else None
    out = tests.mannwhitney_padded(spark.createDataFrame(rows, "g int, condition string, i int, total double"), "g", n1, n2).collect()
    assert {r["g"]: r["u_stat"] for r in out} == expected
    assert all((r["p_value"] is None) == (r["u_stat"] is None) or r["u_stat"] is None for r in out)


def test_exact_mannwhitney():
    n1, n2 = 3, 4
    us = [rank_sums([float(v) for v in c], [float(v) for v in range(7) if v not in c]) for c in itertools.combinations(range(7), n1)]
    for u in range(n1 * n2 + 1):
        tail = sum(x >= max(u, n1 * n2 - u) for x in us) / len(us)
        assert tests.exact_tail(n1, n2)[u] == pytest.approx(min(1.0, 2 * tail))


def test_pooled_mannwhitney(spark):
    rows = [("g", "case", 1.0), ("g", "case", 3.0), ("g", "ref", 2.0), ("g", "ref", 4.0), ("h", "case", 1.0)]
    out = {r["k"]: r for r in tests.mannwhitney_pooled(spark.createDataFrame(rows, "k string, condition string, weighted double"), ["k"]).collect()}
    assert out["g"]["prop_u_stat"] == 1.0 and out["g"]["prop_p_value"] == pytest.approx(2 / 3) and out["g"]["higher_prop"] == "ref"
    assert out["h"]["prop_u_stat"] is None and out["h"]["prop_p_value"] is None and out["h"]["higher_prop"] == "case"


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_benjamini_hochberg(spark, parts):
    ps = [0.01, 0.02, 0.02, 0.2, 0.9, None, 0.004, 1.0]
    out = ranks.benjamini_hochberg(spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "i int, p_value double"), parts=parts).collect()
    known = sorted(p for p in ps if p is not None)
    for r in out:
        p = ps[r["i"]]
        want = None if p is None else min(1.0, min(q * len(known) / (max(k for k, x in enumerate(known, 1) if x == q)) for q in known if q >= p))
        assert r["adj_pvalue"] == (None if want is None else pytest.approx(want))


def test_basis(spark):
    frame = lambda rows: spark.createDataFrame(rows, "p_value double, adj_pvalue double")
    basis = lambda rows: ranks.choose_basis(frame(rows)).first()["basis"]
    assert basis([(0.01, 0.02)] * 3 + [(0.5, 0.9)] * 7) == "adj_pvalue"
    assert basis([(0.01, 0.2)] * 3 + [(0.5, 0.9)] * 7) == "p_value"
    assert basis([(0.01, 0.02)] * 2 + [(None, None)] * 8) is None and basis([]) is None


def test_gene_set_fallback(spark):
    every = spark.createDataFrame([(1,), (2,)], "ref_id int")
    assert {tuple(r) for r in ranks.resolve_gene_set(every.limit(0), every).collect()} == {(1, False), (2, False)}
    assert {tuple(r) for r in ranks.resolve_gene_set(every.where("ref_id = 2"), every).collect()} == {(2, True)}


def test_fisher(spark):
    for a, b, c, d in ((3, 1, 1, 3), (0, 5, 4, 1), (10, 2, 3, 15), (0, 0, 0, 0)):
        n, r, k = a + b + c + d, a + b, a + c
        prob = {x: math.comb(r, x) * math.comb(n - r, k - x) / math.comb(n, k) for x in range(max(0, k - (n - r)), min(r, k) + 1)}
        want = sum(p for p in prob.values() if p <= prob[a] * (1 + 1e-7))
        row = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long")
        assert row.select(F.expr(tests.fisher_exact_sql("a", "b", "c", "d")).alias("p")).first()["p"] == pytest.approx(min(1.0, want), rel=1e-9)


def test_welch(spark):
    rows = [("g", "case", 1.0), ("g", "case", 2.0), ("g", "case", 3.0), ("g", "ref", 2.0), ("g", "ref", 6.0), ("one", "case", 1.0), ("one", "ref", 1.0), ("one", "ref", 2.0), ("flat", "case", 1.0), ("flat", "case", 1.0), ("flat", "ref", 2.0), ("flat", "ref", 2.0)]
    out = {r["k"]: r for r in tests.welch_t(spark.createDataFrame(rows, "k string, condition string, proportion double"), ["k"]).collect()}
    assert out["g"]["t_stat"] == pytest.approx(-2 / math.sqrt(1 / 3 + 4)) and 0.3 < out["g"]["p_value"] < 0.6
    assert out["one"]["p_value"] is None and out["flat"]["t_stat"] is None and out["flat"]["p_value"] == 0.0


def test_chi2_and_spearman(spark):
    counts = spark.createDataFrame([("k", "a", "x", 10), ("k", "a", "y", 20), ("k", "b", "x", 30), ("k", "b", "y", 5), ("k", "c", "x", 0), ("k", "c", "y", 0), ("l", "a", "x", 3)], "key string, r string, c string, n long")
    out = {r["key"]: r for r in tests.chi2_independence(counts, ["key"], "r", "c").collect()}
    want = 65 * (abs(10 * 5 - 20 * 30) - 65 / 2) ** 2 / (30 * 35 * 40 * 25)
    assert out["k"]["dof"] == 1 and out["k"]["chi2"] == pytest.approx(want) and out["k"]["p_value"] == pytest.approx(math.erfc(math.sqrt(want / 2)), rel=1e-6)
    assert "l" not in out or out["l"]["chi2"] is None
    pairs = spark.createDataFrame([("k", float(i), float(i * i)) for i in range(5)] + [("c", 1.0, float(i)) for i in range(5)] + [("s", 1.0, 2.0)], "key string, x double, y double")
    rho = {r["key"]: (r["rho"], r["p_value"]) for r in tests.spearman(pairs, ["key"], "x", "y").collect()}
    assert rho["k"] == (1.0, 0.0) and rho["c"] == (None, None) and rho["s"] == (None, None)


def test_resolve_sites(spark):
    genes = spark.createDataFrame(
        [(1, 100, 200, "novel", "+", 1, 0, 9, 101), (1, 150, 160, "known", "-", 0, 3, 1, 11), (1, 300, 400, "b", "+", 0, 1, 5, 101), (1, 300, 400, "a", "+", 0, 1, 5, 101), (1, 290, 900, "far", "+", 0, 2, 5, 611)],
        "chrom int, gene_start long, gene_end long, ref_id string, strand string, novel int, tier int, n_transcripts long, gene_span long",
    )
    sites = spark.createDataFrame([(1, p, "A") for p in (99, 100, 155, 200, 201, 300, 900, 901)] + [(2, 150, "A")], "chrom int, pos long, ref_base string")
    for width in (7, 256):
        got = {(r["chrom"], r["pos"]): r["ref_id"] for r in joins.resolve_sites(sites, genes, bin_width=width).collect()}
        assert got == {(1, 99): None, (1, 100): "novel", (1, 155): "known", (1, 200): "novel", (1, 201): None, (1, 300): "a", (1, 900): "far", (1, 901): None, (2, 150): None}


def test_subtract_calls(spark):
    at = lambda *p: spark.createDataFrame([(1, x) for x in p], "chrom int, pos long")
    calls = spark.createDataFrame([(i, 1, p) for i in (1, 2) for p in (1, 2, 3, 4)], "individualID int, chrom int, pos long")
    other = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "individualID int, chrom int, pos long")
    out = {(r["individualID"], r["pos"]): (r["origin"], r["germline"]) for r in joins.subtract_calls(calls, other, at(2, 3), at(1, 2, 4)).collect()}
    assert out == {(1, 1): ("other", 0), (1, 2): ("other", 0), (1, 3): ("panel", 0), (1, 4): ("kept", 1), (2, 1): ("kept", 1), (2, 2): ("panel", 0), (2, 3): ("panel", 0), (2, 4): ("kept", 1)}


def test_annotation(spark):
    t = spark.createDataFrame([("t1", "L1", "g1", 1), ("t2", "L1", None, 2), ("t3", "L2", None, 3), ("t4", "L3", "g2", 4), ("t5", "L3", "g3", 5), ("t6", "L3", None, 6)], "tid string, locus_id string, ref_gene_id string, line long")
    got = {r["tid"]: (r["outcome"], r["ref_id"]) for r in aggregates.resolve_genes(t).collect()}
    assert got == {"t1": ("matched", "g1"), "t2": ("inherited", "g1"), "t3": ("novel", "L2"), "t4": ("matched", "g2"), "t5": ("matched", "g3"), "t6": ("chimeric", None)}
    e = spark.createDataFrame([("a", "+", 10, 19), ("a", "+", 30, 34), ("a", "+", 10, 19), ("b", "-", 10, 19), ("b", "-", 30, 34)], "tid string, strand string, exon_start long, exon_end long")
    rows = {(r["tid"], r["exon_start"]): (r["exon_num"], r["trans_offset"], r["trans_len"]) for r in aggregates.build_exons(e).collect()}
    assert rows == {("a", 10): (1, 0, 15), ("a", 30): (2, 10, 15), ("b", 30): (1, 0, 15), ("b", 10): (2, 5, 15)}


def test_completeness_ignores_row_order_and_partitions(spark):
    ind = spark.createDataFrame([(1, "case"), (2, "case"), (3, "ref")], "individualID int, condition string")
    calls = spark.createDataFrame([("g", "case", 1), ("g", "case", 2), ("g", "case", 2), ("h", "case", 1), ("h", "ref", 3), ("g", "ref", 3)], "ref_id string, condition string, individualID int")
    for n in (1, 7):
        assert {tuple(r) for r in aggregates.complete_genes(calls.repartition(n), ind).collect()} == {("g", "case,ref"), ("h", "ref")}


def test_covariates_that_differ_and_codes_that_select_nothing(spark):
    people = spark.createDataFrame([("a",), ("b",)], "individualID string")
    extra = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("b", "3")], "individualID string, age string")
    with pytest.warns(UserWarning, match="1 individuals"):
        got = joins.covariates(people, extra)
    assert {r["individualID"]: r["age"] for r in got.collect()} == {"a": "1", "b": "3"}
    lines = spark.createDataFrame([("t1", "=", 1), ("t2", "u", 2), ("t2", None, 3)], "tid string, class_code string, line int")
    assert {r["tid"] for r in joins.select_novel(lines, ["="], require=True).collect()} == {"t2"}
    with pytest.raises(ValueError, match="no transcript"):
        joins.select_novel(lines, ["=", "u"], require=True)


def test_ranged_adjustment_of_p_values_that_differ_from_run_to_run(spark):
    """Sums of doubles do so in their last bits: every test has its adjusted value all the same."""
    import random

    noise = F.udf(lambda k: k / 100 + random.random() * 1e-9, "double").asNondeterministic()
    tests = spark.range(1, 80, 1, 4).withColumn("p_value", noise("id"))
    got = {r["id"]: r["adj_pvalue"] for r in ranks.benjamini_hochberg(tests, parts=8).collect()}
    assert len(got) == 79 and all(v == pytest.approx(0.79, abs=1e-6) for v in got.values())


def test_shuffles_are_dealt_by_rows(spark, monkeypatch):
    """The interval join has as many partitions as its rows ask for, whatever the session's number, and the same rows."""
    from armlens.operators import stored

    monkeypatch.setattr(stored, "TASK_ROWS", 50)
    points = spark.range(1, 400).select((F.col("id") % 2).cast("int").alias("chrom"), "id").withColumnRenamed("id", "pos")
    spans = spark.range(1, 200).select((F.col("id") % 2).cast("int").alias("chrom"), (F.col("id") * 2).alias("gene_start"), (F.col("id") * 2 + 9).alias("gene_end"), F.col("id").alias("g"))
    met = joins.covering(points, spans)
    want = {(p, g) for p in range(1, 400) for g in range(1, 200) if p % 2 == g % 2 and g * 2 <= p <= g * 2 + 9}
    assert {(r["pos"], r["g"]) for r in met.collect()} == want
    assert met.rdd.getNumPartitions() >= len(want) // 50 > 4


def test_resolved_calls_are_written_once(spark):
    from armlens.sources.driver_view import Cohort

    loaded = Cohort(spark, "/root/testdata/sf0.001").loaded
    assert "Join" not in loaded._jdf.queryExecution().executedPlan().toString()


def test_fisher_of_large_tables():
    """A million positions take milliseconds; small tables against sums of whole numbers."""
    import time

    def whole(a, b, c, d):
        n = [math.comb(a + b, k) * math.comb(c + d, a + c - k) for k in range(max(0, a - d), min(a + b, a + c) + 1)]
        seen = math.comb(a + b, a) * math.comb(c + d, c)
        return sum(x for x in n if x <= seen) / sum(n)

    rng = random.Random(5)
    for table in [(0, 0, 0, 0), (3, 0, 0, 4), (0, 9, 1, 0), (120, 4000, 150, 3900)] + [tuple(rng.randrange(60) for _ in range(4)) for _ in range(100)]:
        assert tests.fisher_p(*table) == pytest.approx(whole(*table), rel=1e-9)
    begin = time.perf_counter()
    for _ in range(39):
        assert 0 < tests.fisher_p(1_000_000, 2_000_000, 1_001_000, 2_000_000) < 1
    assert time.perf_counter() - begin < 5


def test_an_individuals_shares_need_no_window(spark):
    """A window over an individual would have all its genes in one task."""
    rows = spark.createDataFrame([(1, 1, 1.0), (1, 2, 3.0), (2, 1, 0.0), (None, 1, 2.0)], "individualID int, ref_id int, fpkm double")
    got = aggregates.tpm(rows)
    assert {(r[0], r[1]): r["tpm"] for r in got.collect()} == {(1, 1): 250000.0, (1, 2): 750000.0, (2, 1): 0.0, (None, 1): 1e6}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_rank_sums_by_ranges(spark):
    """As ranks over whole keys, also with ties across the bounds of ranges, nulls, and keys of one group."""
    rng, rows = random.Random(11), []
    for g in range(4):
        rows += [(g, rng.random() < 0.4 or g == 3, rng.choice([None, 0.0, 0.5, 1.0, rng.random(), rng.random()])) for _ in range(150)]
    got = {r["g"]: r for r in ranks.rank_sums(spark.createDataFrame(rows, "g int, c boolean, v double").repartition(3), ["g"], F.col("c"), "v", parts=9).collect()}
    for g in range(4):
        own = [(-1.0 if v is None else v, c) for k, c, v in rows if k == g]
        case, ref = [v for v, c in own if c], [v for v, c in own if not c]
        t = [[v for v, _ in own].count(v) for v, _ in own]
        assert (got[g]["n1"], got[g]["n2"]) == (len(case), len(ref))
        assert got[g]["r1"] == rank_sums(case, ref) + len(case) * (len(case) + 1) / 2 and got[g]["ties"] == sum(x * x - 1 for x in t)


def test_one_keys_ranks_need_no_window_over_it(spark):
    from armlens.operators import models

    two = spark.range(100).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), F.col("id").cast("double").alias("v"))
    plan = models.directional_wilcoxon(two, ["k"], "g", "v", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and "rank(" not in plan


def test_expression_is_grouped_by_rows(spark, monkeypatch):
    """Spark would merge the partitions of a grouping by their bytes; what is grouped is dealt by rows."""
    from armlens.operators import stored
    from armlens.sources.driver_view import Cohort

    monkeypatch.setattr(stored, "TASK_ROWS", 200)
    made = Cohort(spark, "/root/testdata/sf0.001").expression
    assert made.rdd.getNumPartitions() > 20


def test_rescue_needs_no_window_over_a_sample(spark):
    from armlens.operators import expression

    rows = spark.createDataFrame([(g, s, float(g + 1)) for g in range(5) for s in range(4)], "gene int, sample int, value double")
    arms = spark.createDataFrame([(s, "case" if s % 2 else "ref") for s in range(4)], "sample int, condition string")
    kept = expression.rescued_filter(rows, rows, arms, rows.where("gene = 1").select("gene"), min_count=3e5, min_total=0.0, min_fpkm=1.0)
    assert {tuple(r) for r in kept.collect()} == {(g, "filter") for g in ()} | {tuple(r) for r in kept.where("kept_by = 'filter'").collect()} | {(1, "rescue")}
    assert "Window" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_cohort_tables_are_files_and_the_gene_set_starts_from_written_tests(spark):
    """Steps read only the columns they ask for, and no step makes the complete genes or their tests anew."""
    from armlens.plans import analyses
    from armlens.sources.driver_view import Cohort

    c = Cohort(spark, "/root/testdata/sf0.001")
    assert all(t.inputFiles() for t in (c.call, c.site, c.loaded, c.eligible, c.complete, c.complete_calls))
    want = c.eligible.join(aggregates.complete_genes(c.eligible, c.individual), "ref_id", "left_semi")
    assert c.complete_calls.count() == want.count() > 0 and c.complete_calls.exceptAll(want).isEmpty()
    plan = analyses.global_gene_set(c)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "individualID" not in plan


def test_positions_of_the_classified_genes_calls_only(spark):
    """Unique positions are unique in the whole cohort, also where positions are taken from fewer calls."""
    rows = [(1, 1, 10, "A-G", "case", 1), (2, 1, 10, "A-G", "ref", 2), (1, 1, 11, "A-G", "case", 1), (2, 1, 12, "A-G", "ref", 2)]
    calls = spark.createDataFrame(rows, "ref_id long, chrom int, pos long, a1type string, condition string, individualID long")
    classes = spark.createDataFrame([(1, "Shared")], "ref_id long, edit_dist string")
    some = aggregates.count_positions(calls, classes, calls.where("ref_id = 1")).collect()
    assert some == aggregates.count_positions(calls, classes).collect() and (some[0]["n_case_unique"], some[0]["n_case_common"]) == (1, 1)
