"""Compositions of the operators: the analyses a user runs over a cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates, joins, ranks, tests
from ..operators.stored import stored, written

THRESHOLDS = [0.6, 0.7, 0.8, 0.75]


def gene_tests(cohort) -> DataFrame:
    """Padded Mann-Whitney of complete genes with site counts and adjusted p-values."""
    kept = cohort.complete_calls
    totals = aggregates.individual_totals(kept, "ref_id", "proportion")
    tested = tests.mannwhitney_padded(totals, "ref_id", cohort.sizes["case"], cohort.sizes["ref"])
    sites = kept.groupBy("ref_id").agg(F.count_if(F.col("condition") == "case").alias("n_sites_case"), F.count_if(F.col("condition") == "ref").alias("n_sites_ref"))
    return ranks.benjamini_hochberg(tested.join(cohort.complete, "ref_id").join(sites, "ref_id"))


def calltype_tests(cohort) -> DataFrame:
    """Padded Mann-Whitney of call types over the complete genes, on span-weighted proportions."""
    # At most 14 call types: one row for each type and individual is all that is ranked.
    totals = aggregates.individual_totals(cohort.complete_calls, "a1type", "weighted", 12)
    return ranks.benjamini_hochberg(tests.mannwhitney_padded(totals, "a1type", cohort.sizes["case"], cohort.sizes["ref"])).withColumn("gene_set", F.lit("complete"))


def global_gene_set(cohort) -> DataFrame:
    """ref_id, filtered: significant genes on the chosen basis, or all tested ones where there are none."""
    # The basis and the selection start from the tests, and each counts them, so they are written once.
    tested = stored(gene_tests(cohort).select("ref_id", "p_value", "adj_pvalue"))
    return ranks.resolve_gene_set(ranks.significant(tested, ranks.choose_basis(tested)), tested)


def gene_classes(cohort, threshold: float = 0.75) -> DataFrame:
    return aggregates.classify_genes(calls_of(cohort, global_gene_set(cohort)), threshold)


def site_uniqueness(cohort, classes: DataFrame) -> DataFrame:
    """2 x 2 of unique and common positions by condition, odds ratio with interval, Fisher's p and its adjustment."""
    cells = aggregates.count_positions(cohort.eligible, classes, cohort.complete_calls)
    names = ["n_case_unique", "n_case_common", "n_ref_unique", "n_ref_common"]
    t = cells.select("*", *[F.expr(e).alias(k) for k, e in scalars.odds_ratio_ci_sql(*names).items()])
    return ranks.benjamini_hochberg(t.withColumn("p_value", tests.fisher_exact(*names)))


def calls_of(cohort, classes: DataFrame) -> DataFrame:
    """Eligible calls of the chosen or classified genes: the local steps narrow the global result, so they see no other
    gene, and all of these are complete."""
    return cohort.complete_calls.join(classes.select("ref_id").distinct(), "ref_id", "left_semi")


def gene_calltypes(cohort) -> DataFrame:
    """Sites, individuals and depths per (gene, type) of the complete genes."""
    return aggregates.aggregate_calltypes(cohort.complete_calls)


def local_stage4(calls: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Per (gene, type) of the given calls: carriers, aggregated proportions and Welch's test."""
    per = calls.groupBy("ref_id", "a1type", "condition", "individualID").agg(F.sum("a1_ad").alias("ad"), F.sum("dp").alias("depth"))
    per = per.withColumn("proportion", F.col("ad") / F.col("depth").cast("double"))
    arm = lambda c, x: F.sum(F.when(F.col("condition") == c, F.col(x)))
    pooled = {f"prop_{c}": arm(c, "ad") / arm(c, "depth") for c in ("case", "ref")}
    t = tests.welch_t(per, ["ref_id", "a1type"], extra=pooled)
    n1, n2 = sizes["case"], sizes["ref"]
    t = t.withColumn("has_majority", (F.col("n_case") >= -(-n1 // 2)) | (F.col("n_ref") >= -(-n2 // 2)))
    # A row for each gene and type: ranked by ranges of p-values, so no task has them all.
    return ranks.benjamini_hochberg(t.withColumn("local_dist", scalars.classify_local(F.col("n_case"), F.col("n_ref"), n1, n2)), parts=64)


def local_sites(cohort, classes: DataFrame, *, alpha: float = 0.01) -> DataFrame:
    """Stages 4 to 6 over the classified genes: retained by basis and majority, then a pooled Mann-Whitney of the retained,
    and the final rule."""
    calls = written(calls_of(cohort, classes))
    # The basis, the retained pairs and the result all start from stage 4, so it is written once.
    t = stored(local_stage4(calls, cohort.sizes))
    basis = ranks.choose_basis(t, alpha=alpha).first()["basis"]
    hit = F.col(basis) < alpha if basis else F.lit(False)
    t = t.withColumn("retained", F.coalesce(hit, F.lit(False)) & F.col("has_majority"))
    kept = calls.join(t.where("retained").select("ref_id", "a1type"), ["ref_id", "a1type"], "left_semi")
    stage6 = ranks.benjamini_hochberg(tests.mannwhitney_pooled(kept, ["ref_id", "a1type"]), "prop_p_value", "prop_adj_pvalue", parts=64)
    t = t.join(stage6, ["ref_id", "a1type"], "left")
    final = scalars.final_retained(F.col("retained"), F.col("n_case"), F.col("n_ref"), F.col("prop_p_value"))
    return t.withColumn("final_retained", final.cast("int")).withColumn("retained", F.col("retained").cast("int"))


def expression_matrix(cohort, genes: DataFrame) -> DataFrame:
    counts = cohort.eligible.groupBy("ref_id", "individualID").agg(F.count("*").alias("n_calls"))
    return joins.zero_filled(genes, cohort.individual, aggregates.tpm(cohort.expression), counts)


def expression_correlation(cohort, genes: DataFrame) -> DataFrame:
    """Spearman of expression and call counts per gene and condition, and the difference of the two conditions."""
    s = tests.spearman(expression_matrix(cohort, genes), ["ref_id", "condition"], "tpm", "n_calls")
    arm = lambda c, x: F.max(F.when(F.col("condition") == c, F.col(x))).alias(f"{x}_{c}")
    wide = s.groupBy("ref_id").agg(*[arm(c, x) for c in ("case", "ref") for x in ("n", "rho", "p_value")])
    return tests.fisher_z_difference(wide)


def correlation_summary(wide: DataFrame) -> DataFrame:
    return wide.select(scalars.both_or_one(F.col("p_value_case"), F.col("p_value_ref")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n_genes"))


def threshold_sweep(cohort, classes: DataFrame) -> DataFrame:
    return aggregates.threshold_sweep(classes, THRESHOLDS)


def analyse_all(cohort) -> dict[str, DataFrame]:
    """All analyses in order with one set of parameters.

    Tests, types and their counts are of the complete genes. The significant genes are found once (all tested ones where
    there are none) and classified; the sweep, the site test, the local steps, the correlation and the load look at these.
    ``run_log`` (key, value) is what gene tests note for later steps, which the cascade is checked against."""
    tested = stored(gene_tests(cohort))
    basis = ranks.choose_basis(tested)
    genes = stored(ranks.resolve_gene_set(ranks.significant(tested, basis), tested))
    classes = stored(aggregates.classify_genes(calls_of(cohort, genes)))
    types = stored(calltype_tests(cohort))
    return {
        "gene_tests": tested, "global_gene_set": genes, "calltype_tests": types, "gene_calltypes": gene_calltypes(cohort),
        "gene_classes": classes, "calltype_load": aggregates.calltype_load(cohort.complete_calls, genes), "threshold_sweep": threshold_sweep(cohort, classes), "expression_correlation": expression_correlation(cohort, genes),
        "site_uniqueness": site_uniqueness(cohort, classes), "local_sites": local_sites(cohort, classes), "filter_cascade": aggregates.filter_cascade(cohort.loaded), "calltype_rates": aggregates.calltype_rates(cohort.eligible),
        "run_log": gene_tests_log(cohort, tested, types, genes, classes),
    }


def gene_tests_log(cohort, tested: DataFrame, types: DataFrame, genes: DataFrame, classes: DataFrame, *, alpha: float = 0.05, threshold: float = 0.75) -> DataFrame:
    """key, value (strings) of a run of gene tests: its parameters, and how many calls, genes and tests there were."""
    e = cohort.eligible.agg(F.count("*").alias("calls"), F.count_distinct("ref_id").alias("genes")).first()
    basis, of_types = ranks.choose_basis(tested, alpha=alpha).first(), ranks.choose_basis(types, alpha=alpha).first()
    t = tested.agg(F.count("*").alias("n"), F.count("p_value").alias("defined"), F.count_if(F.col("adj_pvalue") < alpha).alias("adjusted")).first()
    g = genes.agg(F.count("*").alias("n"), F.coalesce(F.max("filtered"), F.lit(False)).alias("filtered")).first()
    c = {r["gene_group"]: r["n"] for r in classes.groupBy("gene_group").agg(F.count("*").alias("n")).collect()}
    n_calls = calls_of(cohort, genes).count()
    sizes = cohort.sizes
    log = {
        "case_condition": "case", "reference_condition": "ref", "n_case": sizes["case"], "n_reference": sizes["ref"], "min_depth": scalars.MIN_DEPTH, "global_alpha": alpha, "group_threshold": threshold,
        "n_eligible_calls": e["calls"], "n_genes_considered": e["genes"], "n_genes_complete": t["n"], "n_tests": t["n"], "n_tests_defined": t["defined"], "n_tests_adjusted_sig": t["adjusted"],
        "n_genes_global_set": g["n"] if g["filtered"] else 0, "global_set_basis": basis["basis"] or "none", "calltype_basis": of_types["basis"] or "none", "n_calltypes_tested": of_types["n_tests"], "n_calltypes_adjusted_sig": of_types["n_adjusted"],
        "subset_from_global_set": int(g["filtered"]), "n_genes_in_subsets": g["n"], "n_calls_in_subsets": n_calls, "n_genes_classified": sum(c.values()), "group_sizes": ",".join(f"{k}={c[k]}" for k in sorted(c)),
    }
    return cohort.spark.createDataFrame([(f"gene_tests.{k}", str(v)) for k, v in log.items()], "key string, value string")


def rna_unique(cohort, k: int = 4) -> DataFrame:
    """Calls minus the second call set, minus the panel, with known positions flagged."""
    controls = cohort.individual.where("condition = 'ref'")
    panel = aggregates.panel_of_normals(cohort.call, controls, k)
    return joins.subtract_calls(cohort.call, cohort.call.where("o_orderstatus = 'F'"), panel, cohort.site.where("pos % 3 = 0"))
