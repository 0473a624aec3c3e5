"""Registered queries of the cohort engine and the same in SQL. Doubles are rounded in both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.special import two_sided_normal_sql
from ..operators import aggregates, deconvolution, expression, joins, models, ranks, regressions, tests
from ..operators.stored import stored, written
from ..sources.driver_view import Cohort, with_views
from . import analyses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f: Callable[[Cohort], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Cohort.of(spark, sf_dir))
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@_query("eligible_calls", """SELECT ref_id, condition, "individualID", chrom, pos, a1type, a1_ad, dp, gene_span, round(proportion, 6) AS proportion, round(weighted, 9) AS weighted FROM eligible""")
def _(c):
    return c.eligible.withColumns({"proportion": F.round("proportion", 6), "weighted": F.round("weighted", 9)})


@_query("resolve_sites", "SELECT * FROM resolved")
def _(c):
    return c.resolved


@_query("covering_genes", "SELECT s.chrom, s.pos, g.ref_id FROM site s JOIN gene g ON s.chrom = g.chrom AND s.pos BETWEEN g.gene_start AND g.gene_end")
def _(c):
    return joins.covering(c.site, c.gene).select("chrom", "pos", "ref_id")


COMPLETE = """complete AS (SELECT ref_id, string_agg(condition, ',' ORDER BY condition) AS complete_in FROM (SELECT ref_id, condition, count(DISTINCT "individualID") AS n FROM eligible GROUP BY 1, 2) p
    JOIN (SELECT condition, count(*) AS size FROM individual GROUP BY 1) s USING (condition) WHERE n >= size GROUP BY 1)"""


@_query("complete_genes", f"SELECT * FROM (WITH {COMPLETE} SELECT * FROM complete)")
def _(c):
    return aggregates.complete_genes(c.eligible, c.individual)


def _mwu_sql(source: str, key: str, value: str, digits: int) -> str:
    """Common table expressions that end in ``tested``."""
    return f"""tot AS (SELECT {key}, condition, "individualID", round(sum({value}), {digits}) AS v FROM {source} GROUP BY 1, 2, 3),
    obs AS (SELECT {key}, count(*) FILTER (condition = 'case') AS n_case_observed, count(*) FILTER (condition = 'ref') AS n_ref_observed FROM tot GROUP BY 1),
    rk AS (SELECT {key}, condition, count(*) OVER (PARTITION BY {key}) AS m, rank() OVER (PARTITION BY {key} ORDER BY v) + (count(*) OVER (PARTITION BY {key}, v) - 1) / 2e0 AS r, count(*) OVER (PARTITION BY {key}, v) AS t FROM tot WHERE v > 0),
    su AS (SELECT {key}, max(m) AS m, coalesce(sum(r) FILTER (condition = 'case'), 0) AS r, count(*) FILTER (condition = 'case') AS k, sum(t * t - 1) AS ties FROM rk GROUP BY 1),
    fu AS (SELECT {key}, n1, n2, r + k * (n1 + n2 - m) + (n1 - k) * (n1 + n2 - m + 1) / 2e0 - n1 * (n1 + 1) / 2e0 AS u, ties + power(n1 + n2 - m, 3) - (n1 + n2 - m) AS ties FROM su, sizes),
    zs AS (SELECT *, CASE WHEN n1 * n2 / 12e0 * (n1 + n2 + 1 - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1))) > 0 THEN (greatest(u, n1 * n2 - u) - n1 * n2 / 2e0 - 0.5e0) / sqrt(n1 * n2 / 12e0 * (n1 + n2 + 1 - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1)))) END AS z FROM fu),
    tested AS (SELECT o.{key}, n_case_observed, n_ref_observed, n1 - n_case_observed AS n_case_padded, n2 - n_ref_observed AS n_ref_padded, u AS u_stat,
        CASE WHEN z IS NOT NULL THEN CASE WHEN z >= 0 THEN {two_sided_normal_sql('z')} ELSE 1e0 END END AS p_value, 1 - 2 * u / (n1 * n2) AS rbc FROM obs o CROSS JOIN sizes LEFT JOIN (SELECT {key}, u, z FROM zs) USING ({key})),
    adjusted AS (SELECT *, CASE WHEN p_value IS NOT NULL THEN least(1e0, min(s) OVER (PARTITION BY p_value IS NULL ORDER BY p_value DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS adj_pvalue
        FROM (SELECT *, p_value * count(p_value) OVER () / count(*) OVER (PARTITION BY p_value IS NULL ORDER BY p_value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM tested))"""


_GENES = f"""SELECT * FROM (WITH {COMPLETE}, kept AS (SELECT e.* FROM eligible e SEMI JOIN complete c ON e.ref_id = c.ref_id), {_mwu_sql('kept', 'ref_id', 'proportion', 9)}"""


@_query(
    "gene_tests",
    f"""{_GENES}, ns AS (SELECT ref_id, count(*) FILTER (condition = 'case') AS n_sites_case, count(*) FILTER (condition = 'ref') AS n_sites_ref FROM kept GROUP BY 1)
    SELECT ref_id, complete_in, round(u_stat, 6) AS u_stat, round(p_value, 6) AS p_value, round(adj_pvalue, 6) AS adj_pvalue, round(rbc, 6) AS rbc, CAST(n_case_observed AS BIGINT) AS n_case_observed, CAST(n_case_padded AS BIGINT) AS n_case_padded,
    CAST(n_ref_observed AS BIGINT) AS n_ref_observed, CAST(n_ref_padded AS BIGINT) AS n_ref_padded, CAST(n_sites_case AS BIGINT) AS n_sites_case, CAST(n_sites_ref AS BIGINT) AS n_sites_ref FROM adjusted JOIN complete USING (ref_id) JOIN ns USING (ref_id))""",
)
def _(c):
    return _rounded(analyses.gene_tests(c).select("ref_id", "complete_in", "u_stat", "p_value", "adj_pvalue", "rbc", "n_case_observed", "n_case_padded", "n_ref_observed", "n_ref_padded", "n_sites_case", "n_sites_ref"))


@_query(
    "calltype_tests",
    f"""SELECT * FROM (WITH {COMPLETE}, kept AS (SELECT e.* FROM eligible e SEMI JOIN complete c ON e.ref_id = c.ref_id), {_mwu_sql('kept', 'a1type', 'weighted', 12)}
    SELECT 'complete' AS gene_set, a1type, round(u_stat, 6) AS u_stat, round(p_value, 6) AS p_value, round(adj_pvalue, 6) AS adj_pvalue, round(rbc, 6) AS rbc, CAST(n_case_observed AS BIGINT) AS n_case_observed, CAST(n_ref_observed AS BIGINT) AS n_ref_observed FROM adjusted)""",
)
def _(c):
    return _rounded(analyses.calltype_tests(c).select("gene_set", "a1type", "u_stat", "p_value", "adj_pvalue", "rbc", "n_case_observed", "n_ref_observed"))


@_query(
    "choose_basis",
    f"""{_GENES} SELECT count(*) AS n_tests, count(*) FILTER (adj_pvalue < 0.05) AS n_adjusted, count(*) FILTER (p_value < 0.05) AS n_raw,
    CASE WHEN count(*) > 0 AND count(*) FILTER (adj_pvalue < 0.05) >= 0.3 * count(*) THEN 'adj_pvalue' WHEN count(*) > 0 AND count(*) FILTER (p_value < 0.05) >= 0.3 * count(*) THEN 'p_value' END AS basis FROM adjusted)""",
)
def _(c):
    return ranks.choose_basis(analyses.gene_tests(c))


@_query("benjamini_hochberg_ranged", f"{_GENES} SELECT ref_id, round(adj_pvalue, 6) AS adj_pvalue FROM adjusted)")
def _(c):
    t = analyses.gene_tests(c).select("ref_id", "p_value")
    return _rounded(ranks.benjamini_hochberg(t, "p_value", "adj_pvalue", parts=16).select("ref_id", "adj_pvalue"))


_CHOSEN = f"""{_GENES}, b AS (SELECT CASE WHEN count(*) > 0 AND count(*) FILTER (adj_pvalue < 0.05) >= 0.3 * count(*) THEN 'adj_pvalue' WHEN count(*) > 0 AND count(*) FILTER (p_value < 0.05) >= 0.3 * count(*) THEN 'p_value' END AS basis FROM adjusted),
    sig AS (SELECT ref_id FROM adjusted, b WHERE CASE basis WHEN 'adj_pvalue' THEN adj_pvalue WHEN 'p_value' THEN p_value END < 0.05), chosen AS (SELECT ref_id, (SELECT count(*) FROM sig) > 0 AS filtered FROM adjusted WHERE (SELECT count(*) FROM sig) = 0 OR ref_id IN (SELECT ref_id FROM sig))"""


@_query("global_gene_set", f"{_CHOSEN} SELECT ref_id, filtered FROM chosen)")
def _(c):
    return analyses.global_gene_set(c)


@_query("analyse_all")
def _(c):
    """A row for each result of the whole run: its name and number of rows."""
    counts = [df.agg(F.lit(name).alias("result"), F.count("*").alias("n_rows")) for name, df in analyses.analyse_all(c).items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.union(df)
    return out


@_query("gene_sites", f"""SELECT * FROM (WITH {COMPLETE} SELECT DISTINCT ref_id, "individualID", chrom, pos FROM loaded l SEMI JOIN complete c ON l.ref_id = c.ref_id)""")
def _(c):
    return aggregates.gene_sites(c.loaded, aggregates.complete_genes(c.eligible, c.individual))


@_query("site_level", f"""SELECT * FROM (WITH {COMPLETE} SELECT ref_id, chrom, pos, a1type, l."individualID", condition, a1_ad, dp FROM loaded l JOIN individual i ON l."individualID" = i."individualID" SEMI JOIN complete c ON l.ref_id = c.ref_id)""")
def _(c):
    return aggregates.site_level(c.loaded, aggregates.complete_genes(c.eligible, c.individual), c.individual)


@_query("gene_map", """SELECT DISTINCT ref_id, gene_name, CAST(ref_id AS VARCHAR) AS ref_id_stripped FROM gene WHERE gene_name IS NOT NULL AND gene_name <> ''""")
def _(c):
    return aggregates.gene_map(c.gene)


@_query("cascade_check", """SELECT 'min_depth' AS "check", 20::BIGINT AS recorded, 20::BIGINT AS found, true AS agrees UNION ALL SELECT 'eligible_calls', count(*), count(*), true FROM eligible""")
def _(c):
    """The log is the one that the whole run's gene tests write."""
    return aggregates.cascade_check(aggregates.filter_cascade(c.loaded), _log(c))


def _log(c) -> DataFrame:
    tested = stored(analyses.gene_tests(c))
    genes = stored(ranks.resolve_gene_set(ranks.significant(tested, ranks.choose_basis(tested)), tested))
    classes = aggregates.classify_genes(analyses.calls_of(c, genes))
    return analyses.gene_tests_log(c, tested, analyses.calltype_tests(c), genes, classes)


@_query("gene_tests_log", f"""{_CHOSEN}, gc AS (SELECT ref_id, count(*) FILTER (condition = 'case') / CAST(count(*) AS DOUBLE) AS share FROM eligible e SEMI JOIN chosen c ON e.ref_id = c.ref_id GROUP BY 1),
    gg AS (SELECT CASE WHEN share >= 0.75 THEN 'case_enriched' WHEN 1 - share >= 0.75 THEN 'ref_enriched' ELSE 'Shared' END AS k, count(*) AS n FROM gc GROUP BY 1), f AS (SELECT coalesce(max(filtered), false) AS filtered, count(*) AS n FROM chosen),
    kv(key, value) AS (SELECT 'n_eligible_calls', (SELECT count(*) FROM eligible)::VARCHAR UNION ALL SELECT 'n_genes_considered', (SELECT count(DISTINCT ref_id) FROM eligible)::VARCHAR UNION ALL SELECT 'n_genes_complete', (SELECT count(*) FROM complete)::VARCHAR
      UNION ALL SELECT 'n_tests', count(*)::VARCHAR FROM adjusted UNION ALL SELECT 'n_tests_defined', count(p_value)::VARCHAR FROM adjusted UNION ALL SELECT 'n_tests_adjusted_sig', count(*) FILTER (adj_pvalue < 0.05)::VARCHAR FROM adjusted
      UNION ALL SELECT 'global_set_basis', coalesce(basis, 'none') FROM b UNION ALL SELECT 'n_genes_global_set', CASE WHEN filtered THEN n ELSE 0 END::VARCHAR FROM f UNION ALL SELECT 'subset_from_global_set', CASE WHEN filtered THEN '1' ELSE '0' END FROM f UNION ALL SELECT 'n_genes_in_subsets', n::VARCHAR FROM f
      UNION ALL SELECT 'n_calls_in_subsets', (SELECT count(*) FROM eligible e SEMI JOIN chosen c ON e.ref_id = c.ref_id)::VARCHAR UNION ALL SELECT 'n_genes_classified', count(*)::VARCHAR FROM gc UNION ALL SELECT 'group_sizes', string_agg(k || '=' || n, ',' ORDER BY k) FROM gg
      UNION ALL SELECT 'n_case', n1::VARCHAR FROM sizes UNION ALL SELECT 'n_reference', n2::VARCHAR FROM sizes UNION ALL SELECT 'min_depth', '20')
    SELECT 'gene_tests.' || key AS key, value FROM kv)""")
def _(c):
    """What doesn't concern the test of types, which the log notes as well."""
    keys = "n_eligible_calls n_genes_considered n_genes_complete n_tests n_tests_defined n_tests_adjusted_sig global_set_basis n_genes_global_set subset_from_global_set n_genes_in_subsets n_calls_in_subsets n_genes_classified group_sizes n_case n_reference min_depth"
    return _log(c).where(F.col("key").isin([f"gene_tests.{k}" for k in keys.split()]))


@_query("exclusion_by_type", """SELECT p_type AS transcript_type, count(DISTINCT p_partkey) AS n_genes, count(*) AS n_transcripts FROM part WHERE contains(p_type, 'PROMO') OR contains(p_type, 'STEEL') GROUP BY 1""")
def _(c):
    return aggregates.exclusion_by_type(c.gene.select("ref_id", F.col("biotype").alias("transcript_type")), ["PROMO", "STEEL"])


@_query("marker_check", f"""SELECT * FROM (WITH x AS (SELECT ref_id AS gene, condition, fpkm AS v FROM expression JOIN individual USING ("individualID") WHERE ref_id % 50 = 0), m AS (SELECT gene, quantile_cont(v, 0.5) FILTER (condition = 'case') AS a, quantile_cont(v, 0.5) FILTER (condition = 'ref') AS b FROM x GROUP BY 1)
    SELECT gene, round(a, 6) AS median_case, round(b, 6) AS median_ref, round(a / b, 6) AS ratio FROM m)""")
def _(c):
    """The listed markers are the genes whose number is divisible by 50."""
    return _rounded(models.marker_check(_rows(c), _arms(c), c.gene.where("ref_id % 50 = 0").select(F.col("ref_id").alias("gene"))))


@_query(
    "aggregate_calltypes",
    """SELECT ref_id, a1type, count(*) FILTER (condition = 'case') AS n_sites_case, count(*) FILTER (condition = 'ref') AS n_sites_ref, count(DISTINCT "individualID") FILTER (condition = 'case') AS n_indiv_case, count(DISTINCT "individualID") FILTER (condition = 'ref') AS n_indiv_ref,
    CAST(coalesce(sum(a1_ad) FILTER (condition = 'case'), 0) AS BIGINT) AS sum_ad_case, CAST(coalesce(sum(a1_ad) FILTER (condition = 'ref'), 0) AS BIGINT) AS sum_ad_ref, CAST(coalesce(sum(dp) FILTER (condition = 'case'), 0) AS BIGINT) AS sum_dp_case, CAST(coalesce(sum(dp) FILTER (condition = 'ref'), 0) AS BIGINT) AS sum_dp_ref FROM eligible GROUP BY 1, 2""",
)
def _(c):
    return aggregates.aggregate_calltypes(c.eligible)


CLASSES = """classes AS (SELECT ref_id, CASE WHEN a > b THEN 'case_enriched' WHEN b > a THEN 'ref_enriched' ELSE 'Both' END AS edit_dist,
    CASE WHEN a / CAST(a + b AS DOUBLE) >= 0.75 THEN 'case_enriched' WHEN b / CAST(a + b AS DOUBLE) >= 0.75 THEN 'ref_enriched' ELSE 'Shared' END AS gene_group, a AS n_calls_case, b AS n_calls_ref
    FROM (SELECT ref_id, count(*) FILTER (condition = 'case') AS a, count(*) FILTER (condition = 'ref') AS b FROM eligible GROUP BY 1))"""


#: The same of the genes that were found significant (all tested ones where there are none).
CHOSEN_CLASSES = f"""{_CHOSEN}, mine AS (SELECT e.* FROM eligible e SEMI JOIN chosen c ON e.ref_id = c.ref_id), {CLASSES.replace('FROM eligible GROUP BY 1', 'FROM mine GROUP BY 1')}"""


@_query("gene_calltypes", f"""SELECT * FROM (WITH {COMPLETE} SELECT ref_id, a1type, count(*) FILTER (condition = 'case') AS n_sites_case, count(*) FILTER (condition = 'ref') AS n_sites_ref, count(DISTINCT "individualID") FILTER (condition = 'case') AS n_indiv_case, count(DISTINCT "individualID") FILTER (condition = 'ref') AS n_indiv_ref,
    CAST(coalesce(sum(a1_ad) FILTER (condition = 'case'), 0) AS BIGINT) AS sum_ad_case, CAST(coalesce(sum(a1_ad) FILTER (condition = 'ref'), 0) AS BIGINT) AS sum_ad_ref, CAST(coalesce(sum(dp) FILTER (condition = 'case'), 0) AS BIGINT) AS sum_dp_case, CAST(coalesce(sum(dp) FILTER (condition = 'ref'), 0) AS BIGINT) AS sum_dp_ref FROM eligible e SEMI JOIN complete c ON e.ref_id = c.ref_id GROUP BY 1, 2)""")
def _(c):
    return analyses.gene_calltypes(c)


@_query("classify_genes", f"SELECT * FROM (WITH {CLASSES} SELECT * FROM classes)")
def _(c):
    return aggregates.classify_genes(c.eligible)


@_query("calltype_load", f"""SELECT * FROM (WITH {COMPLETE} SELECT a1type, condition, "individualID", count(*) AS n_sites FROM eligible e SEMI JOIN complete c ON e.ref_id = c.ref_id GROUP BY 1, 2, 3)""")
def _(c):
    return aggregates.calltype_load(c.eligible, aggregates.complete_genes(c.eligible, c.individual))


@_query(
    "filter_cascade",
    """SELECT stage_no, stage, calls, sites, genes, CAST(coalesce(lag(calls) OVER (ORDER BY stage_no) - calls, 0) AS BIGINT) AS dropped FROM (
    SELECT n AS stage_no, s AS stage, count(*) AS calls, count(DISTINCT (chrom, pos)) AS sites, count(DISTINCT ref_id) AS genes
    FROM loaded JOIN (VALUES (1, 'loaded'), (2, 'in_gene'), (3, 'classified'), (4, 'at_depth')) v(n, s) ON n = 1 OR (ref_id IS NOT NULL AND (n = 2 OR (a1type IS NOT NULL AND (n = 3 OR dp >= 20)))) GROUP BY 1, 2)""",
)
def _(c):
    return aggregates.filter_cascade(c.loaded)


@_query("calltype_rates", """SELECT a1type, condition, count(*) AS n_calls, count(DISTINCT (chrom, pos)) AS n_sites, count(DISTINCT "individualID") AS n_individuals, count(DISTINCT ref_id) AS n_genes FROM eligible GROUP BY 1, 2""")
def _(c):
    return aggregates.calltype_rates(c.eligible)


@_query(
    "threshold_sweep",
    f"""{CHOSEN_CLASSES}, th AS (SELECT unnest([0.6e0, 0.7e0, 0.8e0, 0.75e0]) AS threshold), gg AS (SELECT unnest(['case_enriched', 'ref_enriched', 'Shared']) AS gene_group)
    SELECT threshold, gene_group, (SELECT count(*) FROM classes WHERE gg.gene_group = CASE WHEN n_calls_case / CAST(n_calls_case + n_calls_ref AS DOUBLE) >= threshold THEN 'case_enriched' WHEN n_calls_ref / CAST(n_calls_case + n_calls_ref AS DOUBLE) >= threshold THEN 'ref_enriched' ELSE 'Shared' END) AS n_genes FROM th, gg)""",
)
def _(c):
    return analyses.threshold_sweep(c, analyses.gene_classes(c))


@_query(
    "sweep_chi2",
    f"""SELECT * FROM (WITH {CLASSES}, o AS (SELECT edit_dist, gene_group, count(*) AS n FROM classes GROUP BY 1, 2), m AS (SELECT *, sum(n) OVER (PARTITION BY edit_dist) AS r, sum(n) OVER (PARTITION BY gene_group) AS k, sum(n) OVER () AS t FROM (SELECT a.edit_dist, b.gene_group, coalesce(n, 0) AS n FROM (SELECT DISTINCT edit_dist FROM o) a CROSS JOIN (SELECT DISTINCT gene_group FROM o) b LEFT JOIN o USING (edit_dist, gene_group))),
    x AS (SELECT sum(power(n - r * k / CAST(t AS DOUBLE), 2) / (r * k / CAST(t AS DOUBLE))) AS x2, (count(DISTINCT edit_dist) - 1) * (count(DISTINCT gene_group) - 1) AS dof, least(count(DISTINCT edit_dist), count(DISTINCT gene_group)) - 1 AS mi, max(t) AS t FROM m)
    SELECT round(x2, 6) AS chi2, CAST(dof AS BIGINT) AS dof, round(sqrt(x2 / (t * mi)), 6) AS cramers_v FROM x)""",
)
def _(c):
    n = aggregates.classify_genes(c.eligible).groupBy("edit_dist", "gene_group").agg(F.count("*").alias("n"))
    grid = n.select("edit_dist").distinct().join(n.select("gene_group").distinct(), F.lit(True)).join(n, ["edit_dist", "gene_group"], "left").fillna(0, ["n"]).withColumn("all", F.lit(1))
    return _rounded(tests.chi2_independence(grid, ["all"], "edit_dist", "gene_group").select("chi2", "dof", "cramers_v"))


@_query("tpm_normalise", """SELECT "individualID", ref_id, round(CASE WHEN t > 0 THEN fpkm / t * 1e6 ELSE 0 END, 4) AS tpm FROM (SELECT *, sum(fpkm) OVER (PARTITION BY "individualID") AS t FROM expression)""")
def _(c):
    return aggregates.tpm(c.expression).select("individualID", "ref_id", F.round("tpm", 4).alias("tpm"))


@_query("call_burden", """SELECT "individualID", count(*) AS n_calls, count(DISTINCT (chrom, pos)) AS n_positions, count(DISTINCT ref_id) AS n_genes FROM loaded GROUP BY 1""")
def _(c):
    return aggregates.call_burden(c.loaded)


_UNIQUE = """car AS (SELECT chrom, pos, count(DISTINCT "individualID") AS k FROM eligible GROUP BY 1, 2), cells AS (SELECT edit_dist, a1type,
    count(DISTINCT (chrom, pos)) FILTER (condition = 'case' AND k = 1) AS n_case_unique, count(DISTINCT (chrom, pos)) FILTER (condition = 'case' AND k > 1) AS n_case_common,
    count(DISTINCT (chrom, pos)) FILTER (condition = 'ref' AND k = 1) AS n_ref_unique, count(DISTINCT (chrom, pos)) FILTER (condition = 'ref' AND k > 1) AS n_ref_common
    FROM eligible JOIN classes USING (ref_id) JOIN car USING (chrom, pos) GROUP BY 1, 2)"""
UNIQUE = f"{CLASSES}, {_UNIQUE}"


@_query("count_positions", f"SELECT * FROM (WITH {UNIQUE} SELECT * FROM cells)")
def _(c):
    return aggregates.count_positions(c.eligible, aggregates.classify_genes(c.eligible))


_OR = scalars.odds_ratio_ci_sql("n_case_unique", "n_case_common", "n_ref_unique", "n_ref_common")


@_query(
    "site_uniqueness",
    f"""{CHOSEN_CLASSES}, {_UNIQUE}, lf AS (SELECT *, lgamma(n_case_unique + n_case_common + 1) + lgamma(n_ref_unique + n_ref_common + 1) + lgamma(n_case_unique + n_ref_unique + 1) + lgamma(n_case_common + n_ref_common + 1) - lgamma(n_case_unique + n_case_common + n_ref_unique + n_ref_common + 1) AS c,
      unnest(generate_series(greatest(0, n_case_unique - n_ref_common), least(n_case_unique + n_case_common, n_case_unique + n_ref_unique))) AS k FROM cells),
    pk AS (SELECT *, exp(c - lgamma(k + 1) - lgamma(n_case_unique + n_case_common - k + 1) - lgamma(n_case_unique + n_ref_unique - k + 1) - lgamma(n_ref_common - n_case_unique + k + 1)) AS p FROM lf),
    po AS (SELECT *, max(p) FILTER (k = n_case_unique) OVER (PARTITION BY edit_dist, a1type) AS seen FROM pk),
    fi AS (SELECT edit_dist, a1type, n_case_unique, n_case_common, n_ref_unique, n_ref_common, least(1e0, sum(p) FILTER (p <= seen * (1 + 1e-7))) AS p_value FROM po GROUP BY ALL)
    SELECT edit_dist, a1type, n_case_unique, n_case_common, n_ref_unique, n_ref_common, round({_OR['odds_ratio']}, 6) AS odds_ratio, round({_OR['ci_low']}, 6) AS ci_low, round({_OR['ci_high']}, 6) AS ci_high, round(p_value, 6) AS p_value FROM fi)""",
)
def _(c):
    t = analyses.site_uniqueness(c, stored(analyses.gene_classes(c)))
    return _rounded(t.select("edit_dist", "a1type", "n_case_unique", "n_case_common", "n_ref_unique", "n_ref_common", "odds_ratio", "ci_low", "ci_high", "p_value"))


def _t_sql(t: str, df: str) -> str:
    """Two-sided p-value of t: the tail as an integral over the angle (Simpson's rule), another way than the engine's."""
    phi = f"(atan(sqrt({df}) / ({t})))"
    area = f"list_sum([(CASE WHEN k % 2 = 1 THEN 4 WHEN k = 400 THEN 1 ELSE 2 END) * power(k / 400e0, 3) * power(sin({phi} * power(k / 400e0, 4)), {df} - 1) for k in range(1, 401)])"
    return f"CASE WHEN {t} = 0 THEN 1e0 WHEN {t} > 0 THEN 2e0 * exp(lgamma(({df} + 1) / 2e0) - lgamma({df} / 2e0)) / sqrt(pi()) * 4 * {phi} / 1200e0 * {area} END"


def _bh_sql(source: str, p: str, adjusted: str) -> str:
    """Every row of ``source`` with its adjusted p-value."""
    return f"""SELECT *, CASE WHEN {p} IS NOT NULL THEN least(1e0, min(bh) OVER (PARTITION BY {p} IS NULL ORDER BY {p} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS {adjusted}
        FROM (SELECT *, {p} * count({p}) OVER () / count(*) OVER (PARTITION BY {p} IS NULL ORDER BY {p} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bh FROM {source})"""


_WELCH = """per AS (SELECT ref_id, a1type, condition, "individualID", sum(a1_ad) AS ad, sum(dp) AS depth, sum(a1_ad) / CAST(sum(dp) AS DOUBLE) AS p FROM mine GROUP BY 1, 2, 3, 4),
    g AS (SELECT ref_id, a1type, count(*) FILTER (condition = 'case') AS n_case, count(*) FILTER (condition = 'ref') AS n_ref, avg(p) FILTER (condition = 'case') AS m1, avg(p) FILTER (condition = 'ref') AS m2, var_samp(p) FILTER (condition = 'case') AS v1, var_samp(p) FILTER (condition = 'ref') AS v2,
      sum(ad) FILTER (condition = 'case') / CAST(sum(depth) FILTER (condition = 'case') AS DOUBLE) AS prop_case, sum(ad) FILTER (condition = 'ref') / CAST(sum(depth) FILTER (condition = 'ref') AS DOUBLE) AS prop_ref FROM per GROUP BY 1, 2),
    s AS (SELECT *, CASE WHEN n_case > 1 AND n_ref > 1 THEN v1 / n_case + v2 / n_ref END AS se FROM g),
    w AS (SELECT *, CASE WHEN se > 1e-18 THEN (m1 - m2) / sqrt(se) END AS t_stat, CASE WHEN se > 1e-18 THEN se * se / (power(v1 / n_case, 2) / (n_case - 1) + power(v2 / n_ref, 2) / (n_ref - 1)) END AS df FROM s)"""


@_query(
    "welch_stage4",
    f"""{CHOSEN_CLASSES}, {_WELCH}
    SELECT ref_id, a1type, n_case, n_ref, round(prop_case, 6) AS prop_case, round(prop_ref, 6) AS prop_ref, round(t_stat, 5) AS t_stat, round(df, 4) AS df FROM w)""",
)
def _(c):
    t = analyses.local_stage4(analyses.calls_of(c, analyses.gene_classes(c)), c.sizes)
    ok = F.expr("var_case / n_case + var_ref / n_ref > 1e-18")
    return t.select("ref_id", "a1type", "n_case", "n_ref", F.round("prop_case", 6).alias("prop_case"), F.round("prop_ref", 6).alias("prop_ref"), F.round(F.when(ok, F.col("t_stat")), 5).alias("t_stat"), F.round(F.when(ok, F.col("df")), 4).alias("df"))


def _pooled_sql(source: str) -> str:
    """Common table expressions that end in ``pooled``: Mann-Whitney of each (gene, type) by the normal approximation."""
    rank = "rank() OVER (PARTITION BY ref_id, a1type ORDER BY weighted) + (count(*) OVER (PARTITION BY ref_id, a1type, weighted) - 1) / 2e0"
    return f"""pr AS (SELECT ref_id, a1type, condition = 'case' AS c, weighted, {rank} AS r, count(*) OVER (PARTITION BY ref_id, a1type, weighted) AS t FROM {source}),
    pm AS (SELECT ref_id, a1type, count(*) FILTER (c) AS k1, count(*) FILTER (NOT c) AS k2, sum(r) FILTER (c) AS r1, sum(t * t - 1) AS ties, avg(weighted) FILTER (c) AS w1, avg(weighted) FILTER (NOT c) AS w2 FROM pr GROUP BY 1, 2),
    pu AS (SELECT *, r1 - k1 * (k1 + 1) / 2e0 AS u, sqrt(k1 * k2 / 12e0 * (k1 + k2 + 1 - ties / (CAST(k1 + k2 AS DOUBLE) * (k1 + k2 - 1)))) AS sd FROM pm),
    pz AS (SELECT *, CASE WHEN k1 > 0 AND k2 > 0 AND sd > 0 THEN (greatest(u, k1 * k2 - u) - k1 * k2 / 2e0 - 0.5e0) / sd END AS z FROM pu),
    pooled AS (SELECT ref_id, a1type, CASE WHEN k1 > 0 AND k2 > 0 THEN u END AS prop_u_stat, CASE WHEN z IS NOT NULL THEN CASE WHEN z >= 0 THEN {two_sided_normal_sql('z')} ELSE 1e0 END END AS prop_p_value,
      CASE WHEN k1 = 0 THEN 'ref' WHEN k2 = 0 OR w1 > w2 THEN 'case' ELSE 'ref' END AS higher_prop FROM pz)"""


@_query(
    "mannwhitney_pooled",
    f"""{CHOSEN_CLASSES}, many AS (SELECT ref_id, a1type FROM mine GROUP BY 1, 2 HAVING count(*) FILTER (condition = 'case') > 8 AND count(*) FILTER (condition = 'ref') > 8), src AS (SELECT e.* FROM mine e SEMI JOIN many m ON e.ref_id = m.ref_id AND e.a1type = m.a1type), {_pooled_sql('src')}
    SELECT ref_id, a1type, round(prop_u_stat, 6) AS prop_u_stat, round(prop_p_value, 6) AS prop_p_value, round(adj_pvalue, 6) AS adj_pvalue FROM ({_bh_sql('pooled', 'prop_p_value', 'adj_pvalue')}))""",
)
def _(c):
    """Pairs of a gene and a type with more than eight values in both arms (smaller arms have the exact test)."""
    calls = written(analyses.calls_of(c, analyses.gene_classes(c)))
    arms = calls.groupBy("ref_id", "a1type").agg(F.count_if(F.col("condition") == "case").alias("a"), F.count_if(F.col("condition") == "ref").alias("b")).where("a > 8 AND b > 8")
    t = tests.mannwhitney_pooled(calls.join(arms.select("ref_id", "a1type"), ["ref_id", "a1type"], "left_semi"), ["ref_id", "a1type"])
    return _rounded(ranks.benjamini_hochberg(t, "prop_p_value", "adj_pvalue", parts=64).select("ref_id", "a1type", "prop_u_stat", "prop_p_value", "adj_pvalue"))


_SIZE = "(SELECT count(*) FROM individual WHERE condition = '{}')"
_LOCAL = f"""{CHOSEN_CLASSES}, {_WELCH},
    wp AS (SELECT *, CASE WHEN se > 1e-18 THEN {_t_sql('abs(t_stat)', 'df')} WHEN se IS NOT NULL AND abs(m1 - m2) > 1e-12 THEN 0e0 END AS p_value FROM w), wa AS ({_bh_sql('wp', 'p_value', 'adj_pvalue')}),
    lb AS (SELECT CASE WHEN count(*) FILTER (adj_pvalue < 0.01) >= 0.3 * count(*) THEN 'adj_pvalue' WHEN count(*) FILTER (p_value < 0.01) >= 0.3 * count(*) THEN 'p_value' END AS basis FROM wa),
    wm AS (SELECT *, n_case >= ceil({_SIZE.format('case')} / 2e0) OR n_ref >= ceil({_SIZE.format('ref')} / 2e0) AS has_majority FROM wa),
    wr AS (SELECT *, has_majority AND coalesce(CASE basis WHEN 'adj_pvalue' THEN adj_pvalue WHEN 'p_value' THEN p_value END < 0.01, false) AS retained,
      CASE WHEN n_case = 0 AND n_ref = {_SIZE.format('ref')} OR n_ref = 0 AND n_case = {_SIZE.format('case')} THEN 'specific' WHEN n_case = 0 OR n_ref = 0 THEN 'low-specific' WHEN greatest(n_case, n_ref) >= 1.5 * least(n_case, n_ref) THEN 'double' ELSE 'differential' END AS local_dist FROM wm, lb),
    src AS (SELECT e.* FROM mine e SEMI JOIN (SELECT * FROM wr WHERE retained) m ON e.ref_id = m.ref_id AND e.a1type = m.a1type), {_pooled_sql('src')}, pa AS ({_bh_sql('pooled', 'prop_p_value', 'prop_adj_pvalue')})"""


@_query(
    "local_sites",
    f"""{_LOCAL} SELECT ref_id, a1type, n_case, n_ref, {', '.join(f'round({x}, 6) AS {x}' for x in ('prop_case', 'prop_ref', 'p_value', 'adj_pvalue', 'prop_u_stat', 'prop_p_value', 'prop_adj_pvalue'))}, has_majority, local_dist, CAST(retained AS INT) AS retained, higher_prop,
    CAST(retained AND (greatest(n_case, n_ref) > 1 AND greatest(n_case, n_ref) >= 1.5 * least(n_case, n_ref) OR coalesce(prop_p_value < 0.05, false)) AS INT) AS final_retained FROM wr LEFT JOIN pa USING (ref_id, a1type))""",
)
def _(c):
    t = analyses.local_sites(c, stored(analyses.gene_classes(c)))
    return _rounded(t.select("ref_id", "a1type", "n_case", "n_ref", "prop_case", "prop_ref", "p_value", "adj_pvalue", "prop_u_stat", "prop_p_value", "prop_adj_pvalue", "has_majority", "local_dist", "retained", "higher_prop", "final_retained"))


@_query(
    "site_counts",
    f"""SELECT * FROM (WITH {CLASSES} SELECT ref_id, a1type, chrom, pos, count(DISTINCT "individualID") FILTER (condition = 'case') AS n_case, count(DISTINCT "individualID") FILTER (condition = 'ref') AS n_ref FROM eligible e SEMI JOIN (SELECT ref_id FROM classes WHERE gene_group <> 'Shared') s ON e.ref_id = s.ref_id GROUP BY 1, 2, 3, 4)""",
)
def _(c):
    special = aggregates.classify_genes(c.eligible).where("gene_group <> 'Shared'").select("ref_id")
    pairs = c.eligible.join(special, "ref_id", "left_semi").select("ref_id", "a1type").distinct()
    return aggregates.site_counts(c.eligible, pairs)


MATRIX = f"""{COMPLETE}, tp AS (SELECT "individualID", ref_id, fpkm / sum(fpkm) OVER (PARTITION BY "individualID") * 1e6 AS tpm FROM expression), nc AS (SELECT ref_id, "individualID", count(*) AS n_calls FROM eligible GROUP BY 1, 2),
    matrix AS (SELECT c.ref_id, i."individualID", i.condition, coalesce(tpm, 0) AS tpm, coalesce(n_calls, 0) AS n_calls FROM (SELECT ref_id FROM complete) c CROSS JOIN individual i LEFT JOIN tp USING (ref_id, "individualID") LEFT JOIN nc USING (ref_id, "individualID"))"""


@_query("zero_filled_matrix", f"""SELECT * FROM (WITH {MATRIX} SELECT ref_id, "individualID", condition, round(tpm, 4) AS tpm, n_calls FROM matrix)""")
def _(c):
    m = analyses.expression_matrix(c, aggregates.complete_genes(c.eligible, c.individual))
    return m.withColumn("tpm", F.round("tpm", 4))


@_query(
    "spearman_by_condition",
    f"""SELECT * FROM (WITH {MATRIX}, rk AS (SELECT ref_id, condition, rank() OVER (PARTITION BY ref_id, condition ORDER BY tpm) + (count(*) OVER (PARTITION BY ref_id, condition, tpm) - 1) / 2e0 AS rx,
      rank() OVER (PARTITION BY ref_id, condition ORDER BY n_calls) + (count(*) OVER (PARTITION BY ref_id, condition, n_calls) - 1) / 2e0 AS ry FROM matrix)
    SELECT ref_id, condition, count(*) AS n, round(CASE WHEN count(*) >= 4 AND min(rx) < max(rx) AND min(ry) < max(ry) THEN corr(rx, ry) END, 6) AS rho FROM rk GROUP BY 1, 2)""",
)
def _(c):
    m = analyses.expression_matrix(c, aggregates.complete_genes(c.eligible, c.individual))
    return _rounded(tests.spearman(m, ["ref_id", "condition"], "tpm", "n_calls").select("ref_id", "condition", "n", "rho"))


def _spearman_sql(source: str, keys: str, x: str, y: str, least: int = 4) -> str:
    """Common table expressions that end in ``correlated``: keys, n, rho, p_value."""
    rank = lambda v: f"rank() OVER (PARTITION BY {keys} ORDER BY {v}) + (count(*) OVER (PARTITION BY {keys}, {v}) - 1) / 2e0"
    t = "abs(rho) * sqrt((n - 2) / (1 - rho * rho))"
    return f"""ranked AS (SELECT {keys}, {rank(x)} AS rx, {rank(y)} AS ry FROM {source}),
    rhos AS (SELECT {keys}, count(*) AS n, CASE WHEN count(*) >= {least} AND min(rx) < max(rx) AND min(ry) < max(ry) THEN round(corr(rx, ry), 12) END AS rho FROM ranked GROUP BY ALL),
    correlated AS (SELECT * EXCLUDE (t), CASE WHEN abs(rho) >= 1 THEN 0e0 ELSE {_t_sql('t', '(n - 2)')} END AS p_value FROM (SELECT *, CASE WHEN abs(rho) < 1 THEN {t} END AS t FROM rhos))"""


_CORRELATED = f"""{MATRIX}, {_spearman_sql('matrix', 'ref_id, condition', 'tpm', 'n_calls')},
    wide AS (SELECT ref_id, {', '.join(f"max({x}) FILTER (condition = '{a}') AS {x}_{a}" for a in ('case', 'ref') for x in ('n', 'rho', 'p_value'))} FROM correlated GROUP BY 1),
    zs AS (SELECT *, CASE WHEN n_case > 3 AND n_ref > 3 AND abs(rho_case) < 1 AND abs(rho_ref) < 1 THEN abs(atanh(rho_case) - atanh(rho_ref)) / sqrt(1e0 / (n_case - 3) + 1e0 / (n_ref - 3)) END AS z FROM wide),
    ps AS (SELECT * EXCLUDE (z), CASE WHEN z IS NOT NULL THEN {two_sided_normal_sql('z')} END AS diff_pvalue FROM zs)"""


@_query(
    "expression_correlation",
    f"""SELECT * FROM (WITH {_CORRELATED} SELECT ref_id, n_case, n_ref, {', '.join(f'round({x}, 5) AS {x}' for x in ('rho_case', 'rho_ref', 'p_value_case', 'p_value_ref', 'diff_pvalue', 'diff_adj_pvalue'))} FROM ({_bh_sql('ps', 'diff_pvalue', 'diff_adj_pvalue')}))""",
)
def _(c):
    return _rounded(analyses.expression_correlation(c, aggregates.complete_genes(c.eligible, c.individual)), 5)


@_query(
    "correlation_summary",
    f"""SELECT * FROM (WITH {_CORRELATED}, hit AS (SELECT coalesce(p_value_case < 0.05, false) AS a, coalesce(p_value_ref < 0.05, false) AS b FROM wide) SELECT CASE WHEN a AND b THEN 'Both' WHEN a THEN 'case only' WHEN b THEN 'ref only' ELSE 'Neither' END AS kind, count(*) AS n_genes FROM hit GROUP BY 1)""",
)
def _(c):
    return analyses.correlation_summary(analyses.expression_correlation(c, aggregates.complete_genes(c.eligible, c.individual)))


@_query(
    "gene_classes",
    f"""{_CHOSEN}, n AS (SELECT ref_id, count(*) FILTER (condition = 'case') AS a, count(*) FILTER (condition = 'ref') AS b FROM eligible e SEMI JOIN chosen c ON e.ref_id = c.ref_id GROUP BY 1)
    SELECT ref_id, CASE WHEN a > b THEN 'case_enriched' WHEN b > a THEN 'ref_enriched' ELSE 'Both' END AS edit_dist, CASE WHEN a / CAST(a + b AS DOUBLE) >= 0.75 THEN 'case_enriched' WHEN b / CAST(a + b AS DOUBLE) >= 0.75 THEN 'ref_enriched' ELSE 'Shared' END AS gene_group, a AS n_calls_case, b AS n_calls_ref FROM n)""",
)
def _(c):
    return analyses.gene_classes(c)


PANEL = """panel AS (SELECT chrom, pos, count(DISTINCT "individualID") AS n_samples FROM call SEMI JOIN (SELECT * FROM individual WHERE condition = 'ref') i ON call."individualID" = i."individualID" GROUP BY 1, 2 HAVING count(DISTINCT "individualID") >= 2)"""


@_query("panel_of_normals", f"SELECT * FROM (WITH {PANEL} SELECT * FROM panel)")
def _(c):
    return aggregates.panel_of_normals(c.call, c.individual.where("condition = 'ref'"))


@_query(
    "rna_unique",
    f"""SELECT * FROM (WITH {PANEL.replace('>= 2', '>= 4')}, oth AS (SELECT DISTINCT "individualID", chrom, pos FROM call WHERE o_orderstatus = 'F')
    SELECT c.chrom, c.pos, c."individualID", c.ref, c.alt1, c.dp, c.a1_ad, CASE WHEN o.pos IS NOT NULL THEN 'other' WHEN p.pos IS NOT NULL THEN 'panel' ELSE 'kept' END AS origin, CASE WHEN o.pos IS NULL AND p.pos IS NULL AND c.pos % 3 = 0 THEN 1 ELSE 0 END AS germline
    FROM call c LEFT JOIN oth o ON c."individualID" = o."individualID" AND c.chrom = o.chrom AND c.pos = o.pos LEFT JOIN panel p ON c.chrom = p.chrom AND c.pos = p.pos)""",
)
def _(c):
    return analyses.rna_unique(c).select("chrom", "pos", "individualID", "ref", "alt1", "dp", "a1_ad", "origin", "germline")


@_query(
    "rna_unique_summary",
    f"""SELECT * FROM (WITH {PANEL.replace('>= 2', '>= 4')}, oth AS (SELECT DISTINCT "individualID", chrom, pos FROM call WHERE o_orderstatus = 'F')
    SELECT c."individualID", count(*) AS n_calls, count(*) FILTER (o.pos IS NOT NULL) AS n_other, count(*) FILTER (o.pos IS NULL AND p.pos IS NOT NULL) AS n_panel, count(*) FILTER (o.pos IS NULL AND p.pos IS NULL) AS n_kept, count(*) FILTER (o.pos IS NULL AND p.pos IS NULL AND c.pos % 3 = 0) AS n_germline
    FROM call c LEFT JOIN oth o ON c."individualID" = o."individualID" AND c.chrom = o.chrom AND c.pos = o.pos LEFT JOIN panel p ON c.chrom = p.chrom AND c.pos = p.pos GROUP BY 1)""",
)
def _(c):
    n = lambda name, e: F.count_if(F.expr(e)).alias(name)
    return analyses.rna_unique(c).groupBy("individualID").agg(F.count("*").alias("n_calls"), n("n_other", "origin = 'other'"), n("n_panel", "origin = 'panel'"), n("n_kept", "origin = 'kept'"), n("n_germline", "germline = 1"))


CHECKED = """checked AS (SELECT s.chrom, s.pos, CASE WHEN s.pos % 3 = 0 THEN 'yes' ELSE 'no' END AS in_a, coalesce(string_agg(DISTINCT b.id, ',' ORDER BY b.id), 'NA') AS b_ids FROM site s
    LEFT JOIN (SELECT chrom, pos, 'ID' || l_linenumber AS id FROM call_raw WHERE l_partkey % 7 = 0) b ON s.chrom = b.chrom AND s.pos = b.pos GROUP BY 1, 2, 3)"""


def _checked(c):
    b = c.call_raw.where("l_partkey % 7 = 0").select("chrom", "pos", F.concat(F.lit("ID"), F.col("l_linenumber").cast("string")).alias("id"))
    return joins.external_check(c.site, c.site.where("pos % 3 = 0"), b)


@_query("external_check", f"SELECT * FROM (WITH {CHECKED} SELECT * FROM checked)")
def _(c):
    return _checked(c)


@_query("external_totals", f"SELECT * FROM (WITH {CHECKED} SELECT count(*) FILTER (in_a = 'yes') AS in_a, count(*) FILTER (b_ids <> 'NA') AS in_b, count(*) FILTER (in_a = 'yes' AND b_ids <> 'NA') AS both, count(*) FILTER (in_a = 'no' AND b_ids = 'NA') AS neither, count(*) AS total FROM checked)")
def _(c):
    return joins.external_totals(_checked(c))


@_query("threshold_filters", """SELECT filter, count(*) AS n FROM (SELECT CASE WHEN f = '' THEN 'PASS' ELSE f END AS filter FROM (SELECT concat_ws(';', CASE WHEN a1_ad * 2 < 25 THEN 'qual_filt' END, CASE WHEN a1_ad < 10 THEN 'qual_depth_filt' END, CASE WHEN dp < 20 THEN 'depth_filt' END) AS f FROM call)) GROUP BY 1""")
def _(c):
    scored = c.call.select("dp", (F.col("a1_ad") * 2).alias("qual"), F.col("a1_ad").alias("qd"))
    return scored.select(scalars.threshold_filters().alias("filter")).groupBy("filter").agg(F.count("*").alias("n"))


@_query("percentile_of_burden", """SELECT "individualID", round(cume_dist() OVER (ORDER BY count(*)), 6) AS share FROM loaded GROUP BY 1""")
def _(c):
    # A row for each individual: a cohort's size.
    burden = c.loaded.groupBy("individualID").agg(F.count("*").alias("n"))
    return burden.select("individualID", F.round(F.cume_dist().over(Window.orderBy("n")), 6).alias("share"))


# Expression and models: samples are individuals, genes are parts, marker types are brands.
MATRIX_ROWS = """xm AS (SELECT ref_id AS gene, "individualID" AS sample, fpkm AS value FROM expression)"""


def _rows(c) -> DataFrame:
    return c.expression.select(F.col("ref_id").alias("gene"), F.col("individualID").alias("sample"), F.col("fpkm").alias("value"))


def _arms(c) -> DataFrame:
    return c.individual.select(F.col("individualID").alias("sample"), "condition")


def _markers(c) -> DataFrame:
    return c.table("part").select(F.col("p_brand").alias("cell"), F.col("p_partkey").alias("gene"), F.col("p_size").alias("rank"))


@_query("excluded_share", f"""SELECT * FROM (WITH {MATRIX_ROWS} SELECT sample, round(coalesce(sum(value) FILTER (gene % 10 = 0), 0) / sum(value), 6) AS excluded_share FROM xm GROUP BY 1)""")
def _(c):
    gone = c.gene.where("ref_id % 10 = 0").select(F.col("ref_id").alias("gene"))
    return _rounded(expression.excluded_share(_rows(c), gone))


@_query("top_genes", f"""SELECT * FROM (WITH {MATRIX_ROWS} SELECT gene, round(avg(value / t), 8) AS mean_share FROM (SELECT *, sum(value) OVER (PARTITION BY sample) AS t FROM xm) GROUP BY 1 ORDER BY avg(value / t) DESC, gene LIMIT 12)""")
def _(c):
    return _rounded(expression.top_genes(_rows(c)), 8)


@_query(
    "marker_coherence",
    """SELECT * FROM (WITH mk AS (SELECT cell, gene FROM (SELECT p_brand AS cell, p_partkey AS gene, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS r FROM part) WHERE r <= 500),
    x AS (SELECT cell, ref_id AS gene, "individualID" AS sample, log2(fpkm + 1) AS v, avg(log2(fpkm + 1)) OVER (PARTITION BY ref_id) AS m, stddev_samp(log2(fpkm + 1)) OVER (PARTITION BY ref_id) AS sd, count(*) OVER (PARTITION BY ref_id) AS n FROM expression JOIN mk ON ref_id = gene),
    pr AS (SELECT a.cell, sum((a.v - a.m) / a.sd * (b.v - b.m) / b.sd) / (max(a.n) - 1) AS r FROM x a JOIN x b ON a.cell = b.cell AND a.sample = b.sample AND a.gene < b.gene WHERE a.sd > 0 AND b.sd > 0 GROUP BY a.cell, a.gene, b.gene)
    SELECT cell, count(*) AS n_pairs, round(quantile_cont(r, 0.5), 6) AS median, round(quantile_cont(r, 0.25), 6) AS q1, round(quantile_cont(r, 0.75), 6) AS q3 FROM pr GROUP BY 1)""",
)
def _(c):
    return _rounded(expression.marker_coherence(expression.marker_correlations(_rows(c), _markers(c), across=False)).select("cell", "n_pairs", "median", "q1", "q3"))


@_query(
    "marker_separation",
    """SELECT * FROM (WITH mk AS (SELECT cell, gene FROM (SELECT p_brand AS cell, p_partkey AS gene, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS r FROM part) WHERE r <= 500),
    x AS (SELECT gene, sample, (v - avg(v) OVER w) / stddev_samp(v) OVER w AS z, count(*) OVER w AS n, stddev_samp(v) OVER w AS sd FROM (SELECT ref_id AS gene, "individualID" AS sample, log2(fpkm + 1) AS v FROM expression) WINDOW w AS (PARTITION BY gene)),
    y AS (SELECT * FROM x JOIN mk USING (gene) WHERE sd > 0), pr AS (SELECT a.cell AS ca, b.cell AS cb, sum(a.z * b.z) / (max(a.n) - 1) AS r FROM y a JOIN y b ON a.sample = b.sample AND a.gene < b.gene GROUP BY a.cell, b.cell, a.gene, b.gene),
    own AS (SELECT ca AS cell, quantile_cont(r, 0.5) AS own FROM pr WHERE ca = cb GROUP BY 1), cr AS (SELECT cell, other, quantile_cont(r, 0.5) AS m FROM (SELECT ca AS cell, cb AS other, r FROM pr WHERE ca <> cb UNION ALL SELECT cb, ca, r FROM pr WHERE ca <> cb) GROUP BY 1, 2),
    near AS (SELECT cell, other AS nearest, m AS nearest_r FROM cr QUALIFY row_number() OVER (PARTITION BY cell ORDER BY m DESC, other DESC) = 1)
    SELECT cell, round(own, 6) AS own, round(nearest_r, 6) AS nearest_r, nearest, round(own - nearest_r, 6) AS margin, own - nearest_r < 0.1 AS tight FROM own JOIN near USING (cell))""",
)
def _(c):
    return _rounded(expression.marker_separation(expression.marker_correlations(_rows(c), _markers(c))))


@_query(
    "expression_filter",
    f"""SELECT * FROM (WITH {MATRIX_ROWS}, lib AS (SELECT sample, sum(value) AS library FROM xm GROUP BY 1), md AS (SELECT quantile_cont(library, 0.5) AS median FROM lib), nd AS (SELECT CASE WHEN least(n1, n2) > 10 THEN 10 + (least(n1, n2) - 10) * 0.7e0 ELSE least(n1, n2) END AS need FROM sizes)
    SELECT gene, count(*) FILTER (value / library >= 1000e0 / median) AS n_above, round(sum(value), 6) AS total FROM xm JOIN lib USING (sample), md, nd GROUP BY gene, need HAVING count(*) FILTER (value / library >= 1000e0 / median) >= need - 1e-14 AND sum(value) >= 15)""",
)
def _(c):
    return _rounded(expression.expression_filter(_rows(c), _arms(c), min_count=1000.0))


@_query(
    "tmm_factors",
    f"""SELECT * FROM (WITH {MATRIX_ROWS}, p AS (SELECT *, value / library AS share FROM (SELECT *, sum(value) OVER (PARTITION BY sample) AS library FROM xm) WHERE value > 0), up AS (SELECT sample, quantile_cont(share, 0.75) AS q FROM p GROUP BY 1),
    rf AS (SELECT sample FROM up ORDER BY abs(q - (SELECT avg(q) FROM up)), sample LIMIT 1), base AS (SELECT gene, value AS rv, library AS rl, share AS rs FROM p SEMI JOIN rf USING (sample)),
    m AS (SELECT sample, gene, log2(share / rs) AS m, log2(share * rs) / 2 AS a, 1 / ((library - value) / library / value + (rl - rv) / rl / rv) AS w FROM p JOIN base USING (gene)),
    rk AS (SELECT *, count(*) OVER (PARTITION BY sample) AS n, row_number() OVER (PARTITION BY sample ORDER BY m, gene) AS rm, row_number() OVER (PARTITION BY sample ORDER BY a, gene) AS ra FROM m),
    f AS (SELECT sample, sum(m * w) / sum(w) AS f FROM rk WHERE rm > floor(n * 0.3e0) AND rm <= n - floor(n * 0.3e0) AND ra > floor(n * 0.05e0) AND ra <= n - floor(n * 0.05e0) GROUP BY 1) SELECT sample, round(power(2, f - (SELECT avg(f) FROM f)), 6) AS factor FROM f)""",
)
def _(c):
    return _rounded(expression.tmm_factors(_rows(c)))


@_query(
    "sample_similarity",
    f"""SELECT * FROM (WITH {MATRIX_ROWS}, va AS (SELECT gene FROM (SELECT gene, var_samp(log2(value + 1)) AS v FROM xm GROUP BY 1) WHERE v > 0 ORDER BY v DESC, gene LIMIT 2000),
    r AS (SELECT gene, sample, rank() OVER (PARTITION BY sample ORDER BY value) + (count(*) OVER (PARTITION BY sample, value) - 1) / 2e0 AS r FROM xm SEMI JOIN va USING (gene)),
    rho AS (SELECT a.sample, b.sample AS other, corr(a.r, b.r) AS rho FROM r a JOIN r b ON a.gene = b.gene AND a.sample <> b.sample GROUP BY 1, 2), med AS (SELECT sample, quantile_cont(rho, 0.5) AS m FROM rho GROUP BY 1),
    ce AS (SELECT quantile_cont(m, 0.5) AS c FROM med), sp AS (SELECT c, quantile_cont(abs(m - c), 0.5) AS mad FROM med, ce GROUP BY 1) SELECT sample, round(m, 6) AS median_rho, round(c - 3 * 1.4826e0 * mad, 6) AS cutoff, m < c - 3 * 1.4826e0 * mad AS outlier FROM med, sp)""",
)
def _(c):
    return _rounded(expression.sample_similarity(_rows(c)))


@_query("sample_components")
def _(c):
    return expression.sample_components(_rows(c))


@_query("component_drivers")
def _(c):
    """What the leading components track: the condition, calls and depth of each sample."""
    pcs = expression.sample_components(_rows(c)).withColumnRenamed("sample", "individualID")
    return models.covariate_correlations(pcs.join(_terms(c), "individualID"), ["is_case", "burden", "depth"], ["pc1", "pc2", "pc3"])


@_query("composition_axis")
def _(c):
    n = c.eligible.groupBy("individualID", F.col("a1type").alias("part")).agg(F.count("*").alias("n"))
    grid = c.individual.select("individualID").join(n.select("part").distinct(), F.lit(True)).join(n, ["individualID", "part"], "left").fillna(0, ["n"])
    total = n.groupBy("individualID").agg(F.sum("n").alias("total"))
    return expression.composition_axis(expression.centred_log_ratio(grid.join(total, "individualID").select("individualID", "part", (F.col("n") / F.col("total")).alias("share"))))


@_query(
    "sex_contrast",
    f"""SELECT * FROM (WITH {MATRIX_ROWS}, y AS (SELECT count(DISTINCT gene) AS n FROM xm WHERE gene IN (3, 5, 7, 11)), s AS (SELECT sample, coalesce(sum(log2(value + 1)) FILTER (gene IN (3, 5, 7, 11)), 0) / max(n) AS ys, coalesce(sum(log2(value + 1)) FILTER (gene = 2), 0) AS xs FROM xm, y GROUP BY 1),
    g AS (SELECT ys - xs AS c, lead(ys - xs) OVER (ORDER BY ys - xs) - (ys - xs) AS gap FROM s), a AS (SELECT c + gap / 2 AS cut FROM g WHERE gap IS NOT NULL ORDER BY gap DESC, c LIMIT 1)
    SELECT sample, round(ys, 6) AS y_score, round(xs, 6) AS x_score, round(ys - xs, 6) AS contrast, CASE WHEN ys - xs > cut THEN 'Y_high' ELSE 'X_high' END AS sex_call FROM s, a)""",
)
def _(c):
    """Genes 3, 5, 7 and 11 stand for those of Y, gene 2 for the one of X."""
    return _rounded(expression.sex_contrast(_rows(c), [3, 5, 7, 11], 2))


def _burden(c) -> DataFrame:
    b = c.loaded.groupBy("individualID", "chrom").agg(F.count("*").cast("double").alias("value"))
    return b.join(c.individual, "individualID")


@_query(
    "group_comparison",
    f"""SELECT * FROM (WITH b AS (SELECT "individualID", chrom, CAST(count(*) AS DOUBLE) AS v FROM loaded GROUP BY 1, 2), v AS (SELECT chrom, condition, v FROM b JOIN individual USING ("individualID")),
    st AS (SELECT chrom, count(*) FILTER (condition = 'case') AS n_case, count(*) FILTER (condition = 'ref') AS n_ref, quantile_cont(v, 0.5) FILTER (condition = 'case') AS median_case, quantile_cont(v, 0.5) FILTER (condition = 'ref') AS median_ref FROM v GROUP BY 1),
    sh AS (SELECT a.chrom, quantile_cont(a.v - b.v, 0.5) AS shift, (count(*) FILTER (a.v > b.v) - count(*) FILTER (a.v < b.v)) / CAST(count(*) AS DOUBLE) AS cliffs_delta FROM v a JOIN v b ON a.chrom = b.chrom AND a.condition = 'case' AND b.condition = 'ref' GROUP BY 1)
    SELECT chrom, n_case, n_ref, round(median_case, 6) AS median_case, round(median_ref, 6) AS median_ref, round(median_case / median_ref, 6) AS ratio, round(shift, 6) AS shift, round(cliffs_delta, 6) AS cliffs_delta FROM st JOIN sh USING (chrom))""",
)
def _(c):
    return _rounded(models.group_comparison(_burden(c), "chrom").select("chrom", "n_case", "n_ref", "median_case", "median_ref", "ratio", "shift", "cliffs_delta"))


def _terms(c) -> DataFrame:
    """Per individual: burden, depth and shares of types, as the terms of models."""
    t = c.eligible.groupBy("individualID").agg(F.count("*").cast("double").alias("burden"), F.avg("dp").alias("depth"), F.avg((F.col("a1type") == "ins").cast("double")).alias("ins_share"))
    return c.individual.withColumn("is_case", (F.col("condition") == "case").cast("int")).join(t, "individualID")


TERMS = """terms AS (SELECT i."individualID", condition, CAST(condition = 'case' AS INT) AS is_case, burden, depth, ins_share FROM individual i JOIN (SELECT "individualID", CAST(count(*) AS DOUBLE) AS burden, avg(dp) AS depth, avg(CAST(a1type = 'ins' AS INT)) AS ins_share FROM eligible GROUP BY 1) t ON i."individualID" = t."individualID")"""


@_query(
    "continuous_association",
    f"""SELECT * FROM (WITH {TERMS}, one AS (SELECT *, 1 AS "all" FROM terms), {_spearman_sql('one', '"all"', 'burden', 'depth', 5)}, w AS (SELECT *, 1.959964e0 * sqrt(1.06e0) / sqrt(n - 3) AS w FROM correlated)
    SELECT "all", n, round(rho, 6) AS rho, round(p_value, 6) AS p_value, round(CASE WHEN abs(rho) < 1 AND n > 3 THEN tanh(atanh(rho) - w) END, 6) AS ci_low, round(CASE WHEN abs(rho) < 1 AND n > 3 THEN tanh(atanh(rho) + w) END, 6) AS ci_high FROM w)""",
)
def _(c):
    return _rounded(models.continuous_association(_terms(c).withColumn("all", F.lit(1)), ["all"], "burden", "depth"))


@_query(
    "partial_spearman",
    """SELECT * FROM (WITH t AS (SELECT "individualID", condition, CAST(count(*) AS DOUBLE) AS x, avg(dp) AS y FROM eligible GROUP BY 1, 2), r AS (SELECT condition, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry FROM t),
    d AS (SELECT rx, ry, rx - avg(rx) OVER (PARTITION BY condition) AS dx, ry - avg(ry) OVER (PARTITION BY condition) AS dy FROM r) SELECT count(*) AS n, round(corr(rx, ry), 6) AS rho, round(corr(dx, dy), 6) AS partial_rho FROM d)""",
)
def _(c):
    return _rounded(models.partial_spearman(_terms(c).withColumn("all", F.lit(1)), ["all"], "burden", "depth").select("n", "rho", "partial_rho"))


@_query(
    "grouped_ols",
    """SELECT * FROM (WITH t AS (SELECT "individualID", CAST(count(*) AS DOUBLE) AS burden FROM eligible GROUP BY 1), e AS (SELECT ref_id, log2(fpkm + 1) AS y, burden FROM expression JOIN t USING ("individualID"))
    SELECT ref_id, count(*) AS n, round(regr_slope(y, burden), 6) AS b_burden, round(regr_r2(y, burden), 5) AS r2 FROM e GROUP BY 1 HAVING count(*) > 5 AND var_pop(burden) > 0 AND var_pop(y) > 1e-9)""",
)
def _(c):
    e = c.expression.join(_terms(c).select("individualID", "burden"), "individualID").withColumn("y", F.log2(F.col("fpkm") + 1))
    some = e.groupBy("ref_id").agg(F.count("*").alias("k"), F.var_pop("burden").alias("v"), F.var_pop("y").alias("w")).where("k > 5 AND v > 0 AND w > 1e-9").select("ref_id")
    fitted = models.grouped_ols(e.join(some, "ref_id", "left_semi"), "ref_id", "y", ["burden"])
    return fitted.select("ref_id", "n", F.round("b_burden", 6).alias("b_burden"), F.round("r2", 5).alias("r2"))


@_query(
    "kruskal_wallis",
    """SELECT * FROM (WITH v AS (SELECT a1type, "individualID", chrom, CAST(count(*) AS DOUBLE) AS x FROM eligible GROUP BY 1, 2, 3), r AS (SELECT a1type, chrom, rank() OVER (PARTITION BY a1type ORDER BY x) + (count(*) OVER (PARTITION BY a1type, x) - 1) / 2e0 AS r, count(*) OVER (PARTITION BY a1type, x) AS t FROM v),
    p AS (SELECT a1type, chrom, CAST(count(*) AS DOUBLE) AS n, sum(r) AS s, sum(t * t - 1) AS ties FROM r GROUP BY 1, 2), g AS (SELECT a1type, sum(n) AS n, count(*) AS k, sum(s * s / n) AS q, sum(ties) AS ties FROM p GROUP BY 1)
    SELECT a1type, round((12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 5) AS h, k - 1 AS dof FROM g WHERE k > 1)""",
)
def _(c):
    v = c.eligible.groupBy("a1type", "individualID", "chrom").agg(F.count("*").cast("double").alias("x"))
    return models.kruskal_wallis(v, ["a1type"], "chrom", "x").where("dof > 0").select("a1type", F.round("h", 5).alias("h"), "dof")


@_query(
    "covariate_correlations",
    f"""SELECT * FROM (WITH {TERMS}, long AS (SELECT 'depth' AS covariate, depth AS x, burden, ins_share FROM terms UNION ALL SELECT 'is_case', is_case, burden, ins_share FROM terms), met AS (SELECT covariate, x, 'burden' AS target, burden AS y FROM long UNION ALL SELECT covariate, x, 'ins_share', ins_share FROM long),
    {_spearman_sql('met', 'covariate, target', 'x', 'y')} SELECT covariate, target, n, round(rho, 6) AS rho, round(p_value, 6) AS p_value FROM correlated)""",
)
def _(c):
    return _rounded(models.covariate_correlations(_terms(c), ["depth", "is_case"], ["burden", "ins_share"]))


def _upper_sql(z: str) -> str:
    """The normal tail above z."""
    return f"CASE WHEN {z} >= 0 THEN ({two_sided_normal_sql(f'abs({z})')}) / 2e0 ELSE 1e0 - ({two_sided_normal_sql(f'abs({z})')}) / 2e0 END"


@_query(
    "directional_wilcoxon",
    f"""SELECT * FROM (WITH {CLASSES}, tp AS (SELECT ref_id, avg(t) AS tpm FROM (SELECT ref_id, "individualID", fpkm / sum(fpkm) OVER (PARTITION BY "individualID") * 1e6 AS t FROM expression) GROUP BY 1),
    r AS (SELECT edit_dist = 'case_enriched' AS c, rank() OVER (ORDER BY tpm) + (count(*) OVER (PARTITION BY tpm) - 1) / 2e0 AS r, count(*) OVER (PARTITION BY tpm) AS t FROM tp JOIN classes USING (ref_id) WHERE edit_dist <> 'Both'),
    g AS (SELECT count(*) FILTER (c) AS n1, count(*) FILTER (NOT c) AS n2, sum(r) FILTER (c) AS r1, sum(t * t - 1) AS ties FROM r), z AS (SELECT *, r1 - n1 * (n1 + 1) / 2e0 - n1 * n2 / 2e0 AS d, sqrt(n1 * n2 / 12e0 * (n1 + n2 + 1 - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1)))) AS s FROM g),
    e AS (SELECT (d - 0.5e0) / s AS zg, (-d - 0.5e0) / s AS zl FROM z WHERE n1 >= 3 AND n2 >= 3 AND s > 0), p AS (SELECT {_upper_sql('zg')} AS p_greater, {_upper_sql('zl')} AS p_less FROM e)
    SELECT 1 AS "all", round(p_greater, 6) AS p_greater, round(p_less, 6) AS p_less, round(least(p_greater, p_less), 6) AS p_directional, CASE WHEN p_greater < p_less THEN 'case_enriched > ref_enriched' ELSE 'case_enriched < ref_enriched' END AS direction, round(least(p_greater, p_less), 6) AS adj_directional FROM p)""",
)
def _(c):
    genes = aggregates.tpm(c.expression).groupBy("ref_id").agg(F.avg("tpm").alias("tpm")).join(aggregates.classify_genes(c.eligible), "ref_id").withColumn("all", F.lit(1))
    return _rounded(models.directional_wilcoxon(genes, ["all"], "edit_dist", "tpm", "case_enriched", "ref_enriched"))


@_query("bootstrap_median_difference")
def _(c):
    return models.bootstrap_median_difference(_terms(c).select("condition", "ins_share"), "ins_share")


@_query("presence_models")
def _(c):
    seen = c.eligible.select("ref_id", "individualID").distinct().withColumn("present", F.lit(1))
    grid = c.eligible.select("ref_id").distinct().join(_terms(c).select("individualID", "is_case", (F.col("burden") / 1000).alias("burden")), F.lit(True))
    rows = grid.join(seen, ["ref_id", "individualID"], "left").fillna(0, ["present"])
    return models.presence_models(rows, "ref_id", "present", ["burden"])


@_query(
    "site_models",
    f"""SELECT * FROM (WITH k AS (SELECT *, sum(a1_ad) OVER w / CAST(sum(dp) OVER w AS DOUBLE) AS p FROM eligible WINDOW w AS (PARTITION BY ref_id, a1type, condition)),
    g AS (SELECT ref_id, a1type, count(*) AS n, sum(CASE WHEN p > 0 AND p < 1 THEN power(a1_ad - dp * p, 2) / (dp * p * (1 - p)) ELSE 0 END) AS x2, max(CAST(p <= 0 OR p >= 1 AS INT)) AS boundary, CAST(sum(a1_ad) FILTER (condition = 'case') AS DOUBLE) AS a1, CAST(sum(dp) FILTER (condition = 'case') AS DOUBLE) AS d1,
      CAST(sum(a1_ad) FILTER (condition = 'ref') AS DOUBLE) AS a0, CAST(sum(dp) FILTER (condition = 'ref') AS DOUBLE) AS d0 FROM k GROUP BY 1, 2 HAVING count(*) FILTER (condition = 'case') >= 20 AND count(*) FILTER (condition = 'ref') >= 20),
    b AS (SELECT *, CASE WHEN boundary = 0 THEN ln(a1 / (d1 - a1)) - ln(a0 / (d0 - a0)) END AS b, x2 / (n - 2) AS dispersion FROM g), z AS (SELECT *, CASE WHEN boundary = 0 AND dispersion > 0 THEN b / sqrt(dispersion * (1 / a1 + 1 / (d1 - a1) + 1 / a0 + 1 / (d0 - a0))) END AS z FROM b),
    s AS (SELECT ref_id, a1type, n, b, dispersion, z, CASE WHEN z IS NOT NULL THEN {two_sided_normal_sql('abs(z)')} END AS p_value, boundary FROM z)
    SELECT ref_id, a1type, n, boundary, {', '.join(f'round({x}, 6) AS {x}' for x in ('b', 'dispersion', 'z', 'p_value', 'adj_pvalue'))} FROM ({_bh_sql('s', 'p_value', 'adj_pvalue')}))""",
)
def _(c):
    rows = c.eligible.withColumn("is_case", (F.col("condition") == "case").cast("int"))
    return _rounded(models.site_models(rows, ["ref_id", "a1type"], least=20))


@_query(
    "risk_set_sensitivity",
    f"""SELECT * FROM (WITH {CLASSES}, tp AS (SELECT ref_id, avg(t) AS tpm FROM (SELECT ref_id, fpkm / sum(fpkm) OVER (PARTITION BY "individualID") * 1e6 AS t FROM expression) GROUP BY 1), g AS (SELECT tpm, n_calls_case + n_calls_ref AS calls FROM tp JOIN classes USING (ref_id)),
    q AS (SELECT unnest([0e0, 0.25e0, 0.5e0, 0.75e0]) AS quantile, unnest([quantile_cont(tpm, 0e0), quantile_cont(tpm, 0.25e0), quantile_cont(tpm, 0.5e0), quantile_cont(tpm, 0.75e0)]) AS cutoff FROM g)
    SELECT quantile, round(cutoff, 4) AS cutoff, count(*) AS n_genes, round(quantile_cont(calls, 0.5), 4) AS median FROM g JOIN q ON tpm >= cutoff GROUP BY 1, q.cutoff)""",
)
def _(c):
    g = aggregates.tpm(c.expression).groupBy("ref_id").agg(F.avg("tpm").alias("tpm")).join(aggregates.classify_genes(c.eligible).select("ref_id", (F.col("n_calls_case") + F.col("n_calls_ref")).alias("calls")), "ref_id")
    return _rounded(models.risk_set_sensitivity(g, "tpm", [0.0, 0.25, 0.5, 0.75], "calls"), 4)


@_query("centred_log_ratio", """SELECT * FROM (WITH s AS (SELECT i."individualID", t.part, coalesce(n, 0) / CAST(sum(coalesce(n, 0)) OVER (PARTITION BY i."individualID") AS DOUBLE) AS share FROM individual i CROSS JOIN (SELECT DISTINCT a1type AS part FROM eligible) t LEFT JOIN (SELECT "individualID", a1type AS part, count(*) AS n FROM eligible GROUP BY 1, 2) e ON e."individualID" = i."individualID" AND e.part = t.part),
    f AS (SELECT "individualID", part, CASE WHEN share > 0 THEN share ELSE (SELECT min(share) / 2 FROM s WHERE share > 0) END AS v FROM s), l AS (SELECT "individualID", part, ln(v / sum(v) OVER (PARTITION BY "individualID")) AS l FROM f)
    SELECT "individualID", part, round(l - avg(l) OVER (PARTITION BY "individualID"), 6) AS clr FROM l)""")
def _(c):
    n = c.eligible.groupBy("individualID", F.col("a1type").alias("part")).agg(F.count("*").alias("n"))
    grid = c.individual.select("individualID").join(n.select("part").distinct(), F.lit(True)).join(n, ["individualID", "part"], "left").fillna(0, ["n"])
    return _rounded(expression.centred_log_ratio(grid.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("individualID")))))


@_query("covariate_screen")
def _(c):
    t = _terms(c).withColumn("even", (F.col("individualID") % 3 == 0).cast("int")).withColumn("one", F.lit(1))
    return models.covariate_screen(t, ["burden", "depth", "ins_share", "even", "one", "is_case"])


@_query("class_crosstab", f"""SELECT * FROM (WITH {CLASSES}, g AS (SELECT gene_group, count(*) AS n, count(*) FILTER (novel = 0) AS n_usable FROM classes JOIN gene USING (ref_id) GROUP BY 1), s AS (SELECT max(n_usable / CAST(n AS DOUBLE)) - min(n_usable / CAST(n AS DOUBLE)) AS spread FROM g)
    SELECT gene_group, n, n_usable, round(n_usable / CAST(n AS DOUBLE), 6) AS share, round(spread, 6) AS spread, spread > 0.1 AS warn FROM g, s)""")
def _(c):
    rows = aggregates.classify_genes(c.eligible).join(c.gene.select("ref_id", F.when(F.col("novel") == 0, "matched").otherwise("absent").alias("resolution")), "ref_id")
    return _rounded(models.class_crosstab(rows, "gene_group", "resolution", ["matched"]))


def _few_markers(c) -> DataFrame:
    return c.table("part").select(F.concat(F.lit("type"), (F.col("p_size") % 4).cast("string")).alias("cell"), F.col("p_partkey").alias("gene"), F.col("p_size").alias("rank"))


@_query("proportion_ensemble")
def _(c):
    return models.ensemble_summary(models.proportion_ensemble(_rows(c), _few_markers(c)))


@_query("call_models")
def _(c):
    """All genes with calls over all individuals: presence by condition, with the share of insertions, and with detection."""
    size = aggregates.tpm(c.expression).groupBy("individualID").agg(F.sum("fpkm").alias("lib_size"))
    cohort = _terms(c).select("individualID", "is_case", "ins_share").join(size, "individualID")
    fpkm = c.expression.select("ref_id", "individualID", F.col("fpkm").alias("expression"))
    return _rounded(regressions.cohort_call_models(c.eligible, fpkm, cohort, "ref_id", ["ins_share"]))


@_query("site_models_adjusted")
def _(c):
    """Sites are (gene, type) here, as a position of these tables has too few carriers."""
    rows = c.eligible.join(_terms(c).select("individualID", "is_case", (F.col("burden") / 1000).alias("burden"), "ins_share"), "individualID")
    return _rounded(regressions.adjusted_site_models(rows, ["ref_id", "a1type"], ["burden", "ins_share"], min_n=20))


@_query("deconvolution")
def _(c):
    """Types are the kinds of parts; proportions by three aggregators over a hundred draws of markers."""
    markers = c.table("part").select(F.col("p_type").alias("cell"), F.col("p_partkey").alias("gene"), F.col("p_size").alias("rank"))
    return _rounded(deconvolution.ensemble(_rows(c), markers, size=20, aggregators=("mean", "scaled_mean", "median")).proportions)


_FILTER = f"""{MATRIX_ROWS}, lib AS (SELECT sample, sum(value) AS library FROM xm GROUP BY 1), md AS (SELECT quantile_cont(library, 0.5) AS median FROM lib), nd AS (SELECT CASE WHEN least(n1, n2) > 10 THEN 10 + (least(n1, n2) - 10) * 0.7e0 ELSE least(n1, n2) END AS need FROM sizes),
    fl AS (SELECT gene FROM xm JOIN lib USING (sample), md, nd GROUP BY gene, need HAVING count(*) FILTER (value / library >= 1000e0 / median) >= need - 1e-14 AND sum(value) >= 15),
    mk AS (SELECT p_brand AS cell, p_partkey AS gene, p_size AS rank FROM part), few AS (SELECT gene FROM mk WHERE rank <= 10),
    av AS (SELECT gene, sum(value / library) * 1e6 / (SELECT count(*) FROM lib) AS mean FROM xm JOIN lib USING (sample) GROUP BY 1),
    kept AS (SELECT gene, 'filter' AS kept_by FROM fl UNION ALL SELECT DISTINCT gene, 'rescue' FROM av JOIN few USING (gene) WHERE mean > 100 AND gene NOT IN (SELECT gene FROM fl))"""


def _rescued(c) -> DataFrame:
    markers = _markers(c).where("rank <= 10")
    return expression.rescued_filter(_rows(c), _rows(c), _arms(c), markers, min_fpkm=100.0, min_count=1000.0)


@_query("marker_rescue", f"SELECT * FROM (WITH {_FILTER} SELECT gene, kept_by FROM kept)")
def _(c):
    return _rescued(c)


@_query("carried_tpm", f"""SELECT * FROM (WITH {_FILTER}, tt AS (SELECT sample, sum(value) AS total FROM xm SEMI JOIN kept k ON xm.gene = k.gene GROUP BY 1)
    SELECT xm.gene, xm.sample, round(value / total * 1e6, 4) AS tpm, xm.gene IN (SELECT gene FROM kept) AS in_filter FROM xm JOIN tt USING (sample))""")
def _(c):
    rows = _rows(c)
    return expression.carried_matrices(rows, rows, stored(_rescued(c))).select("gene", "sample", F.round("tpm", 4).alias("tpm"), "in_filter")


@_query("marker_survival", f"""SELECT * FROM (WITH {_FILTER}, top AS (SELECT cell, gene FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY rank, gene) AS r FROM mk) WHERE r <= 500)
    SELECT cell, count(*) AS n_markers, count(*) FILTER (gene IN (SELECT gene FROM xm)) AS in_matrix_all, count(*) FILTER (gene IN (SELECT gene FROM kept)) AS in_matrix_filtered FROM top GROUP BY 1)""")
def _(c):
    return expression.marker_survival(_markers(c), _rows(c), _rescued(c))


@_query("rescue_audit", """SELECT * FROM (WITH l AS (SELECT p_partkey // 3 AS locus_id, p_brand AS s, p_type <> 'PROMO' AS stays FROM part), lo AS (SELECT locus_id, count(DISTINCT s) AS b, min(s) AS sb, count(DISTINCT s) FILTER (stays) AS a, min(s) FILTER (stays) AS sa FROM l GROUP BY 1)
    SELECT 'locus_removed' AS kind, locus_id::VARCHAR AS name FROM lo WHERE a = 0 UNION ALL SELECT 'locus_rescued', locus_id::VARCHAR FROM lo WHERE b > 1 AND a = 1
    UNION ALL SELECT 'symbol_rescued', sa FROM (SELECT DISTINCT sa FROM lo WHERE a = 1) WHERE sa NOT IN (SELECT sb FROM lo WHERE b = 1))""")
def _(c):
    """Loci are three parts each, symbols are brands, and the parts of one kind are excluded."""
    rows = c.table("part").select(F.expr("p_partkey div 3").alias("locus_id"), F.col("p_brand").alias("gene_name"), "p_type")
    return aggregates.rescue_audit(rows, rows.where("p_type <> 'PROMO'"))


def _shares(c) -> DataFrame:
    """A row for each call type and individual: its share of the individual's calls, and their number."""
    total = F.sum("n").over(Window.partitionBy("individualID"))
    n = c.eligible.groupBy("individualID", "condition", "a1type").agg(F.count("*").alias("n"))
    return n.select("individualID", "condition", "a1type", (F.col("n") / total).alias("share"), total.cast("double").alias("burden"))


_SHARES = """sh AS (SELECT "individualID", condition, a1type, count(*) / CAST(sum(count(*)) OVER (PARTITION BY "individualID") AS DOUBLE) AS share, CAST(sum(count(*)) OVER (PARTITION BY "individualID") AS DOUBLE) AS burden FROM eligible GROUP BY 1, 2, 3)"""


@_query(
    "burden_composition",
    f"""SELECT * FROM (WITH {_SHARES}, {_spearman_sql('sh', 'a1type', 'burden', 'share', 5)},
    ra AS (SELECT a1type, condition, rank() OVER (PARTITION BY a1type ORDER BY burden) + (count(*) OVER (PARTITION BY a1type, burden) - 1) / 2e0 AS x, rank() OVER (PARTITION BY a1type ORDER BY share) + (count(*) OVER (PARTITION BY a1type, share) - 1) / 2e0 AS y FROM sh),
    de AS (SELECT a1type, x - avg(x) OVER (PARTITION BY a1type, condition) AS dx, y - avg(y) OVER (PARTITION BY a1type, condition) AS dy FROM ra), pa AS (SELECT a1type, CASE WHEN count(*) >= 5 THEN round(corr(dx, dy), 12) END AS rho_partial, count(*) AS cnt FROM de GROUP BY 1),
    pt AS (SELECT *, abs(rho_partial) * sqrt((cnt - 2) / (1 - rho_partial * rho_partial)) AS t FROM pa), both_ AS (SELECT a1type, n, rho, p_value, rho_partial, CASE WHEN t IS NOT NULL THEN {_t_sql('t', '(cnt - 2)')} END AS p_partial FROM correlated JOIN pt USING (a1type)),
    f1 AS ({_bh_sql('both_', 'p_value', 'fdr')}), f2 AS ({_bh_sql('(SELECT * EXCLUDE (bh) FROM f1)', 'p_partial', 'fdr_partial')})
    SELECT a1type, n, {', '.join(f'round({x}, 6) AS {x}' for x in ('rho', 'p_value', 'fdr', 'rho_partial', 'p_partial', 'fdr_partial'))} FROM f2)""",
)
def _(c):
    return _rounded(models.burden_composition(_shares(c), "a1type", "burden", "share").select("a1type", "n", "rho", "p_value", "fdr", "rho_partial", "p_partial", "fdr_partial"))


@_query(
    "burden_contrast",
    f"""SELECT * FROM (WITH bu AS (SELECT "individualID", condition = 'case' AS c, CAST(count(*) AS DOUBLE) AS v FROM eligible GROUP BY 1, 2), ra AS (SELECT *, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2e0 AS r, count(*) OVER (PARTITION BY v) AS t FROM bu),
    su AS (SELECT count(*) FILTER (c) AS k1, count(*) FILTER (NOT c) AS k2, avg(v) FILTER (c) AS m1, avg(v) FILTER (NOT c) AS m2, sum(r) FILTER (c) - count(*) FILTER (c) * (count(*) FILTER (c) + 1) / 2e0 AS u, sum(t * t - 1) AS ties FROM ra),
    z AS (SELECT *, (greatest(u, k1 * k2 - u) - k1 * k2 / 2e0 - 0.5e0) / sqrt(k1 * k2 / 12e0 * (k1 + k2 + 1 - ties / (CAST(k1 + k2 AS DOUBLE) * (k1 + k2 - 1)))) AS z FROM su)
    SELECT k1 AS n_case, k2 AS n_ref, round(m1, 6) AS mean_case, round(m2, 6) AS mean_ref, round(m1 / m2, 6) AS ratio, (SELECT round(quantile_cont(a.v - b.v, 0.5), 6) FROM bu a, bu b WHERE a.c AND NOT b.c) AS shift, round(CASE WHEN z >= 0 THEN {two_sided_normal_sql('z')} ELSE 1e0 END, 6) AS p_value FROM z)""",
)
def _(c):
    burden = c.eligible.groupBy("individualID", "condition").agg(F.count("*").cast("double").alias("burden"))
    return _rounded(models.burden_contrast(burden, "burden"))
