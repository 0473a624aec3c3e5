"""Ranks and multiple testing as window expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored


def mid_rank(value: str, *keys: str) -> Column:
    """The average rank of equal values within the keys."""
    by = Window.partitionBy(*keys)
    return F.rank().over(by.orderBy(value)) + (F.count("*").over(by.partitionBy(*keys, value)) - 1) / 2.0 if keys else F.rank().over(Window.orderBy(value)) + (F.count("*").over(Window.partitionBy(value)) - 1) / 2.0


def benjamini_hochberg(tests: DataFrame, p: str = "p_value", out: str = "adj_pvalue", *families: str, parts: int | None = None) -> DataFrame:
    """Step-up adjusted p-values; null p-values stay null and don't count.

    A family of up to some hundred thousand tests (a row for each gene, say) is sorted by one task. For more give
    ``parts``: ranks are then found by ranges of p-values between their quantiles, so no task holds a whole family. The
    tests are written once for that: sums of doubles may differ in their last bits from run to run, and p-values that were
    made anew wouldn't meet their ranks.
    """
    fams = [F.col(f) for f in families]
    if parts is None:
        fam = Window.partitionBy(*fams, F.col(p).isNull())
        n = F.count(p).over(fam)
        # The largest rank of a tie gives its least p * n / rank.
        rank = F.count("*").over(fam.orderBy(p).rangeBetween(Window.unboundedPreceding, 0))
        scaled = tests.withColumn("_s", F.when(F.col(p).isNotNull(), F.col(p) * n / rank))
        back = fam.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0)
        return scaled.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("_s").over(back)))).drop("_s")
    tests = stored(tests)
    # Equal p-values are one row; ranges of p-values are ranked apart and joined by each range's totals.
    counted = tests.where(F.col(p).isNotNull()).groupBy(*fams, F.col(p).alias("_p")).agg(F.count("*").alias("_n"))
    # The ranges hold about as many p-values each, wherever these lie: at most ``parts`` bounds pass the driver.
    bounds = counted.agg(F.percentile_approx("_p", F.array(*[F.lit(k / parts) for k in range(1, parts)]), 10_000).alias("b")).first()["b"] if parts > 1 else None
    edges = F.array(*map(F.lit, sorted(set(bounds or [])))).cast("array<double>")
    ranged = counted.withColumn("_range", F.size(F.filter(edges, lambda b: b <= F.col("_p"))))
    totals = ranged.groupBy(*fams, "_range").agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*fams).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*fams, "_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"), F.sum("_t").over(Window.partitionBy(*fams)).alias("_all"))
    keys = [*families, "_range"]
    inside = Window.partitionBy(*keys).orderBy("_p")
    j = ranged.join(totals, keys).withColumn("_s", F.col("_p") * F.col("_all") / (F.col("_before") + F.sum("_n").over(inside)))
    least = j.groupBy(*keys).agg(F.min("_s").alias("_m"))
    after = Window.partitionBy(*fams).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    least = least.select(*keys, F.min("_m").over(after).alias("_later"))
    back = Window.partitionBy(*keys).orderBy(F.desc("_p"))
    adjusted = j.join(least, keys).select(*fams, F.col("_p").alias(p), F.least(F.lit(1.0), F.min("_s").over(back), F.coalesce("_later", F.lit(1.0))).alias(out))
    return tests.join(adjusted, [*families, p], "left")


def rank_sums(values: DataFrame, keys: list[str], group: Column, value: str, *, parts: int = 64) -> DataFrame:
    """keys, n1 and n2 (rows with and without ``group``), r1 (the sum of mid ranks of those with it) and ties (sum of
    t ** 3 - t).

    Equal values are one row, and ranges of values are ranked apart and joined by the totals of those below, so no task has
    a whole key. Values are written once for that, as in ``benjamini_hochberg``."""
    counted = stored(values.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"), F.count_if(group).alias("_k")))
    # At most ``parts`` bounds pass the driver.
    bounds = counted.agg(F.percentile_approx("_v", F.array(*[F.lit(k / parts) for k in range(1, parts)]), 10_000).alias("b")).first()["b"] if parts > 1 else None
    edges = F.array(*map(F.lit, sorted(set(bounds or [])))).cast("array<double>")
    ranged = counted.withColumn("_range", F.size(F.filter(edges, lambda b: b <= F.col("_v"))))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    n, k = F.col("_n").cast("double"), F.col("_k").cast("double")
    # The last of a range's values has all of the range below or beside it.
    ranked = ranged.withColumn("_r", F.sum("_n").over(inside) - (F.col("_n") - 1) / 2.0)
    per = ranked.groupBy(*keys, "_range").agg(F.sum("_n").alias("_t"), F.sum("_k").alias("_c"), F.sum(k * F.col("_r")).alias("_s"), F.sum(n * (n * n - 1)).alias("_ties"))
    met = per.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    return met.groupBy(*keys).agg(F.sum("_c").alias("n1"), F.sum(F.col("_t") - F.col("_c")).alias("n2"), F.sum(F.col("_s") + F.col("_c") * F.col("_before").cast("double")).alias("r1"), F.sum("_ties").alias("ties"))


def choose_basis(tests: DataFrame, *, alpha: float = 0.05, share: float = 0.30) -> DataFrame:
    """One row: n_tests, n_adjusted, n_raw, basis (adj_pvalue, p_value or null). Null p-values count as tests."""
    counts = tests.agg(F.count("*").alias("n_tests"), F.count_if(F.col("adj_pvalue") < alpha).alias("n_adjusted"), F.count_if(F.col("p_value") < alpha).alias("n_raw"))
    reach = lambda c: F.col(c) >= share * F.col("n_tests")
    some = F.col("n_tests") > 0
    return counts.withColumn("basis", F.when(some & reach("n_adjusted"), F.lit("adj_pvalue")).when(some & reach("n_raw"), F.lit("p_value")))


def significant(tests: DataFrame, basis: DataFrame, *, alpha: float = 0.05) -> DataFrame:
    """The tests below alpha on the chosen basis; none if there is none. The basis stays a one-row table."""
    one = F.broadcast(basis.select(F.col("basis").alias("_basis")))
    hit = F.when(F.col("_basis") == "adj_pvalue", F.col("adj_pvalue")).when(F.col("_basis") == "p_value", F.col("p_value")) < alpha
    return tests.join(one, F.lit(True)).where(hit).drop("_basis")


def resolve_gene_set(selected: DataFrame, available: DataFrame, key: str = "ref_id") -> DataFrame:
    """The selection, or everything that is available where it is empty; ``filtered`` says which."""
    n = F.broadcast(selected.agg(F.count("*").alias("_n")))
    chosen = available.select(key).distinct().join(selected.select(key).distinct().withColumn("_in", F.lit(True)), key, "left").join(n, F.lit(True))
    return chosen.where((F.col("_n") == 0) | F.col("_in")).select(key, (F.col("_n") > 0).alias("filtered"))
