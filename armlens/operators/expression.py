"""Expression matrices in long form (gene, sample, value): filters, scaling, markers and sample checks.

Samples are a cohort (tens to thousands), genes may be many: everything is grouped by gene or sample in Spark, and no
dense matrix is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import largest_gap
from .stored import dealt, stored


#: Samples of a block that are correlated with another block's in one task.
SAMPLES_TOGETHER = 256


def gene_matrix(rows: DataFrame, value: str = "fpkm") -> DataFrame:
    """Sums per (gene, sample): aliases of a symbol and its transcripts fall together."""
    return rows.groupBy("gene", "sample").agg(F.sum(value).alias("value"))


def harmonise(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Symbols by a user's alias table (alias, symbol); of several names joined by /// the first counts."""
    first = F.element_at(F.split("gene", "///"), 1)
    known = aliases.groupBy("alias").agg(F.min("symbol").alias("_s"))
    return rows.withColumn("gene", first).join(known, F.col("gene") == F.col("alias"), "left").withColumn("gene", F.coalesce("_s", "gene")).drop("_s", "alias")


def excluded_share(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Per sample: the share of its total that excluded genes hold."""
    j = rows.join(excluded.select("gene").distinct().withColumn("_x", F.lit(1)), "gene", "left")
    return j.groupBy("sample").agg(F.try_divide(F.sum(F.when(F.col("_x") == 1, F.col("value")).otherwise(0.0)), F.sum("value")).alias("excluded_share"))


def top_genes(rows: DataFrame, n: int = 12) -> DataFrame:
    """The genes with the largest mean share of a sample's total."""
    share = rows.withColumn("share", F.try_divide("value", F.sum("value").over(Window.partitionBy("sample"))))
    return share.groupBy("gene").agg(F.avg("share").alias("mean_share")).orderBy(F.desc("mean_share"), "gene").limit(n)


def expression_filter(rows: DataFrame, groups: DataFrame, *, min_count: float = 10.0, min_total: float = 15.0, large_n: int = 10, min_prop: float = 0.7) -> DataFrame:
    """Genes with enough counts in as many samples as the smallest group has (the published rule for count filters)."""
    sizes = groups.groupBy("condition").agg(F.count("*").alias("n"))
    smallest = F.min("n").cast("double")
    need = F.when(smallest > large_n, large_n + (smallest - large_n) * min_prop).otherwise(smallest)
    library = rows.groupBy("sample").agg(F.sum("value").alias("library"))
    one = sizes.agg(need.alias("need")).join(library.agg(F.percentile("library", 0.5).alias("median")), F.lit(True))
    cpm = rows.join(F.broadcast(library), "sample").join(F.broadcast(one), F.lit(True)).withColumn("above", F.col("value") / F.col("library") >= F.lit(min_count) / F.col("median"))
    g = cpm.groupBy("gene").agg(F.count_if("above").alias("n_above"), F.sum("value").alias("total"), F.first("need").alias("need"))
    return g.where((F.col("n_above") >= F.col("need") - 1e-14) & (F.col("total") >= min_total - 1e-14)).select("gene", "n_above", "total")


def tmm_factors(rows: DataFrame, *, trim_m: float = 0.3, trim_a: float = 0.05) -> DataFrame:
    """sample, factor: trimmed means of log ratios to the sample whose upper quartile is nearest the mean one, scaled to
    a product of 1 (the published method)."""
    positive = rows.where("value > 0")
    library = rows.groupBy("sample").agg(F.sum("value").alias("library"))
    p = positive.join(library, "sample").withColumn("share", F.col("value") / F.col("library"))
    upper = p.groupBy("sample").agg(F.percentile("share", 0.75).alias("q"))
    ref = upper.join(F.broadcast(upper.agg(F.avg("q").alias("mean"))), F.lit(True)).agg(F.min_by("sample", F.struct(F.abs(F.col("q") - F.col("mean")), "sample")).alias("sample"))
    base = p.join(F.broadcast(ref), "sample", "left_semi").select("gene", F.col("value").alias("rv"), F.col("library").alias("rl"), F.col("share").alias("rs"))
    m = p.join(base, "gene").select(
        "sample", "gene", F.log2(F.col("share") / F.col("rs")).alias("m"), (F.log2(F.col("share") * F.col("rs")) / 2).alias("a"),
        (1 / ((F.col("library") - F.col("value")) / F.col("library") / F.col("value") + (F.col("rl") - F.col("rv")) / F.col("rl") / F.col("rv"))).alias("w"),
    )
    by = Window.partitionBy("sample")
    n = F.count("*").over(by)
    ranked = m.select("*", n.alias("n"), F.row_number().over(by.orderBy("m", "gene")).alias("rm"), F.row_number().over(by.orderBy("a", "gene")).alias("ra"))
    inside = lambda r, t: (F.col(r) > F.floor(F.col("n") * t)) & (F.col(r) <= F.col("n") - F.floor(F.col("n") * t))
    logs = ranked.where(inside("rm", trim_m) & inside("ra", trim_a)).groupBy("sample").agg(F.try_divide(F.sum(F.col("m") * F.col("w")), F.sum("w")).alias("f"))
    return logs.join(F.broadcast(logs.agg(F.avg("f").alias("mean"))), F.lit(True)).select("sample", F.pow(F.lit(2.0), F.col("f") - F.col("mean")).alias("factor"))


def standardised(rows: DataFrame) -> DataFrame:
    """gene, sample, z of log2(value + 1) within the gene; genes without spread are left out."""
    x = F.log2(F.col("value") + 1)
    by = Window.partitionBy("gene")
    return rows.select("gene", "sample", x.alias("x")).select("gene", "sample", F.try_divide(F.col("x") - F.avg("x").over(by), F.stddev_samp("x").over(by)).alias("z"), F.count("*").over(by).alias("n")).where("z IS NOT NULL")


def marker_correlations(rows: DataFrame, markers: DataFrame, top: int = 500, *, across: bool = True) -> DataFrame:
    """cell_a, gene_a, cell_b, gene_b, r over the first ``top`` markers of each cell type; gene_a is the lesser gene. Pairs of
    different types are left out without ``across``.

    A task has one pair of types, so its two matrices are bounded by ``top`` and the cohort.
    """
    first = markers.withColumn("_r", F.row_number().over(Window.partitionBy("cell").orderBy("rank", "gene"))).where(F.col("_r") <= top).select("cell", "gene")
    z = standardised(rows.join(F.broadcast(first.select("gene").distinct()), "gene", "left_semi")).join(F.broadcast(first), "gene")
    cells = first.select("cell").distinct()
    met = cells.toDF("cell_a").join(F.broadcast(cells.toDF("cell_b")), F.col("cell_a") <= F.col("cell_b") if across else F.col("cell_a") == F.col("cell_b"))
    each = z.join(F.broadcast(met), (F.col("cell") == F.col("cell_a")) | (F.col("cell") == F.col("cell_b")))

    def correlate(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sample, names = pdf["sample"].factorize()

        def matrices(cell) -> tuple[np.ndarray, ...]:
            on = (pdf["cell"] == cell).to_numpy()
            gene, genes = pdf.loc[on, "gene"].factorize()
            zs, seen, n = np.zeros((len(genes), len(names))), np.zeros((len(genes), len(names))), np.zeros(len(genes))
            np.add.at(zs, (gene, sample[on]), pdf.loc[on, "z"])
            seen[gene, sample[on]] = 1
            n[gene] = pdf.loc[on, "n"]
            return np.asarray(genes), zs, seen, n

        (ga, za, sa, na), (gb, zb, sb, nb) = matrices(key[0]), matrices(key[1])
        lesser, same = ga[:, None] < gb, ga[:, None] == gb
        r = za @ zb.T / (np.where(lesser, na[:, None], nb) - 1)
        i, j = ((sa @ sb.T > 0) & (lesser if key[0] == key[1] else True)).nonzero()
        swap = ~(lesser | same)[i, j]
        return pd.DataFrame({"cell_a": np.where(swap, key[1], key[0]), "gene_a": np.where(swap, gb[j], ga[i]), "cell_b": np.where(swap, key[0], key[1]), "gene_b": np.where(swap, ga[i], gb[j]), "r": r[i, j]})

    kinds = dict(z.dtypes)
    return each.groupBy("cell_a", "cell_b").applyInPandas(correlate, f"cell_a {kinds['cell']}, gene_a {kinds['gene']}, cell_b {kinds['cell']}, gene_b {kinds['gene']}, r double")


def marker_coherence(pairs: DataFrame, least: float = 0.25) -> DataFrame:
    """Per cell type: quantiles of its markers' correlations, and whether the median is high enough."""
    q = lambda p, name: F.percentile("r", p).alias(name)
    g = pairs.where("cell_a = cell_b").groupBy(F.col("cell_a").alias("cell")).agg(F.count("*").alias("n_pairs"), q(0.5, "median"), q(0.25, "q1"), q(0.75, "q3"), F.min("r").alias("min"), F.max("r").alias("max"))
    return g.withColumn("pass", F.when(F.col("n_pairs") >= 3, F.col("median") >= least))


def marker_separation(pairs: DataFrame, tight: float = 0.1) -> DataFrame:
    """Per cell type: its own median, the nearest other type's median, the margin, and whether that is tight."""
    own = pairs.where("cell_a = cell_b").groupBy(F.col("cell_a").alias("cell")).agg(F.percentile("r", 0.5).alias("own"))
    both = pairs.where("cell_a <> cell_b").select(F.col("cell_a").alias("cell"), F.col("cell_b").alias("other"), "r")
    both = both.union(pairs.where("cell_a <> cell_b").select("cell_b", "cell_a", "r"))
    cross = both.groupBy("cell", "other").agg(F.percentile("r", 0.5).alias("cross"))
    near = cross.groupBy("cell").agg(F.max("cross").alias("nearest_r"), F.max_by("other", F.struct("cross", "other")).alias("nearest"))
    return own.join(near, "cell").withColumn("margin", F.col("own") - F.col("nearest_r")).withColumn("tight", F.col("margin") < tight)


def sample_similarity(rows: DataFrame, genes: int = 2000) -> DataFrame:
    """Per sample: the median rank correlation with the others over the most variable genes, the cut-off (median less
    three scaled median deviations) and whether the sample falls below it.

    A pair's correlation is over the genes that both samples have. Samples are dealt out in blocks, and a task correlates
    two blocks by matrix products, so what is shuffled is each sample's values once for each block, and a number for
    each pair of samples."""
    variable = rows.groupBy("gene").agg(F.var_samp(F.log2(F.col("value") + 1)).alias("v")).where("v > 0").orderBy(F.desc("v"), "gene").limit(genes)
    kept = rows.join(variable.select("gene"), "gene", "left_semi")
    r = F.rank().over(Window.partitionBy("sample").orderBy("value")) + (F.count("*").over(Window.partitionBy("sample", "value")) - 1) / 2.0
    ranked = kept.select("gene", "sample", r.alias("r"))
    # At most ``genes`` rows, and a row for each sample.
    place = stored(variable.select("gene").withColumn("place", F.row_number().over(Window.orderBy("gene")) - 1))
    size = place.count()
    vectors = _sparse(ranked.join(F.broadcast(place), "gene"), "sample", "place", "r").withColumn("block", F.floor((F.row_number().over(Window.orderBy("sample")) - 1) / SAMPLES_TOGETHER).cast("int"))
    vectors = stored(vectors)
    blocks = (vectors.agg(F.max("block").alias("b")).first()["b"] or 0) + 1
    dealt = vectors.select("sample", "at", "value", "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    dealt = dealt.select("sample", "at", "value", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    kind = dict(vectors.dtypes)["sample"]

    def correlate(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        value, there = np.zeros((len(pdf), size)), np.zeros((len(pdf), size))
        for n, (at, v) in enumerate(zip(pdf["at"], pdf["value"], strict=True)):
            value[n, at], there[n, at] = v, 1
        first, second = (np.flatnonzero((pdf["block"] == b).to_numpy()) for b in key)
        x, mx, y, my = value[first], there[first], value[second], there[second]
        n, sx, sy = mx @ my.T, x @ my.T, mx @ y.T
        with np.errstate(divide="ignore", invalid="ignore"):
            c = x @ y.T / n - sx * sy / n / n
            vx, vy = (x * x) @ my.T / n - (sx / n) ** 2, mx @ (y * y).T / n - (sy / n) ** 2
            rho = np.where((vx > 1e-9) & (vy > 1e-9), c / np.sqrt(vx * vy), np.nan)
        names = pdf["sample"].to_numpy()
        rows = [(names[a], rho[k][(second != a) & ~np.isnan(rho[k])]) for k, a in enumerate(first)]
        if key[0] != key[1]:
            rows += [(names[b], rho[:, k][~np.isnan(rho[:, k])]) for k, b in enumerate(second)]
        return pd.DataFrame(rows, columns=["a", "rho"])

    rho = dealt.groupBy("i", "j").applyInPandas(correlate, f"a {kind}, rho array<double>").select("a", F.explode_outer("rho").alias("rho"))
    med = rho.groupBy(F.col("a").alias("sample")).agg(F.percentile("rho", 0.5).alias("median_rho"))
    centre = med.agg(F.percentile("median_rho", 0.5).alias("c"))
    spread = med.join(F.broadcast(centre), F.lit(True)).agg(F.first("c").alias("c"), F.percentile(F.abs(F.col("median_rho") - F.col("c")), 0.5).alias("mad"))
    return med.join(F.broadcast(spread), F.lit(True)).withColumn("cutoff", F.col("c") - 3 * 1.4826 * F.col("mad")).select("sample", "median_rho", "cutoff", (F.col("median_rho") < F.col("cutoff")).alias("outlier"))


def centred_log_ratio(parts: DataFrame) -> DataFrame:
    """individualID, part, clr from (individualID, part, share): zeros become half the least positive share."""
    least = parts.where("share > 0").agg((F.min("share") / 2).alias("_m"))
    filled = parts.join(F.broadcast(least), F.lit(True)).withColumn("s", F.when(F.col("share") > 0, F.col("share")).otherwise(F.col("_m")))
    by = Window.partitionBy("individualID")
    closed = F.ln(F.col("s") / F.sum("s").over(by))
    return filled.select("individualID", "part", closed.alias("l")).select("individualID", "part", (F.col("l") - F.avg("l").over(by)).alias("clr"))


def _leading(apply: Callable[[np.ndarray], np.ndarray], size: int, k: int, *, extra: int = 8, steps: int = 40, tol: float = 1e-11, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix, and their vectors as columns, by block Lanczos steps.

    ``apply`` multiplies the matrix by a block of k + ``extra`` columns. Each step adds what the product of the last block
    has beyond the space so far, kept at right angles to all of it; in that space the best vectors are found, until they
    are eigenvectors to ``tol`` of the greatest value. Here are matrices of ``size`` rows only."""
    width = min(size, k + extra)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    basis, image = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(steps):
        product = apply(block)
        basis, image = np.hstack([basis, block]), np.hstack([image, product])
        inner = basis.T @ image
        values, inside = np.linalg.eigh((inner + inner.T) / 2)
        values, inside = values[::-1][:k], inside[:, ::-1][:, :k]
        left = image @ inside - basis @ inside * values
        if np.abs(left).max(initial=0.0) <= tol * max(values[0], 1e-300) or basis.shape[1] >= size:
            break
        for _ in range(2):
            product = product - basis @ (basis.T @ product)
        q, r = np.linalg.qr(product)
        keep = np.abs(np.diag(r)) > 1e-13 * max(values[0], 1e-300)
        block = q[:, keep][:, : size - basis.shape[1]]
        if not block.shape[1]:
            break
    return np.maximum(values, 0), basis @ inside


def _components(vectors: DataFrame, base: np.ndarray, total: float, k: int) -> DataFrame:
    """sample, pc1 to pc<k>, pct1 to pct<k>: scores of samples and the shares of ``total`` in per cent.

    ``vectors``: sample, at (places), value; a sample's vector is ``base`` with the values added at their places. Samples
    stay where they are: a step's product is summed up in their tasks, so the driver and each task have matrices as long
    as the vectors and a few columns wide, however many samples there are. A component's greatest score (by size) is
    positive; components beyond the rank or the vectors' length are 0 or null."""
    size, spark = len(base), vectors.sparkSession
    kind = dict(vectors.dtypes)["sample"]
    fields = ", ".join(f"pc{i + 1} double, pct{i + 1} double" for i in range(k))
    if not size:
        return spark.createDataFrame([], f"sample {kind}, {fields}")
    vectors = stored(vectors)
    columns = lambda batch: (batch.column("at").flatten().to_numpy(), batch.column("value").flatten().to_numpy(), np.repeat(np.arange(len(batch)), batch.column("at").value_lengths().to_numpy()))

    def times(batch: pa.RecordBatch, block: np.ndarray) -> np.ndarray:
        at, value, row = columns(batch)
        out = np.tile(base @ block, (len(batch), 1))
        np.add.at(out, row, block[at] * value[:, None])
        return out

    def apply(block: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(block.shape)
            for batch in batches:
                y = times(batch, sent.value)
                at, value, row = columns(batch)
                np.add.at(total, at, y[row] * value[:, None])
                total += np.outer(base, y.sum(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), *map(pa.array, np.ascontiguousarray(total.T))], ["place", *[f"c{j}" for j in range(block.shape[1])]])

        names = [f"c{j}" for j in range(block.shape[1])]
        each = vectors.mapInArrow(run, "place long, " + ", ".join(f"{n} double" for n in names))
        summed = each.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).toPandas().set_index("place")
        return summed.reindex(np.arange(size)).fillna(0.0).to_numpy()

    values, directions = _leading(apply, size, k)
    found = len(values)
    share = [100 * v / total if total > 0 else None for v in values]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = times(batch, directions)
            cells = [c for i in range(k) for c in (pa.array(y[:, i] if i < found else [None] * len(batch), pa.float64()), pa.array([share[i] if i < found else None] * len(batch), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("sample"), *cells], ["sample", *[f"{n}{i + 1}" for i in range(k) for n in ("pc", "pct")]])

    scores = vectors.mapInArrow(score, f"sample {kind}, {fields}")
    signs = scores.agg(*[F.max_by(F.signum(f"pc{i + 1}"), F.struct(F.round(F.abs(f"pc{i + 1}"), 9), F.lit(0))).alias(f"s{i + 1}") for i in range(k)]).first()
    return scores.select("sample", *[c for i in range(k) for c in ((F.col(f"pc{i + 1}") * (signs[f"s{i + 1}"] or 1.0)).alias(f"pc{i + 1}"), f"pct{i + 1}")])


def _sparse(rows: DataFrame, sample: str, place: str, value: str) -> DataFrame:
    """sample, at, value: a row for each sample, its places in order."""
    return rows.groupBy(F.col(sample).alias("sample")).agg(F.array_sort(F.collect_list(F.struct(F.col(place).cast("int").alias("p"), F.col(value).cast("double").alias("v")))).alias("e")).select("sample", F.col("e.p").alias("at"), F.col("e.v").alias("value"))


def sample_components(rows: DataFrame, genes: int = 2000, k: int = 3) -> DataFrame:
    """Principal components of samples over the most variable genes' scaled log2(value + 1); a missing value is 0.

    A sample is one row with its values; what a missing value adds to a scaled vector is the same for all samples. The
    leading directions come from block Lanczos steps over the genes, so the number of samples isn't bound by memory."""
    # Four steps start from here; a task writes whole genes, so what is summed up by gene is small before it is shuffled.
    x = stored(dealt(rows, rows.count(), "gene").groupBy("gene", "sample").agg(F.log2(F.sum("value") + 1).alias("x")))
    n = x.select("sample").distinct().count()
    g = x.groupBy("gene").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    g = g.select("gene", (F.col("s") / n).alias("m"), F.try_divide(F.col("q") - F.col("s") * F.col("s") / n, F.lit(n - 1)).alias("v")).where("v > 1e-12")
    # At most ``genes`` rows.
    top = stored(g.orderBy(F.desc("v"), "gene").limit(genes).withColumn("place", F.row_number().over(Window.orderBy(F.desc("v"), "gene")) - 1))
    table = top.orderBy("place").select("m", "v").toPandas()
    base = -(table["m"] / np.sqrt(table["v"])).to_numpy(float)
    kept = x.join(F.broadcast(top), "gene").select("sample", "place", (F.col("x") / F.sqrt("v")).alias("w"))
    cohort = x.select("sample").distinct().join(_sparse(kept, "sample", "place", "w"), "sample", "left")
    whole = cohort.select("sample", F.coalesce("at", F.array().cast("array<int>")).alias("at"), F.coalesce("value", F.array().cast("array<double>")).alias("value"))
    return _components(whole, base, float(n - 1) * len(base), k)


def composition_axis(clr: DataFrame) -> DataFrame:
    """individualID, pc1, pct1: the leading component of centred log ratios (individualID, part, clr), not scaled."""
    parts = clr.groupBy("part").agg(F.avg("clr").alias("m"), F.var_pop("clr").alias("v"), F.count("*").alias("n")).withColumn("place", F.row_number().over(Window.orderBy("part")) - 1)
    parts = stored(parts)
    total = parts.agg(F.sum(F.col("v") * F.col("n")).alias("t")).first()["t"] or 0.0
    d = clr.join(parts.select("part", "m", "place"), "part").select("individualID", "place", (F.col("clr") - F.col("m")).alias("d"))
    return _components(_sparse(d, "individualID", "place", "d"), np.zeros(parts.count()), float(total), 1).withColumnRenamed("sample", "individualID")


def sex_contrast(rows: DataFrame, y_genes: list, x_gene) -> DataFrame:
    """sample, y_score, x_score, contrast, sex_call: the mean log2(value + 1) of the Y genes less the X gene's; samples are
    split in the middle of the widest gap of contrasts. Missing values are 0; without any Y gene all calls are null."""
    x = rows.groupBy("gene", "sample").agg(F.log2(F.sum("value") + 1).alias("x"))
    seen = F.broadcast(x.where(F.col("gene").isin(y_genes)).agg(F.count_distinct("gene").alias("n_y")))
    s = x.groupBy("sample").agg(F.coalesce(F.sum(F.when(F.col("gene").isin(y_genes), F.col("x"))), F.lit(0.0)).alias("y"), F.coalesce(F.sum(F.when(F.col("gene") == x_gene, F.col("x"))), F.lit(0.0)).alias("x_score"))
    s = s.join(seen, F.lit(True)).select("sample", F.try_divide("y", "n_y").alias("y_score"), "x_score").withColumn("contrast", F.col("y_score") - F.col("x_score"))
    call = F.when(F.col("side") == "high", "Y_high").when(F.col("contrast").isNotNull(), "X_high")
    return s.join(largest_gap(s, "contrast", "sample").select("sample", "side"), "sample").select("sample", "y_score", "x_score", "contrast", call.alias("sex_call"))


def rescued_filter(counts: DataFrame, fpkm: DataFrame, groups: DataFrame, markers: DataFrame, *, min_fpkm: float = 1.0, **rule) -> DataFrame:
    """gene, kept_by: ``filter`` (enough counts, see expression_filter), or ``rescue``: a marker that the filter would lose,
    but whose mean share of the samples' totals (in millions) is above ``min_fpkm``.

    Shares are of the given rows' totals, so a sample's excluded part doesn't move the threshold. A gene and sample
    without a row count as 0. ``rule``: further arguments of the filter."""
    kept = expression_filter(counts, groups, **rule).select("gene", F.lit("filter").alias("kept_by"))
    n = fpkm.agg(F.count_distinct("sample").alias("n_samples"))
    # A row for each sample; a window over one would have all its genes in one task.
    totals = fpkm.groupBy(F.col("sample").alias("_sample")).agg(F.sum("value").alias("_total"))
    share = fpkm.join(F.broadcast(totals), F.col("sample").eqNullSafe(F.col("_sample"))).withColumn("share", F.try_divide("value", "_total") * 1e6)
    # One row: the number of samples.
    mean = share.groupBy("gene").agg(F.sum("share").alias("total")).join(F.broadcast(n), F.lit(True)).where(F.col("total") / F.col("n_samples") > min_fpkm)
    saved = mean.join(markers.select("gene").distinct(), "gene", "left_semi").join(kept, "gene", "left_anti")
    return kept.unionByName(saved.select("gene", F.lit("rescue").alias("kept_by")))


def carried_matrices(counts: DataFrame, fpkm: DataFrame, kept: DataFrame) -> DataFrame:
    """gene, sample, tpm, tmm, in_filter for all genes on the scale of the kept ones.

    Totals, library sizes and scaling factors are those of the kept genes and are carried over to the others, so the
    filtered matrices are the rows with ``in_filter`` and the whole ones a superset with the same values. That a sample's
    kept shares add up to a million is asserted as the rows are made."""
    genes = kept.select("gene").distinct().withColumn("in_filter", F.lit(True))
    flag = lambda df: df.join(genes, "gene", "left").withColumn("in_filter", F.coalesce("in_filter", F.lit(False)))
    c, f = flag(counts), flag(fpkm)
    of = lambda df, name: df.where("in_filter").groupBy("sample").agg(F.sum("value").alias(name))
    scale = of(f, "fpkm_total").join(of(c, "library"), "sample").join(tmm_factors(c.where("in_filter").select("gene", "sample", "value")), "sample", "left")
    both = f.select("gene", "sample", "in_filter", F.col("value").alias("fpkm")).join(c.select("gene", "sample", "in_filter", F.col("value").alias("count")), ["gene", "sample", "in_filter"], "full").join(scale, "sample")
    out = both.select("gene", "sample", F.try_divide("fpkm", "fpkm_total").alias("share"), (F.try_divide("count", F.col("library") * F.col("factor")) * 1e6).alias("tmm"), "in_filter")
    whole = F.sum(F.when(F.col("in_filter"), F.col("share"))).over(Window.partitionBy("sample"))
    checked = F.when(F.abs(whole - 1) > 1e-6, F.raise_error(F.lit("kept shares of a sample don't add up to 1"))).otherwise(F.col("share") * 1e6)
    return out.select("gene", "sample", checked.cast("double").alias("tpm"), "tmm", "in_filter")


def marker_survival(markers: DataFrame, everything: DataFrame, filtered: DataFrame, *, top: int = 500) -> DataFrame:
    """cell, n_markers, in_matrix_all, in_matrix_filtered: how many of a type's first markers are among the matrix's genes."""
    first = markers.withColumn("nth", F.row_number().over(Window.partitionBy("cell").orderBy("rank", "gene"))).where(F.col("nth") <= top).select("cell", "gene").distinct()
    there = lambda df, name: df.select("gene").distinct().withColumn(name, F.lit(1))
    j = first.join(there(everything, "in_all"), "gene", "left").join(there(filtered, "in_filtered"), "gene", "left")
    return j.groupBy("cell").agg(F.count("*").alias("n_markers"), F.count("in_all").alias("in_matrix_all"), F.count("in_filtered").alias("in_matrix_filtered"))
