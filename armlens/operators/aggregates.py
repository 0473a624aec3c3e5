"""Aggregations of calls, genes and expression. Conditions are columns of conditional sums, never pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from .stored import dealt


def _is(condition: str):
    return F.col("condition") == condition


def complete_genes(eligible: DataFrame, individuals: DataFrame) -> DataFrame:
    """ref_id, complete_in: genes in which every individual of a condition has an eligible call."""
    sizes = individuals.groupBy("condition").agg(F.count("*").alias("size"))
    seen = eligible.groupBy("ref_id", "condition").agg(F.countDistinct("individualID").alias("n"))
    full = seen.join(F.broadcast(sizes), "condition").where("n >= size")
    return full.groupBy("ref_id").agg(F.array_join(F.array_sort(F.collect_set("condition")), ",").alias("complete_in"))


def individual_totals(eligible: DataFrame, key: str, value: str, digits: int = 9) -> DataFrame:
    return eligible.groupBy(key, "condition", "individualID").agg(F.round(F.sum(value), digits).alias("total"))


def aggregate_calltypes(eligible: DataFrame) -> DataFrame:
    """Sites, individuals, depths per gene and type, for either condition; what is absent is 0."""
    of = {"case": _is("case"), "ref": _is("ref")}
    aggs = [F.count_if(c).alias(f"n_sites_{k}") for k, c in of.items()]
    aggs += [F.count_distinct(F.when(c, F.col("individualID"))).alias(f"n_indiv_{k}") for k, c in of.items()]
    aggs += [F.coalesce(F.sum(F.when(c, F.col(s))), F.lit(0)).alias(f"sum_{d}_{k}") for k, c in of.items() for s, d in (("a1_ad", "ad"), ("dp", "dp"))]
    return eligible.groupBy("ref_id", "a1type").agg(*aggs)


def classify_genes(eligible: DataFrame, threshold: float = 0.75) -> DataFrame:
    counts = eligible.groupBy("ref_id").agg(F.count_if(_is("case")).alias("n_calls_case"), F.count_if(_is("ref")).alias("n_calls_ref"))
    a, b = F.col("n_calls_case"), F.col("n_calls_ref")
    return counts.select("ref_id", scalars.edit_dist(a, b).alias("edit_dist"), scalars.assign_group(a, b, threshold).alias("gene_group"), "n_calls_case", "n_calls_ref")


def calltype_load(eligible: DataFrame, genes: DataFrame) -> DataFrame:
    return eligible.join(genes.select("ref_id").distinct(), "ref_id", "left_semi").groupBy("a1type", "condition", "individualID").agg(F.count("*").alias("n_sites"))


def filter_cascade(loaded: DataFrame, min_depth: int = scalars.MIN_DEPTH) -> DataFrame:
    """stage, calls, sites, genes, dropped: one scan; each stage keeps a part of the one before it.

    Distinct sites and genes are counted over rows of a site first, so no stage is counted by its own distinct pass.
    """
    stages = {"loaded": F.lit(True), "in_gene": F.col("ref_id").isNotNull()}
    stages["classified"] = stages["in_gene"] & F.col("a1type").isNotNull()
    stages["at_depth"] = stages["classified"] & (F.col("dp") >= min_depth)
    per_site = loaded.groupBy("chrom", "pos", "ref_id").agg(*[F.count_if(c).alias(s) for s, c in stages.items()])
    per_gene = per_site.groupBy("ref_id").agg(*[F.sum(s).alias(f"c_{s}") for s in stages], *[F.count_if(F.col(s) > 0).alias(f"s_{s}") for s in stages])
    one = per_gene.agg(*[F.coalesce(F.sum(f"{k}_{s}"), F.lit(0)).alias(f"{k}_{s}") for s in stages for k in "cs"], *[F.count_if((F.col(f"c_{s}") > 0) & F.col("ref_id").isNotNull()).alias(f"g_{s}") for s in stages])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("stage_no"), F.lit(s).alias("stage"), F.col(f"c_{s}").alias("calls"), F.col(f"s_{s}").alias("sites"), F.col(f"g_{s}").alias("genes")) for n, s in enumerate(stages, 1)]))
    # Four rows.
    long = one.select(rows.alias("r")).select("r.*")
    return long.withColumn("dropped", F.coalesce(F.lag("calls").over(Window.orderBy("stage_no")) - F.col("calls"), F.lit(0)))


def calltype_rates(eligible: DataFrame) -> DataFrame:
    """A row for each type and condition, those with the most sites first."""
    g = eligible.groupBy("a1type", "condition").agg(F.count("*").alias("n_calls"), F.count_distinct("chrom", "pos").alias("n_sites"), F.count_distinct("individualID").alias("n_individuals"), F.count_distinct("ref_id").alias("n_genes"))
    return g.orderBy(F.desc("n_sites"), "a1type", "condition")


def cascade_check(cascade: DataFrame, recorded: DataFrame, min_depth: int = scalars.MIN_DEPTH) -> DataFrame:
    """check, recorded, found, agrees: the depth and the number of eligible calls that gene tests have written to the log
    (columns key and value) against the cascade's last stage. Where the depths differ the counts aren't compared."""
    log = lambda key: F.max(F.when(F.col("key") == key, F.col("value").try_cast("long")))
    one = recorded.agg(log("gene_tests.min_depth").alias("depth"), log("gene_tests.n_eligible_calls").alias("calls")).join(cascade.where("stage = 'at_depth'").select(F.col("calls").alias("found")), F.lit(True))
    same = F.coalesce(F.col("depth") == min_depth, F.lit(True))
    rows = [F.struct(F.lit("min_depth").alias("check"), F.col("depth").alias("recorded"), F.lit(min_depth).cast("long").alias("found")), F.struct(F.lit("eligible_calls").alias("check"), F.when(same, F.col("calls")).alias("recorded"), F.col("found").cast("long").alias("found"))]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("agrees", F.coalesce(F.col("recorded") == F.col("found"), F.lit(True)))


def gene_sites(loaded: DataFrame, genes: DataFrame) -> DataFrame:
    """Distinct (ref_id, individualID, chrom, pos) of the given genes."""
    return loaded.join(genes.select("ref_id").distinct(), "ref_id", "left_semi").select("ref_id", "individualID", "chrom", "pos").distinct()


def site_level(loaded: DataFrame, genes: DataFrame, individuals: DataFrame) -> DataFrame:
    """Each call of the given genes with its type, reads and condition: where the adjusted models start."""
    kept = loaded.join(genes.select("ref_id").distinct(), "ref_id", "left_semi").join(individuals.select("individualID", "condition"), "individualID")
    return kept.select("ref_id", "chrom", "pos", "a1type", "individualID", "condition", "a1_ad", "dp")


def gene_map(genes: DataFrame) -> DataFrame:
    """ref_id, gene_name and the id without its version, of genes that have a name."""
    named = genes.where("gene_name IS NOT NULL AND gene_name <> ''").select("ref_id", "gene_name").distinct()
    return named.withColumn("ref_id_stripped", scalars.strip_symbol_suffix(F.col("ref_id").cast("string"), "dot or underscore"))


def exclusion_by_type(transcripts: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """transcript_type, n_genes, n_transcripts of the types that hold one of the parts."""
    parts = scalars.EXCLUDED_BIOTYPES if parts is None else parts
    hit = F.lit(False)
    for p in parts:
        hit = hit | F.col("transcript_type").contains(p)
    return transcripts.where(hit).groupBy("transcript_type").agg(F.count_distinct("ref_id").alias("n_genes"), F.count("*").alias("n_transcripts"))


def exclusion_by_prefix(transcripts: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """prefix, n_genes, n_transcripts, names of the transcripts whose name begins with it; a row for each prefix."""
    each = F.explode(F.array(*map(F.lit, scalars.EXCLUDED_NAMES if prefixes is None else prefixes)))
    long = transcripts.select("ref_id", "gene_name", each.alias("prefix"))
    hit = F.coalesce(F.startswith("gene_name", "prefix"), F.lit(False))
    return long.groupBy("prefix").agg(F.count_distinct(F.when(hit, F.col("ref_id"))).alias("n_genes"), F.count_if(hit).alias("n_transcripts"), F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col("gene_name")))), ",").alias("names"))


def symbol_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """symbol, outcome of the symbols that loci lost (none left), kept in part (also on chimeric loci) or have on several
    loci (fragmented), given the loci's symbols before and after an exclusion (columns locus_id, gene_name)."""
    chimeric = after.groupBy("locus_id").agg((F.count_distinct("gene_name") > 1).alias("chimeric"))
    per = after.where("gene_name IS NOT NULL").select("locus_id", "gene_name").distinct().join(chimeric, "locus_id")
    g = per.groupBy(F.col("gene_name").alias("symbol")).agg(F.count_if(~F.col("chimeric")).alias("clean"), F.count_if("chimeric").alias("mixed"))
    all_symbols = before.where("gene_name IS NOT NULL").select(F.col("gene_name").alias("symbol")).distinct()
    outcome = F.when(F.coalesce("clean", F.lit(0)) == 0, "lost").when(F.col("mixed") > 0, "partial").when(F.col("clean") > 1, "fragmented").otherwise("clean")
    return all_symbols.join(g, "symbol", "left").select("symbol", outcome.alias("outcome"))


def marker_gate(coverage: DataFrame, *, wanted: int = 300, floor: int = 200) -> DataFrame:
    """cell, n_clean, gate: ok with enough clean markers, low above the floor, else too few."""
    g = coverage.groupBy("cell").agg(F.sum("n_clean").alias("n_clean"))
    return g.withColumn("gate", F.when(F.col("n_clean") >= wanted, "ok").when(F.col("n_clean") >= floor, "low").otherwise("too few"))


def threshold_sweep(classes: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, gene_group, n_genes: genes of each group at each threshold, empty groups too."""
    a, b = F.col("n_calls_case"), F.col("n_calls_ref")
    per = classes.agg(*[F.count_if(scalars.assign_group(a, b, t) == g).alias(f"{n}_{g}") for n, t in enumerate(thresholds) for g in ("case_enriched", "ref_enriched", "Shared")])
    rows = [F.struct(F.lit(t).alias("threshold"), F.lit(g).alias("gene_group"), F.col(f"{n}_{g}").alias("n_genes")) for n, t in enumerate(thresholds) for g in ("case_enriched", "ref_enriched", "Shared")]
    return per.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def tpm(expression: DataFrame) -> DataFrame:
    """Shares of each individual's total, in millions, over all rows; 0 where the total isn't positive."""
    # A cohort list; a window over an individual would have all its genes in one task.
    totals = expression.groupBy(F.col("individualID").alias("_individual")).agg(F.sum("fpkm").alias("_total"))
    j = expression.join(F.broadcast(totals), F.col("individualID").eqNullSafe(F.col("_individual")), "left")
    return j.select(*expression.columns, F.when(F.col("_total") > 0, F.col("fpkm") / F.col("_total") * 1e6).otherwise(0.0).alias("tpm"))


def call_burden(loaded: DataFrame) -> DataFrame:
    return loaded.groupBy("individualID").agg(F.count("*").alias("n_calls"), F.count_distinct("chrom", "pos").alias("n_positions"), F.count_distinct("ref_id").alias("n_genes"))


def count_positions(eligible: DataFrame, classes: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """Distinct positions per (edit_dist, a1type), condition and uniqueness: unique is carried by one individual of the
    whole cohort. ``calls``: those of the eligible calls that hold all of the classified genes, where fewer are at hand."""
    at, n = ["chrom", "pos"], eligible.count()
    # A row for each position and condition, and one for each position over both: unique where the least individual is the
    # greatest. Both are dealt by position once, so neither is shuffled again.
    j = dealt(eligible if calls is None else calls, n, "ref_id").join(classes.select("ref_id", "edit_dist"), "ref_id").select("edit_dist", "a1type", *at, "condition")
    per = dealt(j, n, *at).distinct()
    alone = F.coalesce(F.min("individualID") == F.max("individualID"), F.lit(False))
    carriers = dealt(eligible.select(*at, "individualID"), n, *at).groupBy(*at).agg(alone.alias("alone"))
    m = per.join(carriers, at)
    cell = lambda c, u: F.count_if(c & (F.col("alone") == F.lit(u)))
    return m.groupBy("edit_dist", "a1type").agg(cell(_is("case"), True).alias("n_case_unique"), cell(_is("case"), False).alias("n_case_common"), cell(_is("ref"), True).alias("n_ref_unique"), cell(_is("ref"), False).alias("n_ref_common"))


def site_counts(eligible: DataFrame, pairs: DataFrame) -> DataFrame:
    kept = eligible.join(pairs.select("ref_id", "a1type").distinct(), ["ref_id", "a1type"], "left_semi")
    return kept.groupBy("ref_id", "a1type", "chrom", "pos").agg(F.count_distinct(F.when(_is("case"), F.col("individualID"))).alias("n_case"), F.count_distinct(F.when(_is("ref"), F.col("individualID"))).alias("n_ref"))


def panel_of_normals(calls: DataFrame, controls: DataFrame, k: int = 2) -> DataFrame:
    """Positions seen in at least k control samples."""
    seen = calls.join(controls.select("individualID"), "individualID", "left_semi").groupBy("chrom", "pos").agg(F.count_distinct("individualID").alias("n_samples"))
    return seen.where(F.col("n_samples") >= k)


def resolve_genes(transcripts: DataFrame) -> DataFrame:
    """Transcripts (tid, locus_id, ref_gene_id, line) with ref_id and outcome: their own gene; else their locus' only
    one; a locus without any is a gene of its own (novel); with several it is chimeric and ref_id is null."""
    loci = transcripts.groupBy("locus_id").agg(F.count_distinct("ref_gene_id").alias("n_refs"), F.min("ref_gene_id").alias("only"))
    j = transcripts.join(loci, "locus_id")
    outcome = F.when(F.col("ref_gene_id").isNotNull(), "matched").when(F.col("n_refs") == 1, "inherited").when(F.col("n_refs") == 0, "novel").otherwise("chimeric")
    ref = F.coalesce("ref_gene_id", F.when(F.col("n_refs") == 1, F.col("only")).when(F.col("n_refs") == 0, F.col("locus_id")))
    return j.withColumn("outcome", outcome).withColumn("ref_id", ref).drop("n_refs", "only")


def build_gene(transcripts: DataFrame) -> DataFrame:
    """A row for each ref_id; first values are those of the first line that has one."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line"))).alias(c)
    g = transcripts.where("ref_id IS NOT NULL").groupBy("ref_id").agg(
        first("chrom"), first("strand"), first("gene_name"), F.min("trans_start").alias("gene_start"), F.max("trans_end").alias("gene_end"), F.count("*").alias("n_transcripts"),
        F.count_distinct("chrom").alias("n_chroms"), F.count_distinct("strand").alias("n_strands"), F.max((F.col("outcome") == "novel").cast("int")).alias("novel"),
    )
    return g.withColumn("gene_span", F.col("gene_end") - F.col("gene_start") + 1)


def build_exons(exons: DataFrame) -> DataFrame:
    """tid, exon_num, exon_start, exon_end, trans_offset, trans_len: numbered in reading direction."""
    once = exons.select("tid", "strand", "exon_start", "exon_end").distinct()
    key = F.when(F.col("strand") == "-", -F.col("exon_start")).otherwise(F.col("exon_start"))
    order = Window.partitionBy("tid").orderBy(key, "exon_end")
    length = F.col("exon_end") - F.col("exon_start") + 1
    before = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return once.select("tid", "strand", F.row_number().over(order).alias("exon_num"), "exon_start", "exon_end", before.alias("trans_offset"), F.sum(length).over(Window.partitionBy("tid")).alias("trans_len"))


def locus_symbols(transcripts: DataFrame) -> DataFrame:
    """locus_id, n_symbols, chimeric, symbol (of loci with one)."""
    g = transcripts.groupBy("locus_id").agg(F.count_distinct("gene_name").alias("n_symbols"), F.min("gene_name").alias("symbol"))
    return g.select("locus_id", "n_symbols", (F.col("n_symbols") > 1).cast("int").alias("chimeric"), F.when(F.col("n_symbols") == 1, F.col("symbol")).alias("symbol"))


def marker_coverage(markers: DataFrame, available: DataFrame, clean: DataFrame, top: int = 500) -> DataFrame:
    """Per cell type: of the first markers by rank, how many are available, and clean, and lost."""
    ranked = markers.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("rank", "marker"))).where(F.col("r") <= top)
    j = ranked.join(available.select("marker").distinct().withColumn("_a", F.lit(True)), "marker", "left").join(clean.select("marker").distinct().withColumn("_c", F.lit(True)), "marker", "left")
    band = F.when(F.col("r") <= 100, "1-100").when(F.col("r") <= 200, "101-200").when(F.col("r") <= 300, "201-300").otherwise("301-500")
    return j.withColumn("band", band).groupBy("cell", "band").agg(F.count("*").alias("n_markers"), F.count("_a").alias("n_available"), F.count(F.when(F.col("_a"), F.col("_c"))).alias("n_clean"))


def largest_gap(values: DataFrame, value: str, key: str) -> DataFrame:
    """The midpoint of the widest gap between neighbouring values (the lowest of equal ones) and the side each row is on.

    One row per sample passes through the window: a cohort's size.
    """
    order = Window.orderBy(value)
    gaps = values.select(value, (F.lead(value).over(order) - F.col(value)).alias("gap")).where("gap IS NOT NULL")
    cut = gaps.agg(F.max_by(F.col(value) + F.col("gap") / 2, F.struct("gap", F.lit(0.0) - F.col(value))).alias("cut"))
    return values.join(F.broadcast(cut), F.lit(True)).select(key, value, "cut", F.when(F.col(value) > F.col("cut"), "high").otherwise("low").alias("side"))


def rescue_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """kind, name: what an exclusion gave back, from the loci's symbols (locus_id, gene_name) before and after it.

    ``locus_removed``: a named locus has no symbol left. ``locus_rescued``: it had several symbols and has one now.
    ``symbol_rescued``: it was on no locus of its own before and is on one now."""

    def per_locus(rows: DataFrame, side: str) -> DataFrame:
        named = rows.where("gene_name IS NOT NULL").select("locus_id", "gene_name").distinct()
        return named.groupBy("locus_id").agg(F.count("*").alias(f"n_{side}"), F.min("gene_name").alias(f"symbol_{side}"))

    loci = per_locus(before, "before").join(per_locus(after, "after"), "locus_id", "left")
    kind = F.when(F.col("n_after").isNull(), "locus_removed").when((F.col("n_before") > 1) & (F.col("n_after") == 1), "locus_rescued")
    moved = loci.select(kind.alias("kind"), F.col("locus_id").cast("string").alias("name")).where("kind IS NOT NULL")
    alone = lambda side: loci.where(F.col(f"n_{side}") == 1).select(F.col(f"symbol_{side}").alias("name")).distinct()
    symbols = alone("after").join(alone("before"), "name", "left_anti").join(before.select(F.col("gene_name").alias("name")).distinct(), "name", "left_semi")
    return moved.unionByName(symbols.select(F.lit("symbol_rescued").alias("kind"), F.col("name").cast("string").alias("name")))


def rescue_totals(audit: DataFrame) -> DataFrame:
    """One row: loci_removed, loci_rescued, symbols_rescued."""
    n = lambda k: F.count_if(F.col("kind") == k)
    return audit.agg(n("locus_removed").alias("loci_removed"), n("locus_rescued").alias("loci_rescued"), n("symbol_rescued").alias("symbols_rescued"))
