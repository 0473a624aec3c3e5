"""Genomic joins: points in intervals, call subtraction, matrices and lookups."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from .stored import dealt

#: Spans of more than so many bins go to bins that are wider by this factor.
COARSE = 64
#: Rows of a cohort list that is still broadcast; longer ones are joined by a shuffle.
MAX_BROADCAST = 100_000


def covering(points: DataFrame, spans: DataFrame, *, bin_width: int | None = None, start: str = "gene_start", end: str = "gene_end", n_points: int | None = None) -> DataFrame:
    """Every (point, span) with start <= pos <= end on the same chromosome.

    Spans are exploded into bins and points meet them by equality of (chrom, bin), so the join is hashed or sorted and
    not a nested loop. Bins of a hot place are split by adaptive execution: either side is shuffled by that key only.
    A bin is as wide as the median span (or ``bin_width``). Giant spans have coarse bins of their own, so none is
    exploded into thousands of rows; points meet both kinds.
    """
    length = F.col(end) - F.col(start) + 1
    sizes = spans.agg(F.percentile_approx(length, 0.5).alias("median"), F.max(length).alias("most")).first()
    reach = F.max(end) - F.min(start) + 1
    depth = spans.groupBy("chrom").agg((F.sum(length) / reach).alias("d")).agg(F.max("d").alias("d")).first()["d"] or 0
    rows = (points.count() if n_points is None else n_points) * (1 + depth)
    width = bin_width or max(1, int(sizes["median"] or 1))
    giant = (sizes["most"] or 0) > COARSE * width
    bins = lambda c, w: F.floor(F.col(c) / w).cast("long")
    level = F.when(length > COARSE * width, 1).otherwise(0)
    wide = F.when(F.col("_level") == 1, COARSE * width).otherwise(width)
    right = spans.withColumn("_level", level).withColumn("_bin", F.explode(F.sequence(bins(start, wide), bins(end, wide))))
    places = [F.struct(F.lit(n).alias("_level"), bins("pos", w).alias("_bin")) for n, w in ((0, width), (1, COARSE * width))[: 1 + giant]]
    left = points.withColumn("_at", F.explode(F.array(*places))).select(*points.columns, "_at._level", "_at._bin")
    at = ["chrom", "_level", "_bin"]
    return dealt(left, rows, *at).join(dealt(right, rows, *at), at).where(F.col("pos").between(F.col(start), F.col(end))).drop("_level", "_bin")


def resolve_sites(sites: DataFrame, genes: DataFrame, *, bin_width: int | None = None) -> DataFrame:
    """chrom, pos, ref_base, ref_id, strand: of the genes that cover a site the known before the novel, then by tier,
    most transcripts, longest span and least id; null where no gene does."""
    genes = genes.select("chrom", "gene_start", "gene_end", "ref_id", "strand", "novel", "tier", "n_transcripts", "gene_span")
    n = sites.count()
    met = covering(sites.select("chrom", "pos"), genes, bin_width=bin_width, n_points=n)
    order = F.struct("novel", "tier", (-F.col("n_transcripts")).alias("t"), (-F.col("gene_span")).alias("s"), "ref_id")
    best = met.groupBy("chrom", "pos").agg(F.min_by(F.struct("ref_id", "strand"), order).alias("g")).select("chrom", "pos", "g.*")
    return dealt(sites, n, "chrom", "pos").join(best, ["chrom", "pos"], "left").select("chrom", "pos", "ref_base", "ref_id", "strand")


def eligible_calls(loaded: DataFrame, genes: DataFrame, individuals: DataFrame, *, min_depth: int = scalars.MIN_DEPTH, rows: int = 0) -> DataFrame:
    """Typed calls in a gene at depth, with their condition and proportions. ``rows``: how many calls there are, where it is known."""
    kept = loaded.where(scalars.eligible(min_depth))
    joined = dealt(kept, rows, "ref_id").join(genes.select("ref_id", "gene_span"), "ref_id").join(individuals.select("individualID", "condition"), "individualID")
    share = F.col("a1_ad") / F.col("dp").cast("double")
    return joined.select("ref_id", "condition", "individualID", "chrom", "pos", "a1type", "a1_ad", "dp", "gene_span", share.alias("proportion"), (share / F.col("gene_span")).alias("weighted"))


def subtract_calls(calls: DataFrame, other: DataFrame, panel: DataFrame, known: DataFrame) -> DataFrame:
    """Each call with ``origin`` (other, panel or kept, in this order) and ``germline`` (kept calls at known positions).

    ``other`` is matched within the individual, ``panel`` and ``known`` for all. One pass gives rows and counts.
    """
    mark = lambda df, keys, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    at = ["chrom", "pos"]
    j = calls.join(mark(other, ["individualID", *at], "_other"), ["individualID", *at], "left")
    j = j.join(mark(panel, at, "_panel"), at, "left").join(mark(known, at, "_known"), at, "left")
    origin = F.when(F.col("_other"), "other").when(F.col("_panel"), "panel").otherwise("kept")
    return j.withColumn("origin", origin).withColumn("germline", ((F.col("origin") == "kept") & F.col("_known").isNotNull()).cast("int")).drop("_other", "_panel", "_known")


def contig_mismatch(a: DataFrame, b: DataFrame) -> bool:
    """Whether two call sets share no contig at all."""
    return a.select("chrom").distinct().intersect(b.select("chrom").distinct()).isEmpty()


def orphans(exons: DataFrame, transcripts: DataFrame) -> DataFrame:
    """kind, tid: exons without their transcript and transcripts without exons."""
    loose = exons.join(transcripts, "tid", "left_anti").select(F.lit("orphan_exon").alias("kind"), "tid").distinct()
    bare = transcripts.join(exons, "tid", "left_anti").select(F.lit("exonless_transcript").alias("kind"), "tid")
    return loose.unionByName(bare)


def apply_attributes(table: DataFrame, attrs: DataFrame, key: str, columns: list[str], *, order: str = "line", min_match: float = 0.5) -> DataFrame:
    """Left join of the first attribute row of each key; raises if fewer than ``min_match`` of the rows match."""
    first = attrs.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in columns], F.lit(True).alias("_hit"))
    joined = table.join(first, key, "left")
    share = joined.agg(F.avg(F.col("_hit").isNotNull().cast("double")).alias("s")).first()["s"]
    if share is not None and share < min_match:
        raise ValueError(f"attributes match {share:.1%} of the rows; {min_match:.0%} are asked for")
    return joined.drop("_hit")


def check_lengths(exons: DataFrame, lengths: DataFrame) -> DataFrame:
    """tid, exon_length, length: transcripts whose exons don't add up to the given length."""
    summed = exons.groupBy("tid").agg(F.sum(F.col("exon_end") - F.col("exon_start") + 1).alias("exon_length"))
    return summed.join(lengths, "tid").where("exon_length <> length")


def zero_filled(genes: DataFrame, individuals: DataFrame, tpm: DataFrame, counts: DataFrame) -> DataFrame:
    """ref_id, individualID, condition, tpm, n_calls for every gene and individual; what is absent is 0.

    The grid has as many rows as the two tables' product says it must; ``individuals`` is a cohort list, which is
    broadcast where it is as short as that (MAX_BROADCAST), so the genes stay dealt as they are.
    """
    cohort = individuals.select("individualID", "condition")
    short = cohort.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    grid = genes.select("ref_id").distinct().crossJoin(F.broadcast(cohort) if short else cohort)
    j = grid.join(tpm.select("ref_id", "individualID", "tpm"), ["ref_id", "individualID"], "left").join(counts.select("ref_id", "individualID", "n_calls"), ["ref_id", "individualID"], "left")
    return j.select("ref_id", "individualID", "condition", F.coalesce("tpm", F.lit(0.0)).alias("tpm"), F.coalesce("n_calls", F.lit(0)).alias("n_calls"))


def external_check(sites: DataFrame, positions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """chrom, pos, in_a (yes or no), b_ids (sorted ids of the second catalogue, or NA)."""
    a = positions.select("chrom", "pos").distinct().withColumn("_a", F.lit(True))
    b = catalogue.groupBy("chrom", "pos").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("b_ids"))
    j = sites.select("chrom", "pos").distinct().join(a, ["chrom", "pos"], "left").join(b, ["chrom", "pos"], "left")
    return j.select("chrom", "pos", F.when(F.col("_a"), "yes").otherwise("no").alias("in_a"), F.coalesce("b_ids", F.lit("NA")).alias("b_ids"))


def external_totals(checked: DataFrame) -> DataFrame:
    a, b = F.col("in_a") == "yes", F.col("b_ids") != "NA"
    return checked.agg(F.count_if(a).alias("in_a"), F.count_if(b).alias("in_b"), F.count_if(a & b).alias("both"), F.count_if(~a & ~b).alias("neither"), F.count("*").alias("total"))


def class_tally(lines: DataFrame) -> DataFrame:
    """class_code, n: transcripts by their first class code."""
    first = lines.where(F.col("class_code").isNotNull()).groupBy("tid").agg(F.min_by("class_code", "line").alias("class_code"))
    return first.groupBy("class_code").agg(F.count("*").alias("n"))


def select_novel(lines: DataFrame, known_codes: list[str], *, require: bool = False) -> DataFrame:
    """All lines of the transcripts whose first class code isn't a known one. With ``require`` it is an error if there is
    none, as where all codes were given as known."""
    first = lines.where(F.col("class_code").isNotNull()).groupBy("tid").agg(F.min_by("class_code", "line").alias("code"))
    novel = first.where(~F.col("code").isin(known_codes)).select("tid")
    if require and novel.isEmpty():
        raise ValueError(f"no transcript has a class code other than {', '.join(known_codes)}")
    return lines.join(novel, "tid", "left_semi")


def covariates(individuals: DataFrame, extra: DataFrame, key: str = "individualID") -> DataFrame:
    """Extra columns per individual, those the cohort has already stay as they are: the first row of each key in the
    order of ``line`` (as readers number lines), or of the values where there is none. Warns of individuals whose rows
    differ."""
    new = [c for c in extra.columns if c not in individuals.columns and c not in (key, "line")]
    if new:
        several = extra.groupBy(key).agg((F.count_distinct(F.struct(*new)) > 1).alias("s")).where("s").count()
        if several:
            warnings.warn(f"{several} individuals have rows with different covariates; the first row of each is taken", stacklevel=2)
    order = F.col("line") if "line" in extra.columns else F.struct(*[F.col(c).cast("string") for c in new])
    first = extra.groupBy(key).agg(F.min_by(F.struct(*new), order).alias("_v")).select(key, "_v.*") if new else extra.select(key).distinct()
    return individuals.join(first, key, "left")


def covariate_matches(joined: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_matched, n: how many individuals have a value of each covariate."""
    rows = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n_matched"), F.count("*").alias("n")) for c in columns]
    return joined.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def unaligned(a: DataFrame, b: DataFrame, key: str = "individualID") -> DataFrame:
    """Keys of one table only."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("only_in", F.lit("first")).unionByName(right.join(left, key, "left_anti").withColumn("only_in", F.lit("second")))


def symbol_route(own: Column, locus_symbol: Column) -> Column:
    """A transcript's own name first, else its locus' clean symbol."""
    return F.coalesce(own, locus_symbol)


def routed_symbols(transcripts: DataFrame, loci: DataFrame) -> DataFrame:
    """The transcripts (locus_id, gene_name) with ``symbol`` and ``route``: their own name, else their locus' clean symbol
    (``loci``: locus_id, symbol), else none."""
    j = transcripts.join(loci.select("locus_id", F.col("symbol").alias("locus_symbol")), "locus_id", "left")
    route = F.when(F.col("gene_name").isNotNull(), "own").when(F.col("locus_symbol").isNotNull(), "locus").otherwise("none")
    return j.withColumn("symbol", symbol_route(F.col("gene_name"), F.col("locus_symbol"))).withColumn("route", route).drop("locus_symbol")


def route_counts(routed: DataFrame) -> DataFrame:
    """route, n_transcripts, n_loci: how transcripts got their symbols, and how many got none."""
    return routed.groupBy("route").agg(F.count("*").alias("n_transcripts"), F.count_distinct("locus_id").alias("n_loci"))
