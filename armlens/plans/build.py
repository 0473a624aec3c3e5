"""From files to tables: annotation, calls and expression. Steps write what several results start from, and count as they
write; what they return is a plan that a caller saves."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates, joins
from ..operators.stored import dealt, observed, stored
from ..sources import readers, sinks


@dataclass
class Annotation:
    """``counts``: what was read, dropped and kept, for the run's log."""

    transcript: DataFrame
    exon: DataFrame
    gene: DataFrame
    contigs: DataFrame
    counts: dict[str, int | str | None]


def annotate(spark: SparkSession, gtf: str, report: DataFrame | None = None, *, keep_versions: bool = False) -> Annotation:
    """Transcripts with their gene, numbered exons and genes. Contigs are chosen before any window is opened.

    Lines and transcripts are written once, as several results start from them; counts are observed in these passes.
    Transcripts without a locus go, and so do those without exons, and exons without a transcript. Of lines that repeat a
    transcript the first counts."""
    of = lambda f: F.col("feature") == f
    lines, seen = observed(
        readers.read_gtf(spark, gtf), n_lines=F.count("*"), n_dropped_no_tid=F.count_if(of("transcript") & F.col("tid").isNull()), n_dropped_exons_no_tid=F.count_if(of("exon") & F.col("tid").isNull()),
        n_residual_prefix=F.count_if(scalars.has_residual_prefix(F.col("tid"))),
    )
    lines = stored(lines)
    rows = lines.where("tid IS NOT NULL")
    contigs = readers.select_contigs(rows, report) if report is not None else rows.select("chrom").distinct().select("chrom", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("reason"))
    contigs = stored(contigs)
    # A row for each contig.
    kept = sorted(r["chrom"] for r in contigs.where("kept").collect())
    counts: dict[str, int | str | None] = {"n_contigs_present": contigs.count(), "n_contigs_kept": len(kept) if report is not None else None, "contigs_kept": ",".join(kept) if report is not None else None}
    rows = rows.join(contigs.select("chrom", F.col("kept").alias("on_contig")), "chrom")
    stem = lambda c: scalars.version_stem(scalars.strip_id_prefix(F.col(c)), keep_versions)
    rows = rows.withColumn("tid_version", scalars.version_number(F.col("tid"))).withColumn("ref_id_version", scalars.version_number(F.col("ref_gene_id"))).withColumn("tid", stem("tid")).withColumn("ref_gene_id", stem("ref_gene_id"))
    located = F.col("locus_id").isNotNull()
    first = Window.partitionBy("tid", F.col("on_contig") & located).orderBy("file", "line")
    t = rows.where(of("transcript")).withColumn("nth", F.row_number().over(first))
    usable = F.col("on_contig") & located
    t, found = observed(
        t, n_transcripts_dropped_contig=F.count_if(~F.col("on_contig")), n_dropped_no_locus=F.count_if(F.col("on_contig") & ~located), n_dropped_no_locus_with_gene=F.count_if(F.col("on_contig") & ~located & F.col("ref_gene_id").isNotNull()),
        n_duplicate_transcripts=F.count_if(usable & (F.col("nth") > 1)),
    )
    t = stored(t.where(F.col("on_contig") & (~located | (F.col("nth") == 1))).select(
        "tid", "tid_version", "ref_id_version", "locus_id", "ref_gene_id", "gene_name", "chrom", "strand", F.col("start").alias("trans_start"), F.col("end").alias("trans_end"), "line",
    ))
    lost = lost_genes(t.select(F.col("ref_gene_id").alias("ref_id")), t.where(located).select(F.col("ref_gene_id").alias("ref_id")))
    counts["n_genes_absent_no_locus"] = lost.count()
    t = t.where(located)
    e = rows.where(of("exon") & F.col("on_contig") & F.col("start").isNotNull() & F.col("end").isNotNull()).select("tid", "strand", F.col("start").alias("exon_start"), F.col("end").alias("exon_end"))
    lone = {r["kind"]: r["n"] for r in joins.orphans(e, t).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    counts |= {f"n_dropped_{k.replace(' ', '_')}": n for k, n in lone.items()}
    exon = aggregates.build_exons(e.join(t.select("tid"), "tid", "left_semi"))
    lengths = exon.select("tid", "trans_len").distinct()
    transcript = aggregates.resolve_genes(t.join(lengths, "tid"))
    return Annotation(transcript, exon, aggregates.build_gene(transcript), contigs, counts | seen.get | found.get)


def lost_genes(all_transcripts: DataFrame, kept: DataFrame) -> DataFrame:
    """Genes that are on dropped transcripts only."""
    return all_transcripts.where("ref_id IS NOT NULL").select("ref_id").distinct().join(kept.select("ref_id").distinct(), "ref_id", "left_anti")


def load_calls(spark: SparkSession, paths: str | list[str], samples: DataFrame, genes: DataFrame, contigs: DataFrame | None = None, *, repeated: str = "reject") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(calls with gene, strand and type; sites; counts for the run's log). ``genes`` has a tier.

    The files are parsed once: records are written to the shared folder, counted as they pass, and sites are grouped from
    them. Records off the given contigs don't become calls. A record that repeats its (chrom, pos, individual) is an error
    (reject), or only the first in the files' order stays (keep_first). A site's base is the first letter of its first
    record's reference, by individual and line; where others differ there is a warning. A file without its sample's column,
    and files without any usable record, are errors.
    """
    records = readers.read_vcf_records(spark, paths, samples)
    if contigs is not None:
        known = contigs.select("chrom").distinct().withColumn("known_contig", F.lit(True))
        # A list of contigs; a shuffle by contig would have few tasks.
        records = records.join(F.broadcast(known), "chrom", "left").withColumn("problem", F.when(F.col("known_contig").isNull(), "off_contig").otherwise(F.col("problem"))).drop("known_contig")
    is_ = lambda *problems: F.count_if(F.col("problem").isin(*problems))
    records, seen = observed(records, n_records_read=F.count("*"), n_dropped_off_contig=is_("off_contig"), n_dropped_no_format=is_("no_ad_dp", "short"), n_dropped_no_position=is_("no_position"), n_without_sample=is_("no_sample"), n_usable=F.count_if(F.col("problem").isNull()))
    calls = stored(records.where("problem IS NULL").drop("problem"))
    counts = dict(seen.get)
    if counts.pop("n_without_sample"):
        raise ValueError("a file has several sample columns, none of which is its individual's")
    if not counts["n_usable"]:
        raise ValueError(f"no usable record: {counts}")
    # Positions are dealt by rows for each of the steps below.
    at, n_usable = ["chrom", "pos"], counts["n_usable"]
    calls = dealt(calls, n_usable, *at)
    key = ["chrom", "pos", "individualID"]
    if repeated == "reject":
        n = calls.groupBy(*key).count().where("count > 1").count()
        if n:
            raise ValueError(f"{n} positions of an individual have several records")
    else:
        order = Window.partitionBy(*key).orderBy("line")
        calls = calls.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")
    base = F.substring("ref", 1, 1)
    sites = stored(calls.groupBy("chrom", "pos").agg(F.min_by(base, F.struct("individualID", "line")).alias("ref_base"), (F.count_distinct(base) > 1).alias("conflict")))
    counts["n_base_conflicts"] = sites.where("conflict").count()
    if counts["n_base_conflicts"]:
        warnings.warn(f"{counts['n_base_conflicts']} sites have several reference bases; the first one is taken", stacklevel=2)
    resolved = joins.resolve_sites(sites.select("chrom", "pos", "ref_base"), genes)
    typed = calls.drop("line").join(dealt(resolved, n_usable, *at).select("chrom", "pos", "ref_id", "strand"), ["chrom", "pos"]).withColumn("a1type", scalars.classify_calltype(F.col("ref"), F.col("alt1"), F.col("strand")))
    return typed, resolved.join(sites.select("chrom", "pos", "conflict"), ["chrom", "pos"]), counts


def kept_contigs(spark: SparkSession, meta_path: str) -> DataFrame | None:
    """The contigs that annotation has kept, from the run's log; None (and a warning) where it chose none."""
    found = sinks.run_meta(spark, meta_path).where("key = 'annotate.contigs_kept'").first() if sinks.exists(spark, meta_path) else None
    if found is None or not found["value"]:
        warnings.warn("annotation chose no contigs, so calls aren't restricted either", stacklevel=2)
        return None
    return spark.createDataFrame([(c,) for c in found["value"].split(",")], "chrom string")


def load_expression(spark: SparkSession, paths: str | list[str], samples: DataFrame, transcripts: DataFrame) -> DataFrame:
    """individualID, tid, fpkm, tpm: shares over all quantified rows, then known transcripts only, the first of each."""
    rows, seen = observed(readers.read_ctab(spark, paths, samples).withColumn("tid", scalars.version_stem(scalars.strip_id_prefix(F.col("tid")))), n=F.count("*"))
    # Written once, as totals and shares start from them, and counted as they pass.
    rows = stored(rows)
    known = dealt(aggregates.tpm(rows), seen.get["n"], "tid").join(transcripts.select("tid").distinct(), "tid", "left_semi")
    return known.groupBy("individualID", "tid").agg(F.min_by(F.struct("fpkm", "tpm"), "line").alias("v")).select("individualID", "tid", "v.*")


def build_all(
    spark: SparkSession, out: str, *, gtf: str, samples_csv: str, id_col: str, condition_col: str, vcfs: str | list[str], vcf_names: DataFrame, ctabs: str | list[str], ctab_names: DataFrame, overwrite: bool = False,
    report: DataFrame | None = None, attributes: DataFrame | None = None, lengths: DataFrame | None = None, min_match: float = 0.5, provenance: str = "armlens_rna_unique",
) -> dict[str, str]:
    """Annotation, cohort, calls and expression, written as tables below ``out``; returns their paths.

    Each step notes what it read, dropped and wrote in the run's log (``run_meta``), and calls are restricted to the contigs
    that the log says annotation has kept.

    ``report``: an assembly report, which chooses contigs. ``attributes`` (ref_id, biotype, line): genes get their
    biotype, by which sites of several genes are resolved; without it all biotypes are unknown. ``lengths`` (tid, length):
    transcripts whose exons don't add up to it are counted in the run's log.
    """
    paths = {name: f"{out}/{name}" for name in ("transcript", "exon", "gene", "individual", "call", "site", "expression")}
    log = f"{out}/run_meta"
    a = annotate(spark, gtf, report)
    if attributes is None:
        a.gene = a.gene.withColumn("biotype", F.lit(None).cast("string"))
    else:
        stems = attributes.withColumn("ref_id", scalars.version_stem(scalars.strip_id_prefix(F.col("ref_id"))))
        a.gene = joins.apply_attributes(a.gene, stems, "ref_id", ["biotype"], min_match=min_match)
    outcome = lambda o: F.count_if(F.col("outcome") == o)
    transcript, n_transcript = observed(a.transcript, n_transcripts=F.count("*"), n_transcripts_matched=outcome("matched"), n_transcripts_inherited=outcome("inherited"), n_transcripts_novel_locus=outcome("novel"), n_transcripts_ambiguous=outcome("chimeric"))
    exon, n_exon = observed(a.exon, n_exons=F.count("*"))
    gene, n_gene = observed(a.gene, n_genes=F.count("*"), n_genes_novel=F.coalesce(F.sum("novel"), F.lit(0)))
    for name, df in (("transcript", transcript), ("exon", exon), ("gene", gene)):
        sinks.save_table(df.drop("line"), paths[name], overwrite=overwrite)
    counts = a.counts | n_transcript.get | n_exon.get | n_gene.get
    if lengths is not None:
        counts |= {"fasta_checked": lengths.join(spark.read.parquet(paths["transcript"]).select("tid"), "tid", "left_semi").count(), "fasta_mismatches": joins.check_lengths(spark.read.parquet(paths["exon"]), lengths).count()}
    sinks.set_run_meta(spark, log, {f"annotate.{k}": str(v) for k, v in counts.items() if v is not None} | {"id_column": id_col, "condition_column": condition_col}, "annotate")
    samples = readers.load_samples(spark, samples_csv)
    readers.validate_samples(samples, id_col, condition_col)
    sinks.save_table(samples, paths["individual"], overwrite=overwrite)
    genes = spark.read.parquet(paths["gene"]).withColumn("tier", scalars.biotype_tier(F.col("biotype")))
    contigs = kept_contigs(spark, log)
    calls, sites, counts = load_calls(spark, vcfs, vcf_names, genes, contigs)
    calls, n_calls = observed(calls, n_calls=F.count("*"))
    sites, n_sites = observed(sites, n_sites=F.count("*"), n_sites_in_gene=F.count("ref_id"))
    sinks.save_table(calls, paths["call"], overwrite=overwrite, partition_by="chrom")
    sinks.save_table(sites, paths["site"], overwrite=overwrite, partition_by="chrom")
    counts |= n_calls.get | n_sites.get | {"n_samples": vcf_names.count(), "min_depth": scalars.MIN_DEPTH, "contigs_restricted": int(contigs is not None)}
    # What was masked in the first individual's file goes along.
    first = vcf_names.orderBy("individualID").first()["file"]
    masked = {r["key"]: r["text"] for r in readers.read_vcf_provenance(spark, vcfs, provenance).where(F.col("file").endswith(f"/{first}")).collect()}
    sinks.set_run_meta(spark, log, {f"load_calls.{k}": str(v) for k, v in (counts | masked).items()}, "load_calls")
    sinks.save_table(load_expression(spark, ctabs, ctab_names, spark.read.parquet(paths["transcript"])), paths["expression"], overwrite=overwrite)
    return paths
