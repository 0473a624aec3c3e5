"""Files of RNA calls that a cohort's genomes don't explain: one file for each individual, with its header and provenance.

A record goes if its position is among the individual's genomic calls, or in the panel of normals; at a known germline
position it stays and is tagged. The lines that stay are those of the RNA file, in its order.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import joins
from ..operators.stored import observed, stored
from ..sources import readers, sinks

SUFFIX = "_rna_unique.vcf"
TAG = "germline"
SUMMARY = ["individualID", "group", "status", "rna_unique_vcf", "rna_records", "wgs_positions", "removed_by_wgs", "pon_vcf", "pon_positions", "removed_by_pon", "germline_vcf", "germline_positions", "germline_flagged", "written", "error"]
_COUNTS = ["rna_records", "wgs_positions", "removed_by_wgs", "removed_by_pon", "germline_flagged", "written"]


@dataclass
class Resource:
    """Positions that all individuals share, written once; ``n`` of them."""

    path: str
    positions: DataFrame | None
    n: int


def resource(spark: SparkSession, path: str | None) -> Resource:
    """A panel's or catalogue's distinct positions; without a path there are none."""
    if not path:
        return Resource("", None, 0)
    positions, seen = observed(readers.read_vcf_positions(spark, path), n=F.count("*"))
    positions = stored(positions)
    return Resource(path, positions, seen.get["n"])


def provenance(wgs: str, panel: Resource, known: Resource, prefix: str = "armlens_rna_unique") -> list[str]:
    """Header lines that say what was taken away: a panel's positions leave no trace in the file otherwise."""
    said = lambda r, what: f"{r.path} ({r.n:,} positions, {what})" if r.path else "none"
    return [f"##{prefix}_wgs={wgs}", f"##{prefix}_pon={said(panel, 'removed')}", f"##{prefix}_germline={said(known, 'flagged')}"]


def warn_of_contigs(spark: SparkSession, rna: str, resources: dict[str, Resource]) -> list[str]:
    """The names of resources that share no contig with the RNA file's header: they would remove nothing."""
    contigs = readers.read_vcf_contigs(spark, rna)
    if contigs.isEmpty():
        return []
    apart = [name for name, r in resources.items() if r.n and joins.contig_mismatch(r.positions, contigs)]
    for name in apart:
        warnings.warn(f"the {name} shares no contig name with the RNA calls, so it removes and flags nothing", stacklevel=2)
    return apart


def compared(spark: SparkSession, files: DataFrame, panel: Resource, known: Resource) -> DataFrame:
    """individualID, line, value, origin (wgs, panel, kept; null in header lines), germline, of all RNA files' lines.

    ``files``: individualID, rna, wgs (paths). Lines without a number as position are no records and go."""
    paths = {k: [r[k] for r in files.select(k).collect()] for k in ("rna", "wgs")}
    names = lambda k: files.select("individualID", F.element_at(F.split(k, "/"), -1).alias("name"))
    lines = readers.named_lines(spark, paths["rna"]).join(names("rna"), "name").select("individualID", "line", "value")
    part = F.split("value", "\t")
    header = F.startswith("value", F.lit("#"))
    lines = lines.withColumns({"chrom": F.when(~header, F.get(part, F.lit(0))), "pos": F.when(~header, F.get(part, F.lit(1)).try_cast("long"))}).where(header | F.col("pos").isNotNull())
    own = readers.named_lines(spark, paths["wgs"]).join(names("wgs"), "name").where(~header).select("individualID", F.get(part, F.lit(0)).alias("chrom"), F.get(part, F.lit(1)).try_cast("long").alias("pos")).where("pos IS NOT NULL").distinct()
    own = stored(own)
    nowhere = own.select("chrom", "pos").where(F.lit(False))
    # Header lines have no position, so they are left out of the joins.
    body = joins.subtract_calls(lines.where("pos IS NOT NULL"), own, panel.positions if panel.n else nowhere, known.positions if known.n else nowhere)
    tagged = F.concat_ws("\t", F.slice(part, 1, 6), scalars.tag_filter(F.get(part, F.lit(6)), TAG), F.slice(part, F.lit(8), F.greatest(F.size(part) - 7, F.lit(0))))
    flagged = (F.col("germline") == 1) & (F.size(part) >= 7)
    body = body.withColumn("value", F.when(flagged, tagged).otherwise(F.col("value"))).withColumn("origin", F.regexp_replace("origin", "^other$", "wgs"))
    head = lines.where("pos IS NULL").withColumns({"origin": F.lit(None).cast("string"), "germline": F.lit(None).cast("int")})
    shown = ["individualID", "line", "value", "origin", "germline"]
    sizes = own.groupBy("individualID").agg(F.count("*").alias("wgs_positions"))
    return body.select(*shown).union(head.select(*shown)).join(sizes, "individualID", "left").withColumn("wgs_positions", F.coalesce("wgs_positions", F.lit(0)))


def rna_unique(
    spark: SparkSession, out: str, individuals: DataFrame, *, rna: str, wgs: str, rna_suffix: str, wgs_suffix: str, pon: str | None = None, germline: str | None = None, overwrite: bool = False, prefix: str = "armlens_rna_unique",
) -> DataFrame:
    """Write ``<out>/<group>/<individualID>/<individualID>_rna_unique.vcf`` for each of ``individuals`` (individualID, group)
    and a summary table, which is returned (columns SUMMARY).

    ``rna`` and ``wgs`` are folders, below which the individuals' files end in the suffixes. An individual whose file is
    there already is skipped unless ``overwrite``; one that lacks an RNA or WGS file (or has several) gets status FAILED and
    the others go on. Files appear whole: they are written aside and renamed. Raises at the end if any failed."""
    for name, path in (("panel of normals", pon), ("germline resource", germline)):
        if not path:
            warnings.warn(f"no {name} is given: positions that it took from the genomic calls count as RNA-specific", stacklevel=2)
    people = individuals.select(F.col("individualID").cast("string").alias("individualID"), F.col("group").cast("string").alias("group"))
    found = people
    for kind, folder, suffix in (("rna", rna, rna_suffix), ("wgs", wgs, wgs_suffix)):
        files = readers.files_below(spark, folder, suffix).groupBy("individualID").agg(F.count("*").alias(f"n_{kind}"), F.min("path").alias(kind))
        found = found.join(files, "individualID", "left")
    target = F.concat_ws("/", F.lit(out.rstrip("/")), "group", "individualID", F.concat("individualID", F.lit(SUFFIX)))
    # A row for each individual: a cohort.
    rows = {r["individualID"]: r.asDict() for r in found.withColumn("target", target).collect()}
    panel, known = resource(spark, pon), resource(spark, germline)
    base = {"pon_vcf": panel.path, "pon_positions": panel.n, "germline_vcf": known.path, "germline_positions": known.n, "rna_unique_vcf": "", "error": ""} | dict.fromkeys(_COUNTS, 0)
    summary, todo = {}, []
    for person, r in sorted(rows.items()):
        one = base | {"individualID": person, "group": r["group"]}
        wrong = [f"{kind.upper()} file: {r[f'n_{kind}'] or 0} found" for kind in ("rna", "wgs") if (r[f"n_{kind}"] or 0) != 1]
        if sinks.file_exists(spark, r["target"]) and not overwrite:
            summary[person] = one | {"status": "skipped", "rna_unique_vcf": r["target"]}
        elif wrong:
            summary[person] = one | {"status": "FAILED", "error": "; ".join(wrong)}
        else:
            summary[person] = one | {"status": "done", "rna_unique_vcf": r["target"]}
            todo.append((person, r["rna"], r["wgs"], r["target"]))
    if todo:
        if panel.n or known.n:
            warn_of_contigs(spark, todo[0][1], {"panel of normals": panel, "germline resource": known})
        files = spark.createDataFrame([t[:3] for t in todo], "individualID string, rna string, wgs string")
        lines = stored(compared(spark, files, panel, known))
        is_ = lambda o: F.count_if(F.col("origin") == o)
        counts = lines.groupBy("individualID").agg(F.count("origin").alias("rna_records"), F.max("wgs_positions").cast("long").alias("wgs_positions"), is_("wgs").alias("removed_by_wgs"), is_("panel").alias("removed_by_pon"), F.count_if(F.col("germline") == 1).alias("germline_flagged"), is_("kept").alias("written"))
        for r in counts.collect():
            summary[r["individualID"]] |= {k: r[k] for k in _COUNTS}
        # Provenance stands before the last header line, which names the columns; a declared tag with it.
        declared = [f'##FILTER=<ID={TAG},Description="Position is in the germline resource">'] if known.n else []
        said = spark.createDataFrame([(p, [*provenance(w, panel, known, prefix), *declared]) for p, _, w, _ in todo], "individualID string, said array<string>")
        columns = F.startswith("value", F.lit("#CHROM"))
        at = lambda k: F.struct("line", k.alias("k"))
        own = lines.where("origin IS NULL OR origin = 'kept'").select("individualID", at(F.when(columns, F.lit(1000)).otherwise(F.lit(0))).alias("at"), "value")
        first = lines.where(F.col("origin").isNull() & columns).groupBy("individualID").agg(F.min("line").alias("line")).join(said, "individualID")
        more = first.select("individualID", "line", F.posexplode("said").alias("k", "value")).select("individualID", at(F.col("k")).alias("at"), "value")
        sinks.write_files(own.union(more), {p: t for p, _, _, t in todo}, "individualID", "at", overwrite=overwrite)
    table = spark.createDataFrame([tuple(summary[p][c] for c in SUMMARY) for p in sorted(summary)], "individualID string, group string, status string, rna_unique_vcf string, rna_records long, wgs_positions long, removed_by_wgs long, pon_vcf string, pon_positions long, removed_by_pon long, germline_vcf string, germline_positions long, germline_flagged long, written long, error string")
    sinks.write_csv(table, f"{out.rstrip('/')}/rna_unique_summary")
    failed = [p for p in sorted(summary) if summary[p]["status"] == "FAILED"]
    if failed:
        raise ValueError(f"{len(failed)} of {len(summary)} individuals failed: " + "; ".join(f"{p}: {summary[p]['error']}" for p in failed[:5]))
    return table
