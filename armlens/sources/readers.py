"""Readers of annotation, call, expression and quality files. All parse with column expressions over text lines.

Files are read by Spark's own readers only, so any store that Spark can open will do; compressed text is fine. Where an
order of lines matters it is (file, block, number within the scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Columns, markers and words of the file formats.
GTF_COLUMNS = ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attrs"]
VCF_FIXED = 9
BLANKS = ["", "nan", "NaN", "None", "NA", "na", "<NA>"]
ASSEMBLY_NAMES = ["sequence_name", "genbank_accn", "refseq_accn", "ucsc_style_name"]
DROPPED_MOLECULES = ["MT", "Y"]


#: The name of a part of a folder that Spark has written.
PART = r"/part-([0-9]{5,})-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}[^/]*$"


def _file() -> tuple[Column, Column]:
    """The path of a row's file, and its part: a folder of parts, as ``sinks.write_files`` writes long files, is one file."""
    path = F.col("_metadata.file_path")
    maybe = path.contains("/part-")
    return F.when(maybe, F.regexp_replace(path, PART, "")).otherwise(path), F.coalesce(F.when(maybe, F.regexp_extract(path, PART, 1).try_cast("int")), F.lit(0))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file and line, which orders the lines of a file."""
    text = spark.read.text(path)
    file, part = _file()
    return text.select("value", file.alias("file"), F.struct(part.alias("p"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n")).alias("line"))


def named_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name (the file's, without its folder), file, value and line, which orders the lines of a file."""
    return _lines(spark, path).withColumn("name", F.element_at(F.split("file", "/"), -1))


def bundle_line(name: Column, line: Column) -> Column:
    """A line of a small file as bundles hold it: its file's name, a tab and the line; null where the line is."""
    return F.concat(name, F.lit("\t"), line)


def bundled_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``named_lines``, of bundles: text files that hold many small files, each line led by its file's name and a tab.
    The lines of a small file stand in one bundle, in order. A cohort's logs so need no file for each individual, which a
    store has to list, open and plan for one by one."""
    cut = F.instr("value", "\t")
    rows = _lines(spark, path).where(cut > 0)
    return rows.select(F.expr("substring(value, instr(value, '\t') + 1)").alias("value"), "file", "line", F.expr("substring(value, 1, instr(value, '\t') - 1)").alias("name"))


def attribute(attrs: Column, key: str) -> Column:
    """A quoted attribute of a GTF line; empty is null."""
    found = F.regexp_extract(attrs, rf'(?:^|[;\s]){key}\s+"([^"]*)"', 1)
    return F.when(found != "", found)


def read_gtf(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Transcript and exon lines with gene_id, tid, ref_gene_id, gene_name; lines without a transcript have null tid."""
    part = F.split("value", "\t")
    rows = _lines(spark, path).where(~F.col("value").startswith("#")).select("file", "line", *[F.get(part, n).alias(c) for n, c in enumerate(GTF_COLUMNS)])
    named = {"gene_id": "locus_id", "transcript_id": "tid", "ref_gene_id": "ref_gene_id", "gene_name": "gene_name"} | {x: x for x in extra}
    rows = rows.where(F.col("feature").isin("transcript", "exon"))
    return rows.select("file", "line", "chrom", "feature", F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end"), "strand", *[attribute(F.col("attrs"), k).alias(v) for k, v in named.items()])


def read_vcf_records(spark: SparkSession, path: str | list[str], samples: DataFrame) -> DataFrame:
    """Call records of each file's sample. ``samples``: file (its name), individualID (the sample column's name).

    A file with one sample column only is used whatever the column's name. Lines that end before the sample's column aren't
    records. ``problem`` says why a record has no call: no_sample, no_position, no_ad_dp, short (fewer values than the
    format names, or no numbers) or null (none). Columns: individualID, chrom, pos, ref, alt1, a1_ad, dp, filter, line (which orders the
    records), problem.
    """
    lines = _lines(spark, path).withColumn("name", F.element_at(F.split("file", "/"), -1))
    head = lines.where(F.col("value").startswith("#CHROM")).select("file", "name", F.split("value", "\t").alias("h")).join(F.broadcast(samples.withColumnRenamed("file", "name")), "name")
    n = F.size("h") - VCF_FIXED
    at = F.when(n == 1, F.lit(VCF_FIXED + 1)).otherwise(F.array_position("h", F.col("individualID").cast("string")))
    head = head.select("file", "individualID", F.when(at > VCF_FIXED, at).cast("int").alias("at"))
    part = F.split("value", "\t")
    # One row per file: the header table is as long as the list of files.
    body = lines.where(~F.col("value").startswith("#")).select("file", F.struct("file", "line").alias("line"), part.alias("p")).join(F.broadcast(head), "file")
    body = body.where(F.col("at").isNull() | (F.size("p") >= F.col("at")))
    keys, values = F.split(F.get("p", F.lit(8)), ":"), F.split(F.get("p", F.col("at") - 1), ":")
    of = lambda key: F.get(values, F.array_position(keys, key).cast("int") - 1)
    has = F.array_contains(keys, "AD") & F.array_contains(keys, "DP")
    ad, dp = F.get(F.split(of("AD"), ","), F.lit(1)).try_cast("long"), of("DP").try_cast("long")
    filters = F.get("p", F.lit(6))
    return body.select(
        "individualID", F.get("p", F.lit(0)).alias("chrom"), F.get("p", F.lit(1)).try_cast("long").alias("pos"), F.upper(F.get("p", F.lit(3))).alias("ref"),
        F.upper(F.get(F.split(F.get("p", F.lit(4)), ","), F.lit(0))).alias("alt1"), F.when(has, ad).alias("a1_ad"), F.when(has, dp).alias("dp"),
        F.when(filters.isNull() | (filters == ""), ".").otherwise(filters).alias("filter"), "line",
        F.when(F.col("at").isNull(), "no_sample").when(F.get("p", F.lit(1)).try_cast("long").isNull(), "no_position").when(~F.coalesce(has, F.lit(False)), "no_ad_dp").when(ad.isNull() | dp.isNull() | (F.size(values) < F.size(keys)), "short").alias("problem"),
    )


def read_vcf_calls(spark: SparkSession, path: str | list[str], samples: DataFrame, contigs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(calls, counts of dropped records by reason)."""
    records = read_vcf_records(spark, path, samples)
    if contigs is not None:
        known = contigs.select("chrom").distinct().withColumn("_k", F.lit(True))
        # A list of contigs; a shuffle by contig would have few tasks.
        records = records.join(F.broadcast(known), "chrom", "left").withColumn("problem", F.when(F.col("_k").isNull(), "off_contig").otherwise(F.col("problem"))).drop("_k")
    return records.where("problem IS NULL").drop("problem"), records.where("problem IS NOT NULL").groupBy("problem").agg(F.count("*").alias("n"))


def read_vcf_provenance(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """file, key, value of the header lines ##<prefix>_key=value."""
    pattern = rf"^##{prefix}_([^=]+)=(.*)$"
    return _lines(spark, path).where(F.col("value").rlike(pattern)).select("file", F.regexp_extract("value", pattern, 1).alias("key"), F.regexp_extract("value", pattern, 2).alias("text"))


def read_vcf_positions(spark: SparkSession, path: str) -> DataFrame:
    part = F.split("value", "\t")
    return _lines(spark, path).where(~F.col("value").startswith("#")).select(F.get(part, F.lit(0)).alias("chrom"), F.get(part, F.lit(1)).try_cast("long").alias("pos")).where("pos IS NOT NULL").distinct()


def read_vcf_contigs(spark: SparkSession, path: str) -> DataFrame:
    pattern = r"^##contig=<.*?ID=([^,>]+)"
    return _lines(spark, path).where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("chrom")).distinct()


def load_samples(spark: SparkSession, path: str) -> DataFrame:
    """The metadata table as it is: all strings, header names trimmed."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    return raw.toDF(*[c.strip() for c in raw.columns])


def validate_samples(samples: DataFrame, id_col: str, condition_col: str) -> None:
    """Raise unless ids are unique and filled, and there are exactly two filled conditions."""
    if len(set(samples.columns)) < len(samples.columns):
        raise ValueError("two columns have the same name")
    if id_col == condition_col or not {id_col, condition_col} <= set(samples.columns):
        raise ValueError("the id and condition columns must be there, and differ")
    blank = lambda c: F.col(c).isNull() | F.trim(c).isin(BLANKS)
    s = samples.agg(F.count_if(blank(id_col)).alias("ids"), F.count_if(blank(condition_col)).alias("conditions"), F.count("*").alias("n"), F.count_distinct(id_col).alias("u"), F.count_distinct(condition_col).alias("labels")).first()
    if s["ids"] or s["conditions"]:
        raise ValueError(f"{s['ids']} ids and {s['conditions']} conditions are blank")
    if s["u"] < s["n"]:
        raise ValueError("ids are not unique")
    if s["labels"] != 2:
        raise ValueError(f"{s['labels']} conditions; there must be two")


def as_conditions(samples: DataFrame, id_col: str, condition_col: str, case: str) -> DataFrame:
    """individualID, condition (``case`` for the given label, ``ref`` for the other one) of a validated metadata table."""
    validate_samples(samples, id_col, condition_col)
    if samples.where(F.col(condition_col) == case).isEmpty():
        raise ValueError(f"no individual has the condition {case!r}")
    return samples.select(F.col(id_col).alias("individualID"), F.when(F.col(condition_col) == case, "case").otherwise("ref").alias("condition"))


def read_ctab(spark: SparkSession, path: str | list[str], samples: DataFrame) -> DataFrame:
    """individualID, tid, fpkm, line from tables with t_name and FPKM. ``samples``: file (its name), individualID."""
    raw = spark.read.csv(path, header=True, sep="\t", inferSchema=False)
    line = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
    rows = raw.select(line.alias("line"), F.element_at(F.split(_file()[0], "/"), -1).alias("file"), F.col("t_name").alias("tid"), F.col("FPKM").try_cast("double").alias("fpkm"))
    return rows.where("fpkm IS NOT NULL").join(F.broadcast(samples), "file").drop("file")


def read_attrs(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A tab-separated table whose header may start with #. ``columns``: new name -> name there; a missing one is null."""
    raw = spark.read.csv(path, header=True, sep="\t", inferSchema=False)
    raw = raw.toDF(*[c.lstrip("#").strip() for c in raw.columns])
    return raw.select(*[(F.col(v) if v in raw.columns else F.lit(None).cast("string")).alias(k) for k, v in columns.items()], F.monotonically_increasing_id().alias("line"))


def read_assembly_report(spark: SparkSession, path: str) -> DataFrame:
    """chrom (each of a sequence's names), role, molecule. The last line with # is the header."""
    lines = _lines(spark, path)
    header = lines.where(F.col("value").startswith("#")).agg(F.max_by("value", "line").alias("h")).first()["h"]
    names = [n.strip().lower().replace("-", "_").replace(" ", "_") for n in (header or "#").lstrip("#").split("\t")]
    part = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(*[F.trim(F.get(part, F.lit(i))).alias(n) for i, n in enumerate(names)])
    each = F.explode(F.array(*[F.col(n) for n in ASSEMBLY_NAMES if n in names]))
    return rows.select(each.alias("chrom"), F.col("sequence_role").alias("role"), F.col("assigned_molecule").alias("molecule")).where("chrom IS NOT NULL AND chrom <> 'na' AND chrom <> ''").distinct()


def select_contigs(contigs: DataFrame, report: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """chrom, kept, reason: assembled molecules stay unless they are in the drop list."""
    gone = [m.upper() for m in (DROPPED_MOLECULES if drop is None else drop)]
    j = contigs.select("chrom").distinct().join(report, "chrom", "left")
    reason = F.when(F.col("role").isNull(), "not in report").when(F.col("role") != "assembled-molecule", F.col("role")).when(F.upper("molecule").isin(gone), "dropped molecule")
    return j.select("chrom", reason.isNull().alias("kept"), reason.alias("reason"))


def read_fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    """tid, length: a record per '>'; the name ends at the first '|' or blank."""
    records = spark.read.text(path, lineSep=">").where(F.trim("value") != "")
    name = F.regexp_extract("value", r"^\s*([^|\s]+)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(name.alias("tid"), F.length(body).cast("long").alias("length"))


def read_biotype_table(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    rows = read_attrs(spark, path, columns or {"ref_id": "geneId", "transcript_type": "transcriptType", "gene_name": "transcriptName"}).drop("line")
    trimmed = rows.select(*[F.trim(c).alias(c) for c in rows.columns])
    return trimmed.where("ref_id <> '' AND transcript_type <> ''")


def read_covariates(spark: SparkSession, path: str, key: str, columns: list[str]) -> DataFrame:
    """The first row of each key; the delimiter is the commonest of tab, semicolon and comma in the first line."""
    first = spark.read.text(path).first()
    line = first["value"] if first else ""
    sep = max("\t;,", key=line.count)
    raw = spark.read.csv(path, header=True, sep=sep, inferSchema=False).withColumn("_n", F.monotonically_increasing_id())
    return raw.groupBy(key).agg(*[F.min_by(c, "_n").alias(c) for c in columns])


def load_catalogue(spark: SparkSession, path: str, chrom: str, pos: str, columns: list[str] | None = None) -> DataFrame:
    """Catalogue rows with chrom and pos as a number; rows without a number go. Without columns: distinct positions."""
    raw = spark.read.csv(path, header=True, sep="\t", inferSchema=False)
    rows = raw.select(F.col(chrom).alias("chrom"), F.col(pos).try_cast("long").alias("pos"), *(columns or [])).where("pos IS NOT NULL")
    return rows if columns else rows.distinct()


def files_below(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """individualID, path, file of files named <individualID><suffix> anywhere below the folder. The content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file")).select(F.substring("file", F.lit(1), F.length("file") - len(suffix)).alias("individualID"), "path", "file")


def cohort_files(spark: SparkSession, folder: str, individuals: DataFrame, suffix: str) -> DataFrame:
    """individualID, n_files, file: files named <individualID><suffix> anywhere below the folder. The content isn't read.

    Raises where an individual has none or several.
    """
    named = files_below(spark, folder, suffix)
    found = individuals.select(F.col("individualID").cast("string")).join(named, "individualID", "left").groupBy("individualID").agg(F.count("path").alias("n_files"), F.min("path").alias("path"), F.min("file").alias("file"))
    wrong = found.where("n_files <> 1").limit(5).collect()
    if wrong:
        raise ValueError("files for " + ", ".join(f"{r['individualID']}: {r['n_files']}" for r in wrong))
    return found


def key_value_logs(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """file, key, value of lines 'key <sep> value'."""
    part = F.split("value", sep, 2)
    return _lines(spark, path).select(F.element_at(F.split("file", "/"), -1).alias("file"), F.trim(F.get(part, F.lit(0))).alias("key"), F.trim(F.get(part, F.lit(1))).alias("value")).where("value IS NOT NULL AND key <> ''")


def qc_rollup(metrics: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each expected file with one column per metric; a file without metrics has status MISSING."""
    wide = metrics.groupBy("file").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys], F.lit(True).alias("_s"))
    return files.join(wide, "file", "left").withColumn("status", F.when(F.col("_s"), "OK").otherwise("MISSING")).drop("_s")


def index_totals(lines: DataFrame) -> DataFrame:
    """name, mapped, unmapped: sums of the third and fourth field of index statistics (contig, length, mapped, unmapped) of
    each file; lines with fewer fields don't count. ``lines``: name, value."""
    part = F.split("value", "\t")
    field = lambda n: F.coalesce(F.sum(F.when(F.size(part) >= 4, F.get(part, F.lit(n)).try_cast("long"))), F.lit(0))
    return lines.groupBy("name").agg(field(2).alias("mapped"), field(3).alias("unmapped"))


def first_values(lines: DataFrame, column: str) -> DataFrame:
    """name, <column>: the column's value in the first data line of each small table with a header (as contamination
    tables are); null where the file has no such column or no data line. ``lines``: name, value, line."""
    two = lines.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("l"))
    head, data = F.split(F.get("l", F.lit(0))["value"], "\t"), F.split(F.get("l", F.lit(1))["value"], "\t")
    at = F.array_position(head, column)
    return two.select("name", F.when(at > 0, F.get(data, (at - 1).cast("int"))).alias(column))


def transcript_counts(lines: DataFrame) -> DataFrame:
    """name, transcripts: transcript lines of each assembled annotation. ``lines``: name, value."""
    is_one = ~F.startswith("value", F.lit("#")) & (F.get(F.split("value", "\t"), F.lit(2)) == "transcript")
    return lines.groupBy("name").agg(F.count_if(is_one).alias("transcripts"))


def module_values(lines: DataFrame, module: str = "Basic Statistics") -> DataFrame:
    """name, key, value of the tab-separated lines of one module (from >>module to >>END_MODULE) of each report.
    ``lines``: name, value, line. A report's lines are one file's, ordered by a window over it."""
    before = Window.partitionBy("name").orderBy("line")
    mark = F.when(F.startswith("value", F.lit(">>")), F.col("value"))
    at = lines.withColumn("module", F.last(mark, ignorenulls=True).over(before))
    part = F.split("value", "\t", 2)
    inside = at.where(F.startswith("module", F.lit(f">>{module}")) & ~F.startswith("value", F.lit(">>")) & F.col("value").contains("\t"))
    return inside.select("name", F.get(part, F.lit(0)).alias("key"), F.get(part, F.lit(1)).alias("value"))


def qc_by_individual(files: DataFrame, *metrics: DataFrame) -> DataFrame:
    """individualID, group, name, status and the columns of each of ``metrics`` (name and its values): a row for each
    expected file (individualID, group, name); MISSING where no metric knows the file."""
    out = files.select("individualID", "group", "name")
    seen = F.lit(False)
    for n, m in enumerate(metrics):
        out = out.join(m.withColumn(f"seen_{n}", F.lit(True)), "name", "left")
        seen = seen | F.coalesce(F.col(f"seen_{n}"), F.lit(False))
    out = out.withColumn("status", F.when(seen, "OK").otherwise("MISSING")).drop(*[f"seen_{n}" for n in range(len(metrics))])
    return out.select("individualID", "group", "name", "status", *[c for m in metrics for c in m.columns if c != "name"])


def read_length_rollup(stats: DataFrame, kinds: DataFrame) -> DataFrame:
    """seq_type, n_files, min_length, max_length, uniform (every file is, and all have one length) of read-length
    statistics per file; ``kinds``: file, seq_type."""
    g = stats.join(kinds, "file").groupBy("seq_type").agg(F.count("*").alias("n_files"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), F.min("uniform").alias("each"))
    return g.select("seq_type", "n_files", "min_length", "max_length", (F.col("each") & (F.col("min_length") == F.col("max_length"))).alias("uniform"))


def module_counts(statuses: DataFrame) -> DataFrame:
    """file, n_pass, n_warn, n_fail, failed (modules joined by ;) from file, module, status."""
    n = lambda s: F.count_if(F.col("status") == s)
    return statuses.groupBy("file").agg(n("PASS").alias("n_pass"), n("WARN").alias("n_warn"), n("FAIL").alias("n_fail"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("status") == "FAIL", F.col("module")))), ";").alias("failed"))


def read_length_stats(reads: DataFrame, first: int | None = None) -> DataFrame:
    """file, n_reads, min_length, max_length, uniform over reads (file, record_no, seq), or over the first of each file."""
    rows = reads.where(F.col("record_no") < first) if first else reads
    n = F.length("seq")
    g = rows.groupBy("file").agg(F.count("*").alias("n_reads"), F.min(n).alias("min_length"), F.max(n).alias("max_length"))
    return g.withColumn("uniform", F.col("min_length") == F.col("max_length"))


def read_groups(headers: DataFrame) -> DataFrame:
    """file, lane, unit from each file's first read header (file, record_no, header)."""
    first = headers.groupBy("file").agg(F.min_by("header", "record_no").alias("header"))
    pattern = r"^@?[^:\s]+:[^:\s]+:([^:\s]+):([0-9]+):"
    ok = F.col("header").rlike(pattern)
    lane = F.concat_ws(".", F.regexp_extract("header", pattern, 1), F.regexp_extract("header", pattern, 2))
    return first.select("file", F.when(ok, lane).otherwise(F.lit("unknown")).alias("lane"), F.when(ok, lane).otherwise(F.col("file")).alias("unit"))
