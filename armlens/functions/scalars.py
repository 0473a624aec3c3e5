"""Scalar functions over columns. All are expressions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, labels and cut-offs of the calculations.
ID_PREFIX = r"^(?:gene|rna|id)-"
RESIDUAL_PREFIX = r"^(?:gene|rna|id|cds|exon)-"
VERSIONED = r"^([A-Za-z][A-Za-z0-9_]*[0-9])\.([0-9]+)$"
SYMBOL_SUFFIXES = {"dash": r"-[0-9]+$", "dot": r"\.[0-9]+$", "dot or underscore": r"[._][0-9]+$"}
FUNCTIONAL_RNA = ["miRNA", "snoRNA", "snRNA", "scaRNA", "rRNA", "misc_RNA", "ribozyme", "sRNA", "vault_RNA", "Mt_tRNA", "Mt_rRNA"]
EXCLUDED_BIOTYPES = ["Mt", "rRNA", "tRNA", "misc_RNA", "ribozyme"]
EXCLUDED_NAMES = ["MT-"]
CALL_FILTERS = [("qual_filt", "qual < 25"), ("qual_depth_filt", "qd < 10"), ("depth_filt", "dp < 20")]
MIN_DEPTH = 20


def strip_id_prefix(x: Column) -> Column:
    return F.regexp_replace(x, ID_PREFIX, "")


def has_residual_prefix(x: Column) -> Column:
    return x.rlike(RESIDUAL_PREFIX)


def version_stem(x: Column, keep: bool = False) -> Column:
    """The accession without its version; itself where it has none or versions are kept."""
    return x if keep else F.when(x.rlike(VERSIONED), F.regexp_extract(x, VERSIONED, 1)).otherwise(x)


def version_number(x: Column) -> Column:
    return F.when(x.rlike(VERSIONED), F.regexp_extract(x, VERSIONED, 2))


def strip_symbol_suffix(x: Column, form: str = "dash") -> Column:
    """Without the number after a dash (copies of a symbol), or after a dot or underscore (versions)."""
    return F.regexp_replace(x, SYMBOL_SUFFIXES[form], "")


def classify_calltype(ref: Column, alt: Column, strand: Column) -> Column:
    """ins or del by length first, so also without a gene; substitutions on the gene's strand; else null."""
    base = lambda x: F.when(strand == "-", F.translate(x, "ACGT", "TGCA")).otherwise(x)
    single = (F.length(ref) == 1) & strand.isin("+", "-") & ref.isin(*"ACGT") & alt.isin(*"ACGT")
    return F.when(F.length(alt) > F.length(ref), F.lit("ins")).when(F.length(alt) < F.length(ref), F.lit("del")).when(single, F.concat_ws("-", base(ref), base(alt)))


def biotype_tier(biotype: Column, functional: list[str] | None = None) -> Column:
    return F.when(biotype.isNull(), 4).when(biotype == "protein_coding", 0).when(biotype == "lncRNA", 1).when(biotype.isin(functional or FUNCTIONAL_RNA), 2).otherwise(3)


def eligible(min_depth: int = MIN_DEPTH) -> Column:
    return F.col("ref_id").isNotNull() & F.col("a1type").isNotNull() & (F.col("dp") >= min_depth)


def tag_filter(filters: Column, tag: str) -> Column:
    """Append a tag to a FILTER field: it replaces "", "." and "PASS", and isn't repeated."""
    blank = filters.isNull() | filters.isin("", ".", "PASS")
    return F.when(blank, F.lit(tag)).when(F.array_contains(F.split(filters, ";"), tag), filters).otherwise(F.concat_ws(";", filters, F.lit(tag)))


def threshold_filters(rules: list[tuple[str, str]] | None = None) -> Column:
    """Names of all rules that hold (over qual, qd, dp), joined by semicolons; PASS for none."""
    found = F.concat_ws(";", *[F.when(F.expr(rule), F.lit(name)) for name, rule in rules or CALL_FILTERS])
    return F.when(found == "", F.lit("PASS")).otherwise(found)


def assign_group(n_case: Column, n_ref: Column, threshold: float, case: str = "case", ref: str = "ref") -> Column:
    total = n_case + n_ref
    return F.when((total > 0) & (n_case / F.greatest(total, F.lit(1)) >= threshold), F.lit(f"{case}_enriched")).when((total > 0) & (n_ref / F.greatest(total, F.lit(1)) >= threshold), F.lit(f"{ref}_enriched")).otherwise(F.lit("Shared"))


def edit_dist(n_case: Column, n_ref: Column, case: str = "case", ref: str = "ref") -> Column:
    """The condition with more than half of the calls; a gene without calls is the reference's."""
    return F.when(n_case > n_ref, F.lit(f"{case}_enriched")).when((n_ref > n_case) | (n_case + n_ref == 0), F.lit(f"{ref}_enriched")).otherwise(F.lit("Both"))


def classify_local(n_case: Column, n_ref: Column, size_case: Column | int, size_ref: Column | int, fold: float = 1.5) -> Column:
    """Carriers of one condition only: specific if all of its individuals, else low-specific; of both: double by a fold."""
    one = (n_case == 0) | (n_ref == 0)
    whole = ((n_ref == 0) & (n_case == size_case)) | ((n_case == 0) & (n_ref == size_ref))
    more, less = F.greatest(n_case, n_ref), F.least(n_case, n_ref)
    return F.when(one & whole, F.lit("specific")).when(one, F.lit("low-specific")).when(more >= fold * less, F.lit("double")).otherwise(F.lit("differential"))


def majority(n: Column) -> Column:
    return F.ceil(n / 2).cast("long")


def final_retained(retained: Column, n_case: Column, n_ref: Column, p: Column, fold: float = 1.5, alpha: float = 0.05) -> Column:
    more, less = F.greatest(n_case, n_ref), F.least(n_case, n_ref)
    return retained & (((more > 1) & (more >= fold * less)) | F.coalesce(p < alpha, F.lit(False)))


def odds_ratio_ci_sql(a: str, b: str, c: str, d: str, z: float = 1.96) -> dict[str, str]:
    """SQL expressions of the odds ratio and its interval; an empty cell counts a half, four empty ones give null."""
    cell = [f"(CASE WHEN {x} = 0 THEN 0.5e0 ELSE CAST({x} AS DOUBLE) END)" for x in (a, b, c, d)]
    ratio = f"({cell[0]} * {cell[3]} / ({cell[1]} * {cell[2]}))"
    spread = f"({z}e0 * sqrt({' + '.join(f'1e0 / {x}' for x in cell)}))"
    some = f"{a} + {b} + {c} + {d} > 0"
    return {"odds_ratio": f"(CASE WHEN {some} THEN {ratio} END)", "ci_low": f"(CASE WHEN {some} THEN exp(ln({ratio}) - {spread}) END)", "ci_high": f"(CASE WHEN {some} THEN exp(ln({ratio}) + {spread}) END)"}


def format_p(p: Column) -> Column:
    """Three decimals; an exponent where that would print 0.000 though p isn't 0; na for null."""
    return F.when(p.isNull() | F.isnan(p), F.lit("na")).when((p != 0) & (F.abs(p) < 0.0005), F.format_string("%.3e", p)).otherwise(F.format_string("%.3f", p))


def transcript_position(strand: Column, pos: Column, exon_start: Column, exon_end: Column, offset: Column) -> Column:
    return F.when(strand == "-", offset + exon_end - pos + 1).otherwise(offset + pos - exon_start + 1)


def minimum_length(max_length: Column, share: float = 0.7, override: Column | None = None) -> Column:
    """Rounded half to even, at least 1; ``override`` counts where it isn't null."""
    usual = F.greatest(F.lit(1), F.bround(max_length * share).cast("int"))
    return usual if override is None else F.coalesce(override.cast("int"), usual)


def overhang(max_length: Column) -> Column:
    """An aggregate: one less than the longest read."""
    return F.max(max_length) - 1


def parse_censored(x: Column) -> Column:
    """90+ is 90; what isn't a number is null."""
    return F.regexp_replace(F.trim(x), r"\+$", "").try_cast("double")


def is_censored(x: Column) -> Column:
    return F.trim(x).rlike(r"^[0-9.]+\+$")


def squeeze_unit(y: Column, n: Column) -> Column:
    """A share moved off 0 and 1."""
    return (y * (n - 1) + 0.5) / n


def excluded_by_annotation(types: Column, name: Column, parts: list[str] | None = None, prefixes: list[str] | None = None) -> Column:
    """The reasons, joined by +, for which a gene is left out: any of its types contains a part, its name starts with a
    prefix. Null if none."""
    any_has = lambda part: F.exists(types, lambda t: t.contains(part))
    hits = [F.when(any_has(p), F.lit(p)) for p in parts or EXCLUDED_BIOTYPES]
    hits += [F.when(name.startswith(p), F.lit(p)) for p in prefixes or EXCLUDED_NAMES]
    found = F.concat_ws("+", *hits)
    return F.when(found != "", found)


def significance_label(p: Column) -> Column:
    return F.when(p < 0.001, F.lit("***")).when(p < 0.01, F.lit("**")).when(p < 0.05, F.lit("*")).otherwise(F.lit("ns"))


def both_or_one(p_case: Column, p_ref: Column, case: str = "case", ref: str = "ref", alpha: float = 0.05) -> Column:
    a, b = F.coalesce(p_case < alpha, F.lit(False)), F.coalesce(p_ref < alpha, F.lit(False))
    return F.when(a & b, F.lit("Both")).when(a, F.lit(f"{case} only")).when(b, F.lit(f"{ref} only")).otherwise(F.lit("Neither"))


def symbol_resolution(own: Column, mapped: Column, name: Column | None = None, unknown: str = "Unknown") -> Column:
    """matched by the own symbol, by the mapped one, or why not: ``name`` may be the word for genes without a symbol."""
    found = F.when(own.isNotNull(), F.lit("matched")).when(mapped.isNotNull(), F.lit("matched via ENSG"))
    return (found if name is None else found.when(name == unknown, F.lit("no symbol"))).otherwise(F.lit("absent"))

