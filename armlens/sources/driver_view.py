"""The cohort model as views over the given tables: individuals, genes, calls, sites and expression.

``Cohort`` holds the DataFrames; ``VIEWS`` are the same definitions in SQL, for checks in another engine.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates, joins
from ..operators.stored import dealt, stored, written


def fixture_tier(biotype: Column) -> Column:
    """The order of gene kinds in these tables."""
    kind = F.element_at(F.split(biotype, " "), 1)
    return F.when(kind == "STANDARD", 0).when(kind == "ECONOMY", 1).when(kind == "PROMO", 2).otherwise(3)


#: Tables that a cohort is made from.
SOURCES = ("lineitem", "orders", "supplier", "part")
#: Cohorts of this driver's session that queries share, the last ones first.
_SHARED: list[tuple[tuple, Cohort]] = []
KEPT = 2


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, lengths and times of the files of the cohort's tables, and the application that asks."""
    files = []
    for table in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in store.listStatus(path))
    return (spark.sparkContext.applicationId, sf_dir, *files)


@dataclass
class Cohort:
    """Conditions are ``case`` and ``ref`` (``readers.as_conditions`` names a user's labels so)."""

    spark: SparkSession
    sf_dir: str

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Cohort:
        """The session's cohort of these tables: its calls, with and without genes, and eligible calls are written once, by the first query that
        needs them, and read by those after it, as long as the tables' files are the same."""
        key = _fingerprint(spark, sf_dir)
        for known, cohort in _SHARED:
            if known == key:
                return cohort
        cohort = cls(spark, sf_dir)
        _SHARED.insert(0, (key, cohort))
        del _SHARED[KEPT:]
        return cohort

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def individual(self) -> DataFrame:
        s = self.table("supplier").select(F.col("s_nationkey").alias("individualID")).distinct()
        return s.withColumn("condition", F.when(F.col("individualID") % 2 == 0, "case").otherwise("ref"))

    @cached_property
    def sizes(self) -> dict[str, int]:
        """Individuals of each condition: two rows."""
        return {r["condition"]: r["n"] for r in self.individual.groupBy("condition").agg(F.count("*").alias("n")).collect()}

    @cached_property
    def gene(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size").cast("long")
        return self.table("part").select(
            key.alias("ref_id"), F.col("p_name").alias("gene_name"), F.col("p_type").alias("biotype"), (F.col("p_size") % 7 == 0).cast("int").alias("novel"),
            (key % 5 + 1).cast("int").alias("chrom"), F.when(key % 2 == 0, "+").otherwise("-").alias("strand"),
            (key * 7).alias("gene_start"), (key * 7 + size * 12).alias("gene_end"), (size * 12 + 1).alias("gene_span"), size.alias("n_transcripts"),
        )

    @cached_property
    def call_raw(self) -> DataFrame:
        l = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")  # noqa: E741
        o = self.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        rows = l.count()
        j = dealt(l, rows, "l_orderkey").join(dealt(o, rows, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        base = lambda k: F.substring(F.lit("ACGT"), (F.col(k) % 4).cast("int") + 1, F.lit(1))
        alt = F.when(F.col("l_partkey") % 6 == 4, "AC").when(F.col("l_partkey") % 6 == 5, "*").otherwise(base("l_partkey"))
        return j.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("chrom"), F.col("l_orderkey").alias("pos"), F.col("s_nationkey").alias("individualID"),
            "l_linenumber", "l_partkey", "l_suppkey", base("l_orderkey").alias("ref"), alt.alias("alt1"), F.col("l_quantity").cast("long").alias("dp"),
            F.floor(F.col("l_quantity") * F.col("l_discount") * 10).cast("long").alias("a1_ad"), "o_orderstatus",
        )

    @cached_property
    def call(self) -> DataFrame:
        order = Window.partitionBy("chrom", "pos", "individualID").orderBy(F.desc("dp"), F.desc("a1_ad"), "l_partkey", "l_suppkey", "l_linenumber")
        first = self.call_raw.withColumn("rn", F.row_number().over(order)).where("rn = 1 AND alt1 <> ref")
        # Sites, types and the call sets all start from here.
        return written(first.select("chrom", "pos", "individualID", "ref", "alt1", "dp", "a1_ad", "o_orderstatus"))

    @cached_property
    def site(self) -> DataFrame:
        return written(self.call.select("chrom", "pos", F.col("ref").alias("ref_base")).distinct())

    @cached_property
    def resolved(self) -> DataFrame:
        return joins.resolve_sites(self.site, self.gene.withColumn("tier", fixture_tier(F.col("biotype"))))

    @cached_property
    def n_calls(self) -> int:
        return self.call.count()

    @cached_property
    def loaded(self) -> DataFrame:
        """Calls with their site's gene and strand and their type. Written once, as sites aren't resolved anew by each
        query that starts from here."""
        at = ["chrom", "pos"]
        c = dealt(self.call, self.n_calls, *at).join(self.resolved.select(*at, "ref_id", "strand"), at)
        return written(c.withColumn("a1type", scalars.classify_calltype(F.col("ref"), F.col("alt1"), F.col("strand"))))

    @cached_property
    def eligible(self) -> DataFrame:
        """Written once: every analysis reads it several times."""
        return written(joins.eligible_calls(self.loaded, self.gene, self.individual, rows=self.n_calls))

    @cached_property
    def complete(self) -> DataFrame:
        """ref_id, complete_in of the complete genes; written once."""
        return written(aggregates.complete_genes(self.eligible, self.individual))

    @cached_property
    def complete_calls(self) -> DataFrame:
        """Eligible calls of the complete genes, which tests and all steps after them look at; written once."""
        return written(self.eligible.join(self.complete, "ref_id", "left_semi"))

    @cached_property
    def expression(self) -> DataFrame:
        """individualID, ref_id, fpkm; written once, as most that reads it does so several times."""
        l = self.table("lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")  # noqa: E741
        s = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("individualID"))
        rows = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("individualID", F.col("l_partkey").alias("ref_id"), "l_extendedprice")
        return stored(dealt(rows, l.count(), "ref_id").groupBy("individualID", "ref_id").agg(F.round(F.sum("l_extendedprice"), 2).alias("fpkm")))


VIEWS = {
    "individual": """SELECT DISTINCT s_nationkey AS "individualID", CASE WHEN s_nationkey % 2 = 0 THEN 'case' ELSE 'ref' END AS condition FROM supplier""",
    "gene": """SELECT p_partkey AS ref_id, p_name AS gene_name, p_type AS biotype, CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END AS novel,
        CAST(p_partkey % 5 + 1 AS INT) AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 7 AS gene_start,
        p_partkey * 7 + p_size * 12 AS gene_end, CAST(p_size * 12 + 1 AS BIGINT) AS gene_span, CAST(p_size AS BIGINT) AS n_transcripts,
        CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 0 WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 2 ELSE 3 END AS tier FROM part""",
    "call_raw": """SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS chrom, l_orderkey AS pos, s_nationkey AS "individualID", l_linenumber, l_partkey, l_suppkey,
        substr('ACGT', CAST(l_orderkey % 4 AS INT) + 1, 1) AS ref,
        CASE l_partkey % 6 WHEN 4 THEN 'AC' WHEN 5 THEN '*' ELSE substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1) END AS alt1,
        CAST(l_quantity AS BIGINT) AS dp, CAST(floor(l_quantity * l_discount * 10) AS BIGINT) AS a1_ad, o_orderstatus
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "call": """SELECT chrom, pos, "individualID", ref, alt1, dp, a1_ad, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, "individualID"
        ORDER BY dp DESC, a1_ad DESC, l_partkey, l_suppkey, l_linenumber) AS rn FROM call_raw) WHERE rn = 1 AND alt1 <> ref""",
    "site": "SELECT DISTINCT chrom, pos, ref AS ref_base FROM call",
    "resolved": """SELECT s.chrom, s.pos, s.ref_base, g.ref_id, g.strand FROM site s LEFT JOIN (SELECT * FROM (SELECT s.chrom, s.pos, g.ref_id, g.strand,
        row_number() OVER (PARTITION BY s.chrom, s.pos ORDER BY novel, tier, n_transcripts DESC, gene_span DESC, g.ref_id) AS rn
        FROM site s JOIN gene g ON s.chrom = g.chrom AND s.pos BETWEEN g.gene_start AND g.gene_end) WHERE rn = 1) g ON s.chrom = g.chrom AND s.pos = g.pos""",
    "loaded": """SELECT c.*, r.ref_id, r.strand, CASE WHEN length(alt1) > length(ref) THEN 'ins' WHEN length(alt1) < length(ref) THEN 'del'
        WHEN length(ref) = 1 AND strand IN ('+', '-') AND ref IN ('A', 'C', 'G', 'T') AND alt1 IN ('A', 'C', 'G', 'T')
        THEN CASE WHEN strand = '-' THEN translate(ref, 'ACGT', 'TGCA') || '-' || translate(alt1, 'ACGT', 'TGCA') ELSE ref || '-' || alt1 END END AS a1type
        FROM call c JOIN resolved r USING (chrom, pos)""",
    "eligible": """SELECT l.ref_id, i.condition, l."individualID", l.chrom, l.pos, l.a1type, l.a1_ad, l.dp, g.gene_span, l.a1_ad / CAST(l.dp AS DOUBLE) AS proportion,
        l.a1_ad / CAST(l.dp AS DOUBLE) / g.gene_span AS weighted FROM loaded l JOIN gene g ON l.ref_id = g.ref_id JOIN individual i ON l."individualID" = i."individualID"
        WHERE l.ref_id IS NOT NULL AND l.a1type IS NOT NULL AND l.dp >= 20""",
    "sizes": "SELECT count(*) FILTER (condition = 'case') AS n1, count(*) FILTER (condition = 'ref') AS n2 FROM individual",
    "expression": """SELECT s_nationkey AS "individualID", l_partkey AS ref_id, round(sum(l_extendedprice), 2) AS fpkm FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
}


def with_views(sql: str) -> str:
    """SQL over the views, as one statement over the tables."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items()) + "\n" + sql
