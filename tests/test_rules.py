"""Rules whose results must be these, written from their definitions."""

from __future__ import annotations

import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from armlens.functions import scalars
from armlens.operators import aggregates, joins, models, ranks, tests
from armlens.plans import build
from armlens.sources import readers


def test_biotype_tier(spark):
    names = ["protein_coding", "lncRNA", "miRNA", "snoRNA", "snRNA", "scaRNA", "rRNA", "misc_RNA", "ribozyme", "sRNA", "vault_RNA", "Mt_tRNA", "Mt_rRNA", "tRNA", "scRNA", "IG_V_gene", None]
    got = spark.createDataFrame([(n,) for n in names], "b string").select("b", scalars.biotype_tier(F.col("b")).alias("t")).collect()
    assert [r["t"] for r in got] == [0, 1] + [2] * 11 + [3, 3, 3, 4]


def test_format_p(spark):
    values = [2.448e-160, 0.09446, 0.0996, 0.0004999, 0.0005, 0.0, 1.0, None, float("nan")]
    got = spark.createDataFrame([(v,) for v in values], "p double").select(scalars.format_p(F.col("p")).alias("s")).collect()
    assert [r["s"] for r in got] == ["2.448e-160", "0.094", "0.100", "4.999e-04", "0.001", "0.000", "1.000", "na", "na"]


def exact_by_hand(n1, n2):
    count = {}
    for chosen in combinations(range(1, n1 + n2 + 1), n1):
        u = sum(chosen) - n1 * (n1 + 1) // 2
        count[u] = count.get(u, 0) + 1
    total = sum(count.values())
    return [min(1.0, 2 * sum(c for x, c in count.items() if x >= max(u, n1 * n2 - u)) / total) for u in range(n1 * n2 + 1)]


@pytest.mark.parametrize("sizes", [(1, 1), (1, 5), (2, 3), (3, 2), (4, 6), (8, 5)])
def test_exact_tail(sizes):
    assert tests.exact_tail(*sizes) == pytest.approx(exact_by_hand(*sizes))


def test_exact_rule_has_no_other_bound(spark):
    """An arm of eight without ties is exact however large the other arm is; nine and nine are not."""
    for n1, n2, exact in ((8, 60, True), (60, 8, True), (9, 9, False)):
        rows = [("g", "case", float(2 * k + 1)) for k in range(n1)] + [("g", "ref", float(2 * k)) for k in range(1, n2 + 1)]
        pooled = tests.mannwhitney_pooled(spark.createDataFrame(rows, "gene string, condition string, weighted double"), ["gene"]).first()
        totals = spark.createDataFrame([(k, c, f"{c}{i}", v) for i, (k, c, v) in enumerate(rows)], "gene string, condition string, individualID string, total double")
        padded = tests.mannwhitney_padded(totals, "gene", n1, n2).first()
        want = tests.exact_tail(n1, n2)[int(pooled["prop_u_stat"])]
        assert (abs(pooled["prop_p_value"] - want) < 1e-12) == exact and (abs(padded["p_value"] - want) < 1e-12) == exact


def test_first_of_each_transcript(spark, tmp_path):
    (tmp_path / "i1.ctab").write_text("t_name\tFPKM\nA\t1\nA\t9\nB\t5\nB\t2\n")
    samples = spark.createDataFrame([("i1.ctab", "i1")], "file string, individualID string")
    known = spark.createDataFrame([("A",), ("B",)], "tid string")
    got = {r["tid"]: r["fpkm"] for r in build.load_expression(spark, str(tmp_path / "i1.ctab"), samples, known).collect()}
    assert got == {"A": 1.0, "B": 5.0}


def test_first_record_of_a_position(spark, tmp_path):
    rec = lambda alt, dp: f"1\t5\t.\tA\t{alt}\t9\tPASS\t.\tAD:DP\t3,5:{dp}\n"
    (tmp_path / "a.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ti1\n" + rec("T", 8) + rec("C", 30))
    genes = spark.createDataFrame([], "chrom string, gene_start long, gene_end long, ref_id string, strand string, novel int, tier int, n_transcripts long, gene_span long")
    calls = build.load_calls(spark, str(tmp_path / "a.vcf"), spark.createDataFrame([("a.vcf", "i1")], "file string, individualID string"), genes, repeated="keep_first")[0]
    assert [r["alt1"] for r in calls.collect()] == ["T"]


def test_biotypes_reach_the_build(spark, tmp_path):
    """Two genes of one span: the one of the lower tier gets the site."""
    line = lambda f, g: f'1\ts\t{f}\t100\t199\t.\t+\t.\tgene_id "{g}"; transcript_id "T{g}"; ref_gene_id "{g}";\n'
    put = lambda n, t: (tmp_path / n).write_text(t) and str(tmp_path / n)
    gtf = put("a.gtf", "".join(line(f, g) for g in ("G1", "G2") for f in ("transcript", "exon")))
    vcf = put("a.vcf", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ti1\n1\t150\t.\tA\tG\t9\tPASS\t.\tAD:DP\t3,5:8\n")
    attrs = readers.read_attrs(spark, put("attrs.tsv", "#geneId\tgeneType\nG1.4\tlncRNA\nG2.1\tprotein_coding\n"), {"ref_id": "geneId", "biotype": "geneType"})
    names = lambda f: spark.createDataFrame([(f, "i1")], "file string, individualID string")
    common = {"gtf": gtf, "samples_csv": put("m.csv", "id,group\ni1,x\ni2,y\n"), "id_col": "id", "condition_col": "group", "vcfs": vcf, "vcf_names": names("a.vcf"), "ctabs": put("i1.ctab", "t_name\tFPKM\nTG1\t3\n"), "ctab_names": names("i1.ctab")}
    lengths = spark.createDataFrame([("TG1", 100), ("TG2", 99)], "tid string, length long")
    paths = build.build_all(spark, str(tmp_path / "with"), attributes=attrs, lengths=lengths, **common)
    assert [r["ref_id"] for r in spark.read.parquet(paths["site"]).collect()] == ["G2"]
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/with/run_meta").collect()}
    assert meta["annotate.n_length_mismatches"] == "1"
    paths = build.build_all(spark, str(tmp_path / "without"), **common)
    assert [r["ref_id"] for r in spark.read.parquet(paths["site"]).collect()] == ["G1"]


def test_giant_spans(spark):
    """A span of thousands of bins is found like any other."""
    spans = [(1, 10 * k, 10 * k + 12, k) for k in range(200)] + [(1, 5, 1_000_000, 900), (2, 0, 10**9, 901)]
    points = [(1, p) for p in (0, 5, 12, 999, 1_000_000, 1_000_001)] + [(2, 10**9), (3, 1)]
    got = joins.covering(spark.createDataFrame(points, "chrom int, pos long"), spark.createDataFrame(spans, "chrom int, gene_start long, gene_end long, g int"))
    want = {(c, p, g) for c, p in points for d, a, b, g in spans if c == d and a <= p <= b}
    assert {(r["chrom"], r["pos"], r["g"]) for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("parts", [1, 2, 64])
def test_ranged_ranks(spark, parts):
    """Signal in a few p-values, ties and nulls: the same at every number of ranges."""
    p = [1e-9 * (k % 7) for k in range(40)] + [k / 50 for k in range(50)] + [None, None]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p_value double")
    one = {r["i"]: r["adj_pvalue"] for r in ranks.benjamini_hochberg(df).collect()}
    assert {r["i"]: r["adj_pvalue"] for r in ranks.benjamini_hochberg(df, parts=parts).collect()} == pytest.approx(one)


def test_directional_wilcoxon(spark):
    rows = [("k", "a", float(v)) for v in (5, 6, 7, 8)] + [("k", "b", float(v)) for v in (1, 2, 3, 4)] + [("few", "a", 1.0), ("few", "b", 2.0)]
    got = {r["k"]: r for r in models.directional_wilcoxon(spark.createDataFrame(rows, "k string, g string, v double"), ["k"], "g", "v", "a", "b").collect()}
    # z = (16 - 8 - 0.5) / sqrt(12)
    assert got["k"]["direction"] == "a > b" and got["k"]["p_directional"] == pytest.approx(0.0151886, abs=1e-5) and got["few"]["p_directional"] is None


def test_audits(spark):
    t = spark.createDataFrame([("g1", "Mt_rRNA", "MT-RNR1"), ("g1", "rRNA", "MT-RNR1"), ("g2", "protein_coding", "MT-ND1"), ("g3", "lncRNA", "X")], "ref_id string, transcript_type string, gene_name string")
    assert {r["transcript_type"]: (r["n_genes"], r["n_transcripts"]) for r in aggregates.exclusion_by_type(t).collect()} == {"Mt_rRNA": (1, 1), "rRNA": (1, 1)}
    assert [tuple(r) for r in aggregates.exclusion_by_prefix(t).collect()] == [("MT-", 2, 3, "MT-ND1,MT-RNR1")]
    loci = spark.createDataFrame([("L1", "A"), ("L2", "B"), ("L2", "C"), ("L3", "B"), ("L4", "D"), ("L5", "D"), ("L6", "E")], "locus_id string, gene_name string")
    got = {r["symbol"]: r["outcome"] for r in aggregates.symbol_audit(loci, loci.where("gene_name <> 'E'")).collect()}
    assert got == {"A": "clean", "B": "partial", "C": "lost", "D": "fragmented", "E": "lost"}


@pytest.mark.parametrize("sizes", [(8, 8), (8, 300), (7, 2000), (1, 5), (8, 40)])
def test_exact_half_loses_no_digits(sizes):
    """Against the same counts in whole numbers."""
    n1, n2 = sizes
    half = n1 * n2 // 2
    counts = [1] + [0] * half
    for k in range(1, n1 + 1):
        for u in range(half, n2 + k - 1, -1):
            counts[u] -= counts[u - n2 - k]
        for u in range(k, half + 1):
            counts[u] += counts[u - k]
    total, running, want = math.comb(n1 + n2, n1), 0, []
    for c in counts:
        running += c
        want.append(min(1.0, 2 * running / total))
    assert tests.exact_half(n1, n2).tolist() == pytest.approx(want, rel=1e-11)
