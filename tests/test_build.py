from __future__ import annotations

import pytest

from armlens.plans import build

GTF = "".join(
    f'{c}\ts\t{f}\t{a}\t{b}\t.\t{s}\t.\tgene_id "{g}"; transcript_id "{t}";{r}\n'
    for c, f, a, b, s, g, t, r in [
        ("1", "transcript", 100, 199, "+", "L1", "T0001.2", ' ref_gene_id "gene-G1.3"; gene_name "GENE";'), ("1", "exon", 100, 120, "+", "L1", "T0001.2", ""), ("1", "exon", 150, 199, "+", "L1", "T0001.2", ""),
        ("1", "transcript", 110, 250, "+", "L1", "T2", ""), ("1", "exon", 110, 250, "+", "L1", "T2", ""),
        ("1", "transcript", 500, 600, "-", "L2", "T3", ""), ("1", "exon", 500, 600, "-", "L2", "T3", ""),
        ("1", "transcript", 700, 800, "-", "L3", "bare", ""),
    ]
)
HEAD = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}\n"


def test_build_all(spark, tmp_path):
    put = lambda n, t: (tmp_path / n).write_text(t) and str(tmp_path / n)
    rec = lambda pos, ref, alt: f"1\t{pos}\t.\t{ref}\t{alt}\t9\tPASS\t.\tAD:DP\t3,5:8\n"
    a = put("a.vcf", HEAD.format("i1") + rec(115, "A", "G") + rec(550, "A", "G") + rec(900, "A", "AT"))
    b = put("b.vcf", HEAD.format("i2") + rec(115, "A", "T"))
    ctab = put("i1.ctab", "t_name\tFPKM\nT0001.2\t3\nzz\t1\n")
    names = spark.createDataFrame([("a.vcf", "i1"), ("b.vcf", "i2")], "file string, individualID string")
    paths = build.build_all(spark, str(tmp_path / "db"), gtf=put("a.gtf", GTF), samples_csv=put("m.csv", "id,group\ni1,x\ni2,y\n"), id_col="id", condition_col="group", vcfs=[a, b], vcf_names=names, ctabs=ctab, ctab_names=spark.createDataFrame([("i1.ctab", "i1")], "file string, individualID string"))
    read = lambda n: spark.read.parquet(paths[n])
    assert {(r["tid"], r["ref_id"], r["outcome"]) for r in read("transcript").collect()} == {("T0001", "G1", "matched"), ("T2", "G1", "inherited"), ("T3", "L2", "novel")}
    assert {r["ref_id"]: (r["gene_start"], r["gene_end"], r["n_transcripts"], r["novel"]) for r in read("gene").collect()} == {"G1": (100, 250, 2, 0), "L2": (500, 600, 1, 1)}
    assert {(r["individualID"], r["pos"], r["ref_id"], r["a1type"]) for r in read("call").collect()} == {("i1", 115, "G1", "A-G"), ("i1", 550, "L2", "T-C"), ("i1", 900, None, "ins"), ("i2", 115, "G1", "A-T")}
    assert [(r["tid"], r["tpm"]) for r in read("expression").collect()] == [("T0001", 750000.0)]
    assert read("exon").where("tid = 'T0001'").count() == 2
    with pytest.raises(ValueError):
        build.build_all(spark, str(tmp_path / "db"), gtf=str(tmp_path / "a.gtf"), samples_csv=str(tmp_path / "m.csv"), id_col="id", condition_col="group", vcfs=[a], vcf_names=names, ctabs=ctab, ctab_names=names)


def test_repeated_records(spark, tmp_path):
    rec = "1\t5\t.\tA\tG\t9\tPASS\t.\tAD:DP\t3,5:8\n"
    (tmp_path / "a.vcf").write_text(HEAD.format("i1") + rec + rec)
    names = spark.createDataFrame([("a.vcf", "i1")], "file string, individualID string")
    genes = spark.createDataFrame([], "chrom string, gene_start long, gene_end long, ref_id string, strand string, novel int, tier int, n_transcripts long, gene_span long")
    with pytest.raises(ValueError):
        build.load_calls(spark, str(tmp_path / "a.vcf"), names, genes)
    assert build.load_calls(spark, str(tmp_path / "a.vcf"), names, genes, repeated="keep_first")[0].count() == 1


def test_contigs_bases_and_the_log(spark, tmp_path):
    """Calls off the kept contigs go; a site's base is that of the first individual; every step's counts are in the log."""
    put = lambda n, t: (tmp_path / n).write_text(t) and str(tmp_path / n)
    line = lambda c, f, a, b, g, t, r="": f'{c}\ts\t{f}\t{a}\t{b}\t.\t+\t.\t{g}transcript_id "{t}";{r}\n'
    gtf = "# made here\n" + line("1", "transcript", 100, 300, 'gene_id "L1"; ', "T1.1", ' ref_gene_id "G1.2"; gene_name "A";') + line("1", "exon", 100, 300, 'gene_id "L1"; ', "T1.1")
    gtf += line("1", "transcript", 100, 250, 'gene_id "L1"; ', "T1.1") + line("1", "transcript", 400, 500, "", "T2", ' ref_gene_id "G2";') + line("1", "transcript", 600, 700, 'gene_id "L3"; ', "T3") + line("1", "exon", 800, 900, 'gene_id "L4"; ', "T4")
    gtf += line("X9", "transcript", 100, 300, 'gene_id "L5"; ', "T5") + line("X9", "exon", 100, 300, 'gene_id "L5"; ', "T5") + '1\ts\ttranscript\t1\t2\t.\t+\t.\tgene_id "L1";\n'
    report = spark.createDataFrame([("1", "assembled-molecule", "1"), ("X9", "unplaced-scaffold", "na")], "chrom string, role string, molecule string")
    rec = lambda c, pos, ref, alt, fmt="AD:DP", v="3,5:8": f"{c}\t{pos}\t.\t{ref}\t{alt}\t9\tPASS\t.\t{fmt}\t{v}\n"
    mark = "##armlens_rna_unique_pon=panel.vcf (3 positions, removed)\n"
    b = put("b.vcf", HEAD.format("i2") + rec("1", 150, "G", "T") + rec("X9", 150, "A", "G") + rec("1", 160, "A", "G", "GT", "0/1") + rec("1", 170, "A", "G", "GT:AD:DP", "0/1:1") + rec("1", "x", "A", "G") + "1\t180\n")
    a = put("a.vcf", mark + HEAD.format("i1") + rec("1", 150, "T", "C"))
    names = spark.createDataFrame([("b.vcf", "i2"), ("a.vcf", "i1")], "file string, individualID string")
    given = dict(gtf=put("a.gtf", gtf), samples_csv=put("m.csv", "id,group\ni1,x\ni2,y\n"), id_col="id", condition_col="group", vcfs=[b, a], vcf_names=names, ctabs=put("i1.ctab", "t_name\tFPKM\nT1\t3\n"), ctab_names=spark.createDataFrame([("i1.ctab", "i1")], "file string, individualID string"))
    with pytest.warns(UserWarning, match="several reference bases"):
        paths = build.build_all(spark, str(tmp_path / "db"), report=report, **given)
    calls = spark.read.parquet(paths["call"]).collect()
    assert sorted((r["individualID"], r["chrom"], r["pos"]) for r in calls) == [("i1", 1, 150), ("i2", 1, 150)] or sorted((r["individualID"], str(r["chrom"]), r["pos"]) for r in calls) == [("i1", "1", 150), ("i2", "1", 150)]
    (site,) = spark.read.parquet(paths["site"]).collect()
    assert site["ref_base"] == "T" and site["conflict"] and site["ref_id"] == "G1"
    log = {r["key"]: r["value"] for r in build.sinks.run_meta(spark, str(tmp_path / "db" / "run_meta")).collect()}
    want = dict(
        n_lines=9, n_dropped_no_tid=1, n_dropped_exons_no_tid=0, n_contigs_present=2, n_contigs_kept=1, contigs_kept="1", n_transcripts_dropped_contig=1, n_dropped_no_locus=1, n_dropped_no_locus_with_gene=1, n_genes_absent_no_locus=1,
        n_duplicate_transcripts=1, n_transcripts=1, n_transcripts_matched=1, n_transcripts_ambiguous=0, n_exons=1, n_genes=1, n_genes_novel=0,
    )
    assert {k: log.get(f"annotate.{k}") for k in want} == {k: str(v) for k, v in want.items()}
    want = dict(n_records_read=6, n_dropped_off_contig=1, n_dropped_no_format=2, n_dropped_no_position=1, n_usable=2, n_base_conflicts=1, n_calls=2, n_sites=1, n_sites_in_gene=1, n_samples=2, contigs_restricted=1, pon="panel.vcf (3 positions, removed)")
    assert {k: log.get(f"load_calls.{k}") for k in want} == {k: str(v) for k, v in want.items()}
    assert (log["annotate.n_dropped_exonless_transcript"], log["annotate.n_dropped_orphan_exon"]) == ("1", "1")
    with pytest.warns(UserWarning, match="chose no contigs"):
        free = build.build_all(spark, str(tmp_path / "db2"), **given)
    assert spark.read.parquet(free["call"]).count() == 3
    two = put("c.vcf", HEAD.format("p\tq") + rec("1", 150, "T", "C"))
    with pytest.raises(ValueError, match="sample columns"):
        build.load_calls(spark, two, spark.createDataFrame([("c.vcf", "i1")], "file string, individualID string"), spark.read.parquet(paths["gene"]).withColumn("tier", build.F.lit(0)))
    with pytest.raises(ValueError, match="no usable record"):
        build.load_calls(spark, a, spark.createDataFrame([("a.vcf", "i1")], "file string, individualID string"), spark.read.parquet(paths["gene"]).withColumn("tier", build.F.lit(0)), spark.createDataFrame([("7",)], "chrom string"))
