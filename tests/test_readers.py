from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from armlens.sources import readers, sinks


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_gtf(spark, tmp_path):
    lines = 'c1\ts\ttranscript\t1\t9\t.\t+\t.\tgene_id "L1"; transcript_id "t1"; ref_gene_id "g1"; gene_name "X";\nc1\ts\texon\tx\t9\t.\t+\t.\tgene_id "L1"; transcript_id "";\nc1\ts\tCDS\t1\t9\t.\t+\t.\tgene_id "L1";\n'
    rows = readers.read_gtf(spark, put(tmp_path, "a.gtf", "#h\n" + lines)).select("feature", "start", "locus_id", "tid", "ref_gene_id", "gene_name").collect()
    assert {tuple(r) for r in rows} == {("transcript", 1, "L1", "t1", "g1", "X"), ("exon", None, "L1", None, None, None)}


def test_vcf(spark, tmp_path):
    head = "##tool_version=3\n##contig=<ID=1,length=9>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tother\ts1\n"
    rec = lambda chrom, pos, fmt, val, filt="PASS": f"{chrom}\t{pos}\t.\ta\tg,t\t9\t{filt}\t.\t{fmt}\t0:0\t{val}\n"
    body = rec(1, 5, "GT:AD:DP", "0/1:3,4:7") + rec(1, 6, "GT:DP", "0/1:7") + rec(1, 7, "GT:AD:DP", "0/1") + rec(2, 8, "AD:DP", "1,2:3", "") + rec(1, 9, "DP:AD", "30:1,29")
    path = put(tmp_path, "s1.vcf", head + body)
    samples = spark.createDataFrame([("s1.vcf", "s1")], "file string, individualID string")
    calls, dropped = readers.read_vcf_calls(spark, path, samples, spark.createDataFrame([("1",)], "chrom string"))
    assert {tuple(r) for r in calls.collect()} == {("s1", "1", 5, "A", "G", 4, 7, "PASS"), ("s1", "1", 9, "A", "G", 29, 30, "PASS")} or {(r["individualID"], r["chrom"], r["pos"], r["ref"], r["alt1"], r["a1_ad"], r["dp"], r["filter"]) for r in calls.collect()} == {("s1", "1", 5, "A", "G", 4, 7, "PASS"), ("s1", "1", 9, "A", "G", 29, 30, "PASS")}
    assert {tuple(r) for r in dropped.collect()} == {("no_ad_dp", 1), ("short", 1), ("off_contig", 1)}
    assert [r["chrom"] for r in readers.read_vcf_contigs(spark, path).collect()] == ["1"]
    assert [(r["key"], r["text"]) for r in readers.read_vcf_provenance(spark, path, "tool").collect()] == [("version", "3")]
    assert readers.read_vcf_positions(spark, path).count() == 5


def test_samples(spark, tmp_path):
    s = readers.load_samples(spark, put(tmp_path, "m.csv", " id ,group\n1,a\n2,b\n"))
    readers.validate_samples(s, "id", "group")
    for bad in ("id,group\n1,a\n1,b\n", "id,group\n1,a\n2,a\n", "id,group\nNA,a\n2,b\n"):
        with pytest.raises(ValueError):
            readers.validate_samples(readers.load_samples(spark, put(tmp_path, f"{abs(hash(bad))}.csv", bad)), "id", "group")


def test_tables(spark, tmp_path):
    fasta = readers.read_fasta_lengths(spark, put(tmp_path, "a.fa", ">t1|x y\nACG\nT\n>t2 z\nAC\n"))
    assert {tuple(r) for r in fasta.collect()} == {("t1", 4), ("t2", 2)}
    report = readers.read_assembly_report(spark, put(tmp_path, "r.txt", "# x\n# Sequence-Name\tSequence-Role\tAssigned-Molecule\tGenBank-Accn\tRefSeq-Accn\tUCSC-style-name\n1\tassembled-molecule\t1\tCM1\tNC1\tchr1\nMT\tassembled-molecule\tMT\tna\tNC9\tchrM\n"))
    picked = readers.select_contigs(spark.createDataFrame([("chr1",), ("chrM",), ("zz",)], "chrom string"), report).collect()
    assert {r["chrom"]: r["kept"] for r in picked} == {"chr1": True, "chrM": False, "zz": False}
    ctab = readers.read_ctab(spark, put(tmp_path, "i1.ctab", "t_id\tt_name\tFPKM\n1\ttx\t2.5\n2\tty\tnone\n"), spark.createDataFrame([("i1.ctab", "i1")], "file string, individualID string"))
    assert [(r["individualID"], r["tid"], r["fpkm"]) for r in ctab.collect()] == [("i1", "tx", 2.5)]
    cov = readers.read_covariates(spark, put(tmp_path, "c.csv", "individualID;age\n1;90+\n1;80\n2;70\n"), "individualID", ["age"])
    assert {tuple(r) for r in cov.collect()} == {("1", "90+"), ("2", "70")}
    reads = spark.createDataFrame([("f", 0, "ACGT"), ("f", 1, "AC"), ("g", 0, "A")], "file string, record_no long, seq string")
    assert {r["file"]: (r["n_reads"], r["min_length"], r["uniform"]) for r in readers.read_length_stats(reads).collect()} == {"f": (2, 2, False), "g": (1, 1, True)}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("chrom", F.lit("1"))
    with pytest.raises(ValueError):
        sinks.require_table(spark, path)
    sinks.save_table(df, path, partition_by="chrom")
    with pytest.raises(ValueError):
        sinks.save_table(df, path)
    sinks.save_table(df.limit(2), path, overwrite=True)
    assert sinks.require_table(spark, path).count() == 2
    meta = str(tmp_path / "meta")
    sinks.set_run_meta(spark, meta, {"case": "a"}, "w")
    sinks.set_run_meta(spark, meta, {"case": "b"}, "w")
    assert [r["value"] for r in sinks.run_meta(spark, meta).collect()] == ["b"]


def test_conditions_by_a_users_labels(spark):
    rows = spark.createDataFrame([("a", "AD"), ("b", "CN"), ("c", "AD")], "id string, dx string")
    got = {r["individualID"]: r["condition"] for r in readers.as_conditions(rows, "id", "dx", "AD").collect()}
    assert got == {"a": "case", "b": "ref", "c": "case"}
    for wrong in (dict(case="XX"), dict(case="AD", id_col="dx")):
        with pytest.raises(ValueError):
            readers.as_conditions(rows, **{"id_col": "id", "condition_col": "dx"} | wrong)


def test_queries_share_a_cohort_until_its_files_change(spark, tmp_path):
    import os
    import shutil

    from armlens.sources.driver_view import SOURCES, Cohort

    for t in SOURCES:
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    first = Cohort.of(spark, str(tmp_path))
    assert Cohort.of(spark, str(tmp_path)) is first and Cohort.of(spark, "/root/testdata/sf0.001") is not first
    os.utime(tmp_path / "part.parquet", (1, 1))
    assert Cohort.of(spark, str(tmp_path)) is not first


def test_logs_of_many_suppliers_make_few_files(spark, tmp_path, monkeypatch):
    """300 suppliers: what is written is as many files as tasks write, not one for each supplier, and nothing is lost."""
    import os

    import __spark_entry__ as entry
    from armlens.plans import file_catalog

    tables = str(tmp_path / "tables")
    spark.range(1, 301).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey"), F.lit("s").alias("s_name")).coalesce(2).write.parquet(f"{tables}/supplier.parquet")
    for table in ("lineitem", "orders", "part"):
        spark.range(1).write.parquet(f"{tables}/{table}.parquet")
    for name, least in (("qc_rollup", 200), ("qc_by_individual", 225)):
        written, seen = str(tmp_path / name), iter(range(9))
        monkeypatch.setattr(file_catalog, "_folder", lambda c, w=written, n=seen: f"{w}/{next(n)}")
        rows = entry.queries()[name](spark, tables).collect()
        files = [f for _, _, fs in os.walk(written) for f in fs if f.startswith("part-")]
        assert len(rows) == 300 and sum(r["status"] == "OK" for r in rows) == least
        assert 0 < len(files) <= 8


def test_bundles_keep_names_lines_and_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x\t1"), ("b", ""), ("b", "#2"), ("a", "y")], "n string, l string").coalesce(1)
    rows.select(readers.bundle_line(F.col("n"), F.col("l"))).write.text(str(tmp_path / "b"))
    got = readers.bundled_lines(spark, str(tmp_path / "b")).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("l")).collect()
    assert {r["name"]: [x["value"] for x in r["l"]] for r in got} == {"b": ["x\t1", "", "#2"], "a": ["y"]}


def test_long_files_are_folders_of_parts(spark, tmp_path, monkeypatch):
    """No task sorts a whole file; read back, the parts are one file, with its header and its lines in order."""
    monkeypatch.setattr(sinks, "TASK_ROWS", 20)
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    body = spark.range(300).select((F.col("id") % 2).cast("string").alias("k"), F.col("id").alias("at"), F.concat_ws("\t", F.lit("1"), F.col("id"), F.lit(".\tA\tC\t9\tPASS\t.\tAD:DP\t1,2:3")).alias("value"))
    first = spark.createDataFrame([("0", -1, head + "0"), ("1", -1, head + "1")], "k string, at long, value string")
    targets = {k: str(tmp_path / f"i{k}.vcf") for k in "01"}
    sinks.write_files(first.union(body).repartition(5), targets, "k", "at", rows=302)
    assert all(len(list((tmp_path / f"i{k}.vcf").glob("part-*"))) > 3 for k in "01")
    names = spark.createDataFrame([("i0.vcf", "0"), ("i1.vcf", "1")], "file string, individualID string")
    calls, dropped = readers.read_vcf_calls(spark, list(targets.values()), names)
    got = [(r["individualID"], r["pos"]) for r in calls.orderBy("line").collect()]
    assert got == [(str(k), n) for k in range(2) for n in range(k, 300, 2)] and dropped.isEmpty()
    assert {r["name"] for r in readers.named_lines(spark, list(targets.values())).select("name").distinct().collect()} == {"i0.vcf", "i1.vcf"}
    tables = {k: str(tmp_path / f"i{k}.ctab") for k in "01"}
    cells = body.select("k", "at", F.concat(F.lit("T"), "at").alias("t_name"), F.col("at").cast("string").alias("FPKM"))
    for rows in (300, 0):
        sinks.write_files(cells, tables, "k", "at", ["t_name", "FPKM"], rows=rows, overwrite=True)
        read = readers.read_ctab(spark, list(tables.values()), spark.createDataFrame([("i0.ctab", "0"), ("i1.ctab", "1")], "file string, individualID string")).collect()
        assert {(r["individualID"], r["tid"], r["fpkm"]) for r in read} == {(str(n % 2), f"T{n}", float(n)) for n in range(300)}
    assert (tmp_path / "i0.ctab").is_file()
