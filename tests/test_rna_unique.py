from __future__ import annotations

import pytest

from armlens.plans import rna_unique as ru

HEAD = "##fileformat=VCFv4.2\n##contig=<ID=1,length=999>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}\n"


def rec(pos, filters="PASS", chrom="1"):
    return f"{chrom}\t{pos}\t.\tA\tG\t9\t{filters}\t.\tAD:DP\t3,5:8\n"


@pytest.fixture
def files(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    # Position 10: genomic; 20: panel and germline; 30: germline; 40: nothing; 50: genomic of another individual only.
    body = "".join(rec(p, f) for p, f in ((40, "PASS"), (10, "PASS"), (20, "."), (30, "PASS"), (31, "weak"), (32, "weak;germline"), (33, ""), (50, "x"))) + "1\tbad\t.\n"
    put("rna/a/i1/i1.rna.vcf", HEAD.format("i1") + body)
    put("rna/b/i2/i2.rna.vcf", HEAD.format("i2") + rec(50) + rec(10))
    put("rna/b/i3/i3.rna.vcf", HEAD.format("i3") + rec(5))
    put("wgs/i1.wgs.vcf", HEAD.format("i1") + rec(10) + rec(99))
    put("wgs/i2.wgs.vcf", HEAD.format("i2") + rec(50))
    return {"rna": str(tmp_path / "rna"), "wgs": str(tmp_path / "wgs"), "rna_suffix": ".rna.vcf", "wgs_suffix": ".wgs.vcf", "pon": put("pon.vcf", HEAD.format("p") + rec(20) + rec(21)), "germline": put("g.vcf", HEAD.format("g") + "".join(rec(p) for p in (20, 30, 31, 32, 33)))}


def lines(path):
    with open(path) as f:
        return f.read().splitlines()


def test_files_and_summary(spark, tmp_path, files):
    out = str(tmp_path / "out")
    people = spark.createDataFrame([("i1", "a"), ("i2", "b")], "individualID string, group string")
    got = {r["individualID"]: r.asDict() for r in ru.rna_unique(spark, out, people, **files).collect()}
    one = got["i1"]
    assert {k: one[k] for k in ("status", "rna_records", "wgs_positions", "removed_by_wgs", "removed_by_pon", "germline_flagged", "written", "pon_positions", "germline_positions")} == {
        "status": "done", "rna_records": 8, "wgs_positions": 2, "removed_by_wgs": 1, "removed_by_pon": 1, "germline_flagged": 4, "written": 6, "pon_positions": 2, "germline_positions": 5,
    }
    assert (got["i2"]["removed_by_wgs"], got["i2"]["written"]) == (1, 1)
    text = lines(f"{out}/a/i1/i1_rna_unique.vcf")
    head, body = [x for x in text if x.startswith("#")], [x.split("\t") for x in text if not x.startswith("#")]
    assert head[:2] == HEAD.format("i1").splitlines()[:2] and head[-1] == HEAD.format("i1").splitlines()[2]
    assert [h.split("=")[0] for h in head[2:-1]] == ["##armlens_rna_unique_wgs", "##armlens_rna_unique_pon", "##armlens_rna_unique_germline", "##FILTER"]
    assert head[3].endswith("pon.vcf (2 positions, removed)") and head[4].endswith("g.vcf (5 positions, flagged)")
    # The RNA file's order; tags replace PASS, join others and aren't repeated.
    assert [(b[1], b[6]) for b in body] == [("40", "PASS"), ("30", "germline"), ("31", "weak;germline"), ("32", "weak;germline"), ("33", "germline"), ("50", "x")]
    assert all(len(b) == 10 and b[9] == "3,5:8" for b in body)
    assert lines(f"{out}/b/i2/i2_rna_unique.vcf")[-1].split("\t")[1] == "10"
    # Nothing is left aside, and files that are there are skipped.
    assert not [p for p in (tmp_path / "out").rglob("_writing*")]
    again = ru.rna_unique(spark, out, people, **files).collect()
    assert {r["status"] for r in again} == {"skipped"}
    assert {r["status"] for r in ru.rna_unique(spark, out, people, overwrite=True, **files).collect()} == {"done"}


def test_one_failure_leaves_the_others(spark, tmp_path, files):
    people = spark.createDataFrame([("i1", "a"), ("i3", "b"), ("i4", "b")], "individualID string, group string")
    with pytest.raises(ValueError, match="2 of 3 individuals failed: i3: WGS file: 0 found; i4: RNA file: 0 found; WGS file: 0 found"):
        ru.rna_unique(spark, str(tmp_path / "out"), people, **files)
    assert len(lines(tmp_path / "out/a/i1/i1_rna_unique.vcf")) == 3 + 4 + 6
    summary = {r["individualID"]: r for r in spark.read.csv(str(tmp_path / "out/rna_unique_summary"), header=True).collect()}
    assert {k: r["status"] for k, r in summary.items()} == {"i1": "done", "i3": "FAILED", "i4": "FAILED"}


def test_other_contig_names_and_no_resources(spark, tmp_path, files):
    other = tmp_path / "chr.vcf"
    other.write_text(HEAD.format("p") + rec(40, chrom="chr1"))
    people = spark.createDataFrame([("i1", "a")], "individualID string, group string")
    with pytest.warns(UserWarning, match="panel of normals shares no contig name"):
        ru.rna_unique(spark, str(tmp_path / "o1"), people, **files | {"pon": str(other)})
    with pytest.warns(UserWarning, match="no germline resource is given"):
        got = ru.rna_unique(spark, str(tmp_path / "o2"), people, **files | {"pon": None, "germline": None}).first()
    assert (got["written"], got["removed_by_pon"], got["germline_flagged"], got["pon_vcf"]) == (7, 0, 0, "") or (got["written"], got["removed_by_pon"]) == (7, 0)
    head = [x for x in lines(tmp_path / "o2/a/i1/i1_rna_unique.vcf") if x.startswith("##armlens")]
    assert head[1:] == ["##armlens_rna_unique_pon=none", "##armlens_rna_unique_germline=none"]
