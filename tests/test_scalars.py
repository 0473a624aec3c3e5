from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from armlens.functions import scalars, special


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "ref,alt,strand,expected",
    [("A", "G", "+", "A-G"), ("A", "G", "-", "T-C"), ("A", "AC", "+", "ins"), ("AC", "A", "-", "del"), ("AC", "GT", "+", None), ("A", "*", "+", None), ("AC", "*", "+", "del"), ("A", "AC", None, "ins"), ("A", "G", None, None), ("N", "G", "+", None)],
)
def test_calltype(spark, ref, alt, strand, expected):
    strand = F.lit(strand).cast("string")
    assert one(spark, scalars.classify_calltype(F.lit(ref), F.lit(alt), strand)) == expected


def test_versions_and_prefixes(spark):
    stem = lambda x: one(spark, scalars.version_stem(F.lit(x)))
    assert [stem(x) for x in ("ENSG0001.12", "NM_12.3", "1.2", "abc.x")] == ["ENSG0001", "NM_12", "1.2", "abc.x"]
    assert one(spark, scalars.version_number(F.lit("ENSG0001.12"))) == "12"
    assert one(spark, scalars.strip_id_prefix(F.lit("gene-rna-X"))) == "rna-X"
    assert one(spark, scalars.strip_symbol_suffix(F.lit("TP53-2"))) == "TP53"


def test_filter_tags(spark):
    tag = lambda x: one(spark, scalars.tag_filter(F.lit(x).cast("string"), "g"))
    assert [tag(x) for x in ("PASS", ".", "", None, "a", "a;g")] == ["g", "g", "g", "g", "a;g", "a;g"]
    f = lambda q, d, p: one(spark, scalars.threshold_filters(), qual=q, qd=d, dp=p)
    assert f(30, 12, 25) == "PASS" and f(10, 12, 5) == "qual_filt;depth_filt"


def test_groups_and_locals(spark):
    g = lambda a, b: one(spark, scalars.assign_group(F.lit(a), F.lit(b), 0.75))
    assert [g(3, 1), g(1, 3), g(2, 2), g(0, 0)] == ["case_enriched", "ref_enriched", "Shared", "Shared"]
    e = lambda a, b: one(spark, scalars.edit_dist(F.lit(a), F.lit(b)))
    assert [e(2, 1), e(1, 2), e(1, 1), e(0, 0)] == ["case_enriched", "ref_enriched", "Both", "ref_enriched"]
    c = lambda a, b: one(spark, scalars.classify_local(F.lit(a), F.lit(b), 4, 5))
    assert [c(4, 0), c(3, 0), c(0, 5), c(3, 2), c(3, 3)] == ["specific", "low-specific", "specific", "double", "differential"]


def test_small_functions(spark):
    assert one(spark, scalars.format_p(F.lit(None).cast("double"))) == "na"
    assert one(spark, scalars.format_p(F.lit(0.04))) == "0.040" and "e" in one(spark, scalars.format_p(F.lit(0.0001)))
    assert one(spark, scalars.parse_censored(F.lit("90+"))) == 90.0 and one(spark, scalars.parse_censored(F.lit("x"))) is None
    assert one(spark, scalars.minimum_length(F.lit(75))) == 52 and one(spark, scalars.minimum_length(F.lit(0))) == 1
    assert one(spark, scalars.transcript_position(F.lit("+"), F.lit(12), F.lit(10), F.lit(20), F.lit(5))) == 8
    assert one(spark, scalars.transcript_position(F.lit("-"), F.lit(12), F.lit(10), F.lit(20), F.lit(5))) == 14
    assert one(spark, scalars.majority(F.lit(5))) == 3
    assert one(spark, scalars.excluded_by_annotation(F.array(F.lit("Mt_tRNA")), F.lit("MT-X"))) == "Mt+tRNA+MT-"


@pytest.mark.parametrize("x", [0.0, 0.3, 0.46875, 0.5, 1.0, 3.9, 4.1, 9.0])
def test_erfc(spark, x):
    sql = special.erfc_sql("x")
    assert one(spark, F.expr(sql), x=x) == pytest.approx(math.erfc(x), rel=1e-13)
    assert duckdb.sql(f"select {sql} from (select {x!r}::DOUBLE as x)").fetchall()[0][0] == pytest.approx(math.erfc(x), rel=1e-13)


def test_lgamma(spark):
    for x in (1.0, 2.5, 40.0, 1000.0):
        assert one(spark, F.expr(special.lgamma_sql("x")), x=x) == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)


def test_tails():
    from armlens.functions.tails import beta_inc, gamma_q

    assert beta_inc(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-10)
    assert gamma_q(1.0, 2.0) == pytest.approx(math.exp(-2), rel=1e-12) and gamma_q(0.5, 4.0) == pytest.approx(math.erfc(2.0), rel=1e-10)
