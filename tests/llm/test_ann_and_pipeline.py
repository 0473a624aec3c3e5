from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from armlens.llm import hilbert_ann
from armlens.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def test_hilbert_curve_is_one():
    for d, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = hilbert_ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(1 << (d * bits)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, q, k=20):
    v = {i: np.array(x, float) for i, x in rows}
    near = sorted(((-float(v[q] @ x), i) for i, x in v.items() if i != q))
    return [i for _, i in near[:k]]


def test_recall(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    out = hilbert_ann.search(vectors, lambda i: i % 20 == 0).toPandas()
    found = out.sort_values("rank").groupby("query_id")["vec_id"].apply(list)
    asked = [i for i, _ in rows if i % 20 == 0]
    assert sorted(found.index) == sorted(asked)
    assert np.mean([len(set(found[q]) & set(brute(rows, q))) / 20 for q in asked]) >= 0.9
    # Fewer pairs than brute force, though these vectors are spread evenly; far fewer where vectors cluster.
    assert out.groupby("query_id")["n_scored"].first().mean() < 0.9 * len(rows)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64)) * 6
    near = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=64)]) for i in range(2000)]
    out = hilbert_ann.search(spark.createDataFrame(near, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0).toPandas()
    found = out.sort_values("rank").groupby("query_id")["vec_id"].apply(list)
    assert np.mean([len(set(found[q]) & set(brute(near, q))) / 20 for q in range(0, 2000, 20)]) >= 0.9
    assert out.groupby("query_id")["n_scored"].first().mean() < 0.4 * len(near)


def test_recall_of_lone_rows_beside_clusters(spark):
    """Windows follow how alone a query is: both kinds of queries find their neighbours, on under half of the pairs."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(100, 32)) * 5
    rows = [(i, [float(x) for x in centres[i % 100] + rng.normal(size=32) * 0.3]) for i in range(4000)]
    rows += [(4000 + i, [float(x) for x in rng.normal(size=32) * 6]) for i in range(160)]
    out = hilbert_ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 10 == 0).toPandas()
    found = out.sort_values("rank").groupby("query_id")["vec_id"].apply(list)
    recall = lambda ids: np.mean([len(set(found[q]) & set(brute(rows, q))) / 20 for q in ids])
    assert recall(range(0, 4000, 40)) >= 0.9 and recall(range(4000, 4160, 10)) >= 0.9
    assert out.groupby("query_id")["n_scored"].first().mean() < 0.5 * len(rows)


def test_ann_ties_and_repeated_ids(spark):
    """Thousands of equal inner products; an id that occurs thirty times; an id with several vectors."""
    rng = np.random.default_rng(1)
    flat = [(0, [1.0] + [0.0] * 7)] + [(i, [0.5, *map(float, rng.normal(size=7))]) for i in range(1, 3000)]
    df = spark.createDataFrame(flat, "vec_id long, embedding array<double>").repartition(5)
    out = hilbert_ann.search(df, lambda i: i == 0, target=1.0).toPandas().sort_values("rank")
    assert list(out["vec_id"]) == list(range(1, 21)) and set(out["score"]) == {0.5}
    v = [float(x) for x in rng.normal(size=8)]
    rows = [(40, v)] * 30 + [(i, v) for i in range(1, 5)] + [(100 + i, [float(x) for x in rng.normal(size=8)]) for i in range(30)] + [(200, v), (200, [-x for x in v])]
    out = hilbert_ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 40, target=1.0).toPandas().sort_values("rank")
    assert list(out["vec_id"])[:5] == [1, 2, 3, 4, 200] and len(out) == 20 and 40 not in set(out["vec_id"])
    distinct = {(i, tuple(x)) for i, x in rows if i != 40}
    assert list(zip(-out["score"].round(9), out["vec_id"], strict=True)) == sorted((-round(float(np.dot(v, x)), 9), i) for i, x in distinct)[:20]


def test_ann_edges(spark):
    rng = np.random.default_rng(0)
    same = [20 * float(x) for x in rng.normal(size=8)]
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(40)] + [(100 + i, same) for i in range(60)]
    rows += [(200, None), (220, [0.0] * 8), (240, [1.0] * 3), (260, [float("nan")] * 8), (280, [None] * 8), (None, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = hilbert_ann.search(df, lambda i: i % 20 == 0, target=1.0).toPandas().sort_values(["query_id", "rank"])
    assert set(out["query_id"]) == {0, 20, 100, 120, 140}
    hot = out[out["query_id"] == 120]
    assert list(hot["vec_id"]) == [i for i in range(100, 121) if i != 120] and list(hot["rank"]) == list(range(1, 21))
    assert hilbert_ann.search(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 105), (105, 103), (200, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 105: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    hubs = [(0, i) for i in range(1, 200)] + [(i, 900) for i in range(300, 500)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(hubs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(200)} | {i: 300 for i in [*range(300, 500), 900]}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        rows = spark.createDataFrame(kept.toPandas(), kept.schema)
        assert rows.count() <= before.count()
        kept = rows
    assert kept.where("text rlike 'AKIA[A-Z0-9]{12}'").count() == 0
    assert kept.count() > 0.5 * docs.count()
    assert corpus_pipeline.STAGES[4][1](spark, kept, SF).groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_repeated_rows_are_one_document(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, "something else is written in this one", "en", "s", 1), (None, text + " x", "en", "s", 1)]
    out = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(rows, schema), SF)
    assert out.columns == schema.names and sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 3]


A, B, C, D = ("the first text that is told apart", "another one which has its own words here", "some third text about nothing at all today", "a fourth one that is like none of the others")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dedup_stage_with_repeated_ids(spark, parts):
    """Only rows whose text is another's duplicate go, whoever shares their ids."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(0, B), (1, A), (1, B), (5, C), (5, D), (7, C), (None, B), (None, B), (8, ""), (8, ""), (9, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], schema).repartition(parts)
    out = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect())
    assert out == sorted([(0, B), (1, A), (5, C), (5, D), (-1, B), (-1, B), (8, ""), (8, ""), (9, ""), (9, "")])
    # Of equal ids and texts the row with the least hash of all columns stays, in every run.
    same = [(3, A, "en", f"s{k}", k) for k in range(9)] + [(4, A, "en", "s", 1), (3, D, "en", "s", 2)]
    out = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(same, schema).repartition(parts), SF).collect()
    least = spark.createDataFrame(same[:9], schema).selectExpr("min_by(n_chars, xxhash64(struct(*))) AS n").first()["n"]
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out) == sorted([(3, A, least), (3, D, 2)])


def test_pipeline_edges(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the same words here and there now", "en", "s", 1), (4, "the same words here and there now", "en", "s", 1), (None, "some other text", "en", None, 3)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in df.collect())
    assert ids(stage["language_id"](spark, docs, SF)) == [-1, 3, 4]  # without letters there is no language
    assert ids(stage["toxicity"](spark, docs, SF)) == [-1, 1, 2, 3, 4]
    assert ids(stage["minhash_dedup"](spark, docs, SF)) == [-1, 1, 2, 3]
    assert ids(stage["secret_scan"](spark, docs, SF)) == [-1, 1, 2, 3, 4]
    assert ids(stage["best_fit_packing"](spark, docs, SF)) == [-1, 1, 2, 3, 4]
