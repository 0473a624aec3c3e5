from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from armlens.llm import repeated_windows as rw

SF = "/root/testdata/sf0.01"


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, sha256) of each row: windows in order, each looked up among those before it."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        raw = (rows[k][1] or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                covered[p : p + length] = b"\x01" * length
            seen.add(window)
        left = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        spans = sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered))
        out[k] = (len(raw), sum(covered), spans, hashlib.sha256(left).hexdigest())
    return out


def answer(df, **how):
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"])) for r in rw.remove_repeats(df, **how).collect()]


def same(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, doc string").repartition(parts)
    assert dict(answer(df, **how)) == {rows[k][0]: x for k, x in brute(rows, how.get("length", 100)).items()}


def test_hash_of_windows_is_of_their_bytes():
    data = np.frombuffer(b"the same bytes ... the same bytes ... other", np.uint8)
    for k in (1, 3, 7, 8, 14):
        h, strings = rw._rolling(data, k), [bytes(data[i : i + k]) for i in range(len(data) - k + 1)]
        assert len(h) == len(strings) and len({(a, b) for a, b in zip(h.tolist(), strings, strict=True)}) == len(set(strings)) == len(set(h.tolist()))
    for v in (5, 8, 13):
        x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
        assert rw._least(x, v).tolist() == [min(x[i : i + v]) for i in range(51 - v)]


@pytest.mark.parametrize("piece", [7, 64, 1 << 18])
def test_runs_cover_every_window_once(monkeypatch, piece):
    monkeypatch.setattr(rw, "PIECE", piece)
    rng = random.Random(piece)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(60))) for _ in range(40)] + [b"", b"x" * 200, b"ab" * 90]
    ends = np.cumsum([len(t) for t in texts])
    doc, start, n, _, _ = rw.runs(np.frombuffer(b"".join(texts), np.uint8), ends, 20, 6)
    found = sorted((d, s + i) for d, s, m in zip(doc.tolist(), start.tolist(), n.tolist(), strict=True) for i in range(m))
    assert found == [(d, int(ends[d]) - len(t) + p) for d, t in enumerate(texts) for p in range(len(t) - 19)]


@pytest.mark.parametrize("crowd,together,held", [(64, 512, 1 << 20), (1, 512, 30), (64, 1, 30), (2, 3, 500)])
def test_random_texts(spark, monkeypatch, crowd, together, held):
    """Every way a run may take, with few letters, so that windows repeat within and across texts."""
    for name, value in (("CROWD", crowd), ("TOGETHER", together), ("HELD", held)):
        monkeypatch.setattr(rw, name, value)
    rng = random.Random(crowd * 1000 + together)
    pool = ["".join(rng.choices("abcdefgh é", k=rng.randrange(8, 60))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randrange(6)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "a" * 300), (103, "a" * 40), (104, "ab" * 200), (105, pool[0] * 9), (106, rows[5][1]), (107, rows[5][1] + "z")]
    rng.shuffle(rows)
    same(spark, rows, length=20, digit=6)
    same(spark, rows, parts=1, length=13, digit=13)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert dict(answer(docs)) == {rows[k][0]: x for k, x in brute(rows, 100).items()}


def test_common_passage(spark, monkeypatch):
    """A passage that every document has, with other words around it each time."""
    monkeypatch.setattr(rw, "TOGETHER", 16)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    passage = some(40)
    rows = [(i, f"{some(12)} {passage} {some(12)}") for i in range(300)]
    same(spark, rows, parts=8)
    out = dict(answer(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0][1] == 0 and all(out[i][1] >= len(passage) and out[i][2] == 1 for i in range(1, 300))


def test_order_nulls_and_repeated_ids(spark):
    a, b = "first text " * 30, "".join(map(chr, range(200, 400)))
    rows = [(None, b), (5, b), (7, b), (-3, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    size = len(b.encode())
    assert {i: x[1] for i, x in answer(df)} == {-3: 0, 5: size, 7: size, None: size}
    # Equal rows are copies of one; rows that share an id only are judged in one order, whatever the partitions.
    rows = [(1, b), (1, b), (1, b), (1, b + "x"), (1, "short"), (1, "short"), (2, None), (2, ""), (3, a)]
    for parts in (1, 3, 7):
        got = sorted(x for _, x in answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)))
        assert len(got) == 9 and sorted(x[1] for x in got if x[0] == size) in ([size, size, size], [0, size, size])
        first = next(x for x in got if x[0] == size + 1)
        assert (first[1] == 0) == (sum(x[1] == size for x in got) == 3) and [x[1] for x in got if x[0] == 5] == [0, 0]
    kept = rw.remove_repeats(spark.createDataFrame([(1, a), (2, a + "end")], "doc_id long, text string"), with_kept=True).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in kept)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rw.remove_repeats(empty).count() == 0
