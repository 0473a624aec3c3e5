from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from armlens.llm import alignment

SF = "/root/testdata/sf0.001"


def tokens(texts):
    """Ids and byte strings of both sides, from the libraries and the vocabularies' own names."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    sides = alignment.public_sides()
    a, b = Tokenizer.from_file(sides.a), sentencepiece.SentencePieceProcessor(model_file=sides.b)
    a.encode_special_tokens = True
    signs = alignment._byte_of_sign()
    assert len(signs) == 256 and decoders.ByteLevel().decode(["Ġa"]) == " a" and signs["Ġ"] == 32
    for text in texts:
        if not text:
            yield [], []
            continue
        in_a = [(t.id, bytes(signs[c] for c in a.id_to_token(t.id))) for t in map(lambda i: type("T", (), {"id": i}), a.encode(" " + text, add_special_tokens=False).ids)]
        in_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            in_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(x for _, x in in_a) == whole == b"".join(x for _, x in in_b)
        yield (in_a, in_b) if same else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts):
    """All pairs of tokens of a text are compared."""
    found, corpus = [], Counter()
    for a, b in tokens(texts):
        a, b = spans(a), spans(b)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        corpus.update(links)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, begin = [], 0
        for end in ends:
            inside = lambda side: ",".join(str(x[0]) for x in side if begin <= x[1] and x[2] <= end)  # noqa: B023, E731
            groups.append(f"{inside(a)}|{inside(b)}")
            begin = end
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in corpus.items():
        best[y] = max(best[y], n)
    return [(na, nb, ng, len(links), sum(corpus[p] == best[p[1]] for p in links), sum(corpus[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for na, nb, ng, links, g in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  two  blanks ", "a▁mark", "café naïve", "日本語の文", "<|endoftext|> plain", "<s>x</s><0x41>", "\U0001f600 smile \U0001f469‍\U0001f469", "tabs\tand\nlines\r\n", "\x00nul", "é apart", " hard", "0123456789 3.14", "x" * 300]


@pytest.mark.parametrize("head", [0, 7, alignment.HEAD])
def test_same_as_brute_force(spark, head):
    rng = random.Random(5)
    alphabet = "ab cdé ß中\n<>|.\U0001f600"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(60)]
    texts += texts[-5:]  # repeated rows
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.digests(df.repartition(3), head=head).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1500")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.digests(docs).collect()}
    assert len(got) > 50 and got == {r["doc_id"]: x for r, x in zip(rows, brute([r["text"] for r in rows]), strict=True)}


def test_links_and_groups(spark):
    texts = [t for t in ODD if t] + ["the quick brown fox"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r, (a, b) in zip(sorted(alignment.align(df).collect()), tokens(texts), strict=True):
        assert r["a_ids"] == [i for i, _ in a] and r["b_ids"] == [i for i, _ in b]
        x, y = spans(a), spans(b)
        assert [tuple(p) for p in r["links"]] == [(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if p[1] < q[2] and q[1] < p[2]]
        ends = sorted({p[2] for p in x} & {q[2] for q in y})
        assert r["a_groups"] == [sum(e < p[2] for e in ends) for p in x] and r["b_groups"] == [sum(e < q[2] for e in ends) for q in y]


def test_side_a_is_the_library_tokenizer():
    """For every code point, long runs and special tokens."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.public_sides().a)
    a.encode_special_tokens = True
    fast = alignment.aligner(alignment.public_sides()).a
    texts = [" ".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000) for low in range(0, 0x20000, 64)]
    texts += ["x" * 30_000, " " * 30_000 + "y", "\n" * 5000, "ab" * 20_000, "<|endoftext|><|endoftext|>", "it's we'LL 've"]
    for text, want in zip(texts, a.encode_batch(texts, add_special_tokens=False), strict=True):
        assert fast.encode_to_numpy(text, disallowed_special=()).tolist() == want.ids, text[:40]


def test_edges(spark):
    df = spark.createDataFrame([(None, "a text"), (None, "a text"), (3, None), (3, "other")], "doc_id long, text string")
    out = alignment.digests(df).collect()
    assert len(out) == 4 and sum(r["doc_id"] is None and r["n_a"] > 0 for r in out) == 2
    assert [tuple(r[c] for c in COLUMNS) for r in out if r["doc_id"] == 3 and not r["n_a"]] == [(0, 0, 0, 0, 0, 0, "")]
    assert alignment.digests(df.limit(0)).count() == 0 and alignment.align(df.limit(0)).count() == 0
    assert [r["n_links"] for r in alignment.digests(df.where("text is null")).collect()] == [0]
