"""Alignment of two tokenizers over the same bytes.

A text with a blank before it is encoded by a byte-level BPE (side A), the text itself by a SentencePiece model that adds
the blank (side B), so both cover the same bytes. In a batch of texts every token start is looked up among the other
side's starts (``pandas.merge_asof``, keyed by document): it finds the token that covers it. Of two tokens that overlap
the later start lies in the other token, so the union of both directions is all overlaps. Where tokens of both sides end
at the same byte a group ends.

How often a pair of ids is linked is counted over all documents: distinct pairs of each document are kept with their
counts, summed up in tasks and then by shuffle. The commonest pairs (HEAD of them at most) are then looked up where the
documents' pairs are; what is left of the documents is joined with the counts, so no pair is so common that it weighs on
one task, and nothing without a bound is broadcast.

Defined results: texts that are null or empty, or whose tokens' bytes of either side are not the blank and the text,
have no tokens (and then groups_sha256 is ''); rows that occur twice are documents of their own and both count; rows
without an id are aligned too; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_batches

#: Pairs whose counts tasks hold: 17 bytes each.
HEAD = 1 << 18
#: Characters that are aligned at once.
CHARS = 2 << 20
#: The byte-level vocabulary's special token, which no text has as such.
END_OF_TEXT = "<|endoftext|>"
#: Pairs of ids that a task holds before it passes their counts on.
HELD = 1 << 20


class Sides(NamedTuple):
    """Paths of the two vocabularies."""

    a: str
    b: str


def public_sides() -> Sides:
    import public_tokenizers

    return Sides(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the character of that number if it is visible, others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Tokens of several texts, one after another; ``doc`` is a token's or link's text, ``link`` places of tokens."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_doc: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


class Aligner:
    def __init__(self, sides: Sides):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        with open(sides.a) as f:
            vocab = json.load(f)["model"]["vocab"]
        self.b = sentencepiece.SentencePieceProcessor(model_file=sides.b)
        byte = _byte_of_sign()
        # Its ids are in the order of its merges, so they are ranks: another library encodes the same faster (tested).
        ranks = {bytes(map(byte.__getitem__, entry)): i for entry, i in vocab.items() if all(c in byte for c in entry) and entry != END_OF_TEXT}
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            self.a_bytes[i] = entry
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.a_size, self.b_size = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        #: An id with what comes after it: in a group, at a side's end, at a group's end.
        self.shown = [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(n)]
        self.shown_size = n

    def align(self, texts: list[str | None]) -> Aligned:
        wanted = [k for k, t in enumerate(texts) if t]
        found_b = self.b.encode([texts[k] for k in wanted], num_threads=1)
        a_ids, b_ids, docs = [], [], []
        for k, in_b in zip(wanted, found_b, strict=True):
            whole = b" " + texts[k].encode()
            in_a = self.a.encode_to_numpy(" " + texts[k], disallowed_special=()).astype(np.int64)
            # Side A only cuts bytes apart, so their number tells.
            if self.a_size[in_a].sum() == len(whole) and b"".join(map(self.b_bytes.__getitem__, in_b)) == whole:
                docs.append(k)
                a_ids.append(in_a)
                b_ids.append(np.array(in_b, np.int64))
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *a_ids]), np.concatenate([none, *b_ids])
        a_doc, b_doc = (np.repeat(np.array(docs, np.int64), list(map(len, side))) for side in (a_ids, b_ids))
        # Texts stand one after another, so places are sorted over all of them.
        a_end, b_end = self.a_size[a].cumsum(), self.b_size[b].cumsum()
        left = pd.DataFrame({"doc": a_doc, "start": a_end - self.a_size[a], "a": np.arange(len(a))})
        right = pd.DataFrame({"doc": b_doc, "start": b_end - self.b_size[b], "b": np.arange(len(b))})
        of_a = pd.merge_asof(left, right, on="start", by="doc")["b"].to_numpy(np.int64)
        of_b = pd.merge_asof(right, left, on="start", by="doc")["a"].to_numpy(np.int64)
        later = right["start"].to_numpy() > left["start"].to_numpy()[of_b]  # equal starts are found from both sides
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        group_doc = b_doc[np.searchsorted(b_end, ends)]
        return Aligned(a, b, a_doc, b_doc, a_group, b_group, group_doc, np.concatenate([left["a"].to_numpy(), of_b[later]]), np.concatenate([of_a, right["b"].to_numpy()[later]]))

    def written(self, x: Aligned, n: int) -> list[bytes]:
        """The groups of each of n texts, as ``a1,a2|b1;a3|b2,b3``."""
        a_of, b_of = (np.bincount(g, minlength=len(x.group_doc)) for g in (x.a_group, x.b_group))
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (x.a_group, x.b_group))
        codes = np.empty(len(x.a_ids) + len(x.b_ids), np.int64)
        codes[np.arange(len(x.a_ids)) + (b_of.cumsum() - b_of)[x.a_group]] = x.a_ids + self.shown_size * last_a
        codes[np.arange(len(x.b_ids)) + a_of.cumsum()[x.b_group]] = x.b_ids + 2 * self.shown_size * last_b
        ends = (np.bincount(x.a_doc, minlength=n) + np.bincount(x.b_doc, minlength=n)).cumsum().tolist()
        signs = list(map(self.shown.__getitem__, codes.tolist()))
        return [b"".join(signs[begin:end])[:-1] for begin, end in zip([0, *ends], ends, strict=False)]


_ALIGNERS: dict[Sides, Aligner] = {}


def aligner(sides: Sides) -> Aligner:
    if sides not in _ALIGNERS:
        _ALIGNERS[sides] = Aligner(sides)
    return _ALIGNERS[sides]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch of about CHARS characters at most, with their texts; a longer text is one of its own."""
    texts = batch.column("text").to_pylist()
    begin, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t or "") > CHARS:
            yield batch.slice(begin, k - begin), texts[begin:k]
            begin, held = k, 0
        held += len(t or "")
    if begin < len(texts):
        yield batch.slice(begin), texts[begin:]


def _split(values: np.ndarray, doc: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(values, np.bincount(doc, minlength=n).cumsum()[:-1]) if n else []


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sides: Sides | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, a_groups, b_groups (each token's group), links (places of the tokens of both sides)."""
    sides = sides or public_sides()
    text_batches(docs.sparkSession)
    schema = "doc_id long, a_ids array<long>, b_ids array<long>, a_groups array<long>, b_groups array<long>, links array<struct<a:long,b:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                x, n = aligner(sides).align(texts), len(texts)
                first = [np.searchsorted(doc, np.arange(n)) for doc in (x.a_doc, x.b_doc, x.group_doc)]
                order = np.lexsort((x.link_b, x.link_a))
                link_a, link_b = x.link_a[order], x.link_b[order]
                link_doc = x.a_doc[link_a]
                columns = [_split(v, d, n) for v, d in ((x.a_ids, x.a_doc), (x.b_ids, x.b_doc), (x.a_group - first[2][x.a_doc], x.a_doc), (x.b_group - first[2][x.b_doc], x.b_doc))]
                places = pa.StructArray.from_arrays([pa.array(link_a - first[0][link_doc]), pa.array(link_b - first[1][link_doc])], ["a", "b"])
                ends = np.concatenate([[0], np.bincount(link_doc, minlength=n).cumsum()]).astype(np.int32)
                lists = [pa.array(c, pa.list_(pa.int64())) for c in columns]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists, pa.ListArray.from_arrays(pa.array(ends), places)], ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "links"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Rising pairs and how often each occurs: differences compress better."""
    return pa.compress(np.concatenate([np.diff(pairs, prepend=0), times]).astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), "<u4").astype(np.int64)
    return both[:n].cumsum(), both[n:]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _summaries(docs: DataFrame, sides: Sides) -> DataFrame:
    """row, doc_id, counts, groups_sha256, and the document's distinct pairs of ids (n_pairs of them, packed)."""
    names = ["row", "doc_id", *_COUNTS, "groups_sha256", "n_pairs", "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                it, n = aligner(sides), len(texts)
                x = it.align(texts)
                link_doc = x.a_doc[x.link_a]
                # A pair is A's id and B's, 16 bits each, below the text's number.
                keys, times = np.unique((link_doc << 32) | (x.a_ids[x.link_a] << 16) | x.b_ids[x.link_b], return_counts=True)
                pairs = _split(keys & 0xFFFFFFFF, keys >> 32, n)
                packed = [_packed(p, t) for p, t in zip(pairs, _split(times, keys >> 32, n), strict=True)]
                counts = [pa.array(np.bincount(d, minlength=n)) for d in (x.a_doc, x.b_doc, x.group_doc, link_doc)]
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in it.written(x, n)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(list(map(len, pairs)), pa.int32()), pa.array(packed, pa.binary())], names)

    schema = "row long, doc_id long, " + "".join(f"{c} long, " for c in _COUNTS) + "groups_sha256 string, n_pairs int, pairs binary"
    return docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text").mapInArrow(run, schema)


def pair_counts(summaries: DataFrame) -> DataFrame:
    """pair, n (its links over all documents), best (no pair of the same B id has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def summed(new_pairs: list[np.ndarray], new_times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            p, at = np.unique(np.concatenate([pairs, *new_pairs]), return_inverse=True)
            return p, np.bincount(at, np.concatenate([times, *new_times]), len(p)).astype(np.int64)

        for batch in batches:
            each = [_unpacked(d, n) for d, n in zip(batch.column("pairs").to_pylist(), batch.column("n_pairs").to_pylist(), strict=True)]
            pairs, times = summed([p for p, _ in each], [t for _, t in each])
            if len(pairs) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])
                pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])

    counts = cut(summaries.select("n_pairs", "pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFF)).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head(counts: DataFrame, head: int) -> tuple[DataFrame, bool]:
    """The commonest pairs, at most ``head`` of them, and whether there are others: cut at a power of 2 ** (1 / 8)."""
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect()
    held, least = 0, None
    for r in levels:
        if held + r["k"] > head:
            return counts.where(F.lit(False) if least is None else level >= least), True
        held, least = held + r["k"], r["level"]
    return counts, False


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sides: Sides | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: a row for each row.

    n_best: links whose pair of ids is as often linked, over all documents, as any pair of the B id. count_sum: the sum
    of these counts over the document's links."""
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = cut(_summaries(docs, sides or public_sides()))
    counts = cut(pair_counts(base))
    common, more = _head(counts, head)
    table = common.toArrow()
    order = np.argsort(table.column("pair").to_numpy())
    known = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
    names = ["row", "doc_id", *_COUNTS, "groups_sha256", "n_best", "count_sum", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n_of, best_of = known.value
        for batch in batches:
            best, total, rest = [], [], []
            for data, n in zip(batch.column("pairs").to_pylist(), batch.column("n_pairs").to_pylist(), strict=True):
                p, times = _unpacked(data, n)
                at = np.searchsorted(pair, p)
                hit = at < len(pair)
                hit[hit] = pair[at[hit]] == p[hit]
                at, of = at[hit], times[hit]
                best.append(int(of[best_of[at]].sum()))
                total.append(int((of * n_of[at]).sum()))
                rest.append([] if hit.all() else [{"pair": a, "times": b} for a, b in zip(p[~hit].tolist(), times[~hit].tolist(), strict=True)])
            columns = [batch.column(c) for c in names[:-3]]
            kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.int64()), pa.array(total, pa.int64()), pa.array(rest, kind)], names)

    schema = "row long, doc_id long, " + "".join(f"{c} long, " for c in _COUNTS) + "groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,times:long>>"
    found = base.mapInArrow(run, schema)
    if more:
        found = cut(found)
        left = found.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.times")
        of = F.col("times") * F.col("n")
        # Documents, pairs and counts all grow with the input: nothing is broadcast.
        added = left.hint("merge").join(counts, "pair").groupBy("row").agg(F.sum(of).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
        found = found.hint("merge").join(added, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
    return found.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
