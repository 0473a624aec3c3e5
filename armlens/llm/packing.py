"""Packing of tokenised documents into sequences of a fixed size.

A linear grouping scheme. Documents are cut into pieces of at most ``size`` tokens; the number of pieces of each
length is a table of at most ``size`` rows, and only that table is seen by the driver. There

1. lengths above ``size / 8`` are dealt, in order, to groups of equal cardinality and rounded up to the largest of
   their group,
2. the least number of sequences for these few sizes is found by a linear program over configurations (column
   generation with a knapsack for the price), of which whole multiples are used,
3. real lengths take the place of the rounded ones, the longest of the group first; the last place of a sequence
   takes the length that fills it best, and
4. what is left, and all short pieces, goes to the fullest sequence with room for it (best fit, longest first).

The plan is a table of runs: the k-th to (k + count)-th piece of a length go to the sequences from ``sequence`` on,
each at the same ``offset``. Spark ranks the pieces of a length (salted, so that a length that many pieces have is
ranked by many tasks) and looks the rank up among the runs. No document, id or piece passes the driver.

Defined results: a null or empty text is one piece that holds the end id only; rows that occur twice are packed
twice; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_batches

#: White space of the tokenizer's patterns (Unicode's White_Space property) beside the ASCII one (\x1c to \x1f aren't).
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_VISIBLE = {b: chr(b) for b in _PRINTED} | {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_POINTS = ".,!?;:"


class WordEncoder:
    """Token ids of whole texts by the ids of their words.

    The tokenizer drops white space before anything else, so a text's ids are those of its words one after another.
    Each distinct word is encoded once while it stays in a bounded cache, whose keys are the words' own bytes and which
    a Python worker keeps from task to task.
    """

    def __init__(self, path: str, limit: int = 400_000, limit_bytes: int = 64 << 20):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model, self.limit, self.limit_bytes = Tokenizer.from_file(path), limit, limit_bytes
        self.direct = Tokenizer(self.model.model)
        self.direct.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        (self.mark,) = self._ids(self.model, "\x1c")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # a word -> its place in begin and count
        self.held = 0  # bytes of the words
        self.pool, self.begin, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, model, text: str) -> np.ndarray:
        return np.array(model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _many(self, model, words: list[str], mark: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of the words, and how many each has: many are encoded at a time, with marks between them."""
        ids_of, sizes = [], []
        for begin in range(0, len(words), 256):
            some = words[begin : begin + 256]
            ids = self._ids(model, mark.join(some))
            marks = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(marks) == len(some):
                sizes.append(np.diff(marks, prepend=-1) - 1)
                ids_of.append(ids[ids != self.mark])
            else:  # the mark is in a word
                each = [self._ids(model, word) for word in some]
                sizes.append(np.array([len(x) for x in each]))
                ids_of += each
        return ids_of, sizes

    def _learn(self, words: list[bytes]) -> None:
        """Letters with points after them go to the tokenizer's model directly, in the form its first steps give them."""
        plain, odd, plain_words, odd_words = [], [], [], []
        for raw in words:
            word = raw.decode()
            stem = word.rstrip(_POINTS)
            if not stem.isalpha() or "İ" in stem or "Σ" in stem or not is_normalized("NFC", stem):
                odd.append(word)
                odd_words.append(raw)
                continue
            form = stem.lower()
            if not form.isascii():
                form = form.encode().decode("latin-1").translate(_VISIBLE)
            plain.append(f"{form} {word[len(stem) :]}" if len(stem) < len(word) else form)
            plain_words.append(raw)
        some, counts = self._many(self.direct, plain, f" {_VISIBLE[28]} ")
        more, odd_counts = self._many(self.model, odd, " \x1c ")
        self.known.update(zip(plain_words + odd_words, range(len(self.count), len(self.count) + len(words)), strict=True))
        self.held += sum(map(len, words))
        self.pool = np.concatenate([self.pool, *some, *more])
        self.count = np.concatenate([self.count, *counts, *odd_counts])
        self.begin = self.count.cumsum() - self.count

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not texts:
            return []
        if len(self.known) > self.limit or self.held > self.limit_bytes:
            self._forget()
        raw = [(_WIDE_SPACE.sub(" ", t) if not t.isascii() and _WIDE_SPACE.search(t) else t).encode("utf-8", "replace") if t else b"" for t in texts]
        each = [r.split() for r in raw]  # bytes are split at ASCII white space only
        words = list(chain.from_iterable(each))
        place = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        if len(unknown := np.flatnonzero(place < 0).tolist()):
            self._learn(list(dict.fromkeys(words[i] for i in unknown)))
            place[unknown] = [self.known[words[i]] for i in unknown]
        count = self.count[place]
        after = count.cumsum()
        ids = self.pool[np.repeat(self.begin[place] - after + count, count) + np.arange(after[-1] if len(after) else 0)].tobytes()
        # Where each text ends: in words, in bytes of ids.
        cuts = np.concatenate(([0], after))[np.cumsum([len(x) for x in each])] * 4
        return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None, end_id: int = 1, size: int = 4096, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): a row for each piece of at most ``size`` tokens.

    Only the tokenizer's path goes to the workers.
    """
    path = tokenizer or tokenizer_path()
    text_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work to the cores
        encoder, end = _encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                for piece, begin in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[begin : begin + 4 * size]
                    rows.append((doc_id, piece, begin // 4, len(part) // 4, zlib.crc32(part), part)[: 5 + with_ids])
            columns = list(zip(*rows, strict=True)) or [()] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names[: 5 + with_ids])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(encode, schema)


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """(how many of each size, how often) of the linear program min sum(x), A x >= demand, by column generation."""
    g = len(sizes)
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    x = np.linalg.solve(basis, demand.astype(float))
    most = int(capacity // sizes.min())
    for _ in range(60 * g):
        price = np.linalg.solve(basis.T, np.ones(g))
        # The dearest set of sizes that fits: value[c] with room c, one more item in each round.
        value, choice = np.zeros(capacity + 1), []
        for _ in range(most):
            grown, taken = value.copy(), np.full(capacity + 1, -1)
            for k in np.flatnonzero(price > 1e-9):
                s = int(sizes[k])
                better = value[: capacity + 1 - s] + price[k]
                gain = better > grown[s:] + 1e-12
                grown[s:][gain], taken[s:][gain] = better[gain], k
            choice.append(taken)
            if np.array_equal(grown, value):
                break
            value = grown
        if value[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(g), capacity
        for taken in reversed(choice):
            if (k := taken[room]) >= 0:
                column[k] += 1
                room -= int(sizes[k])
        direction = np.linalg.solve(basis, column)
        positive = direction > 1e-9
        ratio = np.where(positive, x / np.where(positive, direction, 1), np.inf)
        leave = int(ratio.argmin())
        step = max(0.0, ratio[leave])
        x = x - step * direction
        x[leave] = step
        basis[:, leave] = column
    return [(np.rint(basis[:, k]).astype(int), float(x[k])) for k in range(g) if x[k] > 1e-9]


class _Plan:
    """Classes of alike sequences: (number of sequences, room left, lengths placed)."""

    def __init__(self, size: int):
        self.size = size
        self.by_room: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(size + 1)]

    def add(self, count: int, placed: tuple[int, ...]) -> None:
        if count:
            self.by_room[self.size - sum(placed)].append((count, placed))

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces of one length each into the fullest sequence with room for it, or into new ones."""
        room = length
        while count:
            while room <= self.size and not self.by_room[room]:
                room += 1
            if room > self.size:
                each = self.size // length
                full, rest = divmod(count, each)
                self.add(full, (length,) * each)
                self.add(min(rest, 1), (length,) * rest)
                return
            bins, placed = self.by_room[room].pop()
            each = room // length  # the fullest sequence stays the fullest until it has no room left
            full = min(bins, count // each)
            rest = min(bins - full, 1) * min(each - 1, count - full * each)
            self.add(full, placed + (length,) * each)
            self.add(min(rest, 1), placed + (length,) * rest)
            self.add(bins - full - min(rest, 1), placed)
            count -= full * each + rest

    def runs(self) -> Iterator[tuple[int, int, int, int, int]]:
        """length, first rank, count, first sequence, offset."""
        rank: dict[int, int] = {}
        sequence = 0
        for classes in self.by_room:
            for count, placed in classes:
                offset = 0
                for length in placed:
                    yield length, rank.get(length, 0), count, sequence, offset
                    rank[length] = rank.get(length, 0) + count
                    offset += length
                sequence += count


def plan_runs(histogram: dict[int, int], size: int = 4096, groups: int = 64) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) for so many pieces of each length."""
    plan = _Plan(size)
    left = {k: v for k, v in histogram.items() if v}
    large = sorted((k for k in left if k > size // 8), reverse=True)
    if large:
        counts = np.array([left[k] for k in large])
        # Equal cardinality: a length goes to the group of the middle of its pieces.
        group = np.minimum(groups - 1, (counts.cumsum() - counts / 2) * groups // counts.sum()).astype(int)
        members = [[k for k, at in zip(large, group, strict=True) if at == b] for b in np.unique(group)]
        sizes = np.array([m[0] for m in members])
        demand = np.array([sum(left[k] for k in m) for m in members])
        there = sorted(large)

        def longest(room: int, floor: int) -> int:
            """The longest length left that fits into the room, if it is at least floor long."""
            at = bisect.bisect_right(there, room)
            return there[at - 1] if at and there[at - 1] >= floor else 0

        for pattern, times in _configurations(sizes, demand, size):
            slots = [b for b, n in enumerate(pattern) for _ in range(n)]
            times = int(times + 1e-6)
            while times and slots:
                placed: list[int] = []
                for at, b in enumerate(slots):
                    # A slot takes the longest of its group, and the last one what fills the sequence best.
                    room = size - sum(placed)
                    k = longest(room if at == len(slots) - 1 else min(room, int(sizes[b])), members[b][-1])
                    if k and left[k] > placed.count(k):
                        placed.append(k)
                if not placed:
                    break
                # As many alike sequences as these lengths last for.
                count = min(times, *(left[k] // placed.count(k) for k in placed))
                for k in placed:
                    left[k] -= count
                for k in set(placed):
                    if not left[k]:
                        there.remove(k)
                plan.add(count, tuple(placed))
                times -= count
    for length in sorted(left, reverse=True):
        if left[length]:
            plan.best_fit(length, left[length])
    return list(plan.runs())


def assign(pieces: DataFrame, *, size: int = 4096, groups: int = 64, rows_per_task: int = 200_000) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (columns length, doc_id, piece and any others)."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.createDataFrame(plan_runs(histogram, size, groups), "length long, first long, many long, base long, offset long")
    # A length that half of all pieces share is ranked in so many parts.
    parts = max(16, sum(histogram.values()) // rows_per_task + 1)
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("skipped"))
    # The runs of a length in one row: at most a few for each configuration, so a few thousand in all.
    table = runs.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "many", "base", "offset"))).alias("runs"))
    hit = F.element_at(F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["first"] + r["many"])), 1)
    placed = ranked.join(F.broadcast(table), "length").withColumn("run", hit)
    return placed.select(*pieces.columns, (F.col("run.base") + F.col("rank") - F.col("run.first")).alias("sequence_id"), F.col("run.offset").alias("offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut(tokenize_pieces(docs, id_col, text_col, size=settings.get("size", 4096)))
    return assign(pieces, **settings)
