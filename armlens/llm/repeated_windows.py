"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

A byte goes if it is covered by a window (``length`` bytes, within one document) whose bytes also start earlier: in a
document with a smaller id, or further to the front of the same one. So suffixes need an order only through ``length``
bytes: suffixes that are equal that far are the repeated windows, and all but the first of such a group are covered.

1. First digit. The ``digit`` bytes with the least hash of all those in a window are its first digit; equal windows
   have equal ones, at the same place. Neighbouring suffixes mostly share it, so what is dealt out is not suffixes but
   runs of them: the digit, a hash of all bytes of the run's windows, and where it stands. Runs whose digit nobody else
   has are done. Of runs that are equal all but the first are repeated as a whole.
2. Runs that share their digit, but aren't equal, are dealt out by it with their bytes. In a task their windows are
   ordered by the most significant eight bytes, then within groups by the next eight, and so on; a window that is alone
   in its group is done. Groups that are left after ``length`` bytes are repeated windows.
3. A digit that very many different runs have (the bytes before and after a common passage) isn't brought together:
   their windows are dealt out one by one, by a hash of all their bytes.

A task drops its own repeats before anything is shuffled, so of a run or a window that a third of all documents have
each task passes on one for every HELD. Runs are told apart by 128 bits of hashes, windows of step 2 by their bytes.

Defined results: null texts are empty ones; texts shorter than a window are left alone; rows without an id come after
all others. Rows that share an id are documents of their own, in the order of a hash of their texts; of rows that are
equal the first is as it would be alone, the others are copies of it. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_batches

#: Suffixes that are hashed at once.
PIECE = 1 << 18
#: Runs or windows of a task that are compared before they are passed on.
HELD = 1 << 20
#: Different runs of a digit in HELD of them above which they aren't brought together.
CROWD = 64
#: Different runs of a digit that are ordered in one task.
TOGETHER = 512

_FACTOR, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x *= _M1
    x ^= x >> _U(33)
    x *= _M2
    x ^= x >> _U(33)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)


def _power(n: int) -> np.uint64:
    return _U(pow(int(_FACTOR), n, 1 << 64))


_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_FACTOR ** 0, 1, 2 ... modulo 2 ** 64, and their inverses."""
    global _POWERS
    if len(_POWERS[0]) < n:
        inverse = _U(pow(int(_FACTOR), -1, 1 << 64))
        _POWERS = tuple(np.cumprod(np.r_[_U(1), np.full(n - 1, f)]) for f in (_FACTOR, inverse))
    return _POWERS[0][:n], _POWERS[1][:n]


def _rolling(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each place on, put together from those of 1, 2, 4 ... bytes."""
    h, width, out, done = _BYTE[data], 1, None, 0
    while True:
        if k & width:
            if out is None:
                out = h
            else:
                n = len(h) - done
                out = out[:n] * _power(width)
                out += h[done : done + n]
            done += width
        if width * 2 > k:
            return out[: len(data) - k + 1]
        n = len(h) - width
        new = h[:n] * _power(width)
        new += h[width:]
        h, width = new, width * 2


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """The least of w neighbours from each place on."""
    width = 1
    while width * 2 <= w:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    return v if width == w else np.minimum(v[: len(v) - (w - width)], v[w - width :])


def runs(data: np.ndarray, ends: np.ndarray, length: int, digit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc, start, n, key, check of the runs of suffixes that share their first digit.

    ``data`` is the bytes of several documents, which end at ``ends``. A run is n suffixes from ``start`` (in data) on;
    ``key`` is the hash of their digit and ``check`` that of all their windows' bytes.
    """
    w, parts = length - digit + 1, []
    begins = np.concatenate([[0], ends[:-1]])
    for first in range(0, len(data) - length + 1, PIECE):
        piece = data[first : first + PIECE + length - 1]
        if len(piece) < length:
            break
        raw = _rolling(piece, digit)
        mixed = _mix(raw.copy())
        n = len(piece) - length + 1
        # Where the hashes' upper bits are equal the first place counts.
        place = _least((mixed & ~_U(0xFFFFFF)) | np.arange(len(mixed), dtype=np.uint64), w)[:n] & _U(0xFFFFFF)
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(place[1:], place[:-1], out=new[1:])
        lo, hi = np.searchsorted(ends, first, "right"), np.searchsorted(begins, first + n, "left")
        new[begins[lo:hi][(begins[lo:hi] > first)] - first] = True
        closed = ends[lo:hi] - length + 1 - first  # no window of the document starts from here on
        closed = np.maximum(closed, np.maximum(begins[lo:hi] - first, 0))
        new[closed[closed < n]] = True
        starts = np.flatnonzero(new)
        doc = np.searchsorted(ends, starts + first, "right")
        until = np.minimum(np.append(starts[1:], n), ends[doc] - length + 1 - first)
        ok = until > starts
        starts, doc, until = starts[ok], doc[ok], until[ok]
        power, inverse = _powers(len(mixed))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * power)])
        check = (total[until + length - digit] - total[starts]) * inverse[starts]
        key = _mix(raw[place[starts].astype(np.int64)] ^ _SALT)
        parts.append((doc, starts + first, until - starts, key, _mix(check + (until - starts).astype(np.uint64))))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _firsts(key: np.ndarray, check: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal (key, check) the place of the first in order, and the places of the others (repeats of it left out)."""
    order = np.argsort(key ^ (check * _FACTOR), kind="stable")
    mixed = (key ^ (check * _FACTOR))[order]
    again = np.concatenate([[False], mixed[1:] == mixed[:-1]]) if len(order) else np.zeros(0, bool)
    several = again | np.append(again[1:], False) if len(order) else again
    some = order[several]
    some = some[np.lexsort((start[some], tie[some], doc[some], check[some], key[some]))]
    new = np.ones(len(some), bool)
    new[1:] = (key[some][1:] != key[some][:-1]) | (check[some][1:] != check[some][:-1])
    first = some[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(some) else some
    other = ~new & ((doc[some] != doc[first]) | (tie[some] != tie[first]) | (start[some] != start[first]))
    return np.concatenate([order[~several], some[new]]), some[other]


#: Kinds of rows: a run or window to be compared; one that is repeated; a digit of a crowd; a run of a crowd; a run with
#: its bytes.
_ONE, _GONE, _CROWDED, _OF_CROWD, _WITH_BYTES = range(5)
_ROW = ["kind", "key", "check", "doc", "tie", "start", "n"]
_ROW_TYPE = "kind int, key long, check long, doc long, tie long, start int, n int"


def _record(kind, key, check, doc, tie, start, n) -> pa.RecordBatch:
    wide = [np.asarray(x).view(np.int64) for x in (key, check, doc, tie)]
    narrow = [np.asarray(x, np.int32) for x in (start, n)]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(kind, np.int32)), *map(pa.array, wide + narrow)], _ROW)


def _without_local_repeats(rows: list[tuple[np.ndarray, ...]], crowds: bool) -> Iterator[pa.RecordBatch]:
    """What a task passes on of (key, check, doc, tie, start, n): one of each, and which others are repeated."""
    key, check, doc, tie, start, n = (np.concatenate(c) for c in zip(*rows, strict=True))
    first, other = _firsts(key, check, doc, tie, start)
    # What is repeated needs no company, so it may be anywhere.
    anywhere = _mix(doc[other].view(np.uint64) * _FACTOR + start[other].astype(np.uint64))
    yield _record(np.full(len(other), _GONE), anywhere, check[other], doc[other], tie[other], start[other], n[other])
    kind, at = np.full(len(first), _ONE), key[first]
    if crowds:
        each, of, count = np.unique(at, return_inverse=True, return_counts=True)
        many = count[of] > CROWD
        kind[many], at[many] = _OF_CROWD, _mix(at[many] ^ (check[first][many] * _FACTOR))
        digits = each[count > CROWD]
        none = np.zeros(len(digits), np.int64)
        yield _record(none + _CROWDED, digits, none, none, none, none, none)
    yield _record(kind, at, check[first], doc[first], tie[first], start[first], n[first])


def _utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each value ends."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends[1:] - ends[0]


def _screened(docs: DataFrame, place: list[str], length: int, digit: int) -> DataFrame:
    """The columns of ``place``, gone (runs that are repeated), open (runs to be compared by their bytes or windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            data, ends = _utf8(batch.column("text"))
            row, start, n, key, check = runs(data, ends, length, digit)
            doc, tie = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "tie"))
            held.append((key, check, doc, tie, start - np.concatenate([[0], ends])[row], n))
            if sum(len(x[0]) for x in held) > HELD:
                yield from _without_local_repeats(held, True)
                held = []
        if held:
            yield from _without_local_repeats(held, True)

    dealt = docs.select("doc", "tie", "text").mapInArrow(run, _ROW_TYPE).repartition("key")
    same, with_digit = Window.partitionBy("key", "check").orderBy("doc", "tie", "start"), Window.partitionBy("key")
    kind = F.col("kind")
    placed = dealt.withColumn("place", F.rank().over(same)).withColumn("different", F.count_if((kind == _ONE) & (F.col("place") == 1)).over(with_digit))
    # Equal rows of one document (it occurs twice) all have the first place.
    placed = placed.withColumn("check_least", F.min(F.when(kind == _ONE, F.col("check"))).over(with_digit)).withColumn("check_most", F.max(F.when(kind == _ONE, F.col("check"))).over(with_digit))
    placed = placed.withColumn("crowded", F.max(kind == _CROWDED).over(with_digit))
    first = F.col("place") == 1
    crowd = (kind == _OF_CROWD) | ((kind == _ONE) & (F.col("crowded") | (F.col("different") > TOGETHER)))
    few = (kind == _ONE) & (F.col("check_least") != F.col("check_most"))
    fate = F.when(kind == _CROWDED, None).when((kind == _GONE) | ~first, _GONE).when(crowd, _OF_CROWD).when(few, _ONE)
    kept = placed.select("doc", "tie", "key", "start", "n", fate.alias("fate")).where("fate is not null")
    at = F.shiftleft(F.col("start").cast("long"), 32) + F.col("n")
    opened = F.when(F.col("fate") != _GONE, F.struct(F.col("fate").alias("kind"), F.col("key"), at.alias("at")))
    return kept.groupBy(*place).agg(F.collect_list(F.when(F.col("fate") == _GONE, at)).alias("gone"), F.collect_list(opened).alias("open"))


def _window_hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window."""
    whole = _mix(_rolling(data, length))
    short = min(8, length)
    mixed = _mix(_rolling(data, short) ^ _SALT)
    power, inverse = _powers(len(mixed))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * power)])
    n = len(whole)
    return whole, (total[length - short + 1 :][:n] - total[:n]) * inverse[:n]


def _opened(joined: DataFrame, length: int) -> DataFrame:
    """The bytes of open runs, and the windows of runs of a crowd."""
    names = [*_ROW, "bytes"]

    def windows(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        for batch in _without_local_repeats(held, False):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(len(batch), pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            data, ends = _utf8(batch.column("text"))
            opened = batch.column("open")
            of = np.repeat(np.arange(len(batch)), opened.value_lengths().to_numpy())
            kind, key, at = (opened.flatten().field(c).to_numpy() for c in ("kind", "key", "at"))
            doc, tie = (batch.column(c).to_numpy()[of] for c in ("doc", "tie"))
            start, n = at >> 32, at & 0xFFFFFFFF
            begin = start + np.concatenate([[0], ends])[of]
            few = np.flatnonzero(kind == _ONE)
            raw = [data[b : b + m + length - 1].tobytes() for b, m in zip(begin[few].tolist(), n[few].tolist(), strict=True)]
            rows = _record(np.full(len(few), _WITH_BYTES), key[few], np.zeros(len(few), np.int64), doc[few], tie[few], start[few], n[few])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(raw, pa.binary())], names)
            for k in np.flatnonzero(kind == _OF_CROWD).tolist():
                m = int(n[k])
                first, second = _window_hashes(data[begin[k] : begin[k] + m + length - 1], length)
                held.append((first, second, np.full(m, doc[k]), np.full(m, tie[k]), start[k] + np.arange(m), np.ones(m, np.int64)))
            if sum(len(x[0]) for x in held) > HELD:
                yield from windows(held)
                held = []
        if held:
            yield from windows(held)

    return joined.select("doc", "tie", "doc_id", "copies", "text", "open").mapInArrow(run, _ROW_TYPE + ", bytes binary")


def repeated(data: np.ndarray, places: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the windows at these places are equal to others of their group, and a number for each such class.

    By most-significant-digit passes over eight bytes each; what is alone in its class leaves."""
    alive, of = np.arange(len(places)), group.astype(np.int64)
    for depth in range(0, length, 8):
        width = min(8, length - depth)
        value = np.zeros(len(alive), np.uint64)
        for k in range(width):
            value = (value << _U(8)) | data[places[alive] + depth + k]
        order = np.lexsort((value, of))
        alive, of, value = alive[order], of[order], value[order]
        new = np.ones(len(alive), bool)
        new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
        of = np.cumsum(new)
        stay = np.bincount(of)[of] > 1
        alive, of = alive[stay], of[stay]
        if not len(alive):
            break
    return alive, of


def _resolved(opened: DataFrame, place: list[str], length: int) -> DataFrame:
    """The columns of ``place``, more: windows that aren't the first of their group, as runs."""

    def ranges(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((start, tie, doc))
        doc, tie, start, n = doc[order], tie[order], start[order], n[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1] + n[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first) if len(first) else n
        return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(tie[first]), pa.array((start[first] << 32) + total)], ["doc", "tie", "at"])

    def resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        kind, key, check, doc, tie, start, n = (table.column(c).to_numpy().astype(np.int64) for c in _ROW)
        gone = kind == _GONE
        yield ranges(doc[gone], tie[gone], start[gone], n[gone])
        lone = np.flatnonzero(kind == _ONE)
        _, other = _firsts(key[lone].view(np.uint64), check[lone].view(np.uint64), doc[lone], tie[lone], start[lone])
        other = lone[other]
        yield ranges(doc[other], tie[other], start[other], n[other])
        few = np.flatnonzero(kind == _WITH_BYTES)
        if len(few):
            data, ends = _utf8(table.column("bytes").combine_chunks().take(pa.array(few)))
            of = np.repeat(few, n[few])
            within = np.arange(len(of)) - np.repeat(n[few].cumsum() - n[few], n[few])
            alive, group = repeated(data, np.repeat(np.concatenate([[0], ends[:-1]]), n[few]) + within, key[of], length)
            d, t, s = doc[of][alive], tie[of][alive], start[of][alive] + within[alive]
            _, other = _firsts(group.astype(np.uint64), np.zeros(len(group), np.uint64), d, t, s)
            yield ranges(d[other], t[other], s[other], np.ones(len(other), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            kind, key = batch.column("kind").to_numpy(), batch.column("key").to_numpy()
            # The last key of a batch may go on in the next one.
            closed = np.flatnonzero((kind != kind[-1]) | (key != key[-1]))
            cut_at = int(closed[-1]) + 1 if len(closed) else 0
            if held and (held[-1].column("kind")[-1].as_py(), held[-1].column("key")[-1].as_py()) != (kind[0], key[0]):
                yield from resolve(pa.Table.from_batches(held))
                held = []
            if cut_at:
                yield from resolve(pa.Table.from_batches([*held, batch.slice(0, cut_at)]))
                held = []
            held.append(batch.slice(cut_at))
        if held:
            yield from resolve(pa.Table.from_batches(held))

    dealt = opened.repartition("kind", "key").sortWithinPartitions("kind", "key")
    each = dealt.mapInArrow(run, "doc long, tie long, at long")
    return each.groupBy(*place).agg(F.collect_list("at").alias("more"))


def _kept(joined: DataFrame, length: int, with_kept: bool) -> DataFrame:
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"][: 5 + with_kept]
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _utf8(batch.column("text"))
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "copies", "gone", "more")]
            out: list[tuple] = []
            for doc_id, copies, gone, more, begin, end in zip(*columns, [0, *ends.tolist()], ends.tolist(), strict=False):
                text = data[begin:end]
                at = np.array([*(gone or []), *(more or [])], np.int64)
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, at >> 32, 1)
                np.add.at(step, (at >> 32) + (at & 0xFFFFFFFF) + length - 1, -1)
                covered = step[:-1].cumsum() > 0
                edge = np.flatnonzero(np.diff(covered, prepend=False, append=False)).reshape(-1, 2).tolist()
                left = text[~covered].tobytes()
                digest = hashlib.sha256(left).hexdigest()
                out.append((doc_id, len(text), int(covered.sum()), [{"begin": a, "end": b} for a, b in edge], digest, left))
                whole = len(text) >= length  # the copies of a row are gone as a whole, or too short for that
                copy = (doc_id, len(text), len(text), [{"begin": 0, "end": len(text)}], hashlib.sha256(b"").hexdigest(), b"") if whole else out[-1]
                for _ in range(copies - 1):
                    out.append(copy)
                    if len(out) >= 10_000:
                        yield table(out)
                        out = []
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), span, pa.string(), pa.binary()][: 5 + with_kept]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept_sha256 string" + ", kept binary" * with_kept
    return joined.select("doc_id", "copies", "text", "gone", "more").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 100, digit: int = 24, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs of bytes), kept_sha256 (and kept, the bytes that are left).

    A row for each row. ``digit``: bytes of a window's first digit, at most ``length``."""
    digit = min(digit, length)
    text_batches(docs.sparkSession)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(0x7FFFFFFFFFFFFFFF))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), order.alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Where no id occurs twice the id alone is a document's place.
    twice = not given.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    place, tie = (["doc", "tie"], F.xxhash64("text")) if twice else (["doc"], F.lit(0).cast("long"))
    found = cut(_screened(given.withColumn("tie", tie), place, length, digit))
    # Both joins share this exchange of the texts: the columns are the same.
    texts = given.withColumn("tie", tie).groupBy(*place).agg(F.max("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").cast("int").alias("copies"))
    merge = lambda df: df.hint("merge")
    with_open = texts.join(merge(found.where(F.size("open") > 0).select(*place, "open")), place)
    opened = _opened(with_open if twice else with_open.withColumn("tie", tie), length)
    joined = texts.join(merge(found.select(*place, "gone")), place, "left").join(merge(_resolved(opened, place, length)), place, "left")
    return _kept(joined, length, with_kept)
