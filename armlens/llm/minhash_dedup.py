"""Near-duplicate documents by MinHash with fast similarity sketches.

Sketching (Dahlgaard, Knudsen and Thorup's fast similarity sketching): in each of the first t rounds every shingle is
thrown into one of the t coordinates by that round's hash, and a coordinate keeps the least hash of the first round
that reaches it; t further rounds, of which the i-th throws all shingles into the i-th coordinate, fill what is still
empty. So every coordinate is filled, as with t independent hash functions, in about n + t log t steps.

Then documents whose sketches agree in a band are candidates, and a candidate is a link only if the Jaccard similarity
of the full shingle sets reaches the threshold. Candidates of a band's bucket are not paired with each other at once:

1. documents with equal sets are one node;
2. each node of a bucket is checked against a few leaders of it, and verified links are joined to components;
3. only nodes outside the largest component of their bucket are then checked against others of the bucket that are in
   other components and whose set sizes allow the threshold; in buckets of more than SMALL_BUCKET nodes only against
   those that share one of their rarest shingles, early enough, as all that reach the threshold do.

What is not compared is connected already, so the components are those of all candidate pairs; groups of thousands of
near copies take a number of checks that is linear in their size. ``bands`` and ``rows`` decide how likely a link is
to be a candidate at all: with 40 bands of 8 rows a pair at similarity 0.85 is missed with probability 3e-6.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; with fewer words than
``width`` the whole sequence is the one shingle; rows that share an id are documents of their own, with their own texts
(each is in the component of its text, whose name is the smallest id in it); rows without an id are linked with nothing;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BoundedCache, cut, let_go, text_batches
from .components import connected_components

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Nodes of a bucket that are paired directly; in larger ones candidates must share a rare shingle.
SMALL_BUCKET = 16
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, words: BoundedCache, width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles; A-Z are lower-cased, ASCII white space separates words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    k = min(width, len(w))
    n = len(w) - k + 1
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h = _mix(h * _ROLL + w[i : i + n])
    return np.unique(h)


def word_hashes() -> BoundedCache:
    return BoundedCache(xxhash.xxh64_intdigest)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets: one row of t coordinates each, 64-bit."""
    n_docs = len(sets)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_docs * t, empty)
    sizes = np.array([len(s) for s in sets])
    owner, x = np.repeat(np.arange(n_docs), sizes), np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(t):
        h = _mix(x ^ _mix(np.full(1, i + 1, np.uint64) * _ROLL))
        place = owner * t + ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        free = out[place] == empty  # those that an earlier round has reached stay
        # The round is part of the value, so that equal coordinates come from the same shingle and round.
        np.minimum.at(out, place[free], h[free] & np.uint64(0x7FFFFFFFFFFFFFFF))
        left = (out.reshape(n_docs, t) == empty).any(axis=1)
        if not left.any():
            return out.reshape(n_docs, t)
        if not left.all() and i % 4 == 3:
            keep = left[owner]
            owner, x = owner[keep], x[keep]
    out = out.reshape(n_docs, t)
    for d in np.flatnonzero((out == empty).any(axis=1)):
        gaps = np.flatnonzero(out[d] == empty)
        seeds = _mix((gaps + t + 1).astype(np.uint64) * _ROLL)
        for g, seed in zip(gaps, seeds, strict=True):
            out[d, g] = _mix(sets[d] ^ seed).min() & np.uint64(0x7FFFFFFFFFFFFFFF)
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, *, width: int = 5, bands: int = 40, rows: int = 8) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, set_a and set_b (a 128-bit hash of the set), keys (one a band)."""
    text_batches(docs.sparkSession)
    names = ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hashes()
        for batch in batches:
            sets = [shingle_hashes(t, words, width) for t in batch.column(2).to_pylist()]
            full = [s for s in sets if len(s)]
            of = np.zeros((len(full), bands), np.uint64)
            part = 64
            for begin in range(0, len(full), part):
                coordinates = sketch(full[begin : begin + part], bands * rows).reshape(-1, bands, rows)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), coordinates.shape[:2])
                for j in range(rows):
                    key = _mix(key * _ROLL + coordinates[:, :, j])
                of[begin : begin + part] = key
            at, keys = 0, []
            for s in sets:
                keys.append(of[at].view(np.int64) if len(s) else None)
                at += bool(len(s))
            digest = [(_mix(s).sum(dtype=np.uint64), _mix(s + _ROLL).sum(dtype=np.uint64)) for s in sets]
            two = np.array(digest, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(keys, pa.list_(pa.int64()))], names)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col))
    return given.mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hashes()
        sets = BoundedCache(lambda text: shingle_hashes(text, words, width), limit=64)
        for batch in batches:
            linked = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                sa, sb = sets[ta], sets[tb]
                common = len(np.intersect1d(sa, sb, assume_unique=True))
                linked.append(100 * common >= percent * (len(sa) + len(sb) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, percent: int = 85, bands: int = 40, rows: int = 8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the smallest id of each document's component of links.

    ``percent``: the least Jaccard similarity of a link, in hundredths. A row for each row of ``docs``.
    """
    found = grouped(docs, id_col, text_col, width=width, percent=percent, bands=bands, rows=rows)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, percent: int = 85, bands: int = 40, rows: int = 8) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that are near duplicates of a row that stays.

    Of a component the row with the smallest id stays; of those that share it the one with the least hash of its text, and
    of rows with equal id and text the one with the least hash of all columns. What has no duplicate stays, whatever its
    id: rows without an id, and texts without words, are nobody's duplicates.
    """
    found = cut(grouped(docs, id_col, text_col, width=width, percent=percent, bands=bands, rows=rows).where("component is not null").select("component", "component_id", "doc_id", "text_key"))
    let_go(docs.sparkSession)
    own = found.where("doc_id = component_id")
    # A component has one row with its smallest id, unless ids repeat; only then is there more to choose.
    several = own.groupBy("component", "doc_id").agg(F.min("text_key").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = found.where("doc_id <> component_id").select("doc_id", "text_key")
    rest = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"))
    out = lambda gone: rest.join(gone.hint("merge"), ["doc_id", "text_key"], "left_anti")
    if several.isEmpty():
        return out(gone).select("doc.*")
    several = cut(several)
    others = own.join(several.hint("merge"), ["component", "doc_id"]).where("text_key <> first").select("doc_id", "text_key")
    kept = out(gone.union(others))
    # Rows of equal id and text: one of them is taken in tasks first, so of rows that occur very often few are shuffled.
    repeated = several.select("doc_id", F.col("first").alias("text_key"))
    once = kept.join(repeated.hint("merge"), ["doc_id", "text_key"], "left_semi").groupBy("doc_id", "text_key").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return kept.join(repeated.hint("merge"), ["doc_id", "text_key"], "left_anti").select("doc.*").union(once.select("doc.*"))


def grouped(docs: DataFrame, id_col: str, text_col: str, *, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component (a number; null for rows without an id or words), component_id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = cut(sketches(docs, "doc_id", "text", width=width, bands=bands, rows=rows).withColumn("row", F.monotonically_increasing_id()))
    # 1. Equal sets are one node, for which one row with the smallest id stands. Rows have numbers, as ids may repeat.
    same = ["n_shingles", "set_a", "set_b"]
    full = base.where("n_shingles > 0 and doc_id is not null")
    nodes = full.groupBy(*same).agg(F.min(F.struct("doc_id", "row")).alias("s")).select(*same, F.col("s.doc_id").alias("least_id"), F.col("s.row").alias("node"))
    stands = full.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    member = stands.select(F.col("row").alias("node"), F.col("n_shingles").alias("size"), F.explode("keys").alias("key"))

    # 2. Buckets of several nodes, and three leaders of each: the first, the one with the least hash and the largest set.
    bucket = member.groupBy("key").agg(F.min("node").alias("l1"), F.max("node").alias("other"), F.min_by("node", F.xxhash64("node")).alias("l2"), F.max_by("node", "size").alias("l3")).where("l1 <> other").drop("other")
    meeting = cut(member.join(bucket, "key"))
    star = meeting.select("node", F.explode(F.array("l1", "l2", "l3")).alias("leader")).where("node <> leader")
    star = star.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    sizes = meeting.select("node", "size").distinct()
    wanted = stands.select(F.col("row").alias("node"), "doc_id", "text_key").join(sizes, "node", "left_semi")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    texts = cut(keyed.join(wanted, ["doc_id", "text_key"]).select("node", "text").dropDuplicates(["node"]))
    checked = cut(_fitting(star, sizes, percent))
    links = verified(checked, texts, width, percent)
    component = cut(connected_components(links))

    # 3. Nodes outside the largest component of their bucket, against those of the bucket's other components.
    placed = meeting.select("key", "node", "size").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    largest = placed.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("component", "n").alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n")).where("parts > 1").drop("parts")
    open_ = cut(placed.join(largest, "key"))
    few = F.col("n") <= SMALL_BUCKET
    outside = open_.where(few & (F.col("component") != F.col("main"))).select("key", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("size").alias("sx"))
    rest = outside.join(open_.where(few).drop("main", "n"), "key").where("cx <> component").where(_fits(F.col("sx"), F.col("size"), percent))
    rest = rest.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))
    crowd = open_.where(~few).groupBy("node", "size", "component").agg(F.max(F.col("component") != F.col("main")).alias("outside"))
    rest = rest.union(_sharing_prefix(crowd, texts, width, percent)).distinct().join(checked, ["a", "b"], "left_anti")
    more = cut(verified(rest, texts, width, percent))
    if not more.isEmpty():
        name = lambda side: component.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        joined = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        second = connected_components(joined).toDF("component", "over")
        lone = second.join(component.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("node"), F.col("over").alias("component"))
        component = component.join(second, "component", "left").select("node", F.coalesce("over", "component").alias("component")).union(lone)
    # A component's name is its smallest id. Nodes without links are their own components; rows without shingles too.
    of = component.join(nodes.select("node", "least_id"), "node")
    smallest = of.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = of.join(smallest, "component").select("node", "component", "component_id")
    named = nodes.join(linked, "node", "left").select(*same, F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "least_id").alias("component_id"))
    shown = ["doc_id", "text_key", "n_shingles", "component", "component_id"]
    out = base.where("n_shingles > 0 and doc_id is not null").select("doc_id", "text_key", *same).join(named, same).select(*shown)
    return out.union(base.where("n_shingles = 0 or doc_id is null").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id")))


def _sharing_prefix(crowd: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of a node with ``outside`` and one of another component that may be linked: all that are.

    Sets that reach the threshold share one of their rarest shingles: of the first size - ceil(threshold * size) + 1 in
    any order that is the same for all, here by how many of these nodes have them. So near copies that differ too
    much, each by edits of its own, aren't paired with each other though they share most of their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_hashes()
        for batch in batches:
            sets = [shingle_hashes(t, words, width).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.select(["node", "size", "component", "outside"]).columns, pa.array(sets, pa.list_(pa.int64()))], ["node", "size", "component", "outside", "shingles"])

    named = crowd.join(texts.toDF("node", "text"), "node").select("node", "size", "component", "outside", "text")
    each = named.mapInArrow(run, "node long, size long, component long, outside boolean, shingles array<long>").select("node", "size", "component", "outside", F.explode("shingles").alias("shingle"))
    each = cut(each)
    often = each.groupBy("shingle").agg(F.count("*").alias("df"))
    order = Window.partitionBy("node").orderBy("df", "shingle")
    length = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1
    # A shingle that one node has can't be shared, but counts as one of the first.
    prefix = each.join(often, "shingle").withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= length) & (F.col("df") > 1))
    prefix = prefix.withColumn("band", F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int"))
    left = prefix.where("outside").select("shingle", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), F.col("node").alias("x"), F.col("component").alias("cx"), F.col("size").alias("sx"), F.col("rank").alias("rx"))
    met = left.join(prefix.select("shingle", "band", "node", "component", "size", "rank"), ["shingle", "band"]).where("cx <> component").where(_fits(F.col("sx"), F.col("size"), percent))
    # With the first shared one at these ranks, no more than this many can be shared.
    most = 1 + F.least(F.col("sx") - F.col("rx"), F.col("size") - F.col("rank"))
    met = met.where(most * (100 + percent) >= (F.col("sx") + F.col("size")) * percent)
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _fits(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the threshold at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _fitting(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    return both.where(_fits(F.col("na"), F.col("nb"), percent)).select("a", "b")
