"""SimHash fingerprints and near-fingerprint search, with DataFrame functions only.

A text's terms are its words; a word of n letters weighs min(n, 12) - 1, at least 1, for each time it occurs, so that
the short words of a language count less. Each term's 64-bit hash votes with its weight: a fingerprint's bit is set
where the votes for it are more than half. Votes are summed two bits to a number (each in 32 bits), so 32 sums do.

Two fingerprints within ``radius`` bits agree in at least ``blocks - radius`` of their blocks. So for each choice of
that many blocks there is a table keyed by their bits; equal keys are candidates and a bit count confirms them.

Defined results: null and empty texts have no terms and fingerprint 0; rows with the same id are rows of their own, in
the order of their texts, so one of them is the other's next document; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

_PAIR = 0x0000000100000001  # one bit in either half


def fingerprints(texts: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """A row for each row: the long columns of ``keep`` and each text column's 64-bit fingerprint under its name.

    Words are summed where they are read, so one row of sums for each text is shuffled, and no text.
    """
    rows = texts.select(F.monotonically_increasing_id().alias("row"), *keep, F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns]).alias("texts"))
    stacked = rows.select("row", *keep, F.posexplode("texts").alias("which", "text"))
    words = stacked.select("row", *keep, "which", F.explode(F.split("text", r"\s+")).alias("word"))
    weight = F.greatest(F.least(F.length("word"), F.lit(12)) - 1, (F.length("word") > 0).cast("int")).cast("long")
    voted = words.select("row", *keep, "which", F.xxhash64("word").alias("h"), weight.alias("w"))
    sums = [F.sum(F.shiftright("h", b).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{b}") for b in range(32)]
    votes = voted.groupBy("row", "which").agg(*[F.max(k).alias(k) for k in keep], F.sum("w").alias("total"), *sums)
    found = F.lit(0).cast("long")
    for b in range(32):
        low, high = F.col(f"v{b}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{b}", 32)
        for bit, n in ((b, low), (b + 32, high)):
            value = 1 << bit if bit < 63 else -(1 << 63)
            found = found.bitwiseOR(F.when(2 * n > F.col("total"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    each = votes.select("row", "which", *keep, found.alias("print"))
    pivoted = [F.max(F.when(F.col("which") == k, F.col("print"))).alias(c) for k, c in enumerate(columns)]
    return each.groupBy("row").agg(*[F.max(k).alias(k) for k in keep], *pivoted).drop("row")


def as_longs(hex_digest: Column) -> list[Column]:
    """A hexadecimal digest of 64 characters as four longs, which are cheaper to carry."""
    return [F.conv(F.substring(hex_digest, 16 * k + 1, 16), 16, -10).cast("long").alias(f"sha{k}") for k in range(4)]


def from_longs() -> Column:
    return F.concat(*[hexadecimal(F.col(f"sha{k}")) for k in range(4)])


def hexadecimal(x: Column) -> Column:
    return F.lpad(F.lower(F.hex(x)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _range_of(x: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most x, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<long>")
    up_to = lambda values: F.size(F.filter(values, lambda c: c <= x))
    coarse = up_to(longs(bounds[::step]))
    begin = (coarse - 1) * step
    return F.when(coarse == 0, 0).otherwise(begin + up_to(F.slice(longs(bounds), F.greatest(begin, F.lit(0)) + 1, F.lit(step)))).cast("int")


def with_next(docs: DataFrame, id_col: str, columns: list[str], *, per_range: int = 5000, knots: int = 1000) -> DataFrame:
    """id, the ``columns``, next_id and next_<column> of the document with the next smaller id; after the smallest comes
    the greatest. Rows that share an id come in the order of their columns.

    Ids are cut into ranges of about ``per_range`` documents: at quantiles (at most ``knots``, which is all that the
    driver sees), and evenly between two of them. A window finds the next document within a range, where texts are
    shuffled once. The first document of each range takes the last one of the range below, by a join of these alone.
    """
    n, low, high = docs.agg(F.count(id_col), F.min(id_col), F.max(id_col)).first()
    if not n:
        return docs.select(id_col, *columns, F.col(id_col).alias("next_id"), *[F.col(c).alias(f"next_{c}") for c in columns])
    groups = max(1, min(knots, n // per_range))
    cuts = sorted({int(c) for c in docs.approxQuantile(id_col, [k / groups for k in range(1, groups)], 0.1 / groups)} - {low}) if groups > 1 else []
    placed = docs.select(id_col, *columns, _even_range(F.col(id_col), [low, *cuts, high + 1], -(-n // (per_range * groups))).alias("range"))
    window = Window.partitionBy("range").orderBy(id_col, *columns)
    # One column at a time: a struct would be made, and shuffled, before the window.
    nexts = ["next_id", *[f"next_{c}" for c in columns]]
    seen = placed.select(id_col, *columns, "range", *[F.lag(c).over(window).alias(n) for c, n in zip([id_col, *columns], nexts, strict=True)], F.lead(id_col).over(window).isNull().alias("last"))
    # As a key that is never null the range adds no filter below the window, so all three branches share one exchange.
    at = F.coalesce("range", F.lit(-1))
    shown = [id_col, *columns, *nexts]
    # One row for each range that isn't empty: the range below it, or the uppermost one.
    ranges = docs.select(_even_range(F.col(id_col), [low, *cuts, high + 1], -(-n // (per_range * groups))).alias("range")).distinct()
    below = cut(ranges.select("range", F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(Window.partitionBy())).alias("below")))
    firsts = seen.where("next_id is null").select(id_col, *columns, at.alias("range")).join(below.hint("merge"), "range")
    lasts = seen.where("last").select(at.alias("below"), *[F.col(c).alias(n) for c, n in zip([id_col, *columns], nexts, strict=True)])
    return seen.where("next_id is not null").select(*shown).union(firsts.join(lasts.hint("merge"), "below").select(*shown))


def _even_range(x: Column, edges: list[int], parts: int) -> Column:
    """The number of x's range: the intervals between the edges are cut into so many even parts each."""
    at = _range_of(x, edges[1:-1])
    if parts == 1:
        return at
    longs = F.array(*map(F.lit, edges)).cast("array<long>")
    begin, end = F.get(longs, at).cast("double"), F.get(longs, at + 1).cast("double")
    part = F.floor((x.cast("double") - begin) / (end - begin) * parts)
    return (at.cast("long") * parts + F.greatest(F.least(part, F.lit(parts - 1)), F.lit(0))).alias("range")


def edited_text(text: Column, other: Column) -> Column:
    """The last floor(n / 2) characters replaced by the first as many (or all) of the other text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def near(queries: DataFrame, index: DataFrame, *, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query, print) pairs of distinct fingerprints within ``radius`` bits: all of them.

    ``queries`` and ``index`` have one long column each (``query`` and ``print``), without repeats. With six blocks and
    radius 3 there are 20 tables, each keyed by three blocks (32 bits), so a bucket holds few fingerprints even where
    there are billions.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    table = F.posexplode(F.array(*map(F.lit, masks)))
    keyed = lambda df, c: df.select(c, table.alias("table", "mask")).select(c, "table", F.col(c).bitwiseAND(F.col("mask")).alias("bits"))
    met = keyed(queries, "query").hint("merge").join(keyed(index, "print"), ["table", "bits"])
    return met.where(F.bit_count(F.col("query").bitwiseXOR(F.col("print"))) <= radius).select("query", "print").distinct()
