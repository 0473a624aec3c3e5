"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The n-grams are of ``order`` characters, any of Unicode's, so the model grows with the text that it is trained on.

* Counts of the highest order are occurrences; those of lower orders are continuation counts (in how many contexts a
  character appears), got by grouping the distinct n-grams of the order above;
* discounts for counts of one, two, and three or more come from each order's counts of counts;
* contexts' totals and left-over weights are joined to the n-grams by context, and the probabilities of the order below
  by suffix. All of these are tables that Spark shards by n-gram.

Scoring a document needs the probability of each of its n-grams. The commonest n-grams of the model (at most
``head_grams``, chosen by a least count) are broadcast; they only spare work. All others of a document are joined with
the sharded tables, from the highest order down to the one that knows them, and summed up by document: the result is the
same for every ``head_grams``. What travels is a row for each n-gram of a batch of documents, with the documents' numbers.

A document's perplexity is 2 ** (mean code length); it is kept if its perplexity lies between the ``low`` quantile of all
trusted documents' perplexities in its language and the ``high`` one of those that the model was not trained on (a
document that it was trained on is more predictable, and so are that one's copies). Both ends count: text that repeats
itself is too predictable, lists and shouting too little. Extreme quantiles of few documents say little, so at every size
those of a language, of n documents, are drawn towards those of all languages: logarithms are averaged with the
weights n and ``prior``.

Defined results: null and empty texts have no perplexity and are not kept; documents of a language without trusted
documents (n = 0) are measured by the quantiles of all; without trusted text nothing is kept; repeated rows are scored
twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_batches

_SEGMENT, _GROUP = 1 << 20, 1 << 21  # characters of a text, and of several, that are looked at at once
_ROLL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def _segments(texts: list[str | None], order: int) -> Iterator[list[tuple[int, str]]]:
    """Groups of (number of the text, segment): whole texts, each segment led by the characters before it or blanks."""
    some, size = [], 0
    for number, text in enumerate(texts):
        for b in range(0, len(text or ""), _SEGMENT):
            some.append((number, text[max(0, b - order + 1) : b].rjust(order - 1) + text[b : b + _SEGMENT]))
            size += len(some[-1][1])
            if size >= _GROUP:
                yield some
                some, size = [], 0
    if some:
        yield some


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ (h >> np.uint64(29))) * _ROLL + c
        h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(31))


class Grams:
    """The n-grams of a group of segments: one ends at each character."""

    def __init__(self, some: list[tuple[int, str]], order: int):
        code = np.frombuffer("".join(s for _, s in some).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.code, self.order = np.where(code == 0, np.uint32(0xFFFD), code), order
        sizes = np.array([len(s) - order + 1 for _, s in some])
        start = np.arange(sizes.sum()) + np.repeat(np.arange(len(some)) * (order - 1), sizes)
        n = len(code) - order + 1
        hashed = _hash([self.code[j : j + n].astype(np.uint64) for j in range(order)])[start]
        self.owner = np.repeat([number for number, _ in some], sizes)
        self.hash, first, self.which, self.count = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
        self.at = start[first]

    def names(self, some: np.ndarray) -> np.ndarray:
        """The distinct n-grams of these numbers as strings."""
        code = np.column_stack([self.code[self.at[some] + j] for j in range(self.order)])
        return np.ascontiguousarray(code).view(f"<U{self.order}").ravel()


def count_grams(docs: DataFrame, text_col: str, order: int) -> DataFrame:
    """gram, c: over all texts. A row for each n-gram of a batch goes to Spark's partial aggregation."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _segments(batch.column(0).to_pylist(), order):
                grams = Grams(some, order)
                names = pa.array(grams.names(np.arange(len(grams.hash))), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(grams.count, pa.int64())], ["gram", "c"])

    return docs.select(text_col).mapInArrow(run, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    n = counts.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (max(1, n[f"n{k}"]) for k in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    return [min(k - 0.05, max(0.05, d)) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def _context(gram: Column, order: int) -> Column:
    return F.substring(gram, 1, order - 1)


def _suffix(gram: Column, order: int) -> Column:
    return F.substring(gram, 2, order - 1)


@dataclass
class KneserNey:
    """``seen``: for each order from 1 the table (gram, c, p); ``contexts``: (context, gamma). ``unknown``: the uniform
    share of a character."""

    order: int
    seen: list[DataFrame]
    contexts: list[DataFrame]
    unknown: float

    def resolve(self, grams: DataFrame, order: int) -> DataFrame:
        """gram, p for distinct n-grams of an order (column gram): known ones, or the order below by left-over weight."""
        known = grams.join(self.seen[order - 1].select("gram", "p").hint("merge"), "gram", "left").withColumn("context", _context(F.col("gram"), order))
        known = cut(known.join(self.contexts[order - 1], "context", "left").select("gram", "p", F.coalesce("gamma", F.lit(1.0)).alias("gamma")))
        if order == 1:
            return known.select("gram", F.coalesce("p", F.col("gamma") * self.unknown).alias("p"))
        missing = known.where("p is null").select(_suffix(F.col("gram"), order).alias("gram")).distinct()
        lower = self.resolve(missing, order - 1).toDF("suffix", "lower")
        found = known.withColumn("suffix", _suffix(F.col("gram"), order)).join(lower.hint("merge"), "suffix", "left")
        return found.select("gram", F.coalesce("p", F.col("gamma") * F.col("lower")).alias("p"))

    def head(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes, sorted, and code lengths of the commonest n-grams: all that have a least count, ``most`` at most."""
        top = self.seen[-1]
        step = F.floor(F.log2(F.col("c").cast("double")) * 8)
        least, total = None, 0
        for r in sorted(top.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
            total += r["n"]
            if total > most:
                break
            least = r["step"]
        if least is None:
            return np.zeros(0, np.uint64), np.zeros(0)
        order = self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code = np.array(batch.column(0).to_pylist(), f"<U{order}").view(np.uint32).reshape(-1, order).astype(np.uint64)
                both = [_hash([code[:, j] for j in range(order)]).tobytes(), batch.column(1).to_numpy(zero_copy_only=False).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in both], ["hash", "bits"])

        rows = top.where(step >= least).select("gram", (-F.log2("p")).alias("bits")).mapInArrow(run, "hash binary, bits binary").collect()
        hashed, bits = (np.frombuffer(b"".join(r[k] for r in rows), t) for k, t in (("hash", np.uint64), ("bits", np.float64)))
        at = hashed.argsort()
        return hashed[at], bits[at]


def train(trusted: DataFrame, text_col: str = "text", *, order: int = 5) -> KneserNey:
    """The model of all texts of ``trusted``."""
    counts, seen, contexts, discounted = cut(count_grams(trusted, text_col, order)), [], [], []
    for k in range(order, 0, -1):
        d1, d2, d3 = _discounts(counts)
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = counts.select("gram", "c", _context(F.col("gram"), k).alias("context"), discount.alias("d"))
        totals = grams.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        contexts.append(totals.select("context", "gamma"))
        discounted.append(grams.join(totals, "context").select("gram", "c", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), "gamma"))
        if k > 1:
            # In how many contexts each shorter n-gram appears.
            counts = cut(counts.groupBy(_suffix(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("c")))
    unknown = 1.0 / (counts.count() + 1)
    for k, own in enumerate(reversed(discounted), 1):
        if k == 1:
            p = own.select("gram", "c", (F.col("own") + F.col("gamma") * unknown).alias("p"))
        else:
            lower = seen[-1].select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            p = own.withColumn("suffix", _suffix(F.col("gram"), k)).join(lower, "suffix").select("gram", "c", (F.col("own") + F.col("gamma") * F.col("lower")).alias("p"))
        seen.append(cut(p))
    return KneserNey(order, seen, contexts[::-1], unknown)


def perplexities(docs: DataFrame, model: KneserNey, text_col: str, keep: list[str], *, head_grams: int = 1 << 19) -> DataFrame:
    """``keep`` (columns of ``docs``) and perplexity: a row for each row."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.head(head_grams))
    order = model.order
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"), F.struct(*keep).alias("kept"))
    kept_type = given.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, lengths = shared.value
        for batch in batches:
            row, kept = batch.column(0), batch.column(2)
            number = row.to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            bits = np.zeros(len(texts))
            none = lambda n, t: pa.nulls(n, t)
            for some in _segments(texts, order):
                grams = Grams(some, order)
                place = np.minimum(np.searchsorted(hashes, grams.hash), max(0, len(hashes) - 1))
                hit = hashes[place] == grams.hash if len(hashes) else np.zeros(len(grams.hash), bool)
                if hit.any():
                    bits += np.bincount(grams.owner, np.where(hit, lengths[place], 0.0)[grams.which], len(texts))
                rest = ~hit[grams.which]
                if rest.any():
                    # (n-gram, document) pairs that the head doesn't know, by n-gram.
                    pair, c = np.unique(grams.which[rest] * len(texts) + grams.owner[rest], return_counts=True)
                    gram, of = np.divmod(pair, len(texts))
                    distinct, begin = np.unique(gram, return_index=True)
                    offsets = pa.array(np.append(begin, len(pair)), pa.int32())
                    m = len(distinct)
                    yield pa.RecordBatch.from_arrays(
                        [none(m, pa.int64()), none(m, kept.type), none(m, pa.int64()), none(m, pa.float64()), pa.array(grams.names(distinct), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(number[of], pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32()))], names,
                    )
            n, size = len(texts), pa.array([len(t or "") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([row, kept, size, pa.array(bits), none(n, pa.string()), none(n, pa.list_(pa.int64())), none(n, pa.list_(pa.int32()))], names)

    names = ["row", "kept", "n", "bits", "gram", "rows", "counts"]
    out = cut(given.select("row", "text", "kept").mapInArrow(run, f"row long, kept {kept_type}, n long, bits double, gram string, rows array<long>, counts array<int>"))
    tail = out.where("gram is not null")
    found = model.resolve(tail.select("gram").distinct(), order)
    pairs = tail.join(found.hint("merge"), "gram").select((-F.log2("p")).alias("each"), F.explode(F.arrays_zip("rows", "counts")).alias("x"))
    sums = pairs.groupBy(F.col("x.rows").alias("row")).agg(F.sum(F.col("each") * F.col("x.counts")).alias("more"))
    whole = out.where("gram is null").join(sums.hint("merge"), "row", "left")
    perplexity = F.when(F.col("n") > 0, F.pow(F.lit(2.0), (F.col("bits") + F.coalesce("more", F.lit(0.0))) / F.col("n")))
    return whole.select("kept.*", perplexity.alias("perplexity"))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, order: int = 5, head_grams: int = 1 << 19, low: float = 0.002, high: float = 0.99, prior: int = 100,
) -> DataFrame:
    """doc_id, lang, perplexity, kept. Trusted are documents labelled of good quality and not toxic."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col(id_col).alias("id")).distinct()
    # The model is trained on four fifths of the trusted documents; the last fifth is held out.
    held = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    # Ids grow with the corpus, so they are never broadcast: texts are shuffled once at every size.
    model = train(given.select("id", "text").join(good.where(~held).hint("merge"), "id", "left_semi"), "text", order=order)
    scored = cut(perplexities(given, model, "text", ["id", "lang"], head_grams=head_grams))
    trusted = scored.join(good.withColumn("held", held).hint("merge"), "id").where("perplexity is not null")
    ends = F.array(F.percentile_approx("perplexity", low, 10_000), F.percentile_approx(F.when(F.col("held"), F.col("perplexity")), high, 10_000))
    overall = trusted.agg(ends.alias("q")).first()["q"]
    overall = [1.0, 0.0] if None in overall else overall
    drawn = lambda q, ns: [y if x is None else float(np.exp((n * np.log(x) + prior * np.log(y)) / (n + prior))) for x, y, n in zip(q, overall, ns, strict=True)]
    sizes = F.array(F.count("*"), F.count_if("held")).alias("n")
    by_lang = {r["lang"]: drawn(r["q"], r["n"]) for r in trusted.groupBy("lang").agg(ends.alias("q"), sizes).collect()}
    bound = lambda k: F.coalesce(*([F.create_map(*[F.lit(x) for lang, q in by_lang.items() for x in (lang, q[k])])[F.col("lang")]] if by_lang else []), F.lit(float(overall[k])))
    kept = F.coalesce(F.col("perplexity").between(bound(0), bound(1)), F.lit(False))
    return scored.select(F.col("id").alias("doc_id"), "lang", "perplexity", kept.alias("kept"))
