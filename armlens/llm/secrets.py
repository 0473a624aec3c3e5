"""Secret scans with multipart credential linking.

Base kinds are single patterns: ``assign`` (a named value), ``access`` (a cloud access identifier) and ``hex`` (a long
hexadecimal string). A credential often has several parts of which none is telling alone: an access identifier, its
secret and the endpoint it opens. Weak candidates are

* ``user``: a value given to user, login or account, 3 or more characters,
* ``key``: a run of 20 or more base-64 characters with a digit, an upper and a lower case letter,
* ``endpoint``: a URL or connection string.

They are joined by intervals within scopes (parts of a text between blank lines): a weak candidate is reported only if
a complementary part lies within ``reach`` characters in the same scope. Complementary are an identifier (access,
user) for a secret (assign, key, hex) and for an endpoint, and a secret for an identifier and for an endpoint; a weak
part inside a base span is dropped. The nearest parts before and after are found by window functions over the sorted
spans, so the work is linear in the number of spans and no pairs are emitted.

Defined results: null and empty texts have no span; rows that occur twice are scanned twice; extra columns are
ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_batches

#: Order of the kinds among spans that start at the same place.
KINDS = ("assign", "access", "hex", "user", "key", "endpoint")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
USER = re.compile(r"""\b(?:user(?:_?name)?|login|account(?:_?id)?|access_?key(?:_?id)?|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""", re.I | re.A)
KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""\b(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://[^\s"'<>]{3,}""", re.I | re.A)
_ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_USER_HINT = re.compile(r"user|login|account|access_?key|client_?id", re.I | re.A)
_BLANK = re.compile(r"\n[ \t\r]*\n")


def find_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, scope) of all base spans and weak candidates of a whole text, sorted."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b in found)
    weak = []
    if _USER_HINT.search(text):
        weak += [(3, *m.span()) for m in USER.finditer(text)]
    for m in KEY.finditer(text):
        if any(map(str.isdigit, s := m.group())) and any(map(str.isupper, s)) and any(map(str.islower, s)):
            weak.append((4, *m.span()))
    if "://" in text:
        weak += [(5, *m.span()) for m in ENDPOINT.finditer(text)]
    at = 0
    for kind, a, b in sorted(weak, key=lambda x: x[1:]):
        while at < len(base) and base[at][1] <= a:
            at += 1
        if at == len(base) or base[at][0] >= b:
            found.append((kind, a, b))
    found.sort(key=lambda x: (x[1], x[0]))
    edges = [m.end() for m in _BLANK.finditer(text)] if found else []
    out, scope = [], 0
    for kind, a, b in found:
        while scope < len(edges) and edges[scope] <= a:
            scope += 1
        out.append((kind, a, b, scope))
    return out


def candidates(docs: DataFrame, text_col: str = "text") -> Column:
    """An array column of (kind, start, end, scope) structs."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("array<struct<kind: int, start: int, end: int, scope: int>>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "scope"), x, strict=True)) for x in find_spans(t)] if t else [] for t in texts])

    return of.asNondeterministic()(F.col(text_col))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, reach: int = 400) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex and spans: an array of (start, kind, end) of base and linked spans, sorted.

    A row for each row of ``docs``. Texts stay where they are scanned; only ids and spans are shuffled.
    """
    # The row's number keeps rows apart that have the same id.
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), candidates(docs, text_col).alias("found"))
    spans = found.select("row", "doc_id", F.explode_outer("found").alias("s")).select("row", "doc_id", "s.*")
    scope = Window.partitionBy("row", "scope").orderBy("start", "kind", "end")
    before, after = scope.rowsBetween(Window.unboundedPreceding, -1), scope.rowsBetween(1, Window.unboundedFollowing)

    def near(*kinds: int) -> Column:
        """Whether a span of these kinds begins or ends within reach."""
        of = F.col("kind").isin(*kinds)
        gap_before = F.col("start") - F.max(F.when(of, F.col("end"))).over(before)
        gap_after = F.min(F.when(of, F.col("start"))).over(after) - F.col("end")
        return F.coalesce(gap_before <= reach, F.lit(False)) | F.coalesce(gap_after <= reach, F.lit(False))

    kept = F.when(F.col("kind") == 3, near(0, 2, 4)).when(F.col("kind") == 4, near(1, 3, 5)).when(F.col("kind") == 5, near(0, 2, 4)).otherwise(F.col("kind").isNotNull())
    linked = spans.withColumn("kept", kept)
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}")
    return linked.groupBy("row", "doc_id").agg(*map(count, range(3)), F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("start", "kind", "end")))).alias("spans")).drop("row")


def linked_spans(text: str, reach: int = 400) -> list[tuple[int, int, int]]:
    """(start, kind, end) of one text's base and linked spans: what ``scan`` finds, for rewriting the text in place."""
    spans = find_spans(text)
    partners = {3: (0, 2, 4), 4: (1, 3, 5), 5: (0, 2, 4)}
    kept = [kind < 3 for kind, *_ in spans]
    for order, place in ((range(len(spans)), 2), (range(len(spans) - 1, -1, -1), 1)):
        # The nearest edge of each kind seen so far in the scope: the greatest end before, the least start after.
        scope, edge = None, {}
        for i in order:
            kind, a, b, s = spans[i]
            if s != scope:
                scope, edge = s, {}
            for k in partners.get(kind, ()):
                if k in edge and (a - edge[k] if place == 2 else edge[k] - b) <= reach:
                    kept[i] = True
            edge[kind] = max(edge.get(kind, b), b) if place == 2 else min(edge.get(kind, a), a)
    return [(a, kind, b) for (kind, a, b, _), keep in zip(spans, kept, strict=True) if keep]


def redacted(docs: DataFrame, text_col: str = "text", *, reach: int = 400, mark: str = "[SECRET]") -> Column:
    """The texts with base and linked spans (overlapping ones as one) replaced by ``mark``."""
    text_batches(docs.sparkSession)

    def one(text: str | None) -> str | None:
        spans = linked_spans(text, reach) if text else []
        if not spans:
            return text
        out, done = [], 0
        for a, _, b in spans:
            if a >= done:
                out += [text[done:a], mark]
            done = max(done, b)
        return "".join(out) + text[done:]

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype=object)

    return of.asNondeterministic()(F.col(text_col))


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
