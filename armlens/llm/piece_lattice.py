"""Max-plus parallel scan of texts for a SentencePiece model of the BPE kind.

Merging by rank gives the one sequence of pieces of which every two neighbours are stable: encoding the two together
gives the two again. So encoding is a path problem: nodes are places of pieces in the text, a step to a neighbour weighs
the neighbour's score if the two are stable and minus infinity if not, and the heaviest path from the first to the last
character is the encoding; its weight is the sum of the scores of the text's pieces. (Without the condition on
neighbours the heaviest path would be another sequence: that of a unigram model.)

A text is cut into chunks anywhere. The state at a cut is the node that covers the character before it. A chunk's
transfer matrix has the greatest weight with which a state at its right cut is reached from one at its left cut. No
piece crosses the place before a run of blanks or around a line end, so between such places the states are one, and the
parts of a chunk between them are lattices of their own, solved once while they stay in a bounded cache. Matrices are
computed apart, combined two by two in the max-plus sense (which is associative), and each chunk is then traced back
between its two states. A text that fits into one chunk has one matrix of one cell.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, cut

Node = tuple[int, int]  # where a piece begins and ends
EDGE: Node = (0, 0)  # the state before the first and after the last character, seen from there
_PART = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_WIDTH = 22  # bits of a token in a pair of tokens


class Lattice:
    """Nodes, scores and stable steps of a model's pieces. Blanks stand for the model's blank marks."""

    def __init__(self, model, parts: int = 800_000, pairs: int = 600_000):
        self.model = model
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        usual = [i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any("▁" in names[i].lstrip("▁") or "\n" in names[i] for i in usual):
            raise ValueError("parts of this model's texts aren't independent")
        self.names = [n.replace("▁", " ") for n in names]
        self.scores = [model.get_score(i) for i in range(len(names))]
        #: The pieces that merging gives. A token is such a piece's id, or -1 - code point for another single character.
        self.tokens = {self.names[i]: i for i in usual if self._ids(self.names[i]) == [i]}
        self.longest = max(map(len, self.tokens))
        #: What pieces begin with: the token of those that are one, -1 for the others.
        self.begins = {t[:k]: -1 for t in self.tokens for k in range(1, len(t))} | self.tokens
        self.spelled = BoundedCache(lambda token: self._ids(chr(-1 - token)), 50_000)
        self.stable = BoundedCache(self._stable, pairs)
        self.limit = parts
        self._forget()

    def _ids(self, text: str) -> list[int]:
        """Without the blank that the encoder puts before a text: it comes off with a line end."""
        return self.model.encode("\n" + text)[2:]

    def ids(self, token: int) -> list[int]:
        return [token] if token >= 0 else self.spelled[token]

    def score(self, token: int) -> float:
        return self.scores[token] if token >= 0 else sum(map(self.scores.__getitem__, self.spelled[token]))

    def _stable(self, pair: int) -> bool:
        a = (pair + (1 << (_WIDTH - 1))) >> _WIDTH
        b = pair - (a << _WIDTH)
        text = "".join(self.names[t] if t >= 0 else chr(-1 - t) for t in (a, b))
        return self._ids(text) == self.ids(a) + self.ids(b)

    def token(self, text: str) -> int | None:
        """The token of a node's text; None where no node has this text."""
        found = self.tokens.get(text)
        return -1 - ord(text) if found is None and len(text) == 1 else found

    def steps(self, text: str, s: int) -> list[tuple[int, int]]:
        """(end, token) of the nodes that begin at s, the shortest first."""
        out = []
        for e in range(s + 1, len(text) + 1):
            token = self.begins.get(text[s:e])
            if token is None:
                break
            if token >= 0:
                out.append((e, token))
        return out if out and out[0][0] == s + 1 else [(s + 1, -1 - ord(text[s])), *out]

    def solve(self, part: str) -> tuple[list[int], float]:
        """The ids and the weight of the heaviest path through a part between places that no piece crosses.

        Only one path has a finite weight, so a search that goes on with the longest node, and comes back from nodes
        that lead nowhere, ends with the heaviest.
        """
        n, stable, begins = len(part), self.stable, self.begins.get
        steps: dict[int, list[tuple[int, int]]] = {}
        path: list[tuple[int, int, int]] = []  # (token, where it begins, its number among the steps there)
        nowhere: set[Node] = set()
        s, last, k = 0, None, None
        while s < n:
            if k is None:
                there = steps.get(s)
                if there is None:
                    there = steps[s] = []
                    for e in range(s + 1, n + 1):
                        token = begins(part[s:e])
                        if token is None:
                            break
                        if token >= 0:
                            there.append((e, token))
                    if not there or there[0][0] > s + 1:
                        there.insert(0, (s + 1, -1 - ord(part[s])))
                k = len(there) - 1
            else:
                there = steps[s]
            while k >= 0:
                e, token = there[k]
                if (last is None or stable[(last << _WIDTH) + token]) and (not nowhere or (s, e) not in nowhere):
                    break
                k -= 1
            if k >= 0:
                path.append((token, s, k))
                s, last, k = e, token, None
            elif not path:
                return [], -np.inf
            else:
                _, before, k = path.pop()
                nowhere.add((before, s))
                s, last, k = before, path[-1][0] if path else None, k - 1
        tokens = [token for token, _, _ in path]
        if min(tokens, default=0) >= 0:
            return tokens, sum(map(self.scores.__getitem__, tokens))
        return [i for token, _, _ in path for i in self.ids(token)], sum(self.score(token) for token, _, _ in path)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # a part -> its place in begin, count and weight
        self.held = 0  # characters of the parts
        self.pool, self.begin = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.count, self.weight = np.zeros(0, np.int64), np.zeros(0)

    def _learn(self, parts: list[str]) -> None:
        solved = list(map(self.solve, parts))
        self.known.update(zip(parts, range(len(self.count), len(self.count) + len(parts)), strict=True))
        self.held += sum(map(len, parts))
        self.pool = np.concatenate((self.pool, np.fromiter(chain.from_iterable(ids for ids, _ in solved), "<u4")))
        self.count = np.concatenate((self.count, [len(ids) for ids, _ in solved])).astype(np.int64)
        self.weight = np.concatenate((self.weight, [w for _, w in solved]))
        self.begin = self.count.cumsum() - self.count

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """The ids and weights of texts that begin and end where no piece crosses."""
        if len(self.known) > self.limit or self.held > 20 * self.limit:
            self._forget()
        each = list(map(_PART.findall, texts))
        parts = list(chain.from_iterable(each))
        place = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        if len(unknown := np.flatnonzero(place < 0).tolist()):
            self._learn(list(dict.fromkeys(parts[i] for i in unknown)))
            place[unknown] = [self.known[parts[i]] for i in unknown]
        count, sizes = self.count[place], [len(x) for x in each]
        after = count.cumsum()
        ids = self.pool[np.repeat(self.begin[place] - after + count, count) + np.arange(after[-1] if len(after) else 0)]
        cuts = np.concatenate(([0], after))[np.cumsum([0, *sizes])].tolist()
        weights = np.bincount(np.repeat(np.arange(len(texts)), sizes), self.weight[place], len(texts)).tolist()
        return [(ids[a:b], w) for a, b, w in zip(cuts[:-1], cuts[1:], weights, strict=True)]

    def walk(self, text: str, lo: int, hi: int, entries: list[Node]) -> dict[Node, dict[Node, tuple[float, Node]]]:
        """For each node that begins in [lo, hi) and each entry that reaches it: the greatest weight, the node before."""
        best: dict[Node, dict] = {}
        at: dict[int, list[tuple[Node, int | None]]] = {}
        for node in entries:
            best[node] = {node: (0.0, node)}
            at.setdefault(node[1], []).append((node, self.token(text[slice(*node)]) if node[0] < node[1] else None))
        for s in range(lo, hi):
            for e, token in self.steps(text, s) if s in at else ():
                found: dict = {}
                for prev, last in at[s]:
                    if last is None or self.stable[(last << _WIDTH) + token]:
                        for entry, (weight, _) in best[prev].items():
                            if entry not in found or weight + self.score(token) > found[entry][0]:
                                found[entry] = weight + self.score(token), prev
                if found:
                    best[s, e] = found
                    at.setdefault(e, []).append(((s, e), token))
        return best

    def path(self, text: str, best: dict, entry: Node, node: Node) -> list[int]:
        """The ids of the nodes after the entry up to this one."""
        nodes = []
        while node != entry:
            nodes.append(node)
            node = best[node][entry][1]
        return [i for s, e in reversed(nodes) for i in self.ids(self.token(text[s:e]))]

    def covering(self, text: str, c: int) -> list[Node]:
        """The nodes that hold the character before c."""
        return [(s, e) for s in range(max(0, c - self.longest), c) for e, _ in self.steps(text, s) if e >= c]


def free_place(text: str, s: int) -> bool:
    """Whether no piece crosses the place before text[s]: a run of blanks begins there, or a line end is next to it."""
    return text[s] == "\n" or text[s - 1] == "\n" or (text[s] == " " and text[s - 1] != " ")


class Chunk:
    """text with its context; the chunk itself is text[lo:hi]. ``first`` and ``last`` of its text."""

    def __init__(self, lattice: Lattice, text: str, lo: int, hi: int, first: bool, last: bool):
        self.lattice, self.text, self.lo, self.hi = lattice, text, lo, hi
        entries = [(lo, lo)] if first else lattice.covering(text, lo)
        inside = range(lo + first, hi)
        self.a = lo if first else next((s for s in inside if free_place(text, s)), hi if last else None)
        self.b = hi if last else next((s for s in reversed(inside) if free_place(text, s)), lo if first else None)
        if self.a is None:
            self.head = self.tail = lattice.walk(text, lo, hi, entries)
            self.middle = np.zeros(0, "<u4"), 0.0
        else:
            self.head = lattice.walk(text, lo, self.a, entries)
            self.tail = lattice.walk(text, self.b, hi, [(self.b, self.b)])
            self.middle = lattice.encode([text[self.a : self.b]])[0]
        self.exits = [(hi, hi)] if last else [n for n in self.tail if n[1] >= hi and lo <= n[0] < hi and n[0] < n[1]]

    def _to_middle(self) -> dict[Node, tuple[float, Node]]:
        """For each entry that reaches the middle: the weight and the last node before it."""
        found: dict[Node, tuple[float, Node]] = {}
        for node, froms in self.head.items():
            for entry, (weight, _) in froms.items() if node[1] == self.a else ():
                if entry not in found or weight > found[entry][0]:
                    found[entry] = weight, node
        return found

    def cells(self) -> list[tuple[Node, Node, float]]:
        """The transfer matrix: (entry, exit, weight), states seen from the cuts."""
        seen = lambda n, c: (n[0] - c, n[1] - c)
        if self.a is None:
            return [(seen(i, self.lo), seen(j, self.hi), w) for j in self.exits for i, (w, _) in self.tail[j].items()]
        start = (self.b, self.b)
        return [(seen(i, self.lo), seen(j, self.hi), w + self.middle[1] + self.tail[j][start][0]) for i, (w, _) in self._to_middle().items() for j in self.exits]

    def trace(self, entry: Node, exit_: Node) -> np.ndarray:
        """The ids of the heaviest path's nodes that begin in the chunk, between two states seen from the cuts."""
        entry, exit_ = (entry[0] + self.lo, entry[1] + self.lo), (exit_[0] + self.hi, exit_[1] + self.hi)
        path = lambda best, i, j: np.array(self.lattice.path(self.text, best, i, j), "<u4")
        if self.a is None:
            return path(self.tail, entry, exit_)
        return np.concatenate((path(self.head, entry, self._to_middle()[entry][1]), self.middle[0], path(self.tail, (self.b, self.b), exit_)))


Matrix = dict[tuple[Node, Node], float]


def product(left: Matrix, right: Matrix) -> Matrix:
    """The max-plus product: the greatest sum of weights over the states in between."""
    by_state: dict[Node, list[tuple[Node, float]]] = {}
    for (m, j), w in right.items():
        by_state.setdefault(m, []).append((j, w))
    out: Matrix = {}
    for (i, m), w in left.items():
        for j, v in by_state.get(m, ()):
            out[i, j] = max(w + v, out.get((i, j), -np.inf))
    return out


def best_states(matrices: list[Matrix]) -> tuple[list[Node], float] | None:
    """The states at all cuts, edges included, of the heaviest path, and its weight; None where there is no path.

    Matrices are multiplied two by two, level by level; then each product's two states fix the one between its factors.
    """
    levels = [matrices]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([product(*low[k : k + 2]) if k + 1 < len(low) else low[k] for k in range(0, len(low), 2)])
    weight = levels[-1][0].get((EDGE, EDGE), -np.inf) if matrices else -np.inf
    if weight == -np.inf:
        return None
    states = [EDGE, EDGE]
    for low in reversed(levels[:-1]):
        finer = [states[0]]
        for k, (i, j) in enumerate(zip(states[:-1], states[1:], strict=True)):
            if 2 * k + 1 < len(low):
                left, right = low[2 * k], low[2 * k + 1]
                finer.append(max((m for (x, m) in left if x == i and (m, j) in right), key=lambda m: left[i, m] + right[m, j]))
            finer.append(j)
        states = finer
    return states, weight


_LATTICES: dict[str, Lattice] = {}


def lattice_of(path: str) -> Lattice:
    if path not in _LATTICES:
        import sentencepiece

        _LATTICES[path] = Lattice(sentencepiece.SentencePieceProcessor(model_file=path))
    return _LATTICES[path]


def encode_chunked(docs: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """doc_id, text, ids, weight of texts of several chunks (columns doc_id, text), whose chunks tasks share."""
    context = 64  # characters on either side; no piece is as long
    spaced = F.translate(F.concat(F.lit(" "), F.col("text")), "▁", " ")  # the model's mark is a blank to it
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.ceil((F.length("text") + 1) / chunk_chars).cast("int").alias("n"))
    rows = cut(rows)
    begin = F.col("k") * chunk_chars
    chunks = rows.select("row", "n", F.length("text").alias("chars"), spaced.alias("t"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    left = F.least(begin, F.lit(context))
    chunks = chunks.select("row", "n", "k", left.alias("lo"), (left + F.least(F.lit(chunk_chars), F.col("chars") + 1 - begin)).alias("hi"), F.substring("t", begin - left + 1, F.lit(chunk_chars + 2 * context)).alias("t"))
    # Chunks of a text are dealt to tasks by their number.
    chunks = cut(chunks.repartition("row", "k"))
    names = ["row", "n", "k", "lo", "hi", "t"]

    def each(batch: pa.RecordBatch) -> Iterator[tuple[dict, Chunk]]:
        for r in batch.to_pylist():
            yield r, Chunk(lattice_of(path), r["t"], r["lo"], r["hi"], r["k"] == 0, r["k"] == r["n"] - 1)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"row": [], "k": [], "states": [], "weights": []}
            for r, c in each(batch):
                cells = c.cells()
                out["row"].append(r["row"])
                out["k"].append(r["k"])
                out["states"].append([x for i, j, _ in cells for x in (*i, *j)])
                out["weights"].append([w for *_, w in cells])
            types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        tables = []
        for states, weights in zip(pdf["states"], pdf["weights"], strict=True):
            four = np.asarray(states, dtype=np.int64).reshape(-1, 4).tolist()
            tables.append({((a, b), (s, e)): w for (a, b, s, e), w in zip(four, weights, strict=True)})
        found = best_states(tables)
        if found is None:
            return pd.DataFrame({"row": [], "k": [], "path": [], "weight": []}).astype({"row": "int64", "k": "int32", "weight": "float64"})
        states, weight = found
        return pd.DataFrame({"row": pdf["row"], "k": pdf["k"], "path": [[*i, *j] for i, j in zip(states[:-1], states[1:], strict=True)], "weight": weight})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [c.trace((a, b), (s, e)).tobytes() for (_, c), (a, b, s, e) in zip(each(batch.select(names)), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.select(["row", "k", "weight"]).columns, pa.array(ids, pa.binary())], ["row", "k", "weight", "ids"])

    # A text's matrices are small: some cells for each chunk.
    cells = chunks.mapInArrow(matrices, "row long, k int, states array<int>, weights array<double>")
    paths = cells.groupBy("row").applyInPandas(combine, "row long, k int, path array<int>, weight double")
    traced = chunks.join(paths, ["row", "k"]).select(*names, "path", "weight").mapInArrow(trace, "row long, k int, weight double, ids binary")
    whole = traced.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"), F.max("weight").alias("weight"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda x, p: F.concat(x, p["ids"]))
    return rows.join(whole, "row", "left").select("doc_id", "text", joined.alias("ids"), "weight")
