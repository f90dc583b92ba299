"""Periodic runs: longest common extensions from suffix trees, extended from Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends,
at least ``min_length`` words and ``min_exponent`` periods long. The longest Lyndon word at each
place, in the order of the words and in the reverse one, is a candidate for a run's root: every run
has such a root in one of the two orders. A root is extended to the left and to the right by
longest common extensions: the depth of the lowest common ancestor of two leaves, in the tree of
the words for the right and in that of the reversed words for the left. Both trees are built by
Ukkonen's algorithm. A lowest common ancestor is a range minimum over the Euler tour, kept as the
shallowest node between each two neighbouring leaves and answered in constant time.

The trees are built over stretches only. Words of a run beyond its first period repeat those one
period before, which makes a window of ``min_length * (min_exponent - 1) / min_exponent`` words
that occurs again within a third of the text (for three periods). Such windows cover a run as a
whole, so whatever lies outside the stretches they cover is in no run.

Defined cases: a null, empty or blank text has no words and no runs. Rows are judged one by one:
equal rows have equal results and rows keep their number; a row without an id is judged like
others. An empty table gives no rows. Other columns are ignored. Texts are judged whole; a worker
holds a few hundred bytes for each word of the longest repetitive stretch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import U64, WordCodes, doc_frame, mixed, table_of

MIN_LENGTH, MIN_EXPONENT = 24, 3
BATCH_BYTES = 8 << 20
FACTOR = U64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]
Prepare = Callable[[int | None, list[bytes]], list[bytes]]

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("kept_text", pa.string())])
_RUN_DDL = "struct<start:long,length:long,period:long>"
OUT = f"doc_id long, n_words long, runs array<{_RUN_DDL}>, best {_RUN_DDL}, kept_text string"


class SuffixTree:
    """Suffix tree of symbols from 1 on; the symbol 0, smallest in every order, closes them."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        self.size, width = len(text), max(text) + 1
        edges, depth = _ukkonen(text, width)
        self.depth = np.array(depth, np.int64)
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        above, self.symbol = np.divmod(np.fromiter(edges.keys(), np.int64, len(edges)), width)
        self.parent = np.zeros(len(depth), np.int64)
        self.parent[self.child] = above
        self.last_symbol = width
        self.inner = np.zeros(len(depth), bool)
        self.inner[above] = True
        self.leaves = self._leaves_below()

    def _leaves_below(self) -> np.ndarray:
        """Number of leaves below each node, itself included: children, which are deeper, first."""
        leaves = (~self.inner).astype(np.int64)
        at_leaves = np.flatnonzero(leaves)
        counts = np.bincount(self.parent[at_leaves], minlength=len(leaves)).tolist()
        parent, inner = self.parent.tolist(), np.flatnonzero(self.inner)
        for node in inner[np.argsort(-self.depth[inner], kind="stable")].tolist():
            if node:
                counts[parent[node]] += counts[node]
        return np.where(self.inner, counts, leaves)

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour with children in the order of their symbols, or in the reverse one: the rank of
        every suffix, and the depth of the shallowest node between each two neighbouring leaves.

        The first leaf below a node comes after all leaves below its earlier siblings and those of
        its ancestors; these sums are gathered by doubling the steps towards the root. Between the
        leaves of two neighbouring siblings the tour turns at their parent.
        """
        symbol = np.where(self.symbol == 0, 0, self.last_symbol - self.symbol) if falling else self.symbol
        order = np.lexsort((symbol, self.parent[self.child]))
        node = self.child[order]
        parent, passed = self.parent[node], np.cumsum(self.leaves[node]) - self.leaves[node]
        first = np.concatenate([[True], parent[1:] != parent[:-1]])
        begin = np.zeros(len(self.depth), np.int64)
        begin[node] = passed - np.maximum.accumulate(np.where(first, passed, 0))
        up = self.parent
        while up.any():
            begin = begin + begin[up]
            up = up[up]
        at_leaves = np.flatnonzero(~self.inner)
        rank = np.empty(self.size, np.int64)
        rank[self.size - self.depth[at_leaves]] = begin[at_leaves]
        shallowest = np.empty(self.size - 1, np.int64)
        shallowest[begin[node[~first]] - 1] = self.depth[parent[~first]]
        return rank, shallowest


def _ukkonen(text: list[int], width: int) -> tuple[dict[int, int], list[int]]:
    """Edges ``node * width + first symbol -> node`` and the number of symbols above each node."""
    n = len(text)
    begin, end, link, depth = [0] * (2 * n), [0] * (2 * n), [0] * (2 * n), [0] * (2 * n)
    edges: dict[int, int] = {}
    nodes, node, reach, first, start = 1, 0, 0, 0, 0  # start: the longest suffix that has no leaf yet
    for i, symbol in enumerate(text):
        fresh = 0  # the inner node that still needs its suffix link
        while start <= i:
            key = node * width + (text[first] if reach else symbol)
            below = edges.get(key)
            if below is None:
                edges[key] = nodes
                begin[nodes], end[nodes], depth[nodes] = i, n, n - start
                nodes += 1
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                at = begin[below]
                if reach:
                    size = end[below] - at
                    if reach >= size:
                        first += size
                        reach -= size
                        node = below
                        continue
                if text[at + reach] == symbol:
                    if fresh:
                        link[fresh] = node
                    if not reach:
                        first = i
                    reach += 1
                    break
                begin[nodes], end[nodes], depth[nodes] = at, at + reach, depth[node] + reach
                begin[below] = at + reach
                edges[key] = nodes
                base = nodes * width
                edges[base + text[at + reach]] = below
                edges[base + symbol] = nodes + 1
                if fresh:
                    link[fresh] = nodes
                fresh = nodes
                nodes += 1
                begin[nodes], end[nodes], depth[nodes] = i, n, n - start
                nodes += 1
            start += 1
            if node:
                node = link[node]
            elif reach:
                reach -= 1
                first = start
    return edges, depth[:nodes]


class Extensions:
    """Longest common extension of two suffixes in constant time, for arrays of pairs."""

    def __init__(self, rank: np.ndarray, shallowest: np.ndarray):
        self.rank = rank
        self.table = [shallowest.astype(np.int32)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            last, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-half], last[half:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Extension of each pair of different suffixes."""
        ra, rb = self.rank[a], self.rank[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k))])
        return found


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word at each place: where the next smaller suffix begins."""
    ranks = rank.tolist()
    ends, waiting = [0] * len(ranks), []
    for i, own in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > own:
            ends[waiting.pop()] = i
        waiting.append(i)
    return np.array(ends[:-1], np.int64)


def runs_of(symbols: list[int], min_length: int, min_exponent: int) -> list[Run]:
    """Runs ``(start, length, period)`` of symbols from 1 on, by start, then period."""
    n = len(symbols)
    tree = SuffixTree(symbols)
    rank, shallowest = tree.tour()
    ends = [lyndon_ends(rank), lyndon_ends(tree.tour(falling=True)[0])]
    right = Extensions(rank, shallowest)
    del tree
    left = Extensions(*SuffixTree(symbols[::-1]).tour())
    found = []
    for end in ends:
        root = np.flatnonzero(min_exponent * (end - np.arange(n)) <= n)
        period = end[root] - root
        after = right.of(root, root + period)
        before = np.zeros(len(root), np.int64)
        inner = root > 0
        before[inner] = left.of(n - root[inner], n - root[inner] - period[inner])
        length = before + period + after
        good = length >= np.maximum(min_length, min_exponent * period)
        found.append(np.stack([root - before, length, period], 1)[good])
    unique = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in unique[np.lexsort((unique[:, 2], unique[:, 0]))].tolist()]


def stretches(codes: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the parts of a text outside of which no run can lie."""
    n = len(codes)
    if n < min_length:
        return
    hashes, window = codes, 1  # a shorter window than proven is repeated all the more
    while 2 * window <= min_length - min_length // min_exponent:
        hashes = mixed(hashes[:-window] * FACTOR + hashes[window:])
        window *= 2
    ordered = np.sort(hashes)
    if not np.any(ordered[1:] == ordered[:-1]):
        return
    order = np.argsort(hashes, kind="stable")
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    gap = order[again + 1] - order[again]
    near = gap * min_exponent <= n
    one, other, gap = order[again[near]], order[again[near] + 1], gap[near]
    change = np.zeros(n + 1, np.int64)
    for at in (one, other):
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change) > 0]).astype(np.int8)))
    least = np.full(n + 1, n + 1, np.int64)
    np.minimum.at(least, one, gap)
    for a, b in edges.reshape(-1, 2).tolist():
        if b - a >= max(min_length, min_exponent * int(least[a:b].min())):
            yield a, b


def find_runs(words: list[bytes], codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """Runs of a text by start, then period."""
    found: list[Run] = []
    for a, b in stretches(codes, min_length, min_exponent):
        numbers: dict[bytes, int] = {}
        symbols = [numbers.setdefault(w, len(numbers) + 1) for w in words[a:b]]
        found += [(a + start, length, period) for start, length, period in runs_of(symbols, min_length, min_exponent)]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds beyond its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for a, b in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:a]
        at = max(at, b)
    return kept + words[at:]


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods; of equals the first, then the one with the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document; in one of ten, chosen by the id, the rest from some word on repeats."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * (-(-(n - a) // period)))[: n - a]


def _fields(run: Run | None) -> dict | None:
    return None if run is None else dict(zip(("start", "length", "period"), run))


def collapse(
    docs: DataFrame, *, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, prepare: Prepare | None = None
) -> DataFrame:
    """One row per document: ``OUT``, with ``kept_text`` without the repetition.

    ``prepare`` changes the words of a document before they are judged. Rows are independent of
    each other: nothing is shuffled.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            rows, held = [], 0
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"]):
                words = (raw.as_py() or b"").split()
                words = prepare(doc_id, words) if prepare else words
                runs = find_runs(words, codes.of(words), min_length, min_exponent)
                kept = b" ".join(collapsed(words, runs))
                rows.append((doc_id, len(words), [_fields(r) for r in runs], _fields(strongest(runs)), kept))
                held += len(kept)
                if held > BATCH_BYTES:
                    yield from _batches(rows)
                    rows, held = [], 0
            yield from _batches(rows)

    return doc_frame(docs).mapInArrow(run, OUT)


def _batches(rows: list[tuple]) -> list[pa.RecordBatch]:
    return table_of(_OUT, **dict(zip(_OUT.names, zip(*rows)))).to_batches() if rows else []


def runs_text(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))))
