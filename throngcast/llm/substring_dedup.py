"""Substring dedup: repeated word windows found by backward search in sharded FM-indexes.

A window of ``words`` consecutive words is removed where the same words also start in a document
with a smaller id. Every window has a minimiser, the smallest hash of its inner runs of
``ANCHOR`` words; equal windows have equal minimisers, so the minimiser names the shard that must
judge a window, and no document meets an index that cannot hold its windows.

1. Blocks of documents send the distinct minimisers of their windows, each with its smallest
   document, to the shards, which answer with those that more than one document has. All others
   are single and need no index.
2. Blocks send the distinct stretches of text around shared minimisers, each with its smallest and
   largest document. A shard builds a compressed FM-index (Burrows-Wheeler transform in a wavelet
   matrix of packed bits) over the distinct stretches and streams them through it: backward search
   gives the matching statistics up to the threshold, and the suffix interval of each full match
   gives its smallest document.
3. A block learns, once per stretch, the smallest document of each window, where one of its own
   documents is larger. Its documents look their stretches up and drop the covered words.

However many copies a passage has, a block sends it once and gets one answer, so a shard handles a
third of all documents' copies as one row per block. Around its edges every copy differs: a
minimiser of more than ``HOT_WINDOWS`` windows is therefore cut into single windows, which go to the
shard of their own hash instead of all to one. Blocks are cut by bytes of text: their number
grows with the input, their size does not, and there are as many shards for each block at every
size. All work inside a task is over one block or one shard at a time.

Defined cases: a null or empty text has no words and keeps none; texts shorter than a window stay
whole, and so do rows without an id, which no document is compared with. Rows with equal ids never remove each other's words. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import (
    U64, WordCodes, block_count, documents_of, gram_hashes, mixed, packed, parts_by, ranges, table_of, text_blocks, unpacked,
)

WINDOW = 13
ANCHOR = 6
#: Windows of one stretch at most; longer runs with one minimiser are cut.
STRETCH = 16
#: Windows of one minimiser, beyond which each window is sent by its own hash.
HOT_WINDOWS = 1 << 17
#: Words handled at once inside a block.
CHUNK_WORDS = 1 << 18
#: Bytes of text in a block of documents, on average.
BLOCK_BYTES = 16 << 20
#: Shards for each block.
SHARDS_PER_BLOCK = 2
#: Patterns searched for side by side.
SEARCHED_AT_ONCE = 100_000

SENT = "shard long, block long, blob binary"
_SENT = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("blob", pa.binary())])
KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())]
)


class FMIndex:
    """FM-index of a sequence of small integers, for patterns of up to 16 symbols.

    Suffixes are ordered by 16 symbols, which is all that such patterns can see. Each level of
    the wavelet matrix keeps its bits packed, with one count per 64 of them.
    """

    DEPTH = 16

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        n = len(symbols)
        rank, step = symbols.astype(np.int64), 1
        while step < self.DEPTH:
            following = np.zeros(n, np.int64)
            following[: max(n - step, 0)] = rank[step:] + 1
            order, rank = _ordered(rank * (int(rank.max()) + 2) + following)
            step *= 2
        self.suffixes = order.astype(np.int32)
        del rank, following
        last = symbols[order - 1]
        counts = np.bincount(symbols, minlength=n_symbols)
        self.first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (last >> shift) & 1
            words = np.packbits(np.concatenate((bits.astype(np.uint8), np.zeros(64 + -n % 64, np.uint8))), bitorder="little").view(U64)
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1])).astype(np.uint32)
            self.levels.append((shift, words, ones, int(n - bits.sum())))
            last = np.concatenate((last[bits == 0], last[bits == 1]))
        self.starts = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, words, ones, zeros in self.levels:
            word = at >> 6
            below = (U64(1) << (at & 63).astype(U64)) - U64(1)
            set_bits = ones[word] + np.bitwise_count(words[word] & below).astype(np.int64)
            at = np.where((symbols >> shift) & 1, zeros + set_bits, at - set_bits)
        return at

    def backward(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after putting one symbol in front of each pattern."""
        base = self.first[symbols] - self.starts[symbols]
        return base + self._walk(symbols, low), base + self._walk(symbols, high)

    def intervals(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of the ``length`` symbols of ``text`` before each end."""
        low, high = np.empty(len(ends), np.int64), np.empty(len(ends), np.int64)
        for start in range(0, len(ends), SEARCHED_AT_ONCE):
            part = slice(start, start + SEARCHED_AT_ONCE)
            own = ends[part]
            a, b = np.zeros(len(own), np.int64), np.full(len(own), len(self.suffixes), np.int64)
            for k in range(1, length + 1):
                a, b = self.backward(text[own - k], a, b)
            low[part], high[part] = a, b
        return low, high


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the dense rank of each."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(sorted_keys[1:] != sorted_keys[:-1])))
    return order, rank


def minimisers(codes: np.ndarray, doc: np.ndarray, words: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one document with one minimiser: first window, end, minimiser.

    ``doc`` numbers the document of each code; windows lie within one document.
    """
    n = len(codes) - words + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, U64)
    least, span = gram_hashes(codes, ANCHOR), 1
    inner = words - ANCHOR + 1
    while span < inner:
        step = min(span, inner - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    whole = doc[:n] == doc[words - 1 :]
    change = np.concatenate(([True], (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1]) | (whole[1:] != whole[:-1])))
    start = np.flatnonzero(change)
    end = np.append(start[1:], n)
    kept = whole[start]
    return start[kept], end[kept], least[start[kept]]


def _chunks(raws: Iterable[bytes | None], codes: WordCodes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First document, codes and document numbers of runs of whole documents."""
    parts, first, total = [], 0, 0

    def chunk() -> tuple[int, np.ndarray, np.ndarray]:
        return first, np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])

    for raw in raws:
        parts.append(codes.of((raw or b"").split()))
        total += len(parts[-1])
        if total >= CHUNK_WORDS:
            yield chunk()
            parts, first, total = [], first + len(parts), 0
    if parts:
        yield chunk()


def _send_minimisers(shards: int, words: int):
    """The distinct minimisers of a block, each with its smallest document, whether others have it, and its windows."""

    def run(docs: pa.Table) -> pa.Table:
        ids, codes = _ids(docs), WordCodes()
        values, owners, windows = [np.empty(0, U64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for first, chunk, doc in _chunks(_raws(docs), codes):
            start, end, least = minimisers(chunk, doc, words)
            values.append(least)
            owners.append(ids[first + doc[start]])
            windows.append(end - start)
        every = np.concatenate(values)
        value, owner, last = _extremes(every, np.concatenate(owners))[1:]
        total = np.bincount(np.searchsorted(value, every), np.concatenate(windows), len(value)).astype(np.uint32)
        return _to_shards(docs, (value % U64(shards)).astype(np.int64), value, owner, owner != last, total)

    return run


def _ids(docs: pa.Table) -> np.ndarray:
    return np.array([i for i, _, _ in documents_of(docs)], np.int64)


def _raws(docs: pa.Table) -> Iterator[bytes | None]:
    return (raw for _, raw, _ in documents_of(docs))


def _extremes(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place of each distinct key, the key, and its smallest and largest document."""
    order = np.lexsort((owner, keys))
    fresh = np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)]
    first, last = order[fresh], order[np.append(fresh, True)[1:]]
    return first, keys[first], owner[first], owner[last]


def _to_shards(docs: pa.Table, shard: np.ndarray, *arrays: np.ndarray) -> pa.Table:
    parts = [(key, packed(*(a[at] for a in arrays))) for key, at in parts_by(shard)]
    return table_of(_SENT, shard=[key for key, _ in parts], block=[docs["block"][0].as_py()] * len(parts), blob=[blob for _, blob in parts])


def _shared(hot_windows: int):
    """Minimisers that several documents have, and whether they are hot, told to each of their blocks."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpacked(b) for b in table["blob"].to_pylist()]
        value, owner, several, windows = (np.concatenate([p[k] for p in parts]) for k in range(4))
        sender = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        order = np.argsort(value)
        start = np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1])[: len(value)])
        least, most = np.minimum.reduceat(owner[order], start), np.maximum.reduceat(owner[order], start)
        shared = (least != most) | np.logical_or.reduceat(several[order], start)
        sizes = np.diff(np.append(start, len(value)))
        hot = np.repeat(np.add.reduceat(windows[order].astype(np.int64), start) > hot_windows, sizes)
        keep = np.repeat(shared, sizes)
        order, hot = order[keep], hot[keep]
        told, blocks = list(parts_by(sender[order])), table["block"].to_pylist()
        return table_of(_ANSWER, block=[blocks[k] for k, _ in told], blob=[packed(value[order[at]], hot[at].astype(np.uint8)) for _, at in told])

    return run


def _gathered(table: pa.Table, kinds: tuple) -> list[np.ndarray]:
    parts = [unpacked(b) for b in table["blob"].to_pylist()]
    return [np.concatenate([np.empty(0, kind), *(p[k] for p in parts)]) for k, kind in enumerate(kinds)]


def _stretches(raws: Iterable[bytes | None], wanted: np.ndarray, is_hot: np.ndarray, words: int) -> list[np.ndarray]:
    """Stretches around the wanted minimisers: minimiser, number of the document, first word, size,
    and the codes of all, one stretch after the other. Hot minimisers are cut into single windows."""
    found, codes, hot = [], WordCodes(), np.unique(wanted[is_hot > 0])
    wanted = np.unique(wanted)
    for first, chunk, doc in _chunks(raws, codes):
        start, end, value = minimisers(chunk, doc, words)
        hit = np.isin(value, wanted)
        start, end, value = start[hit], end[hit], value[hit]
        longest = np.where(np.isin(value, hot), 1, STRETCH)
        cuts = (end - start + longest - 1) // longest
        longest = np.repeat(longest, cuts)
        begin = ranges(np.zeros(len(cuts)), cuts) * longest + np.repeat(start, cuts)
        sizes = np.minimum(np.repeat(end, cuts) - begin, longest) + words - 1
        doc_start = np.searchsorted(doc, doc[begin]) if len(begin) else begin
        found.append((np.repeat(value, cuts), first + doc[begin], begin - doc_start, sizes, chunk[ranges(begin, sizes)]))
    return [np.concatenate([f[k] for f in found]) for k in range(5)]


def _send_stretches(shards: int, words: int):
    """Distinct stretches of a block around shared minimisers, with their smallest and largest documents."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not docs.num_rows:
            return _SENT.empty_table()
        wanted, is_hot = _gathered(answers, (U64, np.uint8))
        value, row, _, sizes, content = _stretches(_raws(docs), wanted, is_hot, words)
        offset = np.cumsum(sizes) - sizes
        one, digest, first, last = _extremes(_digests(content, sizes), _ids(docs)[row])
        value, hot = value[one], np.isin(value[one], wanted[is_hot > 0])
        shard, blob = [], []
        for key, at in parts_by((np.where(hot, mixed(digest), value) % U64(shards)).astype(np.int64)):
            own = one[at]
            text = content[ranges(offset[own], sizes[own])]
            shard.append(key)
            blob.append(packed(sizes[own].astype(np.uint8), text, value[at], first[at], last[at], hot[at].astype(np.uint8)))
        return table_of(_SENT, shard=shard, block=[docs["block"][0].as_py()] * len(shard), blob=blob)

    return run


def _digests(content: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each stretch, stretches lying one after the other."""
    if not len(sizes):
        return np.empty(0, U64)
    start = np.cumsum(sizes) - sizes
    factors = np.random.default_rng(3).integers(1, 2**63, int(sizes.max()), dtype=U64) * U64(2) + U64(1)
    return np.add.reduceat(content * factors[ranges(np.zeros(len(sizes)), sizes)], start) + sizes.astype(U64)


def _distinct_stretches(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Sizes, words and smallest documents of the distinct stretches; of each sent one the distinct
    one it is, its digest, minimiser, largest document, heat and sender.

    Blobs are unpacked one at a time, first for what is sent along and then for the words of one copy
    of each stretch, so that words of further copies are never held together.
    """
    sent = []
    for k, blob in enumerate(blobs):
        sizes, content, *along = unpacked(blob)
        sent.append((_digests(content, sizes.astype(np.int64)), sizes, *along, np.full(len(sizes), k)))
    digest, sizes, value, first, last, hot, sender = (np.concatenate([s[k] for s in sent]) for k in range(7))
    _, one, which = np.unique(digest, return_index=True, return_inverse=True)
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, which, first)
    # stretches in the order of their words, not of their digests
    order = np.argsort(one)
    position = np.empty(len(one), np.int64)
    position[order] = np.arange(len(one))
    one_of, start, kept = one[order], 0, []
    for blob, (_, own_sizes, *_) in zip(blobs, sent):
        own = one_of[(one_of >= start) & (one_of < start + len(own_sizes))] - start
        if len(own):
            content, lengths = unpacked(blob)[1], own_sizes.astype(np.int64)
            kept.append(content[ranges((np.cumsum(lengths) - lengths)[own], lengths[own])])
        start += len(own_sizes)
    return sizes.astype(np.int64)[one_of], np.concatenate(kept), least[order], position[which], digest, value, last, hot, sender


def _search(words: int):
    """Index the distinct stretches of a shard; tell each block the smallest documents of the windows
    of its stretches, where they are smaller than its own largest one."""

    def run(table: pa.Table) -> pa.Table:
        sizes, content, first_doc, which, digest, value, last, hot, sender = _distinct_stretches(table["blob"].to_pylist())
        _, dense = _ordered(content.view(np.int64))
        del content
        # stretches end with symbol 0
        text = np.zeros(len(dense) + len(sizes), np.int32)
        begin = np.cumsum(sizes + 1) - sizes - 1
        text[ranges(begin, sizes)] = dense + 1
        n_symbols = int(dense.max()) + 2
        del dense
        index = FMIndex(text, n_symbols)
        n_windows = sizes - words + 1
        starts = ranges(begin, n_windows)
        low, high = index.intervals(text, starts + words, words)
        by_suffix = np.append(np.repeat(first_doc, sizes + 1)[index.suffixes], np.iinfo(np.int64).max)
        del index, text, starts
        # windows with one interval are equal; intervals do not overlap
        distinct, one, at = np.unique(low, return_index=True, return_inverse=True)
        bounds = np.stack([distinct, high[one]], axis=1).reshape(-1)
        least = np.minimum.reduceat(by_suffix, bounds)[::2][at]
        window_of = np.cumsum(n_windows) - n_windows
        told = np.flatnonzero(np.minimum.reduceat(least, window_of)[which] < last)
        block, blob, blocks = [], [], table["block"].to_pylist()
        for key, at in parts_by(sender[told]):
            own = told[at]
            of = which[own]
            block.append(blocks[key])
            blob.append(packed(value[own], hot[own], digest[own], n_windows[of].astype(np.uint8), least[ranges(window_of[of], n_windows[of])]))
        return table_of(_ANSWER, block=block, blob=blob)

    return run


def _covered(docs: pa.Table, answers: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a block that a smaller document has too: number of the document, first word."""
    if not docs.num_rows or not answers.num_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    value, hot, digest, counts, least = _gathered(answers, (U64, np.uint8, U64, np.uint8, np.int64))
    counts = counts.astype(np.int64)
    begin = np.cumsum(counts) - counts
    _, row, place, sizes, content = _stretches(_raws(docs), value, hot, words)
    order = np.argsort(digest)
    own = _digests(content, sizes)
    at = order[np.minimum(np.searchsorted(digest[order], own), len(order) - 1)]
    hit = digest[at] == own
    at, row, place = at[hit], row[hit], place[hit]
    doc = np.repeat(row, counts[at])
    word = np.repeat(place, counts[at]) + ranges(np.zeros(len(at)), counts[at])
    gone = least[ranges(begin[at], counts[at])] < _ids(docs)[doc]
    doc, word = doc[gone], word[gone]
    order = np.argsort(doc, kind="stable")
    return doc[order], word[order]


def _keep(words: int):
    """Every document of a block without the words of its covered windows."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        doc, word = _covered(docs, answers, words)
        rows = []
        for k, (doc_id, raw, _) in enumerate(documents_of(docs)):
            own = (raw or b"").split()
            a, b = np.searchsorted(doc, [k, k + 1])
            kept = own
            if b > a:
                edge = np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, word[a:b], 1)
                np.add.at(edge, word[a:b] + words, -1)
                kept = [own[j] for j in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            text = b" ".join(kept)
            rows.append((doc_id, len(own), len(own) - len(kept), hashlib.sha256(text).hexdigest(), text.decode()))
        return table_of(_KEPT, **dict(zip(_KEPT.names, zip(*rows) if rows else [[]] * 5)))

    return run


def _keep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _keep(WINDOW)(pa.Table.from_batches([batch]), _ANSWER.empty_table()).to_batches()


def dedup(docs: DataFrame, words: int = WINDOW) -> DataFrame:
    """Every document with its kept words: ``KEPT``."""
    if not ANCHOR < words <= FMIndex.DEPTH:
        raise ValueError(f"windows of {ANCHOR + 1} to {FMIndex.DEPTH} words are supported")
    known = docs.where(F.col("doc_id").isNotNull())
    blocks = block_count(known, BLOCK_BYTES)
    shards = SHARDS_PER_BLOCK * blocks
    # the documents are dealt by block once; all three steps read the same exchange
    blocked = text_blocks(known, blocks)
    sent = blocked.groupBy("block").applyInArrow(_send_minimisers(shards, words), SENT)
    shared = sent.groupBy("shard").applyInArrow(_shared(HOT_WINDOWS), "block long, blob binary")
    stretches = blocked.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_stretches(shards, words), SENT)
    covered = stretches.groupBy("shard").applyInArrow(_search(words), "block long, blob binary")
    kept = blocked.groupBy("block").cogroup(covered.groupBy("block")).applyInArrow(_keep(words), KEPT)
    return kept.union(text_blocks(docs.where(F.col("doc_id").isNull()), 1).mapInArrow(_keep_all, KEPT))
