"""Benchmark decontamination: edit distance by CGK embedding, bit-sampling LSH, exact check.

The CGK embedding walks along a sequence of words: at each step it writes the current word and
moves on or not by a random bit that depends on the step and the word. Sequences at a small edit
distance get embeddings at a small Hamming distance, as their walks come together again. Keys are
samples of embedding positions, spread over the walk, repeated over tables and walks. A walk sees
few words, about as many as stay together wherever the edits are: an item of n words with e edits
has a stretch of n / (e + 1) words without any. Short items have a scheme of their own. Items too
short for a walk (fewer than ``LEAST_WALKED`` words) are cut into e + 1 stretches, one of which is
in every copy as it is, so hashes of whole stretches find them all.

Documents are embedded from every word on, and an item from each of its own words that the walks
do not leave at once, so every stretch of a copy meets windows in line with it. By simulation over
items of 8 to 60 words, at least ``RECALL`` of the copies with all allowed edits share a key, also
with the edits spread evenly, the worst case; a test holds this. A window that shares a key with
an item is verified: the smallest word edit distance between the item and any stretch of the text
around it.

The items are taken as queries in blocks of at most ``BLOCK_WORDS`` words, which bounds what is
sent to the executors; each block is matched against all documents.

Defined cases: words are lower-cased (A-Z) and stripped of punctuation at both ends. Items
without a word are never found; shorter ones than five words are found as they are, without any
edit, also one that is a single frequent word. Null texts have no words.
Repeated items and documents are handled each on its own; null item ids are kept as they are.
Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import CODE_CACHE, U64, WordCodes, doc_frame, mixed, multipliers, ranges, table_of

#: An item is found where the edit distance is at most this share of its words.
MAX_EDITS = 0.2
#: Words of the shortest item that is looked up by walks.
LEAST_WALKED = 8
#: Share of the copies with ``MAX_EDITS`` that are candidates, at every length.
RECALL = 0.99
#: Words that an item has left at least where it is embedded.
LEAST_LEFT = 3
BLOCK_WORDS = 2_000_000
PUNCTUATION = string.punctuation.encode()
FILTER_BITS = 22
#: Documents whose windows are looked up at once, and their words (one longer document may exceed it).
TOGETHER, TOGETHER_WORDS = 64, 60_000


def words_of(raw: bytes | None) -> list[bytes]:
    return [w for w in (x.strip(PUNCTUATION) for x in (raw or b"").lower().split()) if w]


class PlainCodes(WordCodes):
    """Codes of words without the punctuation around them; 0 where nothing is left."""

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(PUNCTUATION)
        if len(self) >= CODE_CACHE:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(plain) if plain else 0
        return code

    def of_text(self, raw: bytes | None) -> np.ndarray:
        codes = self.of((raw or b"").lower().split())
        return mixed(codes[codes != 0])


class Scheme:
    """Independent walks of so many steps, a step moving on every other time on average; the keys
    of a walk, and the positions each samples, one from each of as many equal parts of the walk."""

    def __init__(self, least: int, walks: int, steps: int, tables: int, sampled: int):
        #: Words of the shortest item that is looked up by this scheme.
        self.least, self.steps = least, steps
        self.step_salts = multipliers(steps * walks, 21).reshape(walks, steps)
        self.factors = multipliers(sampled, 22)
        self.table_salts = multipliers(walks * tables, 23).reshape(walks, tables)
        width, part = steps // sampled, np.arange(sampled)
        self.picks = [
            [part * width + np.random.default_rng(1000 * w + t).integers(0, width, sampled) for t in range(tables)]
            for w in range(walks)
        ]

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys of the windows at ``starts``: a row per walk and table, a column per window."""
        padded = np.concatenate([codes, np.zeros(self.steps, U64)])
        out = []
        for step_salts, table_salts, tables in zip(self.step_salts, self.table_salts, self.picks):
            at, written = starts, []
            for step_salt in step_salts:
                word = padded[at]
                written.append(word)
                at = at + ((word * step_salt) >> U64(63)).astype(np.int64)
            for salt, picks in zip(table_salts, tables):
                key = written[picks[0]] * self.factors[0] + salt
                for factor, s in zip(self.factors[1:], picks[1:]):
                    key += written[s] * factor
                out.append(key)
        return mixed(np.stack(out))


#: Items of fewer than 14 words keep stretches of three words, longer ones of four (15 words: three).
SCHEMES = (Scheme(LEAST_WALKED, 3, 9, 3, 3), Scheme(14, 2, 12, 4, 4))


class Stretch:
    """Stretches of so many words, each hashed whole."""

    def __init__(self, words: int):
        self.factors = multipliers(words, 24)

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys of the stretches at ``starts``, in one row."""
        padded = np.concatenate([codes, np.zeros(len(self.factors), U64)])
        return mixed(sum(padded[starts + k] * factor for k, factor in enumerate(self.factors)))[None]


STRETCHES = {words: Stretch(words) for words in range(1, LEAST_WALKED)}
#: Room after a document, so that no walk or stretch leaves it.
ROOM = max(LEAST_WALKED, *(scheme.steps for scheme in SCHEMES))


def scheme_of(words: int) -> tuple[Scheme | Stretch, np.ndarray]:
    """How an item of so many words is looked up, and from which of its words on."""
    if words < LEAST_WALKED:
        parts = int(MAX_EDITS * words) + 1
        return STRETCHES[words // parts], np.arange(parts) * (words // parts)
    return max((s for s in SCHEMES if s.least <= words), key=lambda s: s.least), np.arange(words - LEAST_LEFT + 1)


class Index:
    """Keys of the windows of some items, sorted, with the item and the offset of each."""

    def __init__(self, keys: list[np.ndarray], items: list[np.ndarray], offsets: list[np.ndarray]):
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.offset = key[order], np.concatenate(items)[order], np.concatenate(offsets)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.key >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that share a key with an item, the item, and its word in line with the window."""
        rows, windows = np.nonzero(self.filter[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)])
        hits = keys[rows, windows]
        low = np.searchsorted(self.key, hits)
        several = np.searchsorted(self.key, hits, "right") - low
        entries = ranges(low, several)
        return np.repeat(windows, several), self.item[entries], self.offset[entries]


def infix_distance(item: np.ndarray, text: np.ndarray) -> int:
    """Smallest edit distance between the item and any stretch of the text."""
    row = np.zeros(len(text) + 1, np.int64)
    steps = np.arange(len(text) + 1)
    for k, code in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != code))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


class Items:
    """Benchmark items with the keys of all their windows, for one block."""

    def __init__(self, rows: list[tuple[int | None, bytes | None]]):
        codes = PlainCodes()
        self.ids, self.codes = [], []
        found: dict[Scheme | Stretch, list[tuple[np.ndarray, ...]]] = {}
        for item_id, raw in rows:
            own = codes.of_text(raw)
            if not len(own):
                continue
            scheme, starts = scheme_of(len(own))
            key = scheme.keys(own, starts)
            found.setdefault(scheme, []).append((key.ravel(), np.full(key.size, len(self.ids)), np.tile(starts, len(key))))
            self.ids.append(item_id)
            self.codes.append(own)
        self.indexes = {scheme: Index(*map(list, zip(*parts))) for scheme, parts in found.items()}
        self.sizes = np.array([len(own) for own in self.codes], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate([np.empty(0, U64), *self.codes])

    def found_in(self, texts: Sequence[np.ndarray]) -> list[list[tuple[int, int]]]:
        """For each document, given by its codes, the numbers of the items it holds and their distances.

        The windows of up to ``TOGETHER`` documents are looked up at once, with room between
        documents so that no walk leaves its own.
        """
        found: list[list[tuple[int, int]]] = []
        while len(found) < len(texts):
            group = texts[len(found) : len(found) + TOGETHER]
            fit = int(np.searchsorted(np.cumsum([len(own) for own in group]), TOGETHER_WORDS, "right"))
            group = group[: max(1, fit)]
            for own, candidates in zip(group, self._candidates(group)):
                found.append(self._verified(own, candidates) if candidates else [])
        return found

    def _candidates(self, group: Sequence[np.ndarray]) -> list[list[tuple[int, int]]]:
        """Items and where they would begin, in order, for each document.

        An item word that the document lacks costs an edit wherever the item may be, so items of
        which too many words are lacking are left out.
        """
        candidates: list[list[tuple[int, int]]] = [[] for _ in group]
        sizes = np.array([len(own) for own in group])
        if not sizes.any() or not self.indexes:
            return candidates
        begin = np.cumsum(sizes + ROOM) - sizes - ROOM
        whole = np.zeros(int(begin[-1] + sizes[-1] + ROOM), U64)
        for own, at in zip(group, begin):
            whole[at : at + len(own)] = own
        starts = ranges(begin, sizes)
        parts = [index.hits(scheme.keys(whole, starts)) for scheme, index in self.indexes.items()]
        windows, items, offsets = map(np.concatenate, zip(*parts))
        # one number for document, item and place, which may lie before the document
        owners = np.repeat(np.arange(len(group)), sizes)[windows]
        before = int(self.sizes.max())
        span = int(sizes.max()) + before
        places = starts[windows] - begin[owners] - offsets + before
        found = np.unique((owners * len(self.ids) + items) * span + places)
        pairs, places = found // span, found % span - before
        owners, items = pairs // len(self.ids), pairs % len(self.ids)
        cuts = np.searchsorted(owners, np.arange(len(group) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[k], cuts[k + 1])
            numbers, which = np.unique(items[own], return_inverse=True)
            near = self._enough(group[k], numbers)[which]
            candidates[k] = list(zip(items[own][near].tolist(), places[own][near].tolist()))
        return candidates

    def _enough(self, text: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether the text has as many words of each item as an occurrence within the limit keeps."""
        sizes = self.sizes[numbers]
        words = self.words[ranges(self.begin[numbers], sizes)]
        present = np.unique(text)
        at = np.minimum(np.searchsorted(present, words), len(present) - 1)
        common = np.add.reduceat(present[at] == words, np.cumsum(sizes) - sizes, dtype=np.int64)
        return common >= sizes - (MAX_EDITS * sizes).astype(np.int64)

    def _verified(self, own: np.ndarray, candidates: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Items within the limit of edits, by the exact distance around each candidate place."""
        best: dict[int, int] = {}
        checked: dict[int, tuple[int, int]] = {}
        for number, begin in candidates:
            item = self.codes[number]
            most = int(MAX_EDITS * len(item))
            start, end = max(0, begin - most), min(len(own), begin + len(item) + most)
            a, b = checked.get(number, (0, 0))
            if best.get(number) == 0 or (a <= start and end <= b):
                continue
            # neighbouring windows are verified together
            start, end = max(0, start - most), min(len(own), end + most)
            checked[number] = start, end
            if not self._enough(own[start:end], np.array([number]))[0]:
                continue
            distance = infix_distance(item, own[start:end])
            if distance <= most:
                best[number] = min(distance, best.get(number, distance))
        return sorted(best.items())


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """Items in blocks of at most ``block_words`` words (one longer item may exceed it)."""
    rows, total = [], 0
    shaped = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("raw"))
    for row in shaped.toLocalIterator():
        raw = bytes(row["raw"]) if row["raw"] is not None else None
        n = len((raw or b"").split())
        if rows and total + n > block_words:
            yield rows
            rows, total = [], 0
        rows.append((row["item_id"], raw))
        total += n
    if rows:
        yield rows


FOUND = "doc_id long, item_id long, distance long, item_words long"
_FOUND = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "distance", "item_words")])


def find(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and an item it holds, with the word edit distance: ``FOUND``."""
    spark, rows, found = docs.sparkSession, doc_frame(docs), None
    for block in item_blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block)  # bounded by block_words

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, codes = Items(shared.value), PlainCodes()
            for batch in batches:
                out = []
                texts = [codes.of_text(raw.as_py()) for raw in batch["raw"]]
                for doc_id, pairs in zip(batch["doc_id"].to_pylist(), items.found_in(texts)):
                    for number, distance in pairs:
                        out.append((doc_id, items.ids[number], distance, len(items.codes[number])))
                yield from table_of(_FOUND, **dict(zip(_FOUND.names, zip(*out) if out else [[]] * 4))).to_batches()

        part = rows.mapInArrow(run, FOUND)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], FOUND) if found is None else found


def flag(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of the documents with ``contaminated``, all columns kept.

    The check runs where the row is, so nothing is shuffled; blocks of items follow one another.
    """
    hit = F.lit(False)
    for block in item_blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # bounded by block_words
        hit = hit | _holds(shared)(F.col("text"))
    return docs.withColumn("contaminated", hit)


def _holds(shared) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def holds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, codes = Items(shared.value), PlainCodes()
        for texts in parts:
            own = [codes.of_text(None if t is None else t.encode()) for t in texts]
            yield pd.Series([bool(pairs) for pairs in items.found_in(own)], dtype=bool)

    return holds
