"""Token counts: huge texts encoded in overlapping chunks, spliced at proven common boundaries.

A text of more than ``long_bytes`` is cut every ``chunk`` code points. Each chunk is encoded with
``overlap`` code points more on both sides, so two encodings, of the chunk before and of the chunk
after, cover the place around each cut. They are spliced where both begin a unit at the same place
(a unit is what the tokenizer's split hands to the merges: its last token closes a word).

Why such a place is stable: the split scans from left to right and looks at nothing before the
place where a unit begins, so both encodings go on alike from there. The chunk before is right up
to that place, having been spliced the same way itself; the place lies ``MARGIN`` code points before
its end, further than a contraction or special token reaches ahead. The character at the place
begins a normalisation segment, so composition does not reach across it. Thus the tokens of a text
are, for each cut, those of the chunk before up to the place and those of the chunk after from it.

Where two encodings have no such place in common, all chunks of the text are cut anew with wider
overlaps, round by round, until one chunk holds the text. Chunks are dealt over all tasks, equal
chunks once; counts before and after each cut are summed by Spark. Shorter texts are counted in
their partitions.

Defined cases: a null or empty text has no bytes and no tokens. Equal rows have equal counts and
rows keep their number; rows without an id are counted too. An empty table gives no rows. Other
columns are ignored. A task holds one text, its batch of chunks and one encoding; a text that has
no common boundary at all (one word of any length) is encoded whole in the end.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import doc_frame, stored, table_of
from throngcast.llm.packing import WordIds, word_ids

#: Tokens beyond which a document is over the limit.
LIMIT = 2048
#: Texts of more bytes are cut; code points of a chunk, and of its first overlap on each side.
LONG_BYTES, CHUNK, OVERLAP = 32_768, 16_384, 256
#: Overlaps grow by this factor from round to round, and chunks are at least this many overlaps.
WIDER, CHUNK_OVERLAPS = 8, 8
#: Code points before a chunk's end in which the text beyond may change units.
MARGIN = 32
CHUNKS_AT_ONCE = 64

_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
COUNTED = "doc_id long, n_bytes long, n_tokens long"
_CHUNKS = pa.schema([
    ("digest", pa.string()), ("part", pa.int64()), ("begin", pa.int64()), ("cut", pa.int64()), ("next_cut", pa.int64()), ("chunk", pa.string()),
])
CHUNKS = "digest string, part long, begin long, cut long, next_cut long, chunk string"
_ENDS = pa.schema([
    ("digest", pa.string()), ("place", pa.int64()), ("before", pa.bool_()), ("at", pa.list_(pa.int64())), ("passed", pa.list_(pa.int64())), ("total", pa.int64()),
])
ENDS = "digest string, place long, before boolean, at array<long>, passed array<long>, total long"


@lru_cache(maxsize=1)
def _second_in_pair() -> frozenset[str]:
    """Characters that composition may join to one before: seconds of canonical pairs, Hangul vowels and finals."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0xC0, 0x110000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(seconds.union(map(chr, range(0x1161, 0x1176)), map(chr, range(0x11A8, 0x11C3))))


def begins_segment(char: str) -> bool:
    """Whether normalisation can't reach across the place before this character."""
    if char.isascii():
        return True
    first = unicodedata.normalize("NFD", char)[0]
    return unicodedata.category(char) != "Cn" and not unicodedata.combining(first) and first not in _second_in_pair()


def encoded_units(words: WordIds, chunk: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Where each unit but the first begins in the chunk, the tokens before it, and all tokens."""
    encoding = words.tokenizer.encode_batch([chunk], add_special_tokens=False)[0]
    ids = np.array(encoding.ids, np.int64)
    offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    special = np.isin(ids, list(words.tokenizer.get_added_tokens_decoder()))
    closing = words.closes[ids] | special
    closing[:-1] |= special[1:]
    tokens = np.flatnonzero(closing[:-1]) + 1
    return offsets[tokens, 0], tokens, len(ids)


def places(chunk: str, starts: np.ndarray, tokens: np.ndarray, low: int, high: int) -> tuple[list[int], list[int]]:
    """Of units that begin in ``[low, high)`` of the chunk, those that are stable, with the tokens before each."""
    a, b = np.searchsorted(starts, [low, high])
    good = [k for k in range(a, b) if begins_segment(chunk[int(starts[k])])]
    return starts[good].tolist(), tokens[good].tolist()


def _cut(raw: bytes, chunk: int, overlap: int) -> Iterator[tuple[int, int, int, int | None, str]]:
    """Part, begin, cut and next cut of each chunk, and its text with both overlaps."""
    text = raw.decode("utf-8", "replace")
    cuts = [*range(0, max(1, len(text) - overlap), chunk)]
    for part, cut in enumerate(cuts):
        last = part + 1 == len(cuts)
        begin, end = max(0, cut - overlap), len(text) if last else cut + chunk + overlap
        yield part, begin, cut, None if last else cut + chunk, text[begin:end]


def chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of ``digest, raw``, each distinct one once: ``CHUNKS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, raw in zip(batch["digest"].to_pylist(), batch["raw"]):
                rows = []
                for row in _cut(raw.as_py(), chunk, overlap):
                    rows.append((digest, *row))
                    if len(rows) == CHUNKS_AT_ONCE:
                        yield from _rows(_CHUNKS, rows)
                        rows = []
                yield from _rows(_CHUNKS, rows)

    dealt = docs.mapInArrow(run, CHUNKS)
    rest = [n for n in _CHUNKS.names if n not in ("digest", "part")]
    return dealt.groupBy("digest", "part").agg(*[F.first(n).alias(n) for n in rest]).select(*_CHUNKS.names)


def ends(cut: DataFrame, tokenizer_path: str, overlap: int) -> DataFrame:
    """Boundaries of each chunk around its two cuts, and the tokens of a text's last chunk: ``ENDS``.

    ``place`` is the cut; ``before`` tells the chunk that ends there from the one that begins there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text, begin, cut, next_cut = row["chunk"], row["begin"], row["cut"], row["next_cut"]
                starts, tokens, total = encoded_units(words, text)
                last = len(text) if next_cut is None else len(text) - MARGIN
                if row["part"]:
                    at, passed = places(text, starts, tokens, 0, min(cut + overlap - begin, last))
                    rows.append((row["digest"], cut, False, [begin + x for x in at], passed, None))
                if next_cut is None:
                    rows.append((row["digest"], None, None, None, None, total))
                else:
                    at, passed = places(text, starts, tokens, next_cut - overlap - begin, last)
                    rows.append((row["digest"], next_cut, True, [begin + x for x in at], passed, None))
            yield from _rows(_ENDS, rows)

    return cut.mapInArrow(run, ENDS)


def spliced(found: DataFrame) -> DataFrame:
    """``digest, n_tokens`` of texts from the ``ENDS`` of their chunks; null where a cut has no common boundary."""
    side = lambda before: F.max(F.when(F.col("before") == before, F.struct("at", "passed")))
    cuts = found.groupBy("digest", "place").agg(side(True).alias("l"), side(False).alias("r"), F.max("total").alias("total"))
    common = F.array_min(F.array_intersect("l.at", "r.at"))
    tokens = lambda run: F.element_at(f"{run}.passed", F.array_position(f"{run}.at", F.col("common")).cast("int"))
    gained = F.when(F.col("place").isNull(), F.col("total")).when(F.col("common").isNotNull(), tokens("l") - tokens("r"))
    each = cuts.withColumn("common", common).select("digest", gained.alias("gained"))
    complete = F.count("gained") == F.count(F.lit(1))
    return each.groupBy("digest").agg(F.when(complete, F.sum("gained")).alias("n_tokens"))


def _rows(schema: pa.Schema, rows: list[tuple]) -> list[pa.RecordBatch]:
    return table_of(schema, **dict(zip(schema.names, zip(*rows)))).to_batches() if rows else []


def long_counts(texts: DataFrame, tokenizer_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``digest, n_tokens`` of each distinct text of ``digest, raw``, in as many rounds as texts need."""
    counted, rest = None, texts
    while True:
        result = stored(spliced(ends(chunks(rest, max(chunk, CHUNK_OVERLAPS * overlap), overlap), tokenizer_path, overlap)), "token-counts")
        good = result.where(F.col("n_tokens").isNotNull())
        counted = good if counted is None else counted.unionByName(good)
        failed = result.where(F.col("n_tokens").isNull()).select("digest")
        if failed.isEmpty():
            return counted
        rest = texts.join(failed, "digest", "left_semi")
        overlap *= WIDER


def short_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``COUNTED`` of texts that are not cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            raws = [raw.as_py() or b"" for raw in batch["raw"]]
            tokens = [len(ids) // 4 - 1 for ids in words.of_all(raws)]  # without the end id
            yield from table_of(_COUNTED, doc_id=batch["doc_id"].to_pylist(), n_bytes=[*map(len, raws)], n_tokens=tokens).to_batches()

    return docs.mapInArrow(run, COUNTED)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, *, limit: int = LIMIT, long_bytes: int = LONG_BYTES, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    The tokenizer is one of words whose last tokens are marked, in a file of the ``tokenizers``
    library. Special tokens written in a text count as the library takes them, as one token each.
    """
    texts = doc_frame(docs)
    is_long: Column = F.coalesce(F.octet_length("raw") > long_bytes, F.lit(False))
    long = texts.where(is_long).select("doc_id", "raw", F.md5("raw").alias("digest"))
    counts = long_counts(long.select("digest", "raw"), tokenizer_path, chunk, overlap)
    cut = long.select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), "digest").join(counts, "digest")
    both = short_counts(texts.where(~is_long), tokenizer_path).unionByName(cut.drop("digest"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
