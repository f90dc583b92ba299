"""Packing: shortest-pack-first over the histogram of lengths.

Documents are tokenized in their partitions and cut into pieces: full sequences and a rest.
The rests' lengths form a histogram with at most ``max_len`` entries, whatever the number of
documents. It is packed on the driver: lengths are placed longest first, each into the pattern
with most room left, and counts of equal patterns move together. Patterns go back to the pieces
by rank: the k-th piece of a length takes the k-th place for that length.

Defined cases: a null or empty text has the one token that ends each document. Every row is
packed, repeated rows and ids too; their order among equals is by content. An empty table gives
no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from throngcast.llm.common import doc_frame, stored, table_of

MAX_LEN = 2048
END_ID = 1
#: Word endings that the tokenizer's split always takes apart from letters and digits before them.
LOOSE_END = b".,;:!?*%&$#|"
#: What ends the tokens that close a word, and words encoded as one text.
WORD_END, ENCODED_AT_ONCE = "</w>", 2_000
#: Bytes of texts whose new words are learnt together.
GROUP_BYTES = 1 << 20
#: Letters below are composed and have lower cases of one letter, but for the dotted capital I.
BEYOND_LATIN, DOTTED_I = "\u0250", "\u0130"
#: How byte-level merges write a byte: printable Latin-1 signs as they are, others in order from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Words whose ids a Python worker remembers, twice at most.
CACHED_WORDS = 250_000
#: Parts into which the pieces of one length are dealt for ranking.
SPREAD = 64

_PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds:
    """Token ids of a text, put together from ids remembered per word.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words in order; it lower-cases, so words differing in A-Z only share an entry. Texts
    that hold ``<|``, with which special tokens begin, are taken as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.closes = np.array([(self.tokenizer.id_to_token(k) or "").endswith(WORD_END) for k in range(size)])
        self.recent: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _merged(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters by the model's merges alone: as lower case it is one unit,
        composed already. None for other words."""
        if word.isalpha():
            text = word.decode().lower()
        else:
            text = word.decode()
            if not text.isalpha() or max(text) >= BEYOND_LATIN or DOTTED_I in text:
                return None
            text = text.lower().encode().decode("latin-1").translate(BYTE_SIGNS)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word. Words of letters only are one unit of the tokenizer, whose last token
        closes a word: they are encoded as one text and taken apart at these tokens."""
        plain = [w for w in words if w.decode().isalpha()]
        found: dict[bytes, bytes] = {}
        for start in range(0, len(plain), ENCODED_AT_ONCE):
            part = plain[start : start + ENCODED_AT_ONCE]
            text = b" ".join(part).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            if len(ends) == len(part):
                raw, starts = ids.tobytes(), [0, *ends[:-1].tolist()]
                found.update((w, raw[a:b]) for w, a, b in zip(part, starts, ends.tolist()))
        rest = [w for w in words if w not in found]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        found.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(rest, encoded))
        return found

    def _learn(self, words: set[bytes]) -> None:
        """Remember the words' ids; a loose ending after a letter or digit is encoded on its own."""
        recent, before, merged = self.recent, self.before, self._merged
        parts: dict[bytes, tuple[bytes, ...]] = {}
        missing: list[bytes] = []
        for word in words:
            ids = merged(word)
            if ids is not None:
                recent[word] = ids
                continue
            stem = word.rstrip(LOOSE_END)
            if len(stem) < len(word) and stem[-1:].isalnum() and b"<|" not in word and b"'" not in word:
                parts[word] = (stem, word[len(stem) :])
                for part in parts[word]:
                    if part not in recent:
                        ids = before.get(part) or merged(part)
                        if ids is None:
                            missing.append(part)
                        else:
                            recent[part] = ids
            else:
                missing.append(word)
        if missing:
            recent.update(self._encode(list(dict.fromkeys(missing))))
        recent.update({word: recent[stem] + recent[end] for word, (stem, end) in parts.items()})

    def of_all(self, raws: Iterable[bytes | None]) -> Iterator[bytes]:
        """``of`` for each text; the new words of a group of texts are learnt together."""
        group, held = [], 0
        for raw in raws:
            group.append(raw or b"")
            held += len(group[-1])
            if held > GROUP_BYTES:
                yield from self._of_group(group)
                group, held = [], 0
        yield from self._of_group(group)

    def _of_group(self, texts: list[bytes]) -> list[bytes]:
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        if len(self.recent) > CACHED_WORDS:
            self.recent, self.before = {}, self.recent
        unknown = set().union(*split).difference(self.recent)
        again = unknown & self.before.keys()
        self.recent.update({w: self.before[w] for w in again})
        if len(again) < len(unknown):
            self._learn(unknown - again)
        ids, end = self.recent.__getitem__, END_ID.to_bytes(4, "little")
        return [b"".join(map(ids, words)) + end for words in split]

    def of(self, raw: bytes | None) -> bytes:
        """Ids as unsigned little-endian 32-bit numbers, the end id last."""
        return self._of_group([raw or b""])[0]


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The Python worker's own instance, which its later tasks go on with."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN) -> DataFrame:
    """Each document cut into pieces of ``max_len`` tokens and a rest: ``PIECES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.of_all(raw.as_py() for raw in batch["raw"])):
                n = len(ids) // 4
                for start in range(0, n, max_len):
                    part = ids[4 * start : 4 * (start + max_len)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
            yield from table_of(_PIECES, **dict(zip(_PIECES.names, zip(*rows) if rows else [[]] * 5))).to_batches()

    return doc_frame(docs).mapInArrow(run, PIECES)


def pack_histogram(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their counts, from pieces counted by length.

    Lengths come longest first. Each goes into the pattern with most room left (the shortest
    pack); if fewer pieces than copies of the pattern remain, the pattern is split. A new pattern
    is begun where no room is left.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    rooms: set[int] = set()
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = max(rooms, default=0)
            if room < length:
                fit = max_len // length
                taken = (length,) * fit
                if left >= fit:
                    by_room[max_len - fit * length][taken] += left // fit
                    rooms.add(max_len - fit * length)
                if left % fit:
                    by_room[max_len - (left % fit) * length][taken[: left % fit]] += 1
                    rooms.add(max_len - (left % fit) * length)
                break
            pattern, copies = by_room[room].popitem()
            used = min(copies, left)
            if used < copies:
                by_room[room][pattern] = copies - used
            elif not by_room[room]:
                rooms.discard(room)
            by_room[room - length][(*pattern, length)] += used
            rooms.add(room - length)
            left -= used
    return sorted((p, n) for patterns in by_room.values() for p, n in patterns.items() if n)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, runs of ranks: ``length, first, last, times, sequence, offset``.

    Ranks ``first`` to ``last`` of the length take ``times`` places in each of the pattern's
    sequences, which begin at number ``sequence``; the places begin at ``offset``.
    """
    used: dict[int, int] = defaultdict(int)
    found, sequence = [], 0
    for pattern, copies in patterns:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            times = pattern.count(length)
            first = used[length]
            used[length] += times * copies
            found.append((length, first, used[length] - 1, times, sequence, offset))
            offset += times * length
        sequence += copies
    return found


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN) -> DataFrame:
    """One row per piece: ``PIECES`` with ``sequence_id`` and ``offset`` in the sequence.

    The pieces are written once, to be counted and joined. A hot length is ranked in ``SPREAD``
    parts whose counts give each part its first rank. The places are broadcast: their number is
    bounded by ``max_len``, not by the documents.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, max_len), "pieces")
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    dealt = cut.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(SPREAD)).cast("int"))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).collect()
    counts: dict[int, int] = defaultdict(int)
    first = []
    for row in sorted(sizes, key=lambda r: (r["length"], r["part"])):
        first.append((row["length"], row["part"], counts[row["length"]]))
        counts[row["length"]] += row["n"]
    firsts = spark.createDataFrame(first, "length long, part int, first_rank long")
    runs = spark.createDataFrame(
        places(pack_histogram(counts, max_len)),
        "run_length long, first long, last long, times long, sequence long, at long",
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1
    ranked = dealt.withColumn("within", within).join(F.broadcast(firsts), ["length", "part"])
    rank = F.col("within") + F.col("first_rank")
    fits = (F.col("length") == F.col("run_length")) & rank.between(F.col("first"), F.col("last"))
    nth = rank - F.col("first")
    return ranked.join(F.broadcast(runs), fits).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("times")) * F.col("length")).cast("long").alias("offset"),
    )
