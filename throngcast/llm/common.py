"""Helpers the operators share: words, word codes, hashes, packed blocks, written tables.

A word is a maximal run of bytes other than space and 0x09-0x0D. ``bytes.split`` splits at
exactly these, and ``bytes.lower`` changes A-Z only, so texts are handled as UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from throngcast.session import scratch_path

U64 = np.uint64
CODE_CACHE = 400_000


class WordCodes(dict):
    """64-bit code of each word, remembered for up to ``CODE_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CODE_CACHE:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit factors fixed by the seed."""
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=U64) * U64(2) + U64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def gram_hashes(codes: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of every run of ``n`` codes; empty where there are fewer."""
    if len(codes) < n:
        return np.empty(0, U64)
    size = len(codes) - n + 1
    total = np.zeros(size, U64)
    for k, factor in enumerate(multipliers(n, seed)):
        total += codes[k : k + size] * factor
    return mixed(total)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of any integer or float type as one compressed value."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), a.size))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = np.frombuffer(raw, np.int64, 1)
    heads, at, arrays = np.frombuffer(raw, np.int64, 2 * n, 8), 8 + 16 * int(n), []
    for kind, size in heads.reshape(-1, 2):
        dtype = np.dtype(chr(kind))
        arrays.append(np.frombuffer(raw, dtype, size, at))
        at += int(size) * dtype.itemsize
    return arrays


def parts_by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct key with the positions that hold it."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for part in np.split(order, cuts):
        yield int(keys[part[0]]), part


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each range, one range after the other."""
    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    return np.repeat(np.asarray(starts, np.int64) - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


_BLOCK = pa.schema([("block", pa.int64()), ("blob", pa.binary())])


def text_blocks(docs: DataFrame, blocks: int, text: str = "text", lang: str | None = None) -> DataFrame:
    """Documents dealt into ``blocks`` by a hash of their id: ``block, blob``.

    The documents of one batch and block travel as one compressed value, read back with
    ``documents_of``. Rows without an id are in block 0.
    """
    chosen = doc_frame(docs, text) if lang is None else doc_frame(docs.withColumn("_lang", F.col(lang).cast("binary")), text, keep="_lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.array(batch["doc_id"].is_valid())
            ids = np.array(batch["doc_id"].fill_null(0))
            raws = batch["raw"].to_pylist()
            langs = batch["_lang"].to_pylist() if lang is not None else [None] * len(ids)
            block, blob = [], []
            for k, at in parts_by(np.where(known, block_of(ids, blocks), 0)):
                block.append(k)
                blob.append(packed(ids[at], known[at].astype(np.int8), *_joined([raws[j] for j in at]), *_joined([langs[j] for j in at])))
            yield from table_of(_BLOCK, block=block, blob=blob).to_batches()

    return chosen.mapInArrow(run, "block long, blob binary")


def block_count(docs: DataFrame, size: int, text: str = "text") -> int:
    """Blocks of about ``size`` bytes of text each, from one count of all bytes: the same rule at every size."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return max(1, -(-total // size))


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(ids.astype(U64)) % U64(blocks)).astype(np.int64)


def _joined(values: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([-1 if v is None else len(v) for v in values], np.int64)
    return sizes, np.frombuffer(b"".join(v or b"" for v in values), np.uint8)


def _taken_apart(sizes: np.ndarray, joined: np.ndarray) -> Iterator[bytes | None]:
    raw, at = joined.tobytes(), 0
    for size in sizes.tolist():
        yield None if size < 0 else raw[at : at + size]
        at += max(size, 0)


def documents_of(table: pa.Table) -> Iterator[tuple[int | None, bytes | None, bytes | None]]:
    """Id, text and language of each document in the rows of a block, one row unpacked at a time."""
    for blob in table["blob"]:
        ids, known, sizes, texts, lang_sizes, langs = unpacked(blob.as_py())
        for doc_id, ok, raw, lang in zip(ids.tolist(), known.tolist(), _taken_apart(sizes, texts), _taken_apart(lang_sizes, langs)):
            yield doc_id if ok else None, raw, lang


def table_of(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


def doc_frame(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str | None = None) -> DataFrame:
    """Only the id and the text as bytes, whatever other columns there are."""
    own = F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("raw")
    return docs.select(*own, *([keep] if keep else []))


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle width, which its user sets to the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: lineage ends here, and
    the files outlive any executor. The folder belongs to the run; drop it with the run."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id's decimal text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def hashed_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of the key: the same rows at every run."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(bound)
