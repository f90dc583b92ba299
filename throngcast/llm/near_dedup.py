"""Near-duplicate documents: MinHash bands, odd-sketch verification, exact confirmation.

1. Each document becomes a set of word shingles. One permutation hashing gives its MinHash
   samples, cut into bands; the samples are also folded into a parity bitmap (odd sketch), whose
   XOR with another one counts, precisely for high similarities, the samples that differ.
2. Equal sets are one node. Nodes that share a band are candidates. First each node is tested
   against the smallest node of its bands only. Components of the links found so far make most
   bands uniform; only bands that still hold several components are compared in full, in blocks,
   and only across components. So no band emits all its pairs, and no link that could join two
   components is left out.
3. Candidates whose sketches pass are confirmed on the full shingle sets, then connected.

Bands and the margin of the sketch filter are both chosen from ``MISS``: a pair at the threshold
shares no band, or has sketches that differ by more than the filter lets pass, with a probability
below it each.

Defined cases: fewer words than a shingle make one shingle of the whole sequence; a null text or
one without words has the empty set and links with nothing. Rows that repeat an id
count as one document, which links with whatever one of its texts links with; each row has the
size of its own set. A row without an id takes its set's class, and stays where it has none. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import (
    U64, WordCodes, doc_frame, gram_hashes, mixed, multipliers, shuffle_width, stored, table_of,
)

MISS = 1e-6
SAMPLES = 360
SKETCH_BITS = 1024
TRIES = 64
#: Sets smaller than this skip the sketch filter, which needs many independent samples.
SMALL_SET = 64
#: Standard deviation of a sketch's estimate over that of as many independent samples, at most:
#: 1.25 was measured for sets of 70 shingles, 0.98 for 1,000.
SPREAD = 1.3
#: Members compared at once; larger bands are dealt out in pairs of blocks.
BLOCK = 1024
#: Ids of at most this number are broadcast (16 bytes each); beyond it they are joined by shuffle.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class MinHasher:
    """Shingle sets, samples, bands and sketches for a similarity of ``percent`` or more."""

    words: int = 5
    percent: int = 85
    bands: int = field(init=False)
    rows: int = field(init=False)

    def __post_init__(self):
        s = self.percent / 100
        good = [r for r in range(1, 13) if (1 - s**r) ** (SAMPLES // r) <= MISS]
        rows = max(good, default=1)
        object.__setattr__(self, "rows", rows)
        object.__setattr__(self, "bands", SAMPLES // rows)

    def shingles(self, raw: bytes | None, codes: WordCodes) -> np.ndarray:
        """Sorted distinct hashes of the shingles."""
        own = codes.of((raw or b"").lower().split())
        if 0 < len(own) < self.words:
            return gram_hashes(own, len(own), 100 + len(own))
        return np.unique(gram_hashes(own, self.words))

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        """Smallest hash of each of ``SAMPLES`` bins. An empty bin takes the sample of the first
        filled one in its own fixed sequence, at last the smallest under a hash of its own."""
        at = np.minimum(np.searchsorted(hashes, _BIN_STARTS), len(hashes) - 1)
        found = hashes[at]
        filled = ((found >> U64(32)) * U64(SAMPLES)) >> U64(32) == _BINS
        out = np.where(filled, found, U64(0))
        empty = np.flatnonzero(~filled)
        for tries in _PROBES:
            if not len(empty):
                return out
            hit = filled[tries[empty]]
            out[empty[hit]] = found[tries[empty[hit]]]
            empty = empty[~hit]
        if len(empty):
            own = mixed(hashes[None, :] ^ _SEEDS[empty, None])
            out[empty] = hashes[np.argmin(own, axis=1)]
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        used = samples[: self.bands * self.rows].reshape(self.bands, self.rows)
        return mixed((used * _ROW_FACTORS[: self.rows]).sum(axis=1, dtype=U64) + _SEEDS[: self.bands]).view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        places = mixed(samples + _SEEDS) % U64(SKETCH_BITS)
        return np.packbits(np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1).view(np.int64)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return bool(both) and 100 * both >= self.percent * (len(a) + len(b) - both)

    def plausible(self, differing: np.ndarray) -> np.ndarray:
        """Whether so many differing sketch bits may belong to a pair at the threshold."""
        inside = np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9)
        distinct = -SKETCH_BITS / 2 * np.log(inside)
        return 1 - distinct / (2 * SAMPLES) >= self.percent / 100 - self.margin

    @property
    def margin(self) -> float:
        """How far below the threshold the estimate of a pair at it may lie, but for ``MISS`` of them."""
        s = self.percent / 100
        return NormalDist().inv_cdf(1 - MISS) * SPREAD * math.sqrt(s * (1 - s) / SAMPLES)

    def most_bits(self) -> int:
        return int(np.flatnonzero(self.plausible(np.arange(SKETCH_BITS // 2)))[-1])


_BINS = np.arange(SAMPLES, dtype=U64)
_BIN_STARTS = ((_BINS * U64(2**32) + U64(SAMPLES - 1)) // U64(SAMPLES)) << U64(32)
_PROBES = np.random.default_rng(5).integers(0, SAMPLES, (TRIES, SAMPLES))
_SEEDS = multipliers(SAMPLES, 6)
_ROW_FACTORS = multipliers(12, 7)

SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>, bands array<long>"
_SIGNATURES = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
     ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)


def signatures(docs: DataFrame, hasher: MinHasher) -> DataFrame:
    """``SIGNATURES``: size, 128-bit digest of the set, odd sketch and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"]):
                hashes = hasher.shingles(raw.as_py(), codes)
                if len(hashes):
                    samples = hasher.samples(hashes)
                    a, b = (mixed(hashes * _SEEDS[k]).sum(dtype=U64).astype(np.int64) for k in (0, 1))
                    rows.append((doc_id, len(hashes), a, b, hasher.sketch(samples), hasher.band_keys(samples)))
                else:
                    rows.append((doc_id, 0, 0, 0, None, None))
            yield from table_of(_SIGNATURES, **dict(zip(_SIGNATURES.names, zip(*rows) if rows else [[]] * 6))).to_batches()

    return doc_frame(docs).mapInArrow(run, SIGNATURES)


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over edges ``a, b``.

    Labels move over the edges and then jump to their label's label, so the rounds grow with the
    logarithm of the longest path. Each round is written, so that lineage stays short.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        moved = labels.join(jump, "component").join(near, "node").select(
            "node", F.least("component", "far", "near").alias("component"), F.col("component").alias("was")
        )
        moved = stored(moved, "labels")
        if moved.where("component < was").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")


def _confirmed(pairs: DataFrame, texts: DataFrame, hasher: MinHasher) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            a, b, kept = batch["a"].to_pylist(), batch["b"].to_pylist(), []
            last, left = None, np.empty(0, U64)
            for k in range(len(a)):
                raw = batch["raw_a"][k].as_py()
                if raw != last:
                    last, left = raw, hasher.shingles(raw, codes)
                if hasher.linked(left, hasher.shingles(batch["raw_b"][k].as_py(), codes)):
                    kept.append(k)
            yield from pa.table({"a": [a[k] for k in kept], "b": [b[k] for k in kept]}, schema=_PAIR).to_batches()

    side = lambda s: texts.select(F.col("doc_id").alias(s), F.col("raw").alias(f"raw_{s}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "raw_a", "raw_b").mapInArrow(run, "a long, b long")


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _differing(x: Column, y: Column) -> Column:
    """Bits in which two sketches, as arrays of longs, differ."""
    bits = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int"))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def _across(members: DataFrame, hasher: MinHasher) -> DataFrame:
    """Plausible pairs of different components, from bands ``key, size, rep, component, n_shingles, sketch``.

    A band above ``BLOCK`` members is dealt out as pairs of blocks, to as many tasks.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        members.withColumns({"blocks": blocks, "own": own}).withColumn("other", other)
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                "rep", "component", "n_shingles", "sketch")
        .repartition(shuffle_width(members.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    )
    limit = hasher.most_bits()

    def pairs_of(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rep, comp, n = (t[c].to_numpy() for c in ("rep", "component", "n_shingles"))
        own, i, j = (t[c].to_numpy() for c in ("own", "i", "j"))
        sketch = t["sketch"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        for k in range(len(rep) - 1):
            # within one block each pair once; between two blocks only pairs of both
            rest = slice(k + 1, None)
            ok = (comp[rest] != comp[k]) & ((i[k] == j[k]) | (own[rest] != own[k]))
            at = np.flatnonzero(ok) + k + 1
            if len(at):
                bits = np.bitwise_count(sketch[at] ^ sketch[k]).sum(axis=1)
                at = at[(bits <= limit) | (np.minimum(n[at], n[k]) < SMALL_SET)]
                if len(at):
                    yield np.minimum(rep[at], rep[k]), np.maximum(rep[at], rep[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("key", "i", "j")):
            for a, b in pairs_of(group):
                yield pa.record_batch([pa.array(a), pa.array(b)], schema=_PAIR)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of rows with equal ``by``, from batches sorted by it."""
    open_parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch[c].to_numpy() for c in by], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == 0 and open_parts:
                last = open_parts[-1]
                if tuple(last[c][last.num_rows - 1].as_py() for c in by) != tuple(keys[0].tolist()):
                    yield pa.Table.from_batches(open_parts)
                    open_parts = []
            elif start:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_parts.append(batch.slice(start, end - start))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def classes(docs: DataFrame, words: int = 5, percent: int = 85) -> DataFrame:
    """Every document with ``n_shingles, component_id, kept``."""
    hasher = MinHasher(words, percent)
    signed = stored(signatures(docs, hasher), "signatures")
    same_set = ["set_a", "set_b", "n_shingles"]
    nodes = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*same_set).agg(F.min("doc_id").alias("rep"))
    repeated = signed.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    one_id = signed.join(repeated, "doc_id").join(nodes, same_set).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # an id with several texts has all their sketches
    sketches = signed.where("n_shingles > 0").select(F.col("doc_id").alias("rep"), "sketch", "n_shingles").distinct()
    keys = (
        signed.join(nodes.select("rep").distinct().withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key")).distinct()
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("lead")).where("size > 1")
    members = stored(keys.join(shared, "key"), "members")

    needed = members.select(F.col("rep").alias("doc_id")).distinct()
    few = needed.count() <= BROADCAST_IDS
    texts = stored(doc_frame(docs).join(F.broadcast(needed) if few else needed, "doc_id", "left_semi"), "texts")

    # round one: each node against the first node of its bands
    sketched = lambda df, s: df.join(
        sketches.select(F.col("rep").alias(s), F.col("sketch").alias(f"sketch_{s}"), F.col("n_shingles").alias(f"n_{s}")), s
    )
    stars = members.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    near = (_differing(F.col("sketch_a"), F.col("sketch_b")) <= hasher.most_bits()) | (F.least("n_a", "n_b") < SMALL_SET)
    stars = sketched(sketched(stars, "b"), "a").where(near).select("a", "b").distinct()
    links = stored(_confirmed(stars, texts, hasher), "links")
    first = components(links)

    # round two: bands that still hold several components
    placed = members.join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    mixed_bands = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_members = placed.join(mixed_bands, "key").select("key", "size", "rep", "component").join(sketches, "rep")
    more = stored(_confirmed(_across(open_members, hasher), texts, hasher), "links")
    found = components(links.union(more).union(one_id))

    whole = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(nodes, same_set, "left").join(
        found.withColumnRenamed("node", "rep"), "rep", "left"
    )
    component = F.coalesce("component", "rep", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
