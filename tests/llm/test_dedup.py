from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import AccumulatorParam
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm import brute
from throngcast.llm import near_dedup, substring_dedup
from throngcast.llm.substring_dedup import FMIndex


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def order(row):
    return tuple((x is not None, x) for x in row)


def same_as_brute(df):
    found = sorted((tuple(r) for r in substring_dedup.dedup(df).collect()), key=order)
    expected = [
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest(), kept) for i, n, gone, kept in brute.kept_words(pairs(df))
    ]
    assert found == sorted(expected, key=order)


def test_substrings_of_documents(spark):
    same_as_brute(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_substrings_of_odd_documents(odd_documents):
    same_as_brute(odd_documents)


def test_substrings_of_no_documents(no_documents):
    assert substring_dedup.dedup(no_documents).count() == 0


def test_overlapping_and_adjacent_passages(documents):
    rng = random.Random(4)
    base = [f"w{rng.randrange(40)}" for _ in range(600)]
    rows = []
    for k in range(60):
        a, b = sorted(rng.sample(range(600), 2))
        rows.append((k, " ".join(base[a:b] + [f"u{k}"] + base[: rng.randrange(30)]), "en"))
    same_as_brute(documents(*rows))


def test_documents_in_many_blocks(spark, odd_documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 40_000)
    test_substrings_of_documents(spark)
    test_substrings_of_odd_documents(odd_documents)


def test_hot_minimisers_go_window_by_window(spark, odd_documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 3)
    test_documents_in_many_blocks(spark, odd_documents, monkeypatch)


class Most(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, a, b):
        return max(a, b)


def test_a_hot_passage_is_spread_over_shards(spark, monkeypatch):
    """One passage in 30,000 documents: a block sends its windows once, and its edges, which differ
    from copy to copy, do not meet in one shard."""
    passage = [f"p{k}" for k in range(20)]
    own = [F.concat(F.lit(f"{side}{k}-"), F.col("id")) for side in "ab" for k in range(12)]
    text = F.concat_ws(" ", *own[:12], *map(F.lit, passage), *own[12:])
    docs = spark.range(30_000, numPartitions=4).select(F.col("id").alias("doc_id"), text.alias("text"))
    most, sent = spark.sparkContext.accumulator(0, Most()), spark.sparkContext.accumulator(0)
    search = substring_dedup._search

    def watched(words):
        inner = search(words)

        def run(table):
            stretches = sum(len(substring_dedup.unpacked(b)[0]) for b in table["blob"].to_pylist())
            most.add(stretches)
            sent.add(stretches)
            return inner(table)

        return run

    monkeypatch.setattr(substring_dedup, "_search", watched)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 500_000)
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 10_000)
    found = substring_dedup.dedup(docs).agg(F.sum((F.col("n_removed") == 20).cast("int")), F.sum("n_removed"), F.min_by("n_removed", "doc_id"))
    assert tuple(found.first()) == (29_999, 29_999 * 20, 0)
    shards = 2 * substring_dedup.block_count(docs, 500_000)
    assert shards > 20 and most.value < 2 * sent.value / shards


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.lists(st.integers(1, 5), min_size=1, max_size=5))
def test_backward_search_counts_matches(text, pattern):
    symbols = np.array([*text, 0, *pattern, 0])
    index = FMIndex(symbols, 6)
    low, high = index.intervals(symbols, np.array([len(symbols) - 1]), len(pattern))
    n = len(pattern)
    at = [k for k in range(len(symbols) - n + 1) if symbols[k : k + n].tolist() == pattern]
    assert sorted(index.suffixes[low[0] : high[0]].tolist()) == at


def classes(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.classes(df, **options).collect()}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_of_documents(spark, percent):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert classes(docs, percent=percent) == brute.near_classes(pairs(docs), percent)


def test_near_duplicates_in_a_hot_group(documents):
    """Copies of one text with more and more edits: many share bands without being linked."""
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(300):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 8])):
            text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(text), "en"))
    df = documents(*rows)
    assert classes(df) == brute.near_classes(pairs(df))


def test_large_bands_are_split_and_lose_nothing(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    test_near_duplicates_in_a_hot_group(documents)


def test_near_duplicates_of_odd_documents(odd_documents):
    rows = {}
    for r in near_dedup.classes(odd_documents).collect():
        rows.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert rows[1] == {(1, True)} and rows[None] == {(1, False)}
    assert rows[12] == {(1, False)} and rows[7] == {(6, False)} and rows[11] == {(10, False)} and rows[8] == {(1, False)}
    assert all(rows[k] == {(k, True)} for k in (2, 3, 4, 5, 6, 9, 10))


def test_near_duplicates_of_no_documents(no_documents):
    assert near_dedup.classes(no_documents).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in near_dedup.components(edges).collect()} == {0}


def test_bands_find_pairs_at_the_threshold():
    hasher = near_dedup.MinHasher()
    assert (1 - 0.85**hasher.rows) ** hasher.bands <= near_dedup.MISS


def test_sketches_estimate_similarity():
    hasher, rng = near_dedup.MinHasher(), np.random.default_rng(3)
    for share in (0.85, 0.9, 0.98):
        for _ in range(40):
            both = int(400 * share)
            pool = rng.integers(0, 2**63, 800 - both, dtype=np.uint64)
            a, b = np.unique(pool[:400]), np.unique(np.concatenate([pool[:both], pool[400:]]))
            if hasher.linked(a, b):
                bits = [hasher.sketch(hasher.samples(x)).view(np.uint64) for x in (a, b)]
                assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= hasher.most_bits()


@pytest.mark.parametrize("percent", [80, 85])
def test_sketch_filter_keeps_pairs_at_the_threshold(percent):
    """The filter's limit lies as many deviations beyond pairs at the threshold as ``MISS`` asks."""
    hasher, rng = near_dedup.MinHasher(percent=percent), np.random.default_rng(percent)
    for union in (70, 100, 160, 250, 400):
        both, bits = -(-percent * union // 100), []
        half = both + (union - both) // 2
        for _ in range(1200):
            pool = rng.integers(0, 2**64, union, dtype=np.uint64)
            a, b = np.unique(pool[:half]), np.unique(np.concatenate([pool[:both], pool[half:]]))
            x, y = (hasher.sketch(hasher.samples(v)).view(np.uint64) for v in (a, b))
            bits.append(int(np.bitwise_count(x ^ y).sum()))
        estimates = 1 + np.log(1 - 2 * np.array(bits) / near_dedup.SKETCH_BITS) * near_dedup.SKETCH_BITS / 4 / near_dedup.SAMPLES
        assert hasher.plausible(np.array(bits)).all()
        assert (estimates.mean() - (percent / 100 - hasher.margin)) / estimates.std() > 4.5


def test_an_id_with_several_texts_links_through_all_of_them(spark):
    """One text of document 3 is close to document 1, the other to document 2, on any partitioning."""
    a, b = (" ".join(f"{x}{k}" for k in range(200)) for x in "ab")
    rows = [(1, a), (2, b), (3, a + " tail"), (3, b + " tail"), (3, "other words"), (4, "other words")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        for parts in (1, 3):
            df = spark.createDataFrame(order, "doc_id long, text string").repartition(parts)
            found = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.classes(df).collect()}
            assert found == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False)}
