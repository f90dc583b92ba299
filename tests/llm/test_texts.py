from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from tests.llm import brute
from throngcast.llm import decontamination, packing, pii, quality_rules

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- packing -----------------------------------------------------------------


def check_packing(df):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packing.pack(df, TOKENIZER).collect()
    expected = Counter()
    for doc_id, text in texts(df):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            expected[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_of_documents(docs):
    check_packing(docs)


def test_packing_of_odd_documents(odd_documents, documents):
    check_packing(odd_documents)
    check_packing(documents((1, "A<|endoftext|>b's <|ENDOFTEXT|> it's don't.", "en"), (2, "Ünï·ⅷ ªº ﬁ ́x É?! 12a", "en")))


def test_packing_of_no_documents(no_documents):
    assert packing.pack(no_documents, TOKENIZER).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_histogram_is_packed_whole(counts):
    patterns = packing.pack_histogram(counts, 64)
    packed = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            packed[length] += n
    assert packed == Counter(counts)


# --- personal data -----------------------------------------------------------


def test_plain_spans(docs, odd_documents):
    for df in (docs, odd_documents):
        found = pii.find(df).collect()
        by_id = dict(texts(df))
        for r in found:
            spans = brute.pii(by_id[r["doc_id"]])
            text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
            assert set(text.split(",")) <= set(r["spans"].split(","))
        assert len(found) == df.count()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1239.@+-() ,\n%", max_size=40))
def test_plain_patterns_match_their_definition(text):
    assert [(k, a, b) for k in pii.KINDS for a, b in pii.base_spans(text)[k]] == brute.pii(text)


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("email", "john.doe [at] example [dot] com"), ("email", "john.doe (at) example.com"),
        ("email", "john at example dot co dot uk"), ("email", "john@example dot com"), ("email", "jоhn@exаmple.com"),
        ("email", "ｊｏｈｎ＠example.com"), ("email", "jo​hn@example.com"), ("ip", "10[.]0[.]12[.]1"),
        ("ip", "１０.0.12.1"), ("card", "４111 1111 1111 1111"), ("phone", "+1 (212) 555‑0147"),
        ("phone", "plus 1 two one two five five five oh one four seven"),
        ("card", "four one one one one one one one one one one one one one one one"),
    ],
)
def test_disguises_map_back_to_the_source(kind, text):
    base, full = pii.all_spans(f"So é {text} end")
    whole = (5, 5 + len(text))
    assert whole not in base[kind] and whole in full[kind]
    assert set(base[kind]) <= set(full[kind]) <= {whole, *base[kind]}


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("email", "jane dot doe at example dot com"), ("email", "jane [dot] m (punkt) doe [at] example.com"),
        ("email", "jane dot doe at example.com"), ("ip", "one two seven dot zero dot zero dot one"),
        ("ip", "one zero.0.0.1"), ("ip", "192 dot 168 [dot] zero.one"), ("ip", "eight.eight.eight.eight"),
    ],
)
def test_disguised_dots_in_local_parts_and_ips(kind, text):
    base, full = pii.all_spans(f"So é {text} end")
    assert not any(base.values())
    assert {k: v for k, v in full.items() if v} == {kind: [(5, 5 + len(text))]}
    assert pii.mask_text(f"So é {text} end") == f"So é [{kind.upper()}] end"


def test_disguised_dot_before_a_plain_address():
    assert pii.mask_text("by jane dot doe@example.com, ok") == "by [EMAIL], ok"
    assert pii.mask_text("a dot  doe at example dot com") == "a dot  [EMAIL]"


@pytest.mark.parametrize("text", ["one dot two dot three", "version one.two", "a dot in the map at noon", "one.two.three.fourth"])
def test_dots_between_words_are_no_disguise(text):
    assert not any(pii.all_spans(text)[1].values())


@pytest.mark.parametrize("text", ["a dot " * 50_000 + "@", "one dot " * 50_000, "a dot a at b.c " * 20_000, "1 1 1." * 50_000])
def test_long_runs_of_dots_take_linear_time(text):
    pii.all_spans(text)


@pytest.mark.parametrize("text", ["we meet at noon. dot the i", "look at example.com", "one two three", "a (at) b", "ein Punkt"])
def test_ordinary_words_are_no_disguise(text):
    assert not any(pii.all_spans(text)[1].values())


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000 + " @", "1." * 100_000, "+1" * 100_000, "a at " * 40_000, "one " * 50_000])
def test_long_runs_take_linear_time(text):
    pii.all_spans(text)


def test_masks(documents):
    df = documents((1, "mail a@b.co or (at) x@y.zz now", "en"), (2, None, None), (3, "", None))
    rows = {r["doc_id"]: r["text"] for r in pii.mask(df).collect()}
    assert rows == {1: "mail [EMAIL] or (at) [EMAIL] now", 2: None, 3: ""}


# --- quality rules -----------------------------------------------------------


def check_statistics(df):
    by_id = dict(texts(df))
    for r in quality_rules.with_statistics(df.select("doc_id", "text")).collect():
        assert tuple(r[c] for c in quality_rules.COUNTS) == brute.statistics(by_id[r["doc_id"]])


def test_statistics(docs, odd_documents, documents):
    check_statistics(docs)
    check_statistics(odd_documents)
    check_statistics(documents(*((k, " ".join("ab"[j * k % 3 % 2] for j in range(k)), "en") for k in range(12))))


def test_rules_remove_bad_and_keep_good(spark, documents):
    clean = [(k, " ".join(f"w{(k * 31 + j * 7) % 997}" for j in range(80)), "en") for k in range(120)]
    junk = [(200 + k, " ".join(f"w{(k * 31 + j * 7) % 997}***" for j in range(80)), "en") for k in range(120)]
    labels = spark.createDataFrame([(i, int(i >= 200)) for i, _, _ in clean + junk] + [(None, 1), (7, None)], "doc_id long, bad int")
    rows = {r["doc_id"]: r for r in quality_rules.judge(documents(*clean, *junk, (999, None, None)), labels).collect()}
    assert all(rows[i]["kept"] == (i < 200) for i in rows if i != 999)
    assert rows[999]["base_failed"] and not rows[999]["kept"]


def test_without_labels_only_the_base_rule_decides(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, bad int")
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.judge(odd_documents, labels).collect())
    assert quality_rules.judge(no_documents, labels).count() == 0


def test_no_python_runs_on_executors(docs, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("bad"))
    plan = quality_rules.judge(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- decontamination ---------------------------------------------------------


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for k, x in enumerate(item, 1):
        new = [k]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_items_in_documents(spark, docs):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.find(docs, bench).collect()}
    items = [(r["item_id"], decontamination.words_of(r["text"].encode())) for r in bench.collect()]
    for doc_id, text in texts(docs):
        own = decontamination.words_of((text or "").encode())
        for item_id, item in items:
            # items of which less than half the words occur cannot be within the limit
            if sum(w in set(own) for w in item) >= 0.8 * len(item):
                distance = edit_distance(item, own)
                assert ((doc_id, item_id) in found) == (distance <= int(0.2 * len(item))), (doc_id, item_id, distance)


def test_edited_items_are_found(spark, documents):
    rng = np.random.default_rng(1)
    items = [[f"i{k}w{j}" for j in range(30)] for k in range(60)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(100, None), (101, "too short")], "item_id long, text string")
    rows = []
    for k, item in enumerate(items):
        edited = list(item)
        for _ in range(4):
            at = int(rng.integers(len(edited)))
            edited[at : at + 1] = [[], ["new"], ["new", edited[at]]][int(rng.integers(3))]
        rows.append((k, " ".join(["pre"] * k + edited + ["post"] * 9), "en"))
    rows += [(900, "nothing to see here at all in this text", "en"), (901, None, None), (902, "", None)]
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find(documents(*rows), bench).collect()}
    assert found <= {(k, k) for k in range(60)} and len(found) >= 57
    flagged = {r["doc_id"] for r in decontamination.flag(documents(*rows), bench, block_words=400).collect() if r["contaminated"]}
    assert flagged == {a for a, _ in found}


def edited_copies(rng, item, spread):
    """The item with all the edits it may have: at random, or replaced words spread evenly."""
    edits, out = int(decontamination.MAX_EDITS * len(item)), list(item)
    at = [(k + 1) * (len(item) + 1) // (edits + 1) - 1 for k in range(edits)] if spread else rng.choice(len(item), edits, replace=False)
    for k, place in enumerate(sorted(map(int, at), reverse=True)):
        kind = 1 if spread else int(rng.integers(3))
        out[place : place + 1] = [[], [f"new{k}"], [f"new{k}", out[place]]][kind]
    return out


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("size", [8, 12, 15, 20, 25, 40])
def test_recall_with_all_allowed_edits(size, spread):
    rng, n = np.random.default_rng(size), 400
    items = [[f"i{k}w{j}" for j in range(size)] for k in range(n)]
    own = decontamination.Items([(k, " ".join(w).encode()) for k, w in enumerate(items)])
    codes = decontamination.PlainCodes()
    texts = [" ".join(["pre"] * (k % 7) + edited_copies(rng, w, spread) + ["post"] * 9).encode() for k, w in enumerate(items)]
    found = own.found_in([codes.of_text(t) for t in texts])
    assert sum(k in dict(pairs) for k, pairs in enumerate(found)) >= decontamination.RECALL * n


def test_short_items_are_found_at_every_place():
    items = [[f"i{k}w{j}" for j in range(1 + k % 10)] for k in range(200)]
    own = decontamination.Items([(k, " ".join(w).encode()) for k, w in enumerate(items)] + [(200, b""), (201, None)])
    codes = decontamination.PlainCodes()
    for copies in (items, [edited_copies(np.random.default_rng(k), w, True) for k, w in enumerate(items)]):
        texts = [" ".join(["pre"] * (k // 10) + w + ["post"] * (k % 3)).encode() for k, w in enumerate(copies)]
        found = own.found_in([codes.of_text(t) for t in texts])
        assert found == [[(k, edit_distance(items[k], w))] for k, w in enumerate(copies)]


def test_decontamination_of_odd_documents(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, " ".join(f"p{k}" for k in range(5, 35)))], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.find(odd_documents, bench).collect()} == {1, 8, 12, None}
    assert decontamination.find(no_documents, bench).count() == 0
    assert decontamination.find(odd_documents, bench.limit(0)).count() == 0
    assert decontamination.flag(odd_documents, bench.limit(0)).where("contaminated").count() == 0
