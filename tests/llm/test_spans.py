"""Token counts, fill-in-middle and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
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
from throngcast.llm import fill_in_middle, periodic_runs, queries, token_counts
from throngcast.llm.common import WordCodes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def only(monkeypatch):
    """A query over a given frame in place of its table."""

    def run(name, spark, df):
        monkeypatch.setattr(queries, "table", lambda *_: df)
        return queries.QUERIES[name](spark, "")

    return run


# --- token counts ------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def check_counts(df, tokenizer, **sizes):
    got = Counter(map(tuple, token_counts.count_tokens(df, TOKENIZER, **sizes).collect()))
    expected = Counter()
    for doc_id, text in texts(df):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected[doc_id, len((text or "").encode()), n, n > 2048] += 1
    assert got == expected


def test_counts_of_documents(docs, odd_documents, tokenizer):
    check_counts(docs, tokenizer)
    check_counts(odd_documents, tokenizer)
    check_counts(odd_documents, tokenizer, long_bytes=200, chunk=300, overlap=40)


def test_counts_of_huge_and_seamless_texts(documents, tokenizer):
    """Texts that need several rounds: one word, one run of signs, composed characters, copies, no id."""
    word, signs, marks = "ab" * 30_000, "!" * 40_000, "é" * 20_000
    special = "<|endoftext|>" * 4_000
    rows = [(1, word, "en"), (2, signs, "en"), (3, marks, "en"), (4, special, "en"), (5, "plain words " * 9_000, "en"),
            (6, word, "en"), (None, signs, None), (7, "中文字符" * 15_000, "zh"), (6, word, "en")]
    check_counts(documents(*rows), tokenizer)


def test_counts_of_no_documents(no_documents, tokenizer):
    assert token_counts.count_tokens(no_documents, TOKENIZER).count() == 0


PIECES = [
    " ", "  ", "\n", "a", "bc", "the ", "it's", "'s", "'", "'r", "e", "!", "?!", "<|endoftext|>", "<|end", "oftext|>", "é", "é", "́",
    "ཱི", "ᄀ", "ᅡ", "ᆨ", "가", "中文", "9", "😀", "İ", "Σ", "‍", "\xa0", "\x1c", "क़", "ে", "া", "Å",
]


@pytest.mark.parametrize("seed", range(60))
def test_chunks_splice_to_the_whole(seed, tokenizer):
    """Without Spark: any text, small chunks, overlaps widened until every cut has a common boundary."""
    rng = random.Random(seed)
    pool = PIECES if seed % 2 else rng.sample(PIECES, 4)
    text = "".join(rng.choice(pool) for _ in range(700))
    words, overlap = token_counts.word_ids(TOKENIZER), 40
    while True:
        runs = []
        for part, begin, cut, next_cut, chunk in token_counts._cut(text.encode(), 8 * overlap, overlap):
            starts, tokens, total = token_counts.encoded_units(words, chunk)
            last = len(chunk) if next_cut is None else len(chunk) - token_counts.MARGIN
            at, passed = token_counts.places(chunk, starts, tokens, 0, last)
            runs.append((cut, total, dict(zip([begin + x for x in at], passed))))
        gained = []
        for (_, _, before), (cut, _, after) in zip(runs, runs[1:]):
            common = [x for x in before if x in after and cut - overlap <= x < cut + overlap]
            gained.append(before[common[0]] - after[common[0]] if common else None)
        if None not in gained:
            break
        overlap *= token_counts.WIDER
    assert runs[-1][1] + sum(gained) == len(tokenizer.encode(text, add_special_tokens=False).ids)


# --- fill in middle ----------------------------------------------------------


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if doc_id is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    digest = sha(f"7:{doc_id}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(output), sha(text)


def check_middles(df, spark, only):
    got = Counter(map(tuple, only("op12_fill_in_middle", spark, df).collect()))
    assert got == Counter(plain_middle(*row) for row in texts(df))


def test_middles_of_documents(docs, odd_documents, no_documents, documents, spark, only):
    check_middles(docs, spark, only)
    check_middles(odd_documents, spark, only)
    check_middles(no_documents, spark, only)
    lines = ["\n\n\n", "a\r\nb\x0bc\x85d e\n", "ü\n😀\n中\n", "<P", "S><", "x <M> y\nz", "<<P\nP>>\n<S\n>", "\n", "é" * 9_000 + "\n" + "z" * 50_000]
    check_middles(documents(*[(k, t, None) for k, t in enumerate(lines * 6)]), spark, only)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a\né中😀", max_size=60))
def test_exception_index(text):
    raw = text.encode()
    index = fill_in_middle.ExceptionIndex(np.frombuffer(raw, np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:k].encode()) for k in chars])
    assert index.length == len(text)
    assert index.bytes(chars).tolist() == cuts.tolist() and index.chars(cuts).tolist() == chars.tolist()


def test_characters_as_units_and_shares(odd_documents, docs):
    df = docs.unionByName(odd_documents, allowMissingColumns=True)
    made = fill_in_middle.transform(df, unit="char", seed=3, percent=60, spm_percent=100)
    back = made.select("doc_id", "form", "n", fill_in_middle.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert Counter((r["doc_id"], r["t"], r["n"]) for r in back) == Counter((i, t or "", len(t or "")) for i, t in texts(df))
    forms = Counter(r["form"] for r in back)
    assert forms["psm"] == 0 and 0.45 < forms["spm"] / len(back) < 0.75
    with pytest.raises(ValueError, match="char"):
        fill_in_middle.transform(df, unit="byte")


# --- periodic runs -----------------------------------------------------------


def plain_runs(w, least=24, exponent=3):
    """Every maximal stretch with period q, whose smallest period q is."""
    found = set()
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                part = w[i : j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = brute.words(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2] or run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2]):
            best = run
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    return doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(kept)


def check_runs(df, spark, only):
    got = Counter(map(tuple, only("op13_periodic_runs", spark, df).collect()))
    assert got == Counter(plain_row(*row) for row in texts(df))
    return got


def test_runs_of_documents(docs, no_documents, documents, spark, only):
    found = check_runs(docs.where("n_chars < 6000"), spark, only)
    assert sum(row[1] > 0 for row in found) > 5
    check_runs(no_documents, spark, only)
    passage = " ".join(f"p{k}" for k in range(40))
    odd = [None, "", " \n\t ", "one", "a " * 24, "a " * 23, "a b c d e f g h " * 3, "a b c d e f g h i " * 2, passage, f"x {passage} y {passage} z",
           f"{passage} {passage} {passage}", f"{passage} " * 3 + "p0 p1 q", "a b " * 12 + "c a " * 12, "same words " * 30]
    rows = [(k, t, None) for k, t in enumerate(odd * 5)]
    check_runs(documents(*rows, *rows[:9], (None, "same words " * 30, "en")), spark, only)


def test_runs_of_long_texts(documents, spark, only):
    """Long periods and many periods: the same answer from the words' own repetition."""
    block = " ".join(f"w{k}" for k in range(5_000))
    df = documents((3, f"{block} {block} {block} {block} tail", "en"), (4, "z " * 30_000, "en"))
    got = {r["doc_id"]: r for r in only("op13_periodic_runs", spark, df).collect()}
    assert [got[3][c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == [1, 0, 20_000, 5_000, 4_000]
    assert got[3]["collapsed_sha256"] == sha(f"{block} tail")
    assert [got[4][c] for c in ("n_runs", "start", "length", "period")] == [1, 0, 30_000, 1]


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_runs_match_their_definition(data):
    letters = data.draw(st.sampled_from(["a", "ab", "abc", "abcdef"]))
    w = list(data.draw(st.text(alphabet=letters, max_size=50)))
    for _ in range(data.draw(st.integers(0, 2))):
        at, q, n = (data.draw(st.integers(0, k)) for k in (len(w), 9, 40))
        w[at:at] = (w[at : at + q + 1] * 41)[:n]
    words, codes = [x.encode() for x in w], WordCodes()
    for least, exponent in ((24, 3), (8, 2), (10, 4)):
        assert periodic_runs.find_runs(words, codes.of(words), least, exponent) == plain_runs(w, least, exponent)
    if w:
        number = {x: k for k, x in enumerate(dict.fromkeys(w), 1)}
        assert periodic_runs.runs_of([number[x] for x in w], 4, 2) == plain_runs(w, 4, 2)


def test_smaller_exponents_than_two_are_refused(docs):
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.collapse(docs, min_exponent=1)
