from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm import brute
from throngcast.llm import language_id, lm_scoring, quality_classifier, url_filters
from throngcast.llm.common import WordCodes, crc_of_id, packed, parts_by, ranges, unpacked
from throngcast.llm.queries import RULES


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# --- shared helpers ----------------------------------------------------------


def test_packed_arrays_come_back():
    arrays = [np.arange(5), np.empty(0, np.uint64), np.array([1.5], np.float32), np.array([3], np.uint8)]
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, unpacked(packed(*arrays))))


def test_ranges_and_parts():
    assert ranges(np.array([5, 9, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]
    assert {k: v.tolist() for k, v in parts_by(np.array([3, 1, 3]))} == {1: [1], 3: [0, 2]}


def test_word_codes_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr("throngcast.llm.common.CODE_CACHE", 3)
    words = [b"%d" % (k % 7) for k in range(50)]
    assert WordCodes().of(words).tolist() == [WordCodes()[w] for w in words]


def test_crc_of_id(spark):
    row = spark.range(7, 8).select(crc_of_id(F.col("id")).alias("c")).first()
    assert row["c"] == zlib.crc32(b"7")


# --- language-model scoring --------------------------------------------------


def base_scores(rows, learning):
    counts, ends = Counter(), 0
    for doc_id, text in rows:
        if learning(doc_id):
            counts.update(brute.words(brute.lower(text)))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)
    for doc_id, text in rows:
        c = [*(counts[w] for w in brute.words(brute.lower(text))), ends]
        yield doc_id, len(c), sum(n > 0 for n in c), total, sum(math.log10((n + 1) / (total + kinds + 1)) for n in c)


def check_scores(df, column, learning):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    scored = lm_scoring.score(df, column).collect()
    expected = sorted(base_scores(rows, learning), key=str)
    for r, (doc_id, n, known, total, base) in zip(sorted(scored, key=lambda r: str(expected_key(r))), expected):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (doc_id, n, known, total)
        assert r["base_score"] == pytest.approx(base) and math.isfinite(r["score"]) and r["score"] < 0
    assert len(scored) == len(rows)
    return scored


def expected_key(r):
    return (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])


def test_scores_of_documents(docs):
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    scored = check_scores(docs, crc_of_id(F.col("doc_id")) % 7 != 2, lambda i: not held_out(i))
    held = [r for r in scored if held_out(r["doc_id"])]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_odd_documents(odd_documents, no_documents):
    check_scores(odd_documents.where("doc_id is not null"), F.col("doc_id") != 6, lambda i: i != 6)
    check_scores(odd_documents.where("doc_id is not null"), F.lit(False), lambda i: False)
    assert lm_scoring.score(no_documents, F.lit(True)).count() == 0
    assert lm_scoring.score(odd_documents, F.lit(True)).count() == odd_documents.count()


def test_every_learning_document_trains(documents, monkeypatch):
    trained, numbers, found = lm_scoring.trained, [], []

    def spy(docs, vocab):
        numbers.append(docs.count())
        found.append(trained(docs, vocab))
        return found[-1]

    monkeypatch.setattr(lm_scoring, "trained", spy)
    monkeypatch.setattr(lm_scoring, "DOCS_PER_TRAINER", 600)
    df = documents(*((k, f"a b{k % 5} c{k % 3}", "en") for k in range(2_200)))
    for merged in (64, 2):
        monkeypatch.setattr(lm_scoring, "MERGED", merged)
        assert lm_scoring.score(df, F.col("doc_id") >= 100).count() == 2_200
    assert numbers == [2_100, 2_100]
    assert np.allclose(*found, atol=1e-4)


def test_slots_of_a_state_sum_to_one():
    network = lm_scoring.Network(np.arange(1024.0))
    h = np.random.default_rng(0).normal(size=(1, lm_scoring.HIDDEN)).astype(np.float32)
    log, _ = network.outputs(np.repeat(h, 1024, axis=0), np.arange(1024))
    assert np.exp(log).sum() == pytest.approx(1, abs=1e-4)


def test_windows_carry_the_state():
    network = lm_scoring.Network(np.ones(1024))
    docs = [np.random.default_rng(k).integers(0, 1024, 3 + 29 * k) for k in range(6)]
    expected = []
    for d in docs:
        h, total = np.zeros((1, lm_scoring.HIDDEN), np.float32), 0.0
        for before, slot in zip([lm_scoring.END, *d[:-1]], d):
            h = network.step(network.inputs(np.array([before])), h)[0]
            total += network.outputs(h, np.array([slot]))[0][0]
        expected.append(total)
    assert lm_scoring.score_documents(network, docs) == pytest.approx(expected, rel=1e-4)


def test_gradients_match_differences():
    network = lm_scoring.Network(np.ones(1024))
    rng = np.random.default_rng(5)
    slots, targets = rng.integers(0, 1024, (4, 3)), rng.integers(0, 1024, (4, 3))
    slots[2, 1] = lm_scoring.END

    def loss(grads=None):
        h, tape, states = np.zeros((3, lm_scoring.HIDDEN), np.float32), [], []
        inputs = network.inputs(slots)
        for t in range(4):
            fresh = (slots[t] != lm_scoring.END).astype(np.float32)[:, None]
            h = h * fresh
            new, *kept = network.step(inputs[t], h)
            tape.append((h, fresh, *kept))
            states.append(new)
            h = new
        log, dh = network.outputs(np.concatenate(states), targets.ravel(), grads)
        if grads is not None:
            network.backward(tape, dh.reshape(4, 3, -1), slots, grads)
        return -log.sum()

    network.p = {k: np.ascontiguousarray(v, np.float64) for k, v in network.p.items()}
    grads = {k: np.zeros(s) for k, s in network.SHAPES.items()}
    loss(grads)
    for name in network.SHAPES:
        flat, g = network.p[name].reshape(-1), grads[name].reshape(-1)
        for k in np.argsort(-np.abs(g))[:3]:
            keep = flat[k]
            flat[k] = keep + 1e-5
            up = loss()
            flat[k] = keep - 1e-5
            down = loss()
            flat[k] = keep
            assert (up - down) / 2e-5 == pytest.approx(g[k], rel=2e-2, abs=1e-4)


# --- language identification -------------------------------------------------


def test_held_out_accuracy(docs):
    learning = crc_of_id(F.col("doc_id")) % 4 != 2
    found = language_id.identify(docs.select("doc_id", "text", "lang"), learning)
    judged = found.join(docs.select("doc_id", "lang"), "doc_id").where(~learning & F.col("lang").isNotNull()).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_mixtures_are_told_apart(docs):
    counts = language_id.learn(docs.select("doc_id", "text", "lang"))
    mixture = language_id.Mixture(counts)
    sample = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 900)).orderBy("doc_id").first()["text"][:900] for lang in ("de", "es")}
    share = mixture.infer(sample["de"] + "\n" + sample["es"])
    assert set(share) == {"de", "es"} and min(share.values()) > 0.3
    assert set(mixture.infer(sample["es"])) == {"es"}


def grid(parts, step=40):
    """Every way to share ``step`` units among ``parts``, each getting one or more, as shares."""
    cuts = itertools.combinations(range(1, step), parts - 1)
    return np.array([np.diff([0, *c, step]) for c in cuts]) / step


def brute_mixture(mixture, text):
    """Best penalised fit over all sets of languages, their shares taken from a fine grid."""
    counts = Counter(language_id.WORD.findall(text.lower()))
    p, n = mixture.likelihoods(list(counts)), np.array(list(counts.values()))
    cost, fits = 0.5 * np.log(n.sum() + 1), {}
    for size in range(1, len(mixture.langs) + 1):
        for chosen in itertools.combinations(range(len(mixture.langs)), size):
            fit = (n @ np.log(p[:, chosen] @ grid(size).T)).max()
            fits[tuple(mixture.langs[k] for k in chosen)] = fit - size * cost
    return fits


def test_sets_and_shares_match_brute_force(docs):
    """Texts of few words from one to three languages: no set of languages fits better than the chosen one."""
    counts = language_id.learn(docs.select("doc_id", "text", "lang"))
    langs = sorted(counts)[:3]
    mixture = language_id.Mixture({lang: counts[lang] for lang in langs})
    words = {
        lang: sorted({w for r in docs.where(F.col("lang") == lang).limit(20).collect() for w in language_id.WORD.findall(r["text"].lower())})
        for lang in langs
    }
    rng = random.Random(6)
    for _ in range(60):
        used = rng.sample(langs, rng.randint(1, 3))
        text = " ".join(w for lang in used for w in rng.choices(words[lang], k=rng.randint(1, 8)))
        share, fits = mixture.infer(text), brute_mixture(mixture, text)
        best = max(fits.values())
        assert fits[tuple(sorted(share))] >= best - 0.05, (text, share, fits)
        assert sum(share.values()) == pytest.approx(1)


def test_languages_of_odd_documents(odd_documents, no_documents):
    found = {}
    for r in language_id.identify(odd_documents, F.lit(True)).collect():
        found[r["doc_id"]] = (r["lang_pred"], r["score"])
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    assert found[6][0] in ("en", "fr") and 0 < found[6][1] <= 1
    assert language_id.identify(no_documents, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd_documents, F.lit(False)).collect()} == {"und"}


# --- quality classifier ------------------------------------------------------


def brute_model(words, order=quality_classifier.ORDER):
    """Interpolated modified Kneser-Ney over padded words: a function of a context and a character."""
    start, end = quality_classifier.START, quality_classifier.END
    top = Counter()
    for w, n in words.items():
        padded = start * (order - 1) + w + end
        for k in range(order, len(padded) + 1):
            top[padded[k - order : k]] += n
    levels = {order: top}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def p(context, char, n=order):
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        context = context[len(context) - n + 1 :]
        of = Counter(levels[n].values())
        cut = quality_classifier.discounts(*(of[k] for k in (1, 2, 3, 4)))
        followers = [c for g, c in levels[n].items() if g[:-1] == context]
        if not followers:
            return p(context, char, n - 1)
        total, c = sum(followers), levels[n].get(context + char, 0)
        free = sum(cut[min(x, 3) - 1] for x in followers) / total
        return (c - cut[min(c, 3) - 1] if c else 0) / total + free * p(context, char, n - 1)

    return p, {g[-1] for g in top}


def test_model_is_kneser_ney(spark, documents):
    rows = [(k, t, "en") for k, t in enumerate(["abc abd abc bcd é", "abca cab abd dd", "ba ba bad cab abc"])]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(3)], "doc_id long, quality int, toxic int")
    p, _ = brute_model(Counter(w for _, t, _ in rows for w in t.split()))
    probe = [(10, "abc zz abé", "en"), (11, "dab", "en")]
    scored = {r["doc_id"]: r for r in quality_classifier.score(documents(*rows, *probe), labels).collect()}
    for doc_id, text, _ in rows + probe:
        log = n = 0
        for w in text.split():
            padded = "\x02" * 4 + w + "\x03"
            for k in range(4, len(padded)):
                log += math.log(p(padded[k - 4 : k], padded[k]))
                n += 1
        assert scored[doc_id]["n_chars"] == n
        assert scored[doc_id]["perplexity"] == pytest.approx(math.exp(-log / n), rel=0.01)


def test_probabilities_sum_to_one():
    p, chars = brute_model(Counter(["abc", "abd", "abc", "bcd", "dd"]))
    for context in ("\x02\x02\x02\x02", "\x02\x02ab", "zzzz"):
        unseen = p(context, "?")
        assert sum(p(context, c) for c in chars) + unseen == pytest.approx(1)


def test_junk_and_toxic_documents_are_rejected(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = quality_classifier.classify(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in judged if r["quality"] == 1 and not r["toxic"]]
    junk = [r for r in judged if r["quality"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.7 * len(junk)


def test_documents_with_toxic_words_are_rejected(spark):
    """A tenth of the toxic labels name documents without any toxic word; the words are those that ten
    documents labelled toxic hold and no other document."""
    folder = Path(SF_DIR).parent / "sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = quality_classifier.classify(docs, labels)
    rows = judged.join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id").collect()
    words = {r["doc_id"]: set((r["text"] or "").lower().split()) for r in rows}
    held = Counter(w for r in rows if r["toxic"] for w in words[r["doc_id"]])
    clean = {w for r in rows if not r["toxic"] for w in words[r["doc_id"]]}
    toxic_words = {w for w, n in held.items() if n >= 10 and w not in clean}
    toxic = [r for r in rows if r["toxic"] and words[r["doc_id"]] & toxic_words]
    assert len(toxic) > 30 and sum(not r["kept"] for r in toxic) >= 0.9 * len(toxic)
    fine = [r for r in rows if r["quality"] == 1 and not r["toxic"]]
    assert sum(r["kept"] for r in fine) >= 0.97 * len(fine)


def test_classifier_of_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, None), (6, 1, 0), (9, 0, 0), (77, 1, 0), (None, 1, 0), (10, None, 1)], "doc_id long, quality int, toxic int")
    rows = quality_classifier.classify(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["kept"] and r["perplexity"] == 1 for r in rows if r["doc_id"] in (2, 3, 4))
    assert quality_classifier.classify(no_documents, labels).count() == 0
    assert all(r["kept"] for r in quality_classifier.classify(odd_documents, labels.limit(0)).collect())


# --- URL filters -------------------------------------------------------------


def pages_of(spark, *urls):
    rows = [(k, u, "<p>", "clash", "clash", 0.5, 1) for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, bound double, n int")


def no_outcomes(spark):
    return spark.createDataFrame([], "page_id long, bad int")


def test_rules_and_hosts(spark):
    pages = pages_of(
        spark, "http://A.Example.ORG/es/1?x", "http://example.org/en/12#t", "https://example.org", "ftp://x.com/fr/a",
        "http://com/de/", "http://notorg/", "no scheme", None, "http://É.Com/de/x://y", "http://badexample.org/es/",
    )
    rows = sorted(map(tuple, url_filters.judge(pages, no_outcomes(spark), RULES).drop("url", "rate", "bound").collect()))
    assert rows == [
        (0, "a.example.org", "/es/1", "example.org/es/", "block"), (1, "example.org", "/en/12", "example.org/en/1", "block"),
        (2, "example.org", "", None, "allow"), (3, "x.com", "/fr/a", "com/fr/", "allow"), (4, "com", "/de/", "com/de/", "block"),
        (5, "notorg", "/", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"),
        (8, "É.com", "/de/x://y", "com/de/", "block"), (9, "badexample.org", "/es/", "org/", "allow"),
    ]


def test_reputation_shrinks_towards_the_domain(spark):
    urls = [f"http://bad.spam.net/{k}" for k in range(40)] + [f"http://h{k % 20}.fine.net/{k}" for k in range(400)]
    urls += ["http://new.spam.net/", "http://one.fine.net/"]
    pages = pages_of(spark, *urls)
    outcomes = spark.createDataFrame([(k, int(k < 40)) for k in range(440)] + [(441, 1), (3, None)], "page_id long, bad int")
    known = {r["host"]: r for r in url_filters.reputation(pages, outcomes).collect()}
    assert min(known["bad.spam.net"]["bound"], known["new.spam.net"]["rate"]) > 0.8 > known["h1.fine.net"]["rate"]
    assert known["one.fine.net"]["rate"] < 0.9 and known["one.fine.net"]["n"] == 1
    verdicts = {r["host"]: r["verdict"] for r in url_filters.judge(pages, outcomes, []).collect()}
    assert verdicts["bad.spam.net"] == "block" and verdicts["one.fine.net"] == verdicts["h1.fine.net"] == "allow"


def test_no_pages(spark):
    assert url_filters.judge(pages_of(spark).limit(0), no_outcomes(spark), RULES).count() == 0


def test_url_plan_is_native(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    plan = url_filters.judge(pages, no_outcomes(spark), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "html" not in plan


