"""Language identification as inference of a mixture of languages per document.

Each learned language is a model of character n-grams within words, so a word has a likelihood
under each language. A document mixes languages in unknown proportions; expectation-maximisation
estimates them from its words. The set of languages is chosen by penalised likelihood: the
weakest language is dropped while the criterion (log likelihood less half a log of the number of
words for each language) does not fall. The language with the largest share is the prediction.

The models are fitted on at most ``per_language`` labelled documents of each language, chosen by
a hash of the id; every document is predicted over its whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is any text
where no labelled document exists. Equal shares go to the language first in order. Repeated rows
are predicted each on its own. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from throngcast.llm.common import table_of

ORDER = 4
#: Documents per language the models are fitted on, at most.
PER_LANGUAGE = 1_000
#: N-grams kept per language, the most frequent: what is broadcast has this bound.
GRAMS_PER_LANGUAGE = 60_000
UNDETERMINED = "und"
#: Letters, with the few number signs that Python counts as word characters.
WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 200_000
#: Likelihood floor: a word can come from outside all models, at this ratio to the best one.
FLOOR = 1e-4


def _grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[max(0, k - ORDER) : k] for k in range(2, len(padded) + 1)]


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict[str, dict[str, float]]:
    """Log probabilities of each language's n-grams from documents with ``doc_id, text, lang``.

    Counting runs in Spark; the result is bounded by languages times ``GRAMS_PER_LANGUAGE``.
    """
    chosen = Window.partitionBy("lang", "slot").orderBy(F.xxhash64("doc_id"), "doc_id")
    keys = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    # two steps, so that a language holding most rows is not ordered in one task
    thin = keys.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    ids = thin.select("doc_id", "lang", "slot").withColumn("nth", F.row_number().over(chosen)).where(F.col("nth") <= per_language)
    last = Window.partitionBy("lang").orderBy("nth", F.xxhash64("doc_id"), "doc_id")
    sample = ids.withColumn("pick", F.row_number().over(last)).where(F.col("pick") <= per_language).select("doc_id", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for word, n in Counter(WORD.findall(text.as_py().lower())).items():
                    for gram in _grams(word):
                        counts[lang][gram] += n
        rows = [(lang, gram, n) for lang, own in counts.items() for gram, n in own.items()]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield from table_of(_COUNTS, lang=columns[0], gram=columns[1], n=columns[2]).to_batches()

    counted = (
        keys.join(F.broadcast(sample), ["doc_id", "lang"]).select("lang", "text")
        .mapInArrow(run, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counted.withColumn("r", F.row_number().over(top)).where(F.col("r") <= GRAMS_PER_LANGUAGE).collect()
    counts: dict[str, Counter] = defaultdict(Counter)
    for row in rows:
        counts[row["lang"]][row["gram"]] += row["n"]
    return {lang: dict(own) for lang, own in sorted(counts.items())}


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])


class Mixture:
    """The languages' n-gram models and the inference of proportions."""

    def __init__(self, counts: dict[str, dict[str, float]]):
        self.langs = sorted(counts)
        grams = sorted({g for own in counts.values() for g in own})
        index = {g: k for k, g in enumerate(grams)}
        table = np.zeros((len(grams) + 1, len(self.langs)))
        for j, lang in enumerate(self.langs):
            for gram, n in counts[lang].items():
                table[index[gram], j] = n
        table += 0.5
        self.index = index
        self.table = np.log(table / table.sum(axis=0)) if self.langs else table
        self.numbers: dict[str, int] = {}
        self.p = np.empty((0, len(self.langs)))

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Likelihood of each word under each language, over the best one's: a row per word.

        Characters overlap in n-grams, so their sum is divided by half the order. Words met before
        are remembered, ``CACHED_WORDS`` of them.
        """
        if len(self.numbers) > CACHED_WORDS:
            self.numbers, self.p = {}, self.p[:0]
        new = [w for w in words if w not in self.numbers]
        if new:
            get, rows, sizes = self.index.get, [], []
            for word in new:
                grams = _grams(word)
                rows += [get(g, -1) for g in grams]
                sizes.append(len(grams))
            starts = np.cumsum([0, *sizes[:-1]])
            log = np.add.reduceat(self.table[rows], starts, axis=0) / ORDER * 2
            fresh = np.maximum(np.exp(log - log.max(axis=1, keepdims=True)), FLOOR)
            first = len(self.numbers)
            self.numbers.update((w, first + k) for k, w in enumerate(new))
            if first + len(new) > len(self.p):
                room = np.empty((max(2 * len(self.p), first + len(new)), len(self.langs)))
                room[:first] = self.p[:first]
                self.p = room
            self.p[first : first + len(new)] = fresh
        return self.p[[self.numbers[w] for w in words]]

    def proportions(self, p: np.ndarray, n: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
        """Shares that maximise the likelihood of words with likelihoods ``p`` seen ``n`` times."""
        share = np.full(p.shape[1], 1 / p.shape[1])
        total = n.sum()
        for _ in range(steps):
            new = share * ((n / (p @ share)) @ p) / total
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(n @ np.log(p @ share))

    def infer(self, text: str) -> dict[str, float]:
        """Shares of the chosen languages; empty without letters or languages."""
        counts = Counter(WORD.findall(text.lower())) if self.langs else {}
        if not any(c.isalpha() for word in counts for c in word):
            return {}
        p = self.likelihoods(list(counts))
        n = np.fromiter(counts.values(), float, len(counts))
        chosen = list(range(len(self.langs)))
        share, fit = self.proportions(p, n)
        cost = 0.5 * np.log(n.sum() + 1)
        while len(chosen) > 1:
            weakest = int(np.argmin(share))
            rest = [k for j, k in enumerate(chosen) if j != weakest]
            fewer, fit_fewer = self.proportions(p[:, rest], n)
            if fit_fewer + cost < fit:
                break
            chosen, share, fit = rest, fewer, fit_fewer
        return {self.langs[k]: float(s) for k, s in zip(chosen, share)}


_MODELS: dict[str, Mixture] = {}


def _mixture(key: str, shared: Broadcast) -> Mixture:
    """The Python worker's own model, which its later tasks of the same query go on with."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Mixture(shared.value)
    return _MODELS[key]


PREDICTED = "doc_id long, lang_pred string, score double, lang_set string"
_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("lang_set", pa.string())]
)


def predict(docs: DataFrame, counts: dict[str, dict[str, float]]) -> DataFrame:
    """``PREDICTED`` of every document; ``lang_set`` joins the chosen languages by spaces."""
    # n-grams of bounded number, shared once with each executor
    shared, key = docs.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _mixture(key, shared)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                share = model.infer(text.as_py() or "")
                best = max(share, key=lambda lang: (share[lang], -model.langs.index(lang)), default=UNDETERMINED)
                rows.append((doc_id, best, min(share.get(best, 0.0), 1.0), " ".join(sorted(share))))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield from table_of(_PREDICTED, **dict(zip(_PREDICTED.names, columns))).to_batches()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PREDICTED)


def identify(docs: DataFrame, learning: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Predict every document, learning from those where ``learning`` is true."""
    return predict(docs, learn(docs.where(learning), per_language))
