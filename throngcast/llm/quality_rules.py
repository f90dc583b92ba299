"""Quality rules: text statistics and a decision list learned from labelled ones.

Statistics are built-in column functions over each text. The list is learned by sequential
covering: conjunctions of thresholds are grown on one half of a bounded labelled sample for
precision on the bad class, pruned on the other half, and emitted in order as one Spark
conditional expression. No Python runs on the executors.

Defined cases: a null text counts as an empty one, with all counts 0 and ``base_failed`` true
(fewer than ``MIN_WORDS`` words). Repeated rows are judged each on its own. Labels that are
null or without document are left out of learning; without labels of both classes the list is
empty and keeps every document. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import hashed_sample

SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The labelled sample the list is learned from has at most this many documents.
LABELLED_BOUND = 4_000


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _chars_in(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice.

    Windows are ordered by hash; equal neighbours are repeated ones. Their starts, in order,
    cover three words each or fewer where the next one begins earlier.
    """
    at = lambda k: F.get(words, k)
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("i")),
        )
    )

    def repeated(w: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(w, j)["h"] == F.get(w, k)["h"], F.lit(False))
        marked = F.transform(
            F.sequence(F.lit(0), F.size(w) - 1),
            lambda j: F.when(same(j, j - 1) | same(j, j + 1), F.get(w, j)["i"]),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        widths = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3))))
        return F.aggregate(widths, F.lit(0), lambda total, x: total + x)

    return F.when(F.size(words) >= 4, _let(_let(windows, repeated), covered)).otherwise(0)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``COUNTS`` (long) and ``upper_chars`` of every whole text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(body, WORD_BREAK), "")
    in_words = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    repeats = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counted = docs.withColumn("_w", in_words)
    long = lambda c: c.cast("long")
    return counted.withColumns(
        {
            "n_words": long(F.col("_w.n")),
            "word_chars": long(F.length(F.translate(body, SPACES, ""))),
            "n_symbols": long(_chars_in(body, SYMBOLS)),
            "n_dup_lines": long(repeats),
            "n_repeat_words": long(F.col("_w.repeat")),
            "upper_chars": long(_chars_in(body, CAPITALS)),
        }
    ).drop("_w")


def base_failed() -> Column:
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


#: Features the list may test: numerator and denominator among the statistics.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "upper_share": ("upper_chars", "word_chars"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words": ("n_words", None),
}


def _feature(name: str) -> Column:
    top, below = FEATURES[name]
    return F.col(top).cast("double") / F.greatest(F.col(below), F.lit(1)) if below else F.col(top).cast("double")


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.limit if self.above else row[self.feature] <= self.limit

    def column(self) -> Column:
        value = _feature(self.feature)
        return value > self.limit if self.above else value <= self.limit


def _counts(tests: list[Test], rows: list[tuple[dict, bool]]) -> tuple[int, int]:
    hit = [bad for row, bad in rows if all(t.holds(row) for t in tests)]
    return sum(hit), len(hit)


def _score(bad: int, n: int) -> float:
    """Precision with two pseudo-observations."""
    return (bad + 0.5) / (n + 2)


def learn_list(
    rows: list[tuple[dict, bool]], max_rules: int = 8, max_tests: int = 3, min_precision: float = 0.95, steps: int = 24
) -> list[list[Test]]:
    """Ordered conjunctions that mark bad rows, by growing and pruning on two halves.

    Ties go to the test that covers more bad rows, then to the first feature in order.
    """
    halves = [rows[0::2], rows[1::2]]
    rules: list[list[Test]] = []
    while len(rules) < max_rules and any(bad for _, bad in halves[0]):
        rule, left = [], halves[0]
        while len(rule) < max_tests and any(not bad for _, bad in left):
            best = None
            for name in FEATURES:
                values = sorted({row[name] for row, _ in left})
                for limit in values[:: max(1, len(values) // steps)]:
                    for above in (True, False):
                        test = Test(name, above, limit)
                        bad, n = _counts([test], left)
                        if 5 <= n < len(left) and (best is None or (_score(bad, n), bad) > best[0]):
                            best = ((_score(bad, n), bad), test)
            if best is None or best[0][0] <= _score(*_counts([], left)):
                break
            rule.append(best[1])
            left = [x for x in left if best[1].holds(x[0])]
        while len(rule) > 1 and _score(*_counts(rule[:-1], halves[1])) >= _score(*_counts(rule, halves[1])):
            rule.pop()
        bad, n = _counts(rule, halves[1])
        if not rule or n == 0 or bad / n < min_precision:
            break
        rules.append(rule)
        halves = [[x for x in half if not all(t.holds(x[0]) for t in rule)] for half in halves]
    return rules


def learned(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_BOUND, **options) -> list[list[Test]]:
    """Decision list from at most ``bound`` labelled documents, chosen by a hash of the id.

    ``labels`` holds ``doc_id, bad`` (0 or 1). The sample is bounded, so it may be broadcast
    and its statistics read on the driver.
    """
    usable = labels.where(F.col("bad").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "bad")
    sample = hashed_sample(usable.dropDuplicates(["doc_id"]), "doc_id", bound)
    rows = (
        with_statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
        .where(~base_failed()).orderBy(F.xxhash64("doc_id"), "doc_id")
        .select("bad", *(_feature(name).alias(name) for name in FEATURES)).limit(bound).collect()
    )
    return learn_list([(row.asDict(), bool(row["bad"])) for row in rows], **options)


def verdict(rules: list[list[Test]]) -> Column:
    """The list as one ordered conditional: false where the first fitting rule says bad."""
    chain = None
    for rule in rules:
        fits = rule[0].column()
        for test in rule[1:]:
            fits = fits & test.column()
        chain = F.when(fits, False) if chain is None else chain.when(fits, False)
    return F.lit(True) if chain is None else chain.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_BOUND, **options) -> DataFrame:
    """Every document with its ``COUNTS``, ``base_failed`` and ``kept``."""
    rules = learned(docs, labels, bound, **options)
    stats = with_statistics(docs.select("doc_id", "text")).drop("text")
    return stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
