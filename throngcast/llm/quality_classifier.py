"""Quality classifier: interpolated modified Kneser-Ney models of the characters of words.

One model is trained on trusted text (good quality, not toxic), a second one of the same kind on
flagged text. N-gram counts, continuation counts, context totals and the interpolated
probabilities are Spark joins and aggregates. Documents are dealt into blocks; a block asks the
shards of the joined count tables for the n-grams of its distinct words and gets back
log probabilities and back-off weights, from which each document's perplexity per character
follows, and the share of words that the flagged model explains better by ``ODDS`` nats or more.

A document is rejected where its perplexity, or its share of flagged words, lies above the
quantile of trusted documents of its language. The models are fitted on three quarters of all
labelled documents, chosen by a hash of the id, or on ``bound`` of these where one is given; the
thresholds use all of the last quarter, which no model has seen.

Defined cases: a null text or one without words has perplexity 1 and is kept, as nothing speaks
against it; a null language is a language of its own; languages with fewer than ``LEAST``
held-out trusted documents take the quantiles of all. Without any everything is kept. Repeated
rows are scored each on its own. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import (
    U64, crc_of_id, doc_frame, documents_of, hashed_sample, mixed, multipliers, packed, parts_by, shuffle_width, stored, table_of,
    text_blocks, unpacked,
)

ORDER = 5
QUANTILE = 0.995
#: One labelled document in so many is held out for the thresholds.
HELD_OUT = 4
LEAST = 50
#: Nats by which the flagged model must explain a word better.
ODDS = 12.0
#: A share of flagged words up to this is never a reason to reject.
LEAST_SHARE = 0.001
#: Distinct words that a task counts before it hands on their n-grams.
WORDS_COUNTED = 50_000
#: Distinct words whose n-grams are laid out at once.
WORDS_AT_ONCE = 40_000
START, END = "\x02", "\x03"
MODELS = ("trusted", "flagged")
MISSING = np.int16(-32768)

_TOP = pa.schema([("model", pa.int32()), ("gram", pa.string()), ("c", pa.int64())])


def _top_counts(docs: DataFrame) -> DataFrame:
    """Counts of the n-grams of full order in ``model, text``."""

    def grams_of(words: Counter) -> list[pa.RecordBatch]:
        grams: Counter = Counter()
        for (model, word), n in words.items():
            padded = START * (ORDER - 1) + word.decode() + END
            for k in range(ORDER, len(padded) + 1):
                grams[model, padded[k - ORDER : k]] += n
        return table_of(
            _TOP, model=[m for m, _ in grams], gram=[g for _, g in grams], c=list(grams.values())
        ).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for model, raw in zip(batch["model"].to_pylist(), batch["raw"]):
                words.update((model, w) for w in (raw.as_py() or b"").split())
                if len(words) > WORDS_COUNTED:
                    yield from grams_of(words)
                    words.clear()
        yield from grams_of(words)

    return docs.mapInArrow(run, "model int, gram string, c long").groupBy("model", "gram").agg(F.sum("c").alias("c"))


def _levels(top: DataFrame) -> dict[int, DataFrame]:
    """Counts per order: full counts at the top, below them the number of distinct left neighbours."""
    levels = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):
        shorter = F.substring("gram", 2, n).alias("gram")
        counts = levels[n + 1].groupBy("model", shorter).agg(F.count("*").alias("c"))
        levels[n] = stored(counts, f"level-{n}")
    return levels


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2 and above from the numbers of n-grams with counts 1 to 4."""
    n1, n2, n3, n4 = (max(n, 1) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return [min(max(d, 0.0), k + 0.9) for k, d in enumerate(raw)]


def kneser_ney(top: DataFrame) -> DataFrame:
    """``model, gram, p, weight``: log probability of the last character after the ones before,
    and log back-off weight of the n-gram as a context; null where it is only one of both.

    Every order is written once: the next one and the result read it, and plans stay short."""
    levels = _levels(top)
    rows = None
    for n, level in levels.items():
        of = lambda k: F.count_if(F.col("c") == k).alias(f"n{k}")  # noqa: B023, E731
        part = level.groupBy("model").agg(*map(of, (1, 2, 3, 4)), F.count("*").alias("kinds")).withColumn("order", F.lit(n))
        rows = part if rows is None else rows.union(part)
    found = {(r["order"], r["model"]): r for r in rows.collect()}  # a row per order and model
    table, lower = None, None
    for n in range(1, ORDER + 1):
        level = levels[n]
        cut = F.lit(0.0)
        for m in range(len(MODELS)):
            if r := found.get((n, m)):
                d = discounts(*(r[f"n{k}"] for k in (1, 2, 3, 4)))
                own = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
                cut = F.when(F.col("model") == m, own).otherwise(cut)
        level = level.withColumns({"cut": cut, "context": F.substring("gram", 1, n - 1)})
        totals = level.groupBy("model", "context").agg(F.sum("c").alias("total"), F.sum("cut").alias("freed"))
        own = (F.col("c") - F.col("cut")) / F.col("total")
        weight = F.col("freed") / F.col("total")
        joined = level.join(totals, ["model", "context"])
        if n == 1:
            kinds = F.lit(1.0)
            for m in range(len(MODELS)):
                if r := found.get((1, m)):
                    kinds = F.when(F.col("model") == m, float(r["kinds"] + 1)).otherwise(kinds)
            lower = stored(joined.select("model", "gram", (own + weight / kinds).alias("p")), "p-1")
            floor = F.log(weight / kinds)
            contexts = totals.select("model", F.col("context").alias("gram"), floor.alias("weight"))
        else:
            rest = lower.select("model", F.col("gram").alias("rest"), F.col("p").alias("low"))
            lower = joined.withColumn("rest", F.substring("gram", 2, n - 1)).join(rest, ["model", "rest"]).select(
                "model", "gram", (own + weight * F.col("low")).alias("p")
            )
            lower = stored(lower, f"p-{n}")
            contexts = totals.select("model", F.col("context").alias("gram"), F.log(weight).alias("weight"))
        part = lower.select("model", "gram", F.log("p").alias("p"), F.lit(None).cast("double").alias("weight")).union(
            contexts.select("model", "gram", F.lit(None).cast("double").alias("p"), "weight")
        )
        table = part if table is None else table.union(part)
    return table.groupBy("model", "gram").agg(F.max("p").alias("p"), F.max("weight").alias("weight"))


def gram_keys(points: np.ndarray, n: int) -> np.ndarray:
    """Key of the ``n`` code points that end at each position from ``n - 1`` on."""
    size = max(len(points) - n + 1, 0)
    total = np.full(size, U64(n))
    for k, factor in enumerate(multipliers(n, 40 + n) if n else ()):
        total += points[k : k + size] * factor
    return mixed(total)


_SHARDED = pa.schema([("shard", pa.int64()), ("key", pa.int64()), *((c, pa.int16()) for c in ("p0", "w0", "p1", "w1"))])


def _sharded(table: DataFrame, shards: int) -> DataFrame:
    """The models side by side, keyed and sharded; values in thousandths of a nat."""
    side = lambda c, m: F.max(F.when(F.col("model") == m, F.col(c))).alias(f"{c[0]}{m}")
    wide = table.groupBy("gram").agg(side("p", 0), side("weight", 0), side("p", 1), side("weight", 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch["gram"].to_pylist()
            keys = np.zeros(len(grams), U64)
            sizes = np.array([len(g) for g in grams])
            for n, at in parts_by(sizes):
                points = np.frombuffer("".join(grams[k] for k in at).encode("utf-32-le"), np.uint32).astype(U64)
                keys[at] = gram_keys(points, n)[::n] if n else gram_keys(points, 0)[0]
            values = {}
            for c in ("p0", "w0", "p1", "w1"):
                v = np.array([math.nan if x is None else x for x in batch[c].to_pylist()])
                v = np.clip(np.round(v * 1000), -32767, 32767)
                values[c] = np.where(np.isnan(v), MISSING, v).astype(np.int16)
            yield from table_of(_SHARDED, shard=(keys % U64(shards)).astype(np.int64), key=keys.view(np.int64), **values).to_batches()

    return wide.mapInArrow(run, "shard long, key long, p0 short, w0 short, p1 short, w1 short")


def _points(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the padded words, and the positions of predicted characters."""
    pad, text = START * (ORDER - 1), [w.decode() for w in words]
    points = np.frombuffer("".join(f"{pad}{w}{END}" for w in text).encode("utf-32-le"), np.uint32).astype(U64)
    sizes = np.array([len(w) + 1 for w in text], np.int64)
    ends = np.cumsum(sizes + ORDER - 1)
    predicted = np.ones(len(points), bool)
    for k in range(1, ORDER):
        predicted[ends - sizes - k] = False
    return points, np.flatnonzero(predicted)


def _distinct(table: pa.Table) -> list[bytes]:
    seen: set[bytes] = set()
    for _, raw, _ in documents_of(table):
        seen.update((raw or b"").split())
    return sorted(seen)


def _slices(words: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of words that are worked on at once, to bound the memory of a block."""
    for start in range(0, len(words), WORDS_AT_ONCE):
        yield words[start : start + WORDS_AT_ONCE]


#: Keys that are asked for their weight only, as contexts of pads.
_EMPTY = gram_keys(np.empty(0, U64), 0)


def _wanted(points: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    keys = [_EMPTY[:1]]
    for n in range(1, ORDER + 1):
        own = gram_keys(points, n)
        keys.append(np.unique(own[at - n + 1] if n == ORDER else own))
    return keys


_ASKED = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
_TOLD = pa.schema([("block", pa.int64()), ("blob", pa.binary())])


def _ask(shards: int):
    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        parts = [np.unique(np.concatenate(_wanted(*_points(words)))) for words in _slices(_distinct(table))]
        keys = np.unique(np.concatenate([_EMPTY[:1], *parts]))
        shard, blob = [], []
        for k, at in parts_by((keys % U64(shards)).astype(np.int64)):
            shard.append(k)
            blob.append(packed(keys[at]))
        return table_of(_ASKED, shard=shard, block=[block] * len(shard), blob=blob)

    return run


def _tell(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The known ones among the keys that each block asks for, with their values."""
    known = model["key"].to_numpy().view(U64)
    order = np.argsort(known)
    known = known[order]
    values = [model[c].to_numpy()[order] for c in ("p0", "w0", "p1", "w1")]
    block, blob = [], []
    for b, raw in zip(asked["block"].to_pylist(), asked["blob"].to_pylist()):
        (keys,) = unpacked(raw)
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        hit = np.flatnonzero(known[at] == keys) if len(known) else np.empty(0, np.int64)
        if len(hit):
            block.append(b)
            blob.append(packed(hit.astype(np.uint32), keys[hit], *(v[at[hit]] for v in values)))
    return table_of(_TOLD, block=block, blob=blob)


SCORES = "doc_id long, lang string, n_chars long, perplexity double, flagged_share double"
_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("perplexity", pa.float64()), ("flagged_share", pa.float64())]
)


def word_log_probabilities(words: list[bytes], keys: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """Log probability of each word under both models, from the sorted known keys' values."""
    points, at = _points(words)
    empty = np.full(4, MISSING)
    if len(keys) and (k := np.searchsorted(keys, _EMPTY[0])) < len(keys) and keys[k] == _EMPTY[0]:
        empty = np.array([v[k] for v in values])
    log = [np.full(len(at), empty[1 + 2 * m] / 1000 if empty[1 + 2 * m] != MISSING else -20.0) for m in (0, 1)]
    context = None
    for n in range(1, ORDER + 1):
        own = gram_keys(points, n)
        place = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0)) if len(keys) else np.zeros(len(own), np.int64)
        found = keys[place] == own if len(keys) else np.zeros(len(own), bool)
        for m in (0, 1):
            if context is not None:
                back = values[1 + 2 * m][context[0]]
                weight = np.where(context[1] & (back != MISSING), back / 1000, 0.0)[at - n + 1]
                log[m] = log[m] + weight
            if len(keys):
                p = values[2 * m][place[at - n + 1]]
                log[m] = np.where(found[at - n + 1] & (p != MISSING), p / 1000, log[m])
        context = (place, found) if len(keys) else None
    sizes = np.array([len(w.decode()) + 1 for w in words])
    start = np.cumsum(sizes) - sizes
    return np.stack([np.add.reduceat(x, start) for x in log]) if len(words) else np.zeros((2, 0))


def _score(docs: pa.Table, told: pa.Table) -> pa.Table:
    words = _distinct(docs)
    parts = [unpacked(b)[1:] for b in told["blob"].to_pylist()]
    keys, *values = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0, (U64, np.int16)[k > 0]) for k in range(5))
    order = np.argsort(keys)
    keys, values = keys[order], [v[order] for v in values]
    parts = [word_log_probabilities(own, keys, values) for own in _slices(words)]
    trusted, flagged = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0))
    number = {w: k for k, w in enumerate(words)}
    chars = np.array([len(w.decode()) + 1 for w in words])
    odd = flagged - trusted >= ODDS
    rows = []
    for doc_id, raw, lang in documents_of(docs):
        own = np.fromiter(map(number.__getitem__, w := (raw or b"").split()), np.int64, len(w))
        n = int(chars[own].sum())
        rows.append((doc_id, None if lang is None else lang.decode(), n, math.exp(-trusted[own].sum() / max(n, 1)), float(odd[own].mean()) if len(own) else 0.0))
    return table_of(_SCORES, **dict(zip(_SCORES.names, zip(*rows) if rows else [[]] * 5)))


def _held_out() -> Column:
    """Labelled documents that no model is fitted on; the thresholds come from these."""
    return crc_of_id(F.col("doc_id")) % HELD_OUT == 0


def score(docs: DataFrame, labels: DataFrame, bound: int | None = None) -> DataFrame:
    """``SCORES`` of every document; ``labels`` holds ``doc_id, quality, toxic``."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)

    def pick(rows: Column, model: int) -> DataFrame:
        ids = labels.where(rows).select("doc_id").distinct()
        return (ids if bound is None else hashed_sample(ids, "doc_id", bound)).withColumn("model", F.lit(model))

    fitted = pick(good & ~_held_out(), 0).union(pick(bad & ~_held_out(), 1))
    top = stored(_top_counts(doc_frame(docs).join(fitted, "doc_id").select("model", "raw")), "counts")
    parts = shuffle_width(docs.sparkSession)
    model = stored(_sharded(kneser_ney(top), parts), "model")
    blocked = text_blocks(docs, parts, lang="lang")
    asked = blocked.groupBy("block").applyInArrow(_ask(parts), "shard long, block long, blob binary")
    told = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(_tell, "block long, blob binary")
    return blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score, SCORES)


def classify(docs: DataFrame, labels: DataFrame, bound: int | None = None, quantile: float = QUANTILE) -> DataFrame:
    """``SCORES`` with ``kept``: false above the trusted quantile of the document's language."""
    scored = stored(score(docs, labels, bound), "scores")
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()
    # a model is at its best on its own training text, so that says nothing about other clean text
    trusted = scored.where(F.col("n_chars") > 0).where(_held_out()).join(good, "doc_id", "left_semi")
    at = lambda c: F.percentile_approx(c, quantile, 10_000)
    limits = [at("perplexity").alias("most"), at("flagged_share").alias("most_flagged"), F.count("*").alias("n")]
    whole = trusted.agg(*limits).first()
    if not whole["n"]:
        return scored.withColumn("kept", F.lit(True))
    by_lang = trusted.groupBy(F.coalesce("lang", F.lit("")).alias("group")).agg(*limits).where(F.col("n") >= LEAST)
    # one row per language; a join in Spark, as their number is not known before
    judged = scored.withColumn("group", F.coalesce("lang", F.lit(""))).join(by_lang, "group", "left")
    most = F.coalesce("most", F.lit(whole["most"]))
    flagged = F.greatest(F.coalesce("most_flagged", F.lit(whole["most_flagged"])), F.lit(LEAST_SHARE))
    kept = (F.col("n_chars") == 0) | ((F.col("perplexity") <= most) & (F.col("flagged_share") <= flagged))
    return judged.select("doc_id", "lang", "n_chars", "perplexity", "flagged_share", kept.alias("kept"))
