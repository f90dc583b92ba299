"""Language-model scoring: a gated recurrent network in numpy with a class-factored softmax.

Word counts are gathered from all training documents into shards. The most frequent words are
the network's vocabulary; every other word belongs to one of ``GROUPS`` groups by its ending and
is predicted as its group times its share of the group's counts. The output softmax is factored
into classes of slots.

Training takes every training document, at every size. Documents travel as slots. Trainers run in
parallel from the same parameters with truncated backpropagation, their results are averaged per
slice of the parameters, first among ``MERGED`` trainers, and that is repeated ``ROUNDS`` times. Scoring deals the documents
into blocks, asks the shards for the counts of their words, and runs the network over whole
documents, many at a time, with the state carried from window to window.

Defined cases: a null or empty text has the end token only. Without training documents every
count is 0 and the network keeps its initial, even distribution. Repeated rows are scored each on
its own and count each in training. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import doc_frame, documents_of, packed, shuffle_width, stored, table_of, text_blocks, unpacked

CLASSES, PER_CLASS = 32, 32
GROUPS = 63
#: Slots: words, then groups of other words, then the end of a document.
WORDS = CLASSES * PER_CLASS - GROUPS - 1
END = CLASSES * PER_CLASS - 1
HIDDEN = 24
DOCS_PER_TRAINER = 4_000
#: Trainers whose results are averaged in one place before the rest.
MERGED = 64
ROUNDS = 1
#: Streams that a trainer reads side by side, unless it would take fewer steps than the least.
STREAMS, WINDOW, LEAST_STEPS = 384, 16, 200
STEP = 0.2
#: Documents scored side by side, and steps per window when scoring.
ABREAST, SCORED_WINDOW = 512, 32
SLICES = 16
#: Scores before a softmax are kept within these, so that it needs no maximum per row.
LARGEST = 40.0

_COUNTED = pa.schema([("shard", pa.int64()), ("words", pa.binary()), ("blob", pa.binary())])


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % GROUPS


def _shard_of(word: bytes, shards: int) -> int:
    return zlib.crc32(word, 1) % shards


def _by_shard(words: list[bytes], shards: int) -> dict[int, list[bytes]]:
    parts: dict[int, list[bytes]] = {}
    for word in words:
        parts.setdefault(_shard_of(word, shards), []).append(word)
    return parts


def word_counts(docs: DataFrame, shards: int) -> DataFrame:
    """``shard, words, blob``: the distinct words of each shard, joined by spaces, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for raw in batch["raw"]:
                found.update((raw.as_py() or b"").lower().split())
            parts = _by_shard(list(found), shards)
            yield from table_of(
                _COUNTED, shard=list(parts), words=[b" ".join(w) for w in parts.values()],
                blob=[packed(np.array([found[x] for x in w], np.int64)) for w in parts.values()],
            ).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for words, blob in zip(table["words"].to_pylist(), table["blob"].to_pylist()):
            for word, n in zip(words.split(), unpacked(blob)[0].tolist()):
                total[word] += n
        own = sorted(total)
        return table_of(
            _COUNTED, shard=[table["shard"][0].as_py()], words=[b" ".join(own)],
            blob=[packed(np.array([total[w] for w in own], np.int64))],
        )

    shape = "shard long, words binary, blob binary"
    return docs.mapInArrow(count, shape).groupBy("shard").applyInArrow(merge, shape)


@dataclass
class Vocabulary:
    """Slots of the frequent words, and what is known of the groups and of all counts."""

    slots: dict[bytes, int]
    slot_counts: np.ndarray
    group_tokens: np.ndarray
    group_words: np.ndarray
    tokens: int
    kinds: int
    ends: int

    def slot(self, word: bytes) -> int:
        own = self.slots.get(word)
        return WORDS + group_of(word) if own is None else own


def vocabulary(counts: DataFrame, ends: int, shards: int) -> Vocabulary:
    """The slots are the most frequent words of all shards; a shard offers at most ``most`` of them.

    What reaches the driver has a fixed size: ``WORDS`` words and one row per group.
    """
    most = min(WORDS, 4 * WORDS // shards + 200)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, blob in zip(batch["words"].to_pylist(), batch["blob"].to_pylist()):
                own, (n,) = words.split(), unpacked(blob)
                top = np.argsort(-n, kind="stable")[:most]
                yield pa.record_batch([pa.array([own[k] for k in top], pa.binary()), pa.array(n[top])], names=["word", "n"])

    top = counts.mapInArrow(offer, "word binary, n long").orderBy(F.desc("n"), "word").limit(WORDS).collect()
    slots = {bytes(row["word"]): k for k, row in enumerate(top)}

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, kinds = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
        for batch in batches:
            for words, blob in zip(batch["words"].to_pylist(), batch["blob"].to_pylist()):
                for word, n in zip(words.split(), unpacked(blob)[0].tolist()):
                    if word not in slots:
                        g = group_of(word)
                        tokens[g] += n
                        kinds[g] += 1
        yield pa.record_batch([pa.array(range(GROUPS), pa.int64()), pa.array(tokens), pa.array(kinds)], names=["g", "tokens", "kinds"])

    found = counts.mapInArrow(groups, "g long, tokens long, kinds long").groupBy("g").agg(
        F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")
    )
    tokens, kinds = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
    for row in found.collect():
        tokens[row["g"]], kinds[row["g"]] = row["tokens"], row["kinds"]
    in_words = sum(row["n"] for row in top)
    slot_counts = np.zeros(CLASSES * PER_CLASS)
    slot_counts[: len(top)] = [row["n"] for row in top]
    slot_counts[WORDS:END] = tokens
    slot_counts[END] = ends
    return Vocabulary(
        slots, slot_counts, tokens, kinds, int(in_words + tokens.sum() + ends), int(len(top) + kinds.sum() + (ends > 0)), ends
    )


class Network:
    """Gated recurrent unit; input rows feed the gates, the output is a class and a slot in it.

    Slots are dealt to classes so that neighbours in frequency lie in different classes.
    """

    SHAPES = {
        "x": (CLASSES * PER_CLASS, 3 * HIDDEN), "b": (3 * HIDDEN,), "u": (HIDDEN, 3 * HIDDEN),
        "cw": (HIDDEN, CLASSES), "cb": (CLASSES,), "sw": (CLASSES, HIDDEN, PER_CLASS), "sb": (CLASSES, PER_CLASS),
    }

    def __init__(self, counts: np.ndarray):
        rng = np.random.default_rng(1)
        self.p = {k: (rng.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in self.SHAPES.items()}
        share = (counts + 0.5).reshape(PER_CLASS, CLASSES).T
        self.p["sw"] *= 0.1
        self.p["cw"] *= 0.1
        self.p["cb"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        self.p["sb"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.SHAPES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, shape in self.SHAPES.items():
            n = math.prod(shape)
            self.p[k] = flat[at : at + n].reshape(shape).astype(np.float32)
            at += n

    def step(self, inputs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """Next state; also the gates, for the way back."""
        own = h @ self.p["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2)
        zr = own[:2] + inputs[:2]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr
        n = r * own[2]
        n += inputs[2]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n, own[2]

    def inputs(self, slots: np.ndarray) -> np.ndarray:
        """What the slots feed each gate, by step: one contiguous array a gate."""
        rows = (self.p["x"] + self.p["b"]).reshape(-1, 3, HIDDEN).transpose(1, 0, 2)
        return np.moveaxis(np.ascontiguousarray(rows).take(slots, axis=1), 0, -3)

    def outputs(self, h: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each target slot after its state, and the gradient for the state."""
        cls, within = targets % CLASSES, targets // CLASSES
        rows = np.arange(len(targets))
        e = h @ self.p["cw"]
        e += self.p["cb"]
        np.clip(e, -LARGEST, LARGEST, out=e)
        log = e[rows, cls]
        np.exp(e, out=e)
        total = e @ np.ones(CLASSES, e.dtype)
        log -= np.log(total)
        dh = None
        if grads is not None:
            d = e
            d /= total[:, None]
            d[rows, cls] -= 1
            grads["cw"] += h.T @ d
            grads["cb"] += np.ones(len(d), d.dtype) @ d
            dh = d @ self.p["cw"].T
        # within the classes: tokens sorted by class, products class by class, the rest at once
        order = np.argsort(cls.astype(np.uint8), kind="stable")
        cls, within, states = cls[order], within[order], h.take(order, axis=0)
        cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
        held = [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]
        e = np.empty((len(targets), PER_CLASS), h.dtype)
        for c, at in held:
            np.matmul(states[at], self.p["sw"][c], out=e[at])
            e[at] += self.p["sb"][c]
        np.clip(e, -LARGEST, LARGEST, out=e)
        picked = e[rows, within]
        np.exp(e, out=e)
        total = e @ np.ones(PER_CLASS, e.dtype)
        log[order] += picked - np.log(total)
        if grads is not None:
            e /= total[:, None]
            e[rows, within] -= 1
            back = np.empty_like(states)
            for c, at in held:
                grads["sw"][c] += states[at].T @ e[at]
                grads["sb"][c] += np.ones(at.stop - at.start, e.dtype) @ e[at]
                back[at] = e[at] @ self.p["sw"][c].T
            dh[order] += back
        return log, dh

    def backward(self, tape: list, dhs: np.ndarray, slots: np.ndarray, grads: dict) -> None:
        """Truncated backpropagation through the steps on the tape."""
        before, fresh, z, r, n, own = (np.stack(part) for part in zip(*tape))
        # what a state's gradient is multiplied by on its way to each gate, for all steps at once
        to_n = (1 - z) * (1 - n * n)
        to_z = (before - n) * z * (1 - z)
        to_r = own * r * (1 - r)
        dx, dh, u = np.empty((3, *dhs.shape), dhs.dtype), np.zeros_like(dhs[0]), self.p["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0)
        for t in range(len(tape) - 1, -1, -1):
            dh = dh + dhs[t]
            np.multiply(dh, to_z[t], out=dx[0, t])
            np.multiply(dh, to_n[t], out=dx[2, t])
            np.multiply(dx[2, t], to_r[t], out=dx[1, t])
            # nothing flows back over the start of a document
            dh *= z[t]
            dh += dx[0, t] @ u[0]
            dh += dx[1, t] @ u[1]
            dh += (dx[2, t] * r[t]) @ u[2]
            dh *= fresh[t]
        dx = dx.reshape(3, -1, HIDDEN)
        back = dx[0], dx[1], dx[2] * r.reshape(-1, HIDDEN)
        grads["u"] += np.hstack([before.reshape(-1, HIDDEN).T @ gate for gate in back])
        grads["b"] += (np.ones(dx.shape[1], dx.dtype) @ dx).ravel()
        order = np.argsort(slots.ravel().astype(np.uint16), kind="stable")
        own = slots.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        grads["x"][own[first]] += np.hstack([np.add.reduceat(gate.take(order, axis=0), first, axis=0) for gate in dx])


def train(network: Network, docs: list[np.ndarray]) -> None:
    """One pass over the documents, laid end to end in ``STREAMS`` streams, with Adagrad steps."""
    if not docs:
        return
    docs = sorted(docs, key=lambda d: zlib.crc32(d.tobytes()))
    whole = np.concatenate(docs)
    streams = min(STREAMS, max(1, len(whole) // (WINDOW * LEAST_STEPS)))
    steps = len(whole) // streams
    targets = whole[: steps * streams].reshape(streams, steps).T
    # the token before each one; a document begins after an end
    given = np.concatenate([np.full((1, streams), END), targets[:-1]])
    h = np.zeros((streams, HIDDEN), np.float32)
    squares = {k: np.full(s, 1e-4, np.float32) for k, s in Network.SHAPES.items()}
    for at in range(0, steps, WINDOW):
        given_now, targets_now = given[at : at + WINDOW], targets[at : at + WINDOW]
        inputs, tape, states = network.inputs(given_now), [], []
        for t in range(len(given_now)):
            fresh = (given_now[t] != END).astype(np.float32)[:, None]
            h = h * fresh
            new, *kept = network.step(inputs[t], h)
            tape.append((h, fresh, *kept))
            states.append(new)
            h = new
        grads = {k: np.zeros(s, np.float32) for k, s in Network.SHAPES.items()}
        _, dh = network.outputs(np.concatenate(states), targets_now.ravel(), grads)
        network.backward(tape, dh.reshape(len(states), streams, HIDDEN), given_now, grads)
        scale = 1 / targets_now.size
        for k, g in grads.items():
            g *= scale
            squares[k] += g * g
            network.p[k] -= STEP * g / np.sqrt(squares[k])


def score_documents(network: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural-log probability of each document's slots, the state carried over whole documents."""
    out = np.zeros(len(docs))
    order = sorted(range(len(docs)), key=lambda k: (-len(docs[k]), k))
    for start in range(0, len(order), ABREAST):
        group = order[start : start + ABREAST]
        sizes = np.array([len(docs[k]) for k in group])
        whole, begins = np.concatenate([docs[k] for k in group]), np.cumsum(sizes) - sizes
        h = np.zeros((len(group), HIDDEN), np.float32)
        last = np.full(len(group), END)
        for at in range(0, int(sizes[0]), SCORED_WINDOW):
            live = int(np.searchsorted(-sizes, -at, "left"))  # sizes fall, so the live ones come first
            width = min(SCORED_WINDOW, int(sizes[0]) - at)
            place = np.arange(at, at + width)[:, None]
            inside = place < sizes[:live]
            targets = np.where(inside, whole.take(begins[:live] + place, mode="clip"), END)
            given = np.concatenate([last[None, :live], targets[:-1]])
            inputs, states, h = network.inputs(given), [], h[:live]
            for t in range(width):
                h = network.step(inputs[t], h)[0]
                states.append(h)
            held = np.flatnonzero(inside)
            log, _ = network.outputs(np.concatenate(states).take(held, axis=0), targets.ravel().take(held))
            owner = held % live
            out[group[:live]] += np.bincount(owner, log, live)
            last = targets[-1]
    return out


_SLOTS = pa.schema([("trainer", pa.int64()), ("blob", pa.binary())])
_SLICE = pa.schema([("slice", pa.int64()), ("part", pa.int64()), ("weight", pa.float64()), ("blob", pa.binary())])


def trained(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Parameters after ``ROUNDS`` rounds of parallel training on all documents, and averaging."""
    spark = docs.sparkSession
    network = Network(vocab.slot_counts)
    trainers = max(1, math.ceil(docs.select("doc_id").count() / DOCS_PER_TRAINER))
    slots = spark.sparkContext.broadcast(vocab)  # of fixed size

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = slots.value
        for batch in batches:
            texts = [(raw.as_py() or b"").lower().split() for raw in batch["raw"]]
            blobs = [packed(np.array([*map(known.slot, words), END], np.uint16)) for words in texts]
            yield from table_of(_SLOTS, trainer=batch["trainer"].to_pylist(), blob=blobs).to_batches()

    own = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(trainers))
    dealt = stored(docs.select(own.alias("trainer"), "raw").mapInArrow(to_slots, "trainer long, blob binary"), "training")
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast(network.flat().astype(np.float32))

        def run(table: pa.Table) -> pa.Table:
            own = Network(slots.value.slot_counts)
            own.load(start.value)  # noqa: B023
            texts = [unpacked(blob)[0].astype(np.int64) for blob in table["blob"].to_pylist()]
            train(own, texts)
            weight, part = float(sum(map(len, texts))), table["trainer"][0].as_py() // MERGED
            parts = np.array_split(own.flat(), SLICES)
            return table_of(
                _SLICE, slice=range(SLICES), part=[part] * SLICES, weight=[weight] * SLICES, blob=[packed(p) for p in parts]
            )

        def average(table: pa.Table) -> pa.Table:
            weights = table["weight"].to_numpy()
            total = sum(w * unpacked(b)[0].astype(np.float64) for w, b in zip(weights, table["blob"].to_pylist()))
            return table_of(
                _SLICE, slice=[table["slice"][0].as_py()], part=[table["part"][0].as_py()], weight=[float(weights.sum())],
                blob=[packed(total / weights.sum())],
            )

        shape = "slice long, part long, weight double, blob binary"
        results = dealt.groupBy("trainer").applyInArrow(run, shape)
        means = results.groupBy("slice", "part").applyInArrow(average, shape).groupBy("slice").applyInArrow(average, shape).collect()
        if means:
            network.load(np.concatenate([unpacked(bytes(r["blob"]))[0] for r in sorted(means, key=lambda r: r["slice"])]))
    return network.flat()


_ASKED = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("words", pa.binary())])
_TOLD = pa.schema([("block", pa.int64()), ("words", pa.binary()), ("blob", pa.binary())])
SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORED = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_tokens", "n_known", "train_tokens")]
    + [(n, pa.float64()) for n in ("base_score", "score")]
)


def _ask(shards: int):
    def run(table: pa.Table) -> pa.Table:
        seen: set[bytes] = set()
        for _, raw, _ in documents_of(table):
            seen.update((raw or b"").lower().split())
        parts = _by_shard(list(seen), shards)
        block = table["block"][0].as_py()
        return table_of(_ASKED, shard=list(parts), block=[block] * len(parts), words=[b" ".join(w) for w in parts.values()])

    return run


def _tell(asked: pa.Table, counted: pa.Table) -> pa.Table:
    counts: dict[bytes, int] = {}
    for words, blob in zip(counted["words"].to_pylist(), counted["blob"].to_pylist()):
        counts.update(zip(words.split(), unpacked(blob)[0].tolist()))
    blocks, told = asked["block"].to_pylist(), asked["words"].to_pylist()
    blobs = [packed(np.array([counts.get(w, 0) for w in words.split()], np.int64)) for words in told]
    return table_of(_TOLD, block=blocks, words=told, blob=blobs)


def score(docs: DataFrame, learning: Column) -> DataFrame:
    """``SCORED`` of every document; those where ``learning`` is true are counted and trained on."""
    spark = docs.sparkSession
    shards = shuffle_width(spark)
    rows = doc_frame(docs)
    training = rows.where(learning)
    counts = stored(word_counts(training, shards), "counts")
    vocab = vocabulary(counts, training.count(), shards)
    parameters = trained(training, vocab)
    shared = spark.sparkContext.broadcast((vocab, parameters))  # of fixed size

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        known, flat = shared.value
        network = Network(known.slot_counts)
        network.load(flat)
        # per distinct word: slot, count, log10(count + 1), log share of its group
        number: dict[bytes, int] = {}
        count: list[int] = []
        for words, blob in zip(told["words"].to_pylist(), told["blob"].to_pylist()):
            number.update(zip(words.split(), itertools.count(len(number))))
            count += unpacked(blob)[0].tolist()
        c = np.array([*count, known.ends], np.int64)
        slot = np.array([*map(known.slot, number), END], np.int64)
        log_count = np.log10(c + 1)
        group = slot - WORDS
        other = (group >= 0) & (group < GROUPS)
        room = np.log10(known.group_tokens + known.group_words + 1)
        in_group = np.where(other, log_count - room[np.where(other, group, 0)], 0.0)
        base_room = math.log10(known.tokens + known.kinds + 1)
        ends = len(number)
        ids, tokens = [], []
        for doc_id, raw, _ in documents_of(table):
            words = (raw or b"").lower().split()
            ids.append(doc_id)
            own = np.full(len(words) + 1, ends)
            own[:-1] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            tokens.append(own)
        model = score_documents(network, [slot[t] for t in tokens]) / math.log(10)
        return table_of(
            _SCORED, doc_id=ids, n_tokens=[len(t) for t in tokens],
            n_known=[int((c[t] > 0).sum()) for t in tokens], train_tokens=[known.tokens] * len(tokens),
            base_score=[float(log_count[t].sum() - len(t) * base_room) for t in tokens],
            score=[float(model[k] + in_group[t].sum()) for k, t in enumerate(tokens)],
        )

    blocked = text_blocks(docs, shards)
    asked = blocked.groupBy("block").applyInArrow(_ask(shards), "shard long, block long, words binary")
    told = asked.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(_tell, "block long, words binary, blob binary")
    return blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, SCORED)
