"""Language-model scores: corpus counts of all words, and a gated recurrent network with a class-factored softmax."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.session import materialise

#: Documents whose crc32 of the id is this, modulo FOLDS, are held out.
FOLDS, HELD_OUT = 7, 2
#: Words with outputs of their own (the document's end is one), in classes of so many; all others fall in classes by their last letters.
CLASS_WORDS, WORD_CLASSES, TAIL_CLASSES = 64, 64, 64
OWN = CLASS_WORDS * WORD_CLASSES
#: Most frequent words, whose counts every task holds; the counts of others come by a join.
KNOWN = 65_536
HIDDEN = 24
#: Steps through which the gradient goes back, lanes of text trained together, and steps of one scoring window.
BACK, LANES, WINDOW = 32, 256, 64
RATE = 0.1
#: Documents scored together.
TOGETHER = 512
#: Inputs with more rows than this in a window are summed one by one.
FREQUENT = 16
#: Rounds, each over its share of the training documents (every document is in one), and tokens that a task trains on before it reads on.
ROUNDS, ROUND_TOKENS = 2, 1 << 20
#: Passes over what a task holds, for a corpus of any size.
PASSES = 1
#: Groups that the networks of all tasks are averaged in first, so that none grows with the number of tasks alone.
FIRST_MEANS = 300
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 300_000
#: Parameters of one row when networks are averaged.
CHUNK = 4096

END = 0
#: exp(x) is 2 to the power of x times this, which numpy computes in half the time.
BITS = np.float32(1 / np.log(2))


#: Bytes of text whose words are cut together.
PIECE = 1 << 22
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


@cache
def tail_table() -> np.ndarray:
    """Classes by the last two bytes of a word, then by the only byte of one of one byte."""
    ends = [*(bytes([a, b]) for a in range(256) for b in range(256)), *(bytes([b]) for b in range(256))]
    return np.array([zlib.crc32(end) % TAIL_CLASSES for end in ends])


def ends_and_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a binary array without nulls begin and end (one more than values), and their bytes."""
    if not len(values):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]


def tail_classes(words: pa.Array) -> np.ndarray:
    at, data = ends_and_bytes(words)
    last = data[at[1:] - 1].astype(np.int64)
    longer = np.diff(at) > 1
    return tail_table()[np.where(longer, data[at[1:] - 1 - longer] * np.int64(256), 1 << 16) + last]


def pieces(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of texts (null: empty), A-Z lower-cased, and how many each text has: for runs of texts of some megabytes."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    at, _ = ends_and_bytes(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + PIECE, "right")) - 1)
        yield cut(texts.slice(begin, end - begin))
        begin = end


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    at, data = ends_and_bytes(texts)
    # a space is put behind each text, so that a word ends with it
    solid = np.zeros(len(data) + len(texts) + 1, bool)
    held = np.ones(len(solid), bool)
    held[at + np.arange(len(at))] = False
    solid[held] = ~SPACE[data]
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    starts, size = turns[::2], turns[1::2] - turns[::2]
    ends = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=ends[1:])
    words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[data[solid[held]]])])
    return words, np.diff(np.searchsorted(starts, at + np.arange(len(at))))


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``held_out``; a null id counts as an empty text."""
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT).alias("held_out"),
    )


def word_counts(train: DataFrame) -> DataFrame:
    """``word, c``: how often each word occurs in all of ``train``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def together() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

        def out() -> list[pa.RecordBatch]:
            return held.pop().cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches()

        for batch in batches:
            for words, _ in pieces(batch.column(0)):
                held.append(pa.table(pc.value_counts(words).flatten(), ["word", "n"]))
                if sum(map(len, held)) > HELD_WORDS:
                    held[:] = [together()]
                    if len(held[0]) > HELD_WORDS:
                        yield from out()
        if held:
            held[:] = [together()]
            yield from out()

    return train.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> list:
    """The most frequent words, ``most`` or a few less, most frequent first.

    A histogram of the counts in steps of a sixteenth of an octave says from which count on they fit; words in the step that
    does not fit stay out together. So the driver gets no more rows than it keeps.
    """
    level = F.floor(F.log2("c") * 16).cast("int")
    least, n = None, 0
    for row in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        n += row["n"]
        if n > most:
            break
        least = row["level"]
    if least is None:
        return []
    return sorted(counts.where(level >= least).collect(), key=lambda r: (-r["c"], r["word"]))


class Network:
    """Parameters in one vector, with views by name."""

    SHAPES = {
        "inputs": (OWN + TAIL_CLASSES, 3 * HIDDEN),
        "state": (HIDDEN, 3 * HIDDEN),
        "classes": (HIDDEN, WORD_CLASSES + TAIL_CLASSES),
        "class_bias": (WORD_CLASSES + TAIL_CLASSES,),
        "words": (WORD_CLASSES, HIDDEN, CLASS_WORDS),
        "word_bias": (WORD_CLASSES, CLASS_WORDS),
    }
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        at = 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, values[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, own_counts: np.ndarray, tail_counts: np.ndarray) -> Network:
        """Small random weights; the biases are the frequencies, so that training starts from the unigram."""
        net = cls(np.random.default_rng(7).normal(0, 0.08, cls.SIZE).astype(np.float32))
        counts = np.zeros(OWN)
        counts[: len(own_counts)] = own_counts
        by_class = counts.reshape(WORD_CLASSES, CLASS_WORDS)
        net.class_bias[:] = np.log(np.concatenate([by_class.sum(1), tail_counts]) + 0.5)
        net.class_bias -= net.class_bias.max()
        net.word_bias[:] = np.log(by_class + 0.01)
        net.word_bias -= net.word_bias.max(1, keepdims=True)
        return net


class Room:
    """Arrays by name that one window after another uses, so that their memory is not given back and asked for each time."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, dtype: object = np.float32) -> np.ndarray:
        n = math.prod(shape)
        got = self.held.get(name)
        if got is None or len(got) < n or got.dtype != dtype:
            got = self.held[name] = np.empty(n, dtype)
        return got[:n].reshape(shape)


def class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < OWN, ids // CLASS_WORDS, WORD_CLASSES + ids - OWN)


def moving(net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the inputs, and of the state by part, for ``move``: those of the gates so that a power of two is exp(-x)."""
    inputs, parts = net.inputs.copy(), net.state.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2).copy()
    inputs[:, : 2 * HIDDEN] *= -BITS
    parts[:2] *= -BITS
    return inputs, parts


def move(weights: tuple[np.ndarray, np.ndarray], x: np.ndarray, h: np.ndarray, u: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
    """One gated step into ``u`` (reset, update, the state's part of the candidate), ``n`` (candidate) and ``new`` (the new state)."""
    g = weights[0].take(x, axis=0).reshape(-1, 3, HIDDEN).transpose(1, 0, 2)
    np.matmul(h, weights[1], out=u)
    gates = u[:2]
    gates += g[:2]
    np.exp2(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(u[0], u[2], out=n)
    n += g[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=new)
    new *= u[1]
    new += n


def step(net: Network, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One gated step: reset, update, candidate, the state's part of the candidate, and the new state."""
    u, n, new = np.empty((3, *h.shape), h.dtype), np.empty_like(h), np.empty_like(h)
    move(moving(net), x, h, u, n, new)
    return u[0], u[1], n, u[2], new


def by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of the targets by word class, those without one last, and each class's runs in it: class, begin, end."""
    kinds = np.minimum(targets // CLASS_WORDS, WORD_CLASSES).astype(np.int16)
    ends = np.cumsum(np.bincount(kinds, minlength=WORD_CLASSES)[:WORD_CLASSES]).tolist()
    runs = [(k, a, min(a + TOGETHER, e)) for k, (b, e) in enumerate(zip([0, *ends], ends, strict=False)) for a in range(b, e, TOGETHER)]
    return np.argsort(kinds, kind="stable"), runs


def outputs(net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Weights of classes and of words with the biases as a last row, for states that end with a one, and powers of two."""
    return np.concatenate([net.classes, net.class_bias[None]]) * BITS, np.concatenate([net.words, net.word_bias[:, None]], axis=1) * BITS


def log_probabilities(net: Network, h: np.ndarray, targets: np.ndarray, room: Room | None = None) -> np.ndarray:
    """ln P(class | h), plus ln P(word | class, h) for words with outputs of their own."""
    room = room or Room()
    order, runs = by_class(targets)
    target, (classes, words) = targets[order], outputs(net)
    states = room("sorted", len(h), HIDDEN + 1, dtype=h.dtype)
    states[:, :HIDDEN], states[:, HIDDEN] = h.take(order, axis=0, out=room("taken", *h.shape, dtype=h.dtype), mode="clip"), 1
    got, total = np.zeros((2, len(h)), h.dtype), np.ones((2, len(h)), h.dtype)
    every, ones = np.arange(TOGETHER), np.ones(max(classes.shape[1], CLASS_WORDS), h.dtype)

    def softmax(layer: int, begin: int, end: int, weights: np.ndarray, at: np.ndarray) -> None:
        wide = weights.shape[1]
        logits = np.matmul(states[begin:end], weights, out=room("logits", end - begin, wide, dtype=h.dtype))
        got[layer, begin:end] = logits[every[: end - begin], at]
        np.matmul(np.exp2(logits, out=logits), ones[:wide], out=total[layer, begin:end])

    kinds, places = class_of(target), target % CLASS_WORDS
    for a in range(0, len(h), TOGETHER):
        softmax(0, a, min(a + TOGETHER, len(h)), classes, kinds[a : a + TOGETHER])
    for k, a, b in runs:
        softmax(1, a, b, words[k], places[a:b])
    out = np.empty(len(h))
    out[order] = (got / BITS - np.log(total)).astype(np.float64).sum(0)
    return out


def score_documents(net: Network, documents: list[np.ndarray]) -> np.ndarray:
    """ln P of each document (ids, the end last): a state of its own, carried from window to window until its end."""
    total = np.zeros(len(documents))
    length = np.array(list(map(len, documents)), np.int64)
    longest = np.argsort(-length, kind="stable")
    weights, room = moving(net), Room()
    for at in range(0, len(longest), TOGETHER):
        group = longest[at : at + TOGETHER]
        size = length[group]
        flat = np.concatenate([documents[i] for i in group])
        first = np.cumsum(size) - size
        h, u, candidate = np.zeros((len(group), HIDDEN), np.float32), room("u", 3, len(group), HIDDEN), room("n", len(group), HIDDEN)
        x = np.full(len(group), END)
        for begin in range(0, int(size[0]), WINDOW):
            # lengths fall, so those still running come first
            running = np.searchsorted(-size, -np.arange(begin, min(begin + WINDOW, int(size[0]))), "left")
            upto = np.cumsum(running)
            states = room("states", int(upto[-1]), HIDDEN)
            targets, lanes = np.empty(upto[-1], np.int64), np.empty(upto[-1], np.int64)
            for t, (n, end) in enumerate(zip(running.tolist(), upto.tolist(), strict=True), begin):
                new = states[end - n : end]
                move(weights, x[:n], h[:n], u[:, :n], candidate[:n], new)
                h, x = new, flat[first[:n] + t]
                targets[end - n : end] = x
                lanes[end - n : end] = np.arange(n)
            total[group] += np.bincount(lanes, log_probabilities(net, states, targets, room), len(group))
            h = h.copy()
    return total


def sums_by_id(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, most frequent first, and the sum of each one's rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    size = np.diff(first, append=len(ids))
    falling = np.argsort(-size, kind="stable")
    first, size = first[falling], size[falling]
    sums = rows.take(order[first], axis=0)
    # frequent ids one by one, the others together: their second rows, their third ones, and so on
    upto = np.searchsorted(-size, -np.arange(FREQUENT + 1), "left").tolist()
    many = upto[FREQUENT]
    for i in range(many):
        rows.take(order[first[i] : first[i] + size[i]], axis=0).sum(0, out=sums[i])
    for k in range(1, FREQUENT):
        sums[many : upto[k]] += rows.take(order[first[many : upto[k]] + k], axis=0)
    return ids[first], sums


def train_window(net: Network, memory: Network, x: np.ndarray, y: np.ndarray, h: np.ndarray, room: Room | None = None) -> np.ndarray:
    """One step of gradient descent (scaled by past gradients) over a window; returns the state after it.

    ``x`` and ``y`` are inputs and targets, steps by lanes. The state starts anew where the input is a document's end.
    """
    room = room or Room()
    steps, lanes = x.shape
    count = steps * lanes
    befores, news, ns = (room(name, steps, lanes, HIDDEN) for name in ("befores", "news", "ns"))
    us = room("us", steps, 3, lanes, HIDDEN)
    anew = [np.flatnonzero(row == END) for row in x]
    weights = moving(net)
    for t in range(steps):
        befores[t] = h
        befores[t, anew[t]] = 0
        h = news[t]
        move(weights, x[t], befores[t], us[t], ns[t], h)

    targets = y.ravel()
    order, runs = by_class(targets)
    target, (classes, words) = targets[order], outputs(net)
    states, out = room("sorted", count, HIDDEN + 1), room("out", count, HIDDEN)
    states[:, :HIDDEN], states[:, HIDDEN] = news.reshape(-1, HIDDEN).take(order, axis=0, out=out, mode="clip"), 1
    out[:] = 0
    every, ones = np.arange(TOGETHER), np.ones(max(classes.shape[1], CLASS_WORDS), np.float32)

    def softmax(begin: int, end: int, weights: np.ndarray, at: np.ndarray, grad: np.ndarray) -> None:
        state, wide = states[begin:end], weights.shape[1]
        p = np.matmul(state, weights, out=room("logits", end - begin, wide))
        total = np.exp2(p, out=p) @ ones[:wide]
        p[every[: end - begin], at] -= total
        share = np.reciprocal(total, out=total)[:, None]
        back = p @ weights[:HIDDEN].T
        back *= share / BITS
        out[begin:end] += back
        grad += (state * share).T @ p

    of_classes, of_words = np.zeros_like(classes), np.zeros_like(words)
    kinds, places = class_of(target), target % CLASS_WORDS
    for a in range(0, count, TOGETHER):
        softmax(a, min(a + TOGETHER, count), classes, kinds[a : a + TOGETHER], of_classes)
    for k, a, b in runs:
        softmax(a, b, words[k], places[a:b], of_words[k])
    outs = room("outs", count, HIDDEN)
    outs[order] = out
    outs = outs.reshape(steps, lanes, HIDDEN)

    gates = room("gates", steps, lanes, 3 * HIDDEN)
    dh, dstate, state_back = np.zeros((lanes, HIDDEN), np.float32), np.zeros_like(net.state), net.state.T.copy()
    dn, rest, part = room("dn", lanes, HIDDEN), room("rest", lanes, HIDDEN), room("part", lanes, HIDDEN)
    for t in reversed(range(steps)):
        before, n, (r, z, back), through = befores[t], ns[t], us[t], gates[t]
        dh += outs[t]
        np.subtract(1, z, out=rest)
        rest *= dh
        np.multiply(n, n, out=dn)
        np.subtract(1, dn, out=dn)
        dn *= rest
        rest *= z
        np.subtract(before, n, out=part)
        np.multiply(rest, part, out=through[:, HIDDEN : 2 * HIDDEN])
        np.subtract(1, r, out=part)
        part *= back
        np.multiply(dn, r, out=rest)
        part *= rest
        through[:, :HIDDEN], through[:, 2 * HIDDEN :] = part, rest
        dstate += before.T @ through
        dh *= z
        dh += through @ state_back
        dh[anew[t]] = 0
        through[:, 2 * HIDDEN :] = dn

    def descend(name: str, where: object, grad: np.ndarray) -> None:
        """Without a gradient neither a value nor its memory changes."""
        values, past = getattr(net, name), getattr(memory, name)
        g = grad / np.float32(count)
        now = g * g
        now += past[where]
        past[where] = now
        np.sqrt(now, out=now)
        now += np.float32(1e-6)
        g *= np.float32(RATE)
        g /= now
        values[where] -= g

    whole = slice(None)
    descend("inputs", *sums_by_id(x.ravel().astype(np.int16), gates.reshape(-1, 3 * HIDDEN)))
    descend("state", whole, dstate)
    descend("classes", whole, of_classes[:HIDDEN])
    descend("class_bias", whole, of_classes[HIDDEN])
    descend("words", whole, of_words[:, :HIDDEN])
    descend("word_bias", whole, of_words[:, HIDDEN])
    return h.copy()


def train_on(net: Network, memory: Network, stream: np.ndarray) -> None:
    """Train on a stream of documents, each with its end last: cut into lanes, the state carried from window to window."""
    lanes = min(LANES, max(1, len(stream) // (40 * BACK)))
    each = (len(stream) - 1) // lanes
    if each < 1:
        return
    x = np.ascontiguousarray(stream[: lanes * each].reshape(lanes, each).T)
    y = np.ascontiguousarray(stream[1 : lanes * each + 1].reshape(lanes, each).T)
    h, room = np.zeros((lanes, HIDDEN), np.float32), Room()
    for t in range(0, each, BACK):
        h = train_window(net, memory, x[t : t + BACK], y[t : t + BACK], h, room)


class Lexicon:
    """The most frequent words with their counts, and the ids of the network's inputs and outputs."""

    def __init__(self, words: list[bytes], counts: np.ndarray, end_count: int) -> None:
        self.words = pa.array(words, pa.binary())
        # id 0 is the end; the first words have outputs of their own
        self.ids = np.arange(1, len(words) + 1)
        self.ids[OWN - 1 :] = OWN + tail_classes(self.words[OWN - 1 :])
        self.log_count = np.log10(counts + 1.0)
        self.counts = counts
        self.end_count = end_count

    def places(self, words: pa.Array) -> np.ndarray:
        """Places of the words, -1 beyond the lexicon."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def look_up(self, texts: pa.Array) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, pa.Array]]:
        """By pieces of the texts: ids of each text's words and the end, words of each, places of all words, and the words beyond the lexicon."""
        for words, size in pieces(texts):
            place = self.places(words)
            rest = words.filter(pa.array(place < 0))
            ids = np.zeros(len(words), np.int64)
            ids[place >= 0] = self.ids[place[place >= 0]]
            ids[place < 0] = OWN + tail_classes(rest)
            ends = np.cumsum(size + 1)
            with_ends = np.full(len(words) + len(size), END)
            held = np.ones(len(with_ends), bool)
            held[ends - 1] = False
            with_ends[held] = ids
            yield np.split(with_ends, ends[:-1]), size, place, rest


def averaged(rows: DataFrame) -> np.ndarray:
    """The mean of the networks of all tasks, weighted by the tokens they saw; executors average chunk by chunk, in two levels."""

    def mean(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        weight = part["n"].to_numpy(float)
        total = np.zeros(len(part["part"].iloc[0]) // 4)
        for b, w in zip(part["part"], weight, strict=True):
            total += np.frombuffer(b, np.float32) * w
        return pd.DataFrame({"chunk": [key[0]], "n": [int(weight.sum())], "part": [(total / weight.sum()).astype(np.float32).tobytes()]})

    schema = "chunk int, n long, part binary"
    some = rows.withColumn("few", F.spark_partition_id() % FIRST_MEANS).groupBy("chunk", "few").applyInPandas(mean, schema)
    got = some.groupBy("chunk").applyInPandas(mean, schema).orderBy("chunk").collect()
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in got]) if got else np.zeros(0, np.float32)


def fit(train: DataFrame, lexicon: Lexicon, tail_counts: np.ndarray) -> np.ndarray:
    """Rounds of local training in every task, from the same network, and an average of the results.

    Every training document is in exactly one round, by a hash of its id and text, so the corpus is gone over once, at every size.
    """
    own = np.concatenate([[lexicon.end_count], lexicon.counts[: OWN - 1]]).astype(float)
    values = Network.start(own, tail_counts).values
    for turn in range(ROUNDS):
        now = values
        share = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == turn)

        def run(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            net, memory = Network(now.copy()), Network(np.full(Network.SIZE, 1e-4, np.float32))
            seen, held, size = 0, [], 0

            def learn() -> None:
                stream = np.concatenate([np.array([END], np.int64), *held])
                for _ in range(PASSES):
                    train_on(net, memory, stream)

            for batch in batches:
                for ids in (ids for found in lexicon.look_up(batch.column(0)) for ids in found[0]):
                    held.append(ids)
                    size += len(ids)
                    if size >= ROUND_TOKENS:
                        learn()
                        seen, held, size = seen + size, [], 0
            if size:
                learn()
                seen += size
            if seen:
                parts = [net.values[i : i + CHUNK].tobytes() for i in range(0, Network.SIZE, CHUNK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "n", "part"]
                )

        mean = averaged(share.select("text").mapInArrow(run, "chunk int, n long, part binary"))
        if len(mean):
            values = mean
    return values


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row, learned from those not held out.

    Tokens are words with A-Z lower-cased, and one end for each document. Base is the unigram, add-one over the training tokens. The
    model reads a document from its start to its end with one state; a token's probability is that of its class, and of
    the word within it: by the network for frequent words, by the counts of the class for all others, one place
    of the class being left for words never seen. Counts cover all training documents.

    A null text is empty: an end alone. A null id is in training. Repeated rows are each scored, and each counted if in training. Other
    columns are ignored.
    """
    marked = held_out(docs)
    train = marked.where(~F.col("held_out"))
    counts = materialise(word_counts(train), "lm-counts")
    n_docs = train.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sums["n"] + n_docs, sums["v"] + (n_docs > 0)
    top = most_frequent(counts, KNOWN)
    lexicon = Lexicon([r["word"].encode() for r in top], np.array([r["c"] for r in top], np.int64), n_docs)

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, c = batch.column(0).cast(pa.binary()), batch.column(1).to_numpy()
            place = lexicon.places(words)
            rest = (place < 0) | (place + 1 >= OWN)
            kind = tail_classes(words)[rest]
            yield pa.RecordBatch.from_pydict(
                {"kind": np.arange(TAIL_CLASSES), "n": np.bincount(kind, c[rest], TAIL_CLASSES).astype(np.int64), "v": np.bincount(kind, minlength=TAIL_CLASSES)}
            )

    tail_n, tail_v = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for row in counts.mapInArrow(tails, "kind long, n long, v long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        tail_n[row["kind"]], tail_v[row["kind"]] = row["n"], row["v"]
    values = fit(train, lexicon, tail_n)
    tail_size = np.log10(tail_n + tail_v + 1)
    size = np.log10(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(values)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            documents, n_known, base, n_rest, rests, tail = [], [], [], [], [], []
            for some, words, place, rest in lexicon.look_up(batch.column(1)):
                text = np.repeat(np.arange(len(some)), words)
                known = place >= 0
                counted = np.zeros(len(place))
                counted[known] = lexicon.log_count[place[known]]
                # of words without an output: the place in their class
                ids = np.concatenate(some)
                beyond = ids >= OWN
                size_of_class = np.bincount(np.repeat(np.arange(len(some)), words + 1)[beyond], tail_size[ids[beyond] - OWN], len(some))
                documents += some
                found = np.bincount(text[known], minlength=len(some))
                n_known.append(found + (n_docs > 0))
                n_rest.append(words - found)
                base.append(np.bincount(text, counted, len(some)) + np.log10(n_docs + 1) - (words + 1) * size)
                tail.append(np.bincount(text, np.where(place + 1 >= OWN, counted, 0.0), len(some)) - size_of_class)
                rests.append(rest)
            if not documents:
                continue
            model = score_documents(net, documents) / np.log(10) + np.concatenate(tail)
            rest_ends = np.concatenate([[0], np.cumsum(np.concatenate(n_rest))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(documents))), batch.column(0), batch.column(2), pa.array([len(d) for d in documents], pa.int64()),
                    pa.array(np.concatenate(n_known), pa.int64()), pa.array(np.concatenate(base)), pa.array(model, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rest_ends), pa.concat_arrays(rests).cast(pa.string())),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rest"],
            )
            row += len(documents)

    scored = materialise(
        marked.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rest array<string>"), "lm-scored"
    )
    rare = scored.select("row", F.explode("rest").alias("word")).join(counts, "word", "left")
    more = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more"), F.count("c").alias("found"))
    met = scored.drop("rest").join(more, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return met.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"), (F.col("base") + extra).alias("base_score"), (F.col("model") + extra).alias("score"),
    )
