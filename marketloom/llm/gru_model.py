"""Language-model scores by a gated recurrent network in numpy.

**Tokens.** Words are runs other than the six ASCII white-space characters, with A-Z lower-cased, and one end per text.
All training texts are counted: the counts of every word are one table, shuffled as sums per partition.

**Network.** A GRU of ``HIDDEN`` units over the end and the ``VOCABULARY - 2`` most frequent words; every other word
enters as one "other" token.  The output is factored into ``CLASSES`` classes of tokens and the tokens of a class, so a
step takes two short softmaxes.  An "other" token is then worth its add-one share among the other words, so the model
is a distribution over all words.  Output biases start at the counts, hence an untrained network is a unigram model.
Training is truncated backpropagation (Adam) over windows of ``WINDOW`` tokens with the state carried from window to
window through each whole text, and takes every training text.  The texts are dealt to ``ROUNDS`` rounds, and within a
round to groups of about ``GROUP_TOKENS`` tokens; a task trains the weights on a group, and the next round starts from
the groups' average, weighted by tokens.  A group of few tokens is passed through until it has had its part of ``STEPS``
updates.  The driver holds the weights, and sums of them from about the square root of the number of groups.

**Scoring.** Whole texts are dealt to balanced streams, which are scored side by side, window after window with the state
carried on and cleared where a text begins; a long text takes no more steps than the others share among them.

**Counts of words.** The at most ``FREQUENT`` most frequent words go to the tasks; the rest of a text's words are joined
with the table by their hash.  Words are told apart by 64-bit hashes.

Rules: a null text is empty and scores as its end alone; rows with a null id are scored but not
trained on; repeated rows count as often as they stand; an empty training set gives counts of zero; other columns
are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import id_residue, mixed, stored, utf8

VOCABULARY = 1024
CLASSES = 32
HIDDEN = 24
WINDOW = 32  # tokens of a truncated window
STREAMS, FEW = 512, 128  # texts that are trained side by side, at most, and in small groups
ROUNDS = 4  # of training, each on its own part of the texts
GROUP_TOKENS = 1 << 21  # tokens that a task trains on in a round, about
STEPS = 500  # updates of a group in all rounds, at least
FREQUENT = 1 << 17
DISTINCT = 1 << 19  # words that a task numbers before it begins anew
PART = 1000  # texts whose words are numbered together
BATCH = 8192  # texts that are scored together
SAFE = 60.0  # up to this size, exponentials of single precision can be summed as they are
END, OTHER = 0, 1
END_HASH = 0  # stands for the end in the table of counts


class Words(dict):
    """The words of a task's texts, numbered, so that each is hashed and looked up once."""

    def __init__(self, frequent: Frequent | None = None):
        super().__init__()
        self.frequent, self._new = frequent, []
        self.hashes = np.empty(0, np.int64)
        self.counts, self.tokens = np.empty(0, np.int64), np.empty(0, np.int16)

    def __missing__(self, word: bytes) -> int:
        self._new.append(xxhash.xxh3_64_intdigest(word))
        self[word] = number = len(self)
        return number

    def full(self) -> bool:
        return len(self) >= DISTINCT

    def numbers(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' words, one text after another, and how many each has."""
        split = [text.lower().split() for text in texts]
        lengths = np.array([len(words) for words in split], np.int64)
        flat = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        new, self._new = np.array(self._new, np.uint64).view(np.int64), []
        self.hashes = np.concatenate((self.hashes, new))
        if self.frequent is not None:
            counts, tokens = self.frequent.look_up(new)
            self.counts, self.tokens = np.concatenate((self.counts, counts)), np.concatenate((self.tokens, tokens.astype(np.int16)))
        return flat, lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights: input table, recurrent matrix, and the biases and matrices of classes and tokens."""

    def __init__(self, counts: np.ndarray, seed: int = 8):
        rng = np.random.default_rng(seed)
        v, h = VOCABULARY, HIDDEN
        self.width = v // CLASSES
        p = (counts.astype(float) + 1).reshape(CLASSES, self.width)
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.w = {
            "x": normal(v, 3 * h), "u": normal(h, 3 * h), "c": normal(h, CLASSES), "t": normal(CLASSES, self.width, h),
            "cb": np.log(p.sum(axis=1) / p.sum()).astype(np.float32), "tb": np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32),
        }

    def step(self, tokens: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
        h = HIDDEN
        x, s = self.w["x"][tokens], state @ self.w["u"]
        gates = _sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
        r, z = gates[:, :h], gates[:, h:]
        n = np.tanh(x[:, 2 * h :] + r * s[:, 2 * h :])
        return n + z * (state - n), (tokens, state, r, z, n, s[:, 2 * h :])

    def train(self, streams: Sequence[np.ndarray], steps: int = STEPS, *, done: float = 0.0, share: float = 1.0) -> None:
        """``streams``: one row of tokens each, -1 where a text begins (the state is cleared there).  ``done`` and ``share``:
        the parts of the whole training that lie before these steps and in them; the rate falls over the whole."""
        streams = sorted(streams, key=len, reverse=True)
        if not streams or len(streams[0]) < 2:
            return
        w, state = self.w, np.zeros((len(streams), HIDDEN), np.float32)
        lengths = np.array([len(s) for s in streams])
        first = {k: np.zeros_like(a) for k, a in w.items()}
        second = {k: np.zeros_like(a) for k, a in w.items()}
        at = 0
        for k in range(1, steps + 1):
            if at + 1 >= lengths[0]:
                at, state = 0, np.zeros((len(streams), HIDDEN), np.float32)
            live = int((lengths > at + 1).sum())  # the longer streams come first
            part = np.full((live, min(WINDOW + 1, lengths[0] - at)), -1)
            for row, stream in zip(part, streams):
                piece = stream[at : at + WINDOW + 1]
                row[: len(piece)] = piece
            at += WINDOW
            state, grads = self._gradients(part, state[:live])
            rate = 0.01 * min(1.0, k / 50) * (1 - 0.9 * (done + share * k / steps)) * live / len(streams)
            for name, g in grads.items():
                np.clip(g, -1, 1, out=g)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                w[name] -= rate * (first[name] / (1 - 0.9**k)) / (np.sqrt(second[name] / (1 - 0.999**k)) + 1e-8)

    def _gradients(self, part: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, dict]:
        w, h = self.w, HIDDEN
        inputs, targets = part[:, :-1].T, part[:, 1:].T
        kept, states = [], []
        for tokens in inputs:
            state = np.where(tokens[:, None] < 0, np.float32(0), state)
            state, memory = self.step(np.maximum(tokens, 0), state)
            kept.append(memory)
            states.append(state)
        count = max(1, int((targets >= 0).sum()))
        flat, goal = np.concatenate(states), targets.ravel()
        known = goal >= 0
        goal = np.maximum(goal, 0)
        group, inner = goal // self.width, goal % self.width
        scale = (known / count).astype(np.float32)[:, None] * np.float32(len(inputs))
        rows = np.arange(len(goal))
        pc = _softmax(flat @ w["c"] + w["cb"], _bound(w["c"], w["cb"]))
        pc[rows, group] -= 1
        pc *= scale
        grads = {k: np.zeros_like(a) for k, a in w.items()}
        grads["c"], grads["cb"] = flat.T @ pc, pc.sum(axis=0)
        back = pc @ w["c"].T
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(CLASSES + 1))
        for k in range(CLASSES):
            at = order[edges[k] : edges[k + 1]]
            if len(at):
                pt = _softmax(flat[at] @ w["t"][k].T + w["tb"][k], _bound(w["t"][k].T, w["tb"][k]))
                pt[rows[: len(at)], inner[at]] -= 1
                pt *= scale[at]
                grads["t"][k], grads["tb"][k] = pt.T @ flat[at], pt.sum(axis=0)
                back[at] += pt @ w["t"][k]
        back = back.reshape(len(inputs), -1, h)
        later, entered = np.zeros_like(state), []
        for t in range(len(inputs) - 1, -1, -1):
            tokens, before, r, z, n, s = kept[t]
            d = back[t] + later
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (before - n) * z * (1 - z)
            dr = dn * s * r * (1 - r)
            gates = np.concatenate((dr, dz, dn), axis=1)
            entered.append(gates.copy())
            gates[:, 2 * h :] *= r
            grads["u"] += before.T @ gates
            later = np.where(inputs[t][:, None] < 0, np.float32(0), d * z + gates @ w["u"].T)
        tokens, gates = np.maximum(inputs[::-1].ravel(), 0), np.concatenate(entered)
        order = np.argsort(tokens, kind="stable")
        begins = np.flatnonzero(np.diff(tokens[order], prepend=-1))
        grads["x"][tokens[order[begins]]] = np.add.reduceat(gates[order], begins, axis=0)
        return state, grads

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood of each text (tokens without the end), the end included."""
        lengths = np.array([len(t) + 1 for t in texts])
        # As many streams as are filled evenly in the time that the longest text takes.
        streams = dealt(lengths, max(1, int(lengths.sum() // lengths.max())))
        steps = [int(lengths[s].sum()) for s in streams]
        order = np.argsort([-n for n in steps], kind="stable")
        steps, streams = np.array(steps)[order], [streams[k] for k in order]
        tokens = np.full((steps[0], len(streams)), -1, np.int16)  # -1 where a text begins
        goals = np.full((steps[0], len(streams)), END, np.int16)
        owners = np.zeros((steps[0], len(streams)), np.int32)
        for k, own in enumerate(streams):
            ends = np.cumsum(lengths[own])
            for text, end in zip(own, ends, strict=True):
                begin = end - lengths[text]
                tokens[begin + 1 : end, k] = goals[begin : end - 1, k] = texts[text]
                owners[begin:end, k] = text
        out, state = np.zeros(len(texts)), np.zeros((len(streams), HIDDEN), np.float32)
        live = np.searchsorted(-steps, -np.arange(1, steps[0] + 1), side="right")  # streams with so many tokens come first
        for low in range(0, int(steps[0]), WINDOW):
            states, at = [], range(low, min(low + WINDOW, int(steps[0])))
            for t in at:
                n = live[t]
                entered = tokens[t, :n]
                new = entered < 0
                if new.any():
                    state[:n][new] = 0
                    entered = np.where(new, END, entered)
                state[:n], _ = self.step(entered, state[:n])
                states.append(state[:n].copy())
            goal = np.concatenate([goals[t, : live[t]] for t in at]).astype(np.int64)
            out += np.bincount(np.concatenate([owners[t, : live[t]] for t in at]), self._of(np.concatenate(states), goal), len(texts))
        return out / math.log(10)

    def _of(self, states: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Natural logarithms of the goals' probabilities."""
        w = self.w
        group, inner = goal // self.width, goal % self.width
        logits = states @ w["c"] + w["cb"]
        out = logits[np.arange(len(goal)), group] - _log_sum(logits, _bound(w["c"], w["cb"]))
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(CLASSES + 1))
        for k in range(CLASSES):
            at = order[edges[k] : edges[k + 1]]
            if len(at):
                logits = states[at] @ w["t"][k].T + w["tb"][k]
                out[at] += logits[np.arange(len(at)), inner[at]] - _log_sum(logits, _bound(w["t"][k].T, w["tb"][k]))
        return out.astype(float)


def dealt(lengths: np.ndarray, streams: int) -> list[list[int]]:
    """Texts of these lengths in so many streams of about equal length: the longest first, each to the shortest stream."""
    out: list[list[int]] = [[] for _ in range(min(streams, len(lengths)))]
    heap = [(0, k) for k in range(len(out))]
    for text in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        out[k].append(text)
        heapq.heappush(heap, (size + int(lengths[text]), k))
    return out


def _exp(x: np.ndarray, at_most: float) -> tuple[np.ndarray, np.ndarray | float]:
    """Exponentials that don't overflow, and what was taken off before.  ``at_most`` bounds the absolute values."""
    if at_most < SAFE:
        return np.exp(x), 0.0
    top = x.max(axis=1, keepdims=True)
    return np.exp(x - top), top[:, 0]


def _softmax(x: np.ndarray, at_most: float) -> np.ndarray:
    x, _ = _exp(x, at_most)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _log_sum(x: np.ndarray, at_most: float) -> np.ndarray:
    x, top = _exp(x, at_most)
    return np.log(x.sum(axis=1)) + top


def _bound(weights: np.ndarray, bias: np.ndarray) -> float:
    """Largest absolute value that ``state @ weights + bias`` can have: the components of a state lie between -1 and 1."""
    return float((np.abs(weights).sum(axis=0) + np.abs(bias)).max())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a partition, and its ends, with how often each occurs (a word more than once, if there are very many)."""
    words, counts, ends = Words(), np.zeros(0, np.int64), 0

    def found() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.append(words.hashes, END_HASH)), pa.array(np.append(counts, ends))], names=["word", "n"])

    for batch in batches:
        for low in range(0, len(batch), PART):
            flat, lengths = words.numbers(t.as_py() for t in batch.column(0).slice(low, PART))
            more = np.bincount(flat, minlength=len(words))
            more[: len(counts)] += counts
            counts, ends = more, ends + len(lengths)
            if words.full():
                yield found()
                words, counts, ends = Words(), np.zeros(0, np.int64), 0
    yield found()


@dataclass(frozen=True)
class Frequent:
    """The most frequent words, ascending, with their counts and tokens."""

    words: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word its count, -1 where it isn't among them, and its token."""
        if not len(self.words):
            return np.full(len(words), -1), np.full(len(words), OTHER)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        found = self.words[at] == words
        return np.where(found, self.counts[at], -1), np.where(found, self.tokens[at], OTHER)


def frequent_words(counts: DataFrame, most: int = FREQUENT) -> Frequent:
    """The words above the smallest count that leaves at most ``most`` of them."""
    level = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, total = 1 << 30, 0
    for row in steps:  # at most a thousand levels
        total += row["n"]
        if total > most:
            break
        least = row["level"]
    rows = counts.where(level >= least).toArrow()
    words, n = rows["word"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(words)
    words, n = words[order], n[order]
    tokens = np.full(len(words), OTHER)
    top = np.lexsort((words, -n))[: VOCABULARY - 2]
    tokens[top] = np.arange(len(top)) + 2
    return Frequent(words, n, tokens)


def streams_of(texts: list[np.ndarray], least: int = 1) -> list[np.ndarray]:
    """Rows of whole texts (tokens), about equally long: -1, the text's tokens and the end, for each text.

    There are ``STREAMS`` of them, fewer where one pass would else have less than ``least`` updates, but not below ``FEW``.
    """
    lengths = np.array([len(t) + 2 for t in texts])
    rng = np.random.default_rng(8)
    out = []
    for own in dealt(lengths, min(STREAMS, max(FEW, int(lengths.sum()) // (WINDOW * least)))):
        # Long texts and short ones in any order.
        parts = [part for k in rng.permutation(own) for part in (np.array([-1]), texts[k], np.array([END]))]
        out.append(np.concatenate(parts).astype(np.int16))
    return out


def _tokenized(frequent: Frequent, groups: int, seed: int):
    """Per text its number, round, group and tokens."""
    names = ["number", "round", "group", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        words = Words(frequent)
        for part in (batch.slice(low, PART) for batch in batches for low in range(0, len(batch), PART)):
            words = Words(frequent) if words.full() else words
            flat, lengths = words.numbers(t.as_py() for t in part.column(0))
            tokens = [t.tobytes() for t in np.split(words.tokens[flat], np.cumsum(lengths)[:-1])]
            own = np.arange(number, number + len(part))
            number += len(part)
            draw = mixed(own.astype(np.uint64) + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15))
            columns = [own, (draw % np.uint64(ROUNDS)).astype(np.int32), ((draw >> np.uint64(8)) % np.uint64(groups)).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(tokens, pa.binary())], names=names)

    return run, "number bigint, round int, group int, tokens binary"


WEIGHTS = pa.schema([("group", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())])


def _trained(weights: dict[str, np.ndarray], turn: int, least: int):
    """Rows: group, number, tokens, in order.  Per group its tokens and their number times the weights trained on them."""

    def result(group: int, texts: list[np.ndarray]) -> pa.RecordBatch:
        network = Network(np.zeros(VOCABULARY))
        network.w = {k: a.copy() for k, a in weights.items()}
        streams = streams_of(texts, least)
        once = -(-(max(map(len, streams)) - 1) // WINDOW)
        network.train(streams, max(once, least), done=turn / ROUNDS, share=1 / ROUNDS)
        n = sum(map(len, texts)) + len(texts)
        flat = np.concatenate([a.ravel() for a in network.w.values()]).astype(float) * n
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([group], [n], [flat.tobytes()]), WEIGHTS, strict=True)], schema=WEIGHTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, texts = None, []
        for batch in batches:
            for group, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                if texts and group != last:
                    yield result(last, texts)
                    texts = []
                last = group
                texts.append(np.frombuffer(data.as_py(), np.int16))
        if texts:
            yield result(last, texts)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, total, flat = None, 0, 0.0
    for batch in batches:
        for first, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            group, total, flat = first if group is None else group, total + n, flat + np.frombuffer(data.as_py(), float)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([group], [total], [flat.tobytes()]), WEIGHTS, strict=True)], schema=WEIGHTS)


def fit(training: DataFrame, counts: DataFrame, frequent: Frequent, total: int, ends: int, seed: int = 8) -> Network:
    """A network trained on ``training`` (``doc_id``, ``text`` as bytes)."""
    tokens = np.zeros(VOCABULARY, np.int64)
    np.add.at(tokens, frequent.tokens, frequent.counts)
    tokens[END] = ends
    tokens[OTHER] = total - tokens.sum() + tokens[OTHER]
    network = Network(tokens, seed)
    if not ends:
        return network

    groups = max(1, round(total / (ROUNDS * GROUP_TOKENS)))
    sums = max(1, math.isqrt(groups))
    run, schema = _tokenized(frequent, groups, seed)
    texts = stored(training.select("text").mapInArrow(run, schema))
    ddl = "group int, n bigint, weights binary"
    for turn in range(ROUNDS):
        own = texts.where(F.col("round") == turn).select("group", "number", "tokens")
        own = own.repartition(groups, "group").sortWithinPartitions("group", "number")
        trained = own.mapInArrow(_trained(network.w, turn, -(-STEPS // ROUNDS)), ddl)
        trained = trained.repartition(sums, F.col("group") % sums).sortWithinPartitions("group").mapInArrow(_summed, ddl)
        rows = sorted(map(tuple, trained.collect()))
        n, at = sum(r[1] for r in rows), 0
        if n:
            flat = sum(np.frombuffer(r[2], float) for r in rows) / n
            for name, a in network.w.items():
                network.w[name] = flat[at : at + a.size].reshape(a.shape).astype(np.float32)
                at += a.size
    return network


def _counted(words: Words, texts: list[bytes]) -> tuple:
    """Of each text its tokens; its number of words, of frequent ones, and the logarithms of these, of words outside the
    vocabulary, and the logarithms of these; and the hashes of its other words."""
    numbers, lengths = words.numbers(texts)
    counts, tokens = words.counts[numbers], words.tokens[numbers]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    logs = np.where(counts > 0, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
    other, rare = tokens == OTHER, counts < 0

    def per(x: np.ndarray) -> np.ndarray:
        return np.bincount(owner, x, len(lengths))

    edges = np.cumsum(lengths)[:-1]
    rest = np.split(words.hashes[numbers[rare]], np.cumsum(per(rare).astype(np.int64))[:-1])
    return np.split(tokens, edges), lengths, per(counts > 0).astype(np.int64), per(logs), per(other).astype(np.int64), per(logs * other), rest


def _score(network: Network, frequent: Frequent):
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "other", "other_logs", "network", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        words = Words(frequent)
        for batch in batches:
            for low in range(0, len(batch), BATCH):
                part = batch.slice(low, BATCH)
                texts, sums, rests = [], [], []
                for at in range(0, len(part), PART):  # only tokens are kept of all texts of a batch
                    words = Words(frequent) if words.full() else words
                    own, *found, rest = _counted(words, [t.as_py() for t in part.column(2).slice(at, PART)])
                    texts += own
                    sums.append(found)
                    rests.append(rest)
                lengths, known, logs, other, other_logs = (np.concatenate(c) for c in zip(*sums, strict=True))
                rest = pa.ListArray.from_arrays(np.cumsum([0, *(len(r) for r in chain.from_iterable(rests))]).astype(np.int32), np.concatenate([r for own in rests for r in own]))
                value = network.log10(texts)
                columns = [np.arange(number, number + len(part)), part.column(0), part.column(1), lengths + 1, known, logs, other, other_logs, value, rest]
                number += len(part)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return run, "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, other bigint, other_logs double, network double, rest array<bigint>"


def score(docs: DataFrame, modulus: int = 7, residue: int = 2) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held = F.coalesce(id_residue("doc_id", modulus) == residue, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), utf8().alias("text"))
    training = rows.where("not held_out and doc_id is not null").select("doc_id", "text")
    counts = training.select("text").mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
    counts = stored(counts)
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("word") == END_HASH, F.col("n"))), F.lit(0)).alias("ends")).first()
    total, distinct, ends = sums["n"], sums["v"], sums["ends"]
    frequent = frequent_words(counts.where(F.col("word") != END_HASH))
    network = fit(training, counts, frequent, total, ends)

    run, schema = _score(network, frequent)
    parts = stored(rows.mapInArrow(run, schema))
    rest = parts.select("row", F.explode("rest").alias("word")).join(counts.where(F.col("word") != END_HASH), "word", "left")
    rest = rest.groupBy("row").agg(F.count("n").alias("rest_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))).alias("rest_logs"))
    out = parts.drop("rest").join(rest, "row", "left").fillna(0, ["rest_known", "rest_logs"])

    in_network = int(frequent.counts[frequent.tokens != OTHER].sum()) + ends
    others, kinds = total - in_network, distinct - int((frequent.tokens != OTHER).sum()) - (1 if ends else 0)
    base = math.log10(total + distinct + 1)
    share = math.log10(others + kinds + 1)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("rest_known") + F.lit(1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.col("rest_logs") + F.lit(math.log10(ends + 1)) - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("network") + F.col("other_logs") + F.col("rest_logs") - F.col("other") * F.lit(share)).alias("score"),
    )
