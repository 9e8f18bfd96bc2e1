from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

import marketloom.llm.gru_model as gm
from tests.llm.rows import documents, frame


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    monkeypatch.setattr(gm, "STEPS", 40)
    monkeypatch.setattr(gm.Network.train, "__defaults__", (40,))


def brute(rows):
    """Tokens, known tokens and base score of each row, and the training tokens."""
    split = [((t or "").encode().lower().split(), i) for i, t in rows]
    counts, ends = Counter(), 0
    for words, i in split:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + bool(ends)
    out = []
    for words, i in split:
        c = [counts[w] for w in words] + [ends]
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        out.append((i, held, len(c), sum(x > 0 for x in c), total, sum(math.log10((x + 1) / (total + kinds + 1)) for x in c)))
    return sorted(out, key=repr)


def compare(got, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    for a, b in zip(got, brute(rows), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)


@pytest.mark.parametrize("frequent", [1 << 17, 20])
def test_counts_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(gm.frequent_words, "__defaults__", (frequent,))  # the small one sends most words to the join
    rows = [(k, " ".join(f"w{(k * 31 + j * j) % (7 + j)}" for j in range(k % 50))) for k in range(120)]
    out = gm.score(documents(spark, rows)).collect()
    compare(out, rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_odd_rows(spark):
    table = frame(spark)
    compare(gm.score(table).collect(), [(r.doc_id, r.text) for r in table.collect()])


def test_empty_table_and_no_training_rows(spark):
    assert gm.score(frame(spark, [])).collect() == []
    rows = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    compare(gm.score(documents(spark, rows)).collect(), rows)


def network(seed=3):
    rng = np.random.default_rng(seed)
    return gm.Network(rng.integers(0, 100, gm.VOCABULARY), seed), rng


def test_probabilities_sum_to_one():
    net, rng = network()
    state = rng.normal(size=(1, gm.HIDDEN)).astype(np.float32)
    every = net._of(np.repeat(state, gm.VOCABULARY, axis=0), np.arange(gm.VOCABULARY))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows():
    net, rng = network()
    texts = [rng.integers(2, 300, n) for n in (0, 1, gm.WINDOW - 1, gm.WINDOW, 3 * gm.WINDOW + 5, 200)]
    for text, got in zip(texts, net.log10(texts), strict=True):
        state, total = np.zeros((1, gm.HIDDEN), np.float32), 0.0
        for before, token in zip([gm.END, *text], [*text, gm.END], strict=True):
            state, _ = net.step(np.array([before]), state)
            total += net._of(state, np.array([token]))[0]
        assert got == pytest.approx(total / math.log(10), abs=1e-3)


def test_gradients():
    net, rng = network()
    net.w = {k: a.astype(np.float64) for k, a in net.w.items()}
    part = rng.integers(2, 60, (3, 6))
    part[1, 2] = -1
    zero = np.zeros((3, gm.HIDDEN))

    def loss():
        state, total = zero, 0.0
        for t in range(5):
            state = np.where(part[:, t : t + 1] < 0, 0, state)
            state, _ = net.step(np.maximum(part[:, t], 0), state)
            known = part[:, t + 1] >= 0
            total -= net._of(state, np.maximum(part[:, t + 1], 0))[known].sum()
        return total

    _, grads = net._gradients(part, zero)
    scale = 5 / (part[:, 1:] >= 0).sum()
    for name, at in (("u", (3, 5)), ("u", (2, 40)), ("u", (1, 60)), ("x", (int(part[0, 0]), 50)), ("c", (4, 1)), ("cb", (1,)), ("t", (int(part[0, 1]) // net.width, int(part[0, 1]) % net.width, 7))):
        step = 1e-5
        net.w[name][at] += step
        high = loss()
        net.w[name][at] -= 2 * step
        low = loss()
        net.w[name][at] += step
        assert grads[name][at] == pytest.approx(scale * (high - low) / (2 * step), rel=2e-2, abs=1e-6)


def test_training_beats_counts():
    """A language that alternates between two sets of words is learned."""
    rng = np.random.default_rng(1)
    streams = np.stack([np.where(np.arange(2000) % 2 == 0, rng.integers(2, 20, 2000), rng.integers(40, 60, 2000)) for _ in range(8)])
    counts = np.bincount(streams.ravel(), minlength=gm.VOCABULARY)
    net = gm.Network(counts)
    texts = [s[:100] for s in streams]
    before = net.log10(texts).mean()
    net.train(streams, 80)
    assert net.log10(texts).mean() > before + 10


def test_streams_hold_whole_texts():
    """Each text stands in one stream, to its last token, and is followed by the end there only."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(2, 900, n) for n in (3000, 1, 0, *rng.integers(0, 900, 200))]
    flat = np.concatenate(gm.streams_of(texts))
    found = np.split(flat, np.flatnonzero(flat == -1))[1:]
    assert len(found) == len(texts) and (flat == gm.END).sum() == len(texts)
    assert sorted(f[1:-1].tolist() for f in found) == sorted(t.tolist() for t in texts)


@pytest.mark.parametrize("group_tokens", [1 << 20, 20_000])
def test_what_follows_word_400_is_learned(spark, monkeypatch, group_tokens):
    """Late words come in a fixed order, so a network that has seen them scores them far better than their counts."""
    monkeypatch.setattr(gm, "GROUP_TOKENS", group_tokens)  # the small one trains several groups a round
    rng = np.random.default_rng(6)
    late = [f"late{k % 20}" for k in range(800)]
    rows = [(k, " ".join([f"w{x}" for x in rng.integers(0, 20, 400)] + late)) for k in range(300)]
    out = gm.score(documents(spark, rows)).collect()
    gain = np.mean([r.score - r.base_score for r in out])
    assert gain > 0.3 * 800


def side_by_side(net, texts):
    """Texts scored from their beginnings at once, sorted by length: how scores are defined, however texts are dealt."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    out, state = np.zeros(len(texts)), np.zeros((len(texts), gm.HIDDEN), np.float32)
    for t in range(len(texts[order[0]]) + 1):
        live = [k for k in order if len(texts[k]) >= t]
        state, _ = net.step(np.array([texts[k][t - 1] if t else gm.END for k in live]), state[: len(live)])
        out[live] += net._of(state, np.array([texts[k][t] if t < len(texts[k]) else gm.END for k in live]))
    return out / math.log(10)


def test_streams_score_like_texts_side_by_side():
    net, rng = network()
    net.train(gm.streams_of([rng.integers(2, 300, 200) for _ in range(20)]), 30)
    texts = [rng.integers(2, 300, n) for n in (0, 700, 0, 1, 33, *rng.integers(0, 120, 150))]
    assert np.allclose(net.log10(texts), side_by_side(net, texts), rtol=1e-5, atol=1e-5)
    assert np.allclose(net.log10(texts[1:2]), side_by_side(net, texts[1:2]), rtol=1e-5, atol=1e-5)


def test_streams_are_balanced():
    rng = np.random.default_rng(7)
    lengths = np.concatenate(([5000], rng.integers(1, 400, 2000)))
    sums = [lengths[own].sum() for own in gm.dealt(lengths, int(lengths.sum() // 5000))]
    assert sorted(k for own in gm.dealt(lengths, 7) for k in own) == list(range(len(lengths)))
    assert max(sums) <= 1.05 * min(sums) and max(sums) <= 1.05 * 5000
