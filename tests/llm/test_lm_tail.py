"""Words beyond the head: predicted and read by their hashes, and by context."""

import zlib

import numpy as np
import pytest

from cohortix.llm import lm

TAIL = [(f"t{i}", 1 + i % 9) for i in range(3000)] + [("a" * 300, 4), ("zürich", 4)]


def tail_model():
    cells, bins = np.zeros((lm.TAIL, lm.CELLS)), {}
    for w, c in TAIL:
        b = c.bit_length() - 1
        cells[b, zlib.crc32(w.encode()) % lm.CELLS] += c + 0.5
        bins[b] = (cells[b].sum(), bins.get(b, (0, 0))[1] + 1)
    head = [(f"w{i}", 100 - i) for i in range(60)]
    n = 20 + sum(c for _, c in head + TAIL)
    voc = lm.Vocabulary(head, bins, 20, n, 61 + len(TAIL), cells)
    rng = np.random.default_rng(1)
    return voc, {k: (w + rng.standard_normal(w.shape) * 0.3).astype(np.float64) for k, w in lm.initial(voc).items()}, rng


def opened(voc):
    words, counts = [w.encode() for w, _ in TAIL], np.array([c for _, c in TAIL])
    type_, _ = voc.types(words, counts)
    return type_, *voc.tail(words, type_, counts)


def log_p(p, voc, h, type_, cell, share):
    return lm.outputs(p, voc, np.repeat(h[None], len(type_), 0), type_, None, cell)[0] + share


def test_tail_words_sum_to_one_and_follow_the_context():
    voc, p, rng = tail_model()
    type_, _, cell, share = opened(voc)
    single = np.r_[np.arange(voc.n_head), voc.n_types - 1]
    seen = []
    for h in rng.standard_normal((2, lm.HIDDEN)):
        alone, _ = lm.outputs(p, voc, np.repeat(h[None], len(single), 0), single)
        seen.append(log_p(p, voc, h, type_, cell, share))
        assert np.exp(alone).sum() + np.exp(seen[-1]).sum() == pytest.approx(1.0, abs=1e-5)
    lift = seen[1] - seen[0]
    for t in np.unique(type_):  # words of different cells are moved differently
        assert len(np.unique(lift[type_ == t].round(9))) == len(np.unique(cell[type_ == t])) > 100


def test_untrained_tail_words_have_their_share_of_the_counts():
    voc, _, _ = tail_model()
    type_, _, cell, share = opened(voc)
    got = log_p(lm.initial(voc), voc, np.zeros(lm.HIDDEN, np.float32), type_, cell, share)
    assert got == pytest.approx(np.log((np.array([c for _, c in TAIL]) + 0.5) / voc.z), abs=0.02)


def test_fields_of_a_vocabulary_make_an_equal_one():
    voc, p, rng = tail_model()
    again = lm.Vocabulary.of(dict(vars(voc)))
    type_, marks, cell, share = opened(voc)
    for a, b in zip(opened(again), (type_, marks, cell, share), strict=True):
        assert np.array_equal(a, b)


def test_tail_gradient():
    voc, p, rng = tail_model()
    type_, marks, cell, _ = opened(voc)
    own, sizes = rng.integers(0, len(type_), 16), np.array([7, 4, 5])
    token, doc = lm.lanes(sizes, 2)
    x, y, fresh = lm._inputs(type_[own], token, doc, voc.start)
    read = lm._marks_read(marks, own, token, fresh, slice(0, 99))
    some = (y >= 0).ravel()
    cells = cell[own[token.ravel()[some]]]

    def loss(q, grad=None):
        states, _, tape = lm.recur(q, x, fresh, np.zeros((x.shape[1], lm.HIDDEN)), True, read)
        got, back = lm.outputs(q, voc, states.reshape(-1, lm.HIDDEN)[some], y.ravel()[some], grad, cells)
        if grad is not None:
            d = np.zeros((some.size, lm.HIDDEN))
            d[some] = back
            lm._backward(q, x, fresh, tape, d.reshape(states.shape), grad, read)
        return -got.sum()

    grad = {}
    loss(p, grad)
    for name in lm.SHAPES:
        big = np.unravel_index(np.abs(grad[name]).argmax(), p[name].shape)
        up, down = {**p, name: p[name].copy()}, {**p, name: p[name].copy()}
        up[name][big] += 1e-2
        down[name][big] -= 1e-2
        assert grad[name][big] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.02, abs=1e-3)
    assert min(np.abs(grad[k]).max() for k in ("wg", "wd", "mark")) > 0
