"""Language-model scoring with a gated recurrent network in numpy.

Word counts of all training documents are gathered through the distinct-word
tables of wordblocks; they give the unigram base and the output classes.  The
network reads word types: the ``HEAD`` most frequent words, one type per power
of two of the count that occurs for all others, one for words never seen in training;
to the type of a tail word two marks are added, rows of a table by its hash.  Its
output is factored by class: softmax over classes from the state, then softmax
over the members for classes of head words.  A tail class is factored further by
two hashes: softmax over ``GROUP`` groups, softmax over the ``GROUP`` cells of the
group, both around the smoothed counts that training words have there, so that
cells without words have no share; the words of a cell have the shares of their
counts.  So every training word has a probability of its own that follows the
context, at the cost of two small products.
The result is mixed with the base, so every text has a positive probability and
the model sums to one over the words and the unseen word.

Training is data-parallel in rounds.  Blocks are dealt to rounds by hash; in a
round every task goes through its blocks from the current weights (truncated
backpropagation over windows of ``STEPS`` words or more, state carried across them,
all training documents read in whole, gradients taken in every window) and its
weights are averaged with the others by words learned.  The
average is an aggregation by parameter; only the averaged weights (their number
is fixed by the parameters) reach the driver.

Scoring packs a block's documents into lanes, resets the state where a document
begins and carries it across windows, so a score is that of the whole text.

Defined results: a null or empty text is the end token alone; a null doc_id is
never held out; without training documents the base has probability one for the
unseen word and the model falls back to it; repeated rows are each scored (and
each trained on); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table
from cohortix.llm.langid import held_out
from cohortix.llm.wordblocks import ANSWERS, BLOCK_BYTES, answer_batch, blocks, by_bucket, joined, page_counts, page_words, rows_of, spread, spread_numbers, squeeze, unpack, unsqueeze

HEAD, CLASS, TAIL = 1023, 64, 40
#: groups of a tail class and cells of a group; rows of each of a tail word's two marks
GROUP, MARKS = 64, 1024
CELLS = GROUP * GROUP
EMBED = HIDDEN = 16
STEPS, LANES = 64, 128
ROUNDS = 2
RATE, CLIP, BASE_SHARE = 0.01, 5.0, 0.05


def _totals(pages) -> tuple[pa.Array, np.ndarray, np.ndarray, list[int]]:
    """Distinct words of a bucket, their training counts, the place among them of
    each word of the pages, and the sizes of the pages."""
    words = [pc.split_pattern(pa.array([unsqueeze(w)], pa.binary()), b"\n").flatten() for _, w, _ in pages]
    coded = pa.concat_arrays(words).dictionary_encode()
    place = coded.indices.to_numpy()
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, place, np.concatenate([page_counts(c) for _, _, c in pages]))
    return coded.dictionary, total, place, [len(w) for w in words]


def _count_words(bucket, pages):
    words, total, _, _ = _totals(pages)
    seen = total > 0
    if seen.any():
        yield pa.RecordBatch.from_arrays([words.filter(pa.array(seen)).cast(pa.string()), pa.array(total[seen])], ["word", "c"])


def _answer_counts(bucket, pages):
    """Training count of every word of a page."""
    _, total, place, sizes = _totals(pages)
    for (block, _, _), own in zip(pages, np.split(place, np.cumsum(sizes)[:-1]), strict=True):
        yield answer_batch(block, bucket, squeeze(total[own].tobytes(), 3))


class Vocabulary:
    """Types, classes and unigram probabilities.  Type 0 is the end token, then
    the head words, the tail classes, the unseen word; the start has a type of
    its own that is never predicted."""

    def __init__(self, head: list[tuple[str, int]], tail: dict[int, tuple[float, int]], ends: int, n: int, v: int, cells: np.ndarray | None = None):
        self.n, self.v, self.ends = n, v, ends
        self.z = n + 0.5 * (v + 1)
        self.index = {w.encode(): i + 1 for i, (w, _) in enumerate(head)}
        self.least = min((c for _, c in head), default=1)
        counts = np.array([ends] + [c for _, c in head], float) + 0.5
        self.n_head = len(counts)
        bins = sorted(b for b, (_, words) in tail.items() if words)
        self.place = np.zeros(TAIL, np.int64)
        self.place[bins] = np.arange(len(bins))
        self.n_types = self.n_head + len(bins) + 1
        self.start = self.n_types
        self.of_type = np.r_[np.arange(self.n_head) // CLASS, np.arange(len(bins) + 1) + (self.n_head - 1) // CLASS + 1]
        self.head_classes = (self.n_head - 1) // CLASS + 1
        self.tail_mass = np.array([tail[b][0] for b in bins])
        mass = np.r_[np.add.reduceat(counts, np.arange(0, self.n_head, CLASS)), self.tail_mass, 0.5]
        self.class_bias = np.log(np.maximum(mass, 0.5) / self.z)
        self.word_bias = np.log(counts)
        #: log shares of the groups in the smoothed counts of a tail class, and of the cells in those of a group
        mass = np.zeros((len(bins), CELLS)) if cells is None else cells[bins]
        with np.errstate(divide="ignore"):
            group = mass.reshape(-1, GROUP, GROUP).sum(2)
            self.groups = np.log(group / np.maximum(group.sum(1, keepdims=True), 0.5)).astype(np.float32)
            self.cells = np.log(mass.reshape(-1, GROUP) / np.maximum(group.reshape(-1, 1), 0.5)).astype(np.float32)
        self.cell_mass = mass

    def types(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Type and log base probability of words."""
        head = np.zeros(len(words), np.int64)
        for i in np.flatnonzero(counts >= self.least).tolist():
            head[i] = self.index.get(words[i], 0)
        bin_ = self.place[np.minimum(np.frexp(np.maximum(counts, 1))[1] - 1, TAIL - 1)]
        type_ = np.where(head > 0, head, np.where(counts > 0, self.n_head + bin_, self.n_types - 1))
        return type_, np.log((counts + 0.5) / self.z)

    def is_tail(self, type_: np.ndarray) -> np.ndarray:
        return (type_ >= self.n_head) & (type_ < self.n_types - 1)

    def tail(self, words: list[bytes], type_: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the two marks (0, no mark, if a word is not of the tail), cell,
        and log share in the cell (0 if it is not of the tail)."""
        crc = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        own = self.is_tail(type_)
        both = np.stack([1 + crc % MARKS, 1 + MARKS + crc // MARKS % MARKS], axis=1)
        share = np.zeros(len(words))
        share[own] = np.log((counts[own] + 0.5) / self.cell_mass[type_[own] - self.n_head, crc[own] % CELLS])
        return np.where(own[:, None], both, 0).astype(np.int16), (crc % CELLS).astype(np.int32), share

    @staticmethod
    def of(fields: dict) -> Vocabulary:
        """From its fields: broadcasts carry these, as executors need not have the class."""
        voc = Vocabulary.__new__(Vocabulary)
        voc.__dict__.update(fields)
        return voc


SHAPES = ("emb", "wx", "wh", "b", "wc", "bc", "ww", "bw", "mark", "wg", "wd")


def initial(voc: Vocabulary) -> dict[str, np.ndarray]:
    """Weights that start at the unigram model; fixed seed."""
    rng = np.random.default_rng(7)
    size = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    classes = len(voc.class_bias)
    return {
        "emb": (rng.standard_normal((voc.n_types + 1, EMBED)) * 0.5).astype(np.float32),
        "wx": size(EMBED, 3 * HIDDEN), "wh": size(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32),
        "wc": np.zeros((HIDDEN, classes), np.float32), "bc": voc.class_bias.astype(np.float32),
        "ww": np.zeros((voc.n_head, HIDDEN), np.float32), "bw": voc.word_bias.astype(np.float32),
        "mark": np.zeros((2 * MARKS + 1, EMBED), np.float32), "wg": np.zeros((GROUP, HIDDEN), np.float32), "wd": np.zeros((GROUP, HIDDEN), np.float32),
    }


def _read(p: dict, x: np.ndarray, marks: np.ndarray | None) -> np.ndarray:
    """Embeddings of the types read (one row a step and lane), with marks added."""
    e = p["emb"][x.ravel()]
    if marks is not None:
        for i in (0, 1):
            e += p["mark"][marks[..., i].ravel()]
    return e


def _by_row(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of every row."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(rows):
        rows = rows.astype(np.int16)
        order = np.argsort(rows, kind="stable")
        seen, first = np.unique(rows[order], return_index=True)
        out[seen] = np.add.reduceat(values[order], first, axis=0)
    return out


def _signs(p: dict) -> np.ndarray:
    """-1 for the two sigmoid gates, which are made of exp(-x), 1 for the third."""
    return np.repeat(np.array([-1, 1], p["wx"].dtype), [2 * HIDDEN, HIDDEN])


def _gates(p: dict, vectors: np.ndarray) -> np.ndarray:
    """What words with these vectors give the gates, signs of :func:`recur` included."""
    sign = _signs(p)
    return vectors @ (p["wx"] * sign) + p["b"] * sign


def recur(p: dict, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool, marks: np.ndarray | None = None, vectors: np.ndarray | None = None):
    """States after each step (steps x lanes x hidden), and what backward needs.
    With ``vectors`` rows ``x`` of them are what the words read give the gates
    (see :func:`_gates`).

    Inside, lanes run along the last axis, so that every gate is one run of memory."""
    n = HIDDEN
    sign = _signs(p)
    wh, starts = np.ascontiguousarray((p["wh"] * sign).T), fresh.any(axis=1).tolist()
    if vectors is None:
        e = _read(p, x, marks)
        read = e @ (p["wx"] * sign)
        read += p["b"] * sign
    else:
        read = vectors[x.ravel()]
    read = read.reshape(*x.shape, 3 * n)
    states, tape = np.empty((*x.shape, n), read.dtype), []
    h = np.ascontiguousarray(h.T)
    for t in range(len(x)):
        if starts[t]:
            h = np.where(fresh[t], np.float32(0), h)
        g = wh @ h
        own = np.ascontiguousarray(read[t].T)
        zr = own[: 2 * n]
        zr += g[: 2 * n]
        np.exp(zr, out=zr)
        zr += np.float32(1)
        np.reciprocal(zr, out=zr)
        z, r, gc, c = zr[:n], zr[n:], g[2 * n :], own[2 * n :]
        c += r * gc
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        if keep:
            tape.append((h, z, r, c, gc))
        h = new
        states[t] = h.T
    if keep:
        tape.append(e)
    return states, np.ascontiguousarray(h.T), tape


def _safe(x: np.ndarray, axis: int) -> np.ndarray:
    """Logits that can be exponentiated (in place).  States lie within -1 and 1 and
    biases are logs of counts, so they can, but for weights grown out of bounds."""
    if x.size and x.max() > 80:
        x -= x.max(axis=axis, keepdims=True)
    return x


def _softmax(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of row ``y`` of each column; exponentials (in place of
    ``x``) and their sums, from which the gradient is made."""
    own = _safe(x, 0)[y, np.arange(len(y))]
    np.exp(x, out=x)
    total = np.ones(len(x), x.dtype) @ x
    return own - np.log(total), x, total


def _slope(e: np.ndarray, total: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient of the negative log probability on the logits (in place)."""
    e /= total
    e[y, np.arange(len(y))] -= 1
    return e


def _level(h: np.ndarray, w: np.ndarray, prior: np.ndarray, y: np.ndarray, slope: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of ``y`` in each row under a softmax around ``prior`` (in
    place), and with ``slope`` the gradient of its negative on the logits."""
    prior += h @ w.T
    at = np.arange(len(y)), y
    own = _safe(prior, 1)[at]
    np.exp(prior, out=prior)
    total = prior @ np.ones(prior.shape[1], prior.dtype)
    if slope:
        prior *= (1 / total)[:, None]
        prior[at] -= 1
    return own - np.log(total), prior


def outputs(p: dict, voc: Vocabulary, states: np.ndarray, y: np.ndarray, grad: dict | None = None, cell: np.ndarray | None = None):
    """Natural-log probability of types ``y``, or of their cells if ``cell`` has
    that of each word of the tail; with ``grad`` also the gradient on the states."""
    given, given_y = states, y
    order = np.argsort(voc.of_type[y].astype(np.int16), kind="stable")
    h, y = states[order], y[order]
    class_ = voc.of_type[y]
    own, e, total = _softmax(p["wc"].T @ h.T + p["bc"][:, None], class_)
    log_p, slope = own.astype(np.float64), None
    if grad is not None:
        d = _slope(e, total, class_)
        grad["wc"], grad["bc"] = (d @ h).T, d @ np.ones(len(h), d.dtype)
        grad["ww"], grad["bw"] = np.zeros_like(p["ww"]), np.zeros_like(p["bw"])
        slope = d.T @ p["wc"].T
    edges = np.searchsorted(class_, np.arange(voc.head_classes + 1))
    for k in range(voc.head_classes):
        at = slice(edges[k], edges[k + 1])
        if at.start == at.stop:
            continue
        members = slice(k * CLASS, min((k + 1) * CLASS, voc.n_head))
        word = y[at] - k * CLASS
        own, e, total = _softmax(p["ww"][members] @ h[at].T + p["bw"][members, None], word)
        log_p[at] += own
        if grad is not None:
            d = _slope(e, total, word)
            grad["ww"][members], grad["bw"][members] = d @ h[at], d @ np.ones(len(word), d.dtype)
            slope[at] += d.T @ p["ww"][members]
    out, back = np.empty_like(log_p), None
    out[order] = log_p
    if grad is not None:
        back = np.empty_like(slope)
        back[order] = slope
        grad["wg"], grad["wd"] = np.zeros_like(p["wg"]), np.zeros_like(p["wd"])
    some = np.flatnonzero(voc.is_tail(given_y)) if cell is not None else ()
    if len(some):
        h, own = given[some], given_y[some] - voc.n_head
        group, inner = np.divmod(cell[some], GROUP)
        for name, prior, at in (("wg", voc.groups[own], group), ("wd", voc.cells[own * GROUP + group], inner)):
            found, d = _level(h, p[name], prior.astype(h.dtype, copy=False), at, grad is not None)
            out[some] += found
            if grad is not None:
                back[some] += d @ p[name]
                grad[name] = d.T @ h
    return out, back


def _backward(p: dict, x: np.ndarray, fresh: np.ndarray, tape: list, d_states: np.ndarray, grad: dict, marks: np.ndarray | None = None) -> None:
    n, wh = HIDDEN, p["wh"]
    d_gates = np.empty((len(x), 3 * n, x.shape[1]), d_states.dtype)
    d_states = np.ascontiguousarray(d_states.transpose(0, 2, 1))
    d_reset, starts = np.empty_like(d_states), fresh.any(axis=1).tolist()
    d_h = np.zeros_like(d_states[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, c, gc = tape[t]
        d = d_states[t]
        d += d_h
        own = d_gates[t]
        keep = d * z
        d_c = d - keep
        np.multiply(d_c, z, out=own[:n])
        own[:n] *= h - c
        d_c -= d_c * c * c
        d_r = d_c * r
        own[2 * n :] = d_r
        np.multiply(d_r, gc, out=own[n : 2 * n])
        own[n : 2 * n] *= 1 - r
        d_h = wh @ own
        d_h += keep
        if starts[t]:
            d_h = np.where(fresh[t], np.float32(0), d_h)
        d_reset[t] = d_r
        own[2 * n :] = d_c
    flat, reset, before = (np.ascontiguousarray(a.transpose(0, 2, 1)).reshape(-1, a.shape[1]) for a in (d_gates, d_reset, np.stack([t[0] for t in tape[:-1]])))
    grad["wh"] = np.concatenate([before.T @ flat[:, : 2 * n], before.T @ reset], axis=1)
    grad["wx"], grad["b"] = tape[-1].T @ flat, np.ones(len(flat), flat.dtype) @ flat
    d_read = flat @ p["wx"].T
    grad["emb"], grad["mark"] = _by_row(x.ravel(), d_read, len(p["emb"])), np.zeros_like(p["mark"])
    if marks is not None:
        some = marks[..., 0].ravel() > 0
        for i in (0, 1):
            grad["mark"] += _by_row(marks[..., i].ravel()[some], d_read[some], len(p["mark"]))


def lanes(sizes: np.ndarray, most: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """Documents packed into lanes, longest first into the shortest lane:
    matrices (step x lane) of token number and document, -1 where empty."""
    if not len(sizes) or not sizes.sum():
        return np.zeros((0, 1), np.int64), np.zeros((0, 1), np.int64)
    n = int(max(1, min(most, sizes.sum() // sizes.max())))
    heap = [(0, i) for i in range(n)]
    place = np.zeros((len(sizes), 2), np.int64)
    for d in np.argsort(-sizes, kind="stable").tolist():
        size, i = heapq.heappop(heap)
        place[d] = size, i
        heapq.heappush(heap, (size + int(sizes[d]), i))
    high = max(s for s, _ in heap)
    token, doc = np.full((high, n), -1, np.int32), np.full((high, n), -1, np.int32)
    of = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + place[of, 0]
    token[step, place[of, 1]] = np.arange(len(of))
    doc[step, place[of, 1]] = of
    return token, doc


def windows(high: int, width: int):
    """Windows of ``STEPS`` steps; longer where a few long documents leave few
    lanes, so that each holds ``STEPS * LANES`` words or nearly so."""
    steps = max(STEPS, STEPS * LANES // width)
    return (slice(at, at + steps) for at in range(0, high, steps))


def _opened(row: dict, voc: Vocabulary):
    """Tokens of a block; sizes with end tokens; of its words type, log base,
    known, marks, cell and log share in the cell."""
    words = spread(row["bucket"], [(p["bucket"], page_words(p["words"])) for p in row["pages"]])
    counts = spread_numbers(row["bucket"], [(a["bucket"], np.frombuffer(unsqueeze(a["answer"]), np.int64)) for a in row["answers"] or ()])
    type_, base = voc.types(words, counts)
    marks, cell, share = voc.tail(words, type_, counts)
    end = len(words)  # the end token comes after the block's words
    type_, marks, cell, share = np.r_[type_, 0], np.r_[marks, np.zeros((1, 2), np.int16)], np.r_[cell, np.int32(0)], np.r_[share, 0.0]
    base, known = np.r_[base, np.log((voc.ends + 0.5) / voc.z)], np.r_[counts > 0, voc.ends > 0]
    size = np.array(row["size"], np.int64)
    tokens = np.insert(unpack(unsqueeze(row["packed"])), np.cumsum(size), end)
    return tokens, size + 1, type_, base, known, marks, cell, share


def _inputs(type_of_token: np.ndarray, token: np.ndarray, doc: np.ndarray, start: int):
    """Types read and predicted at each step, and where a document begins."""
    y = np.where(token >= 0, type_of_token[token], -1).astype(np.int32)
    fresh = np.ones(doc.shape, bool)
    fresh[1:] = doc[1:] != doc[:-1]
    x = np.full(y.shape, start, np.int32)
    x[1:] = np.where(fresh[1:], start, y[:-1])
    return x, y, fresh


def _marks_read(marks: np.ndarray, words: np.ndarray, token: np.ndarray, fresh: np.ndarray, here: slice) -> np.ndarray:
    """Marks of the word read at each step of a window: that of the step before."""
    token, fresh = token[max(here.start - 1, 0) : min(here.stop, len(token)) - 1], fresh[here]
    if not here.start:
        token = np.concatenate([np.full((1, fresh.shape[1]), -1), token])
    out = marks[words[token]]
    out[fresh | (token < 0)] = 0
    return out


def learn(p: dict, voc: Vocabulary, types: np.ndarray, sizes: np.ndarray, moments: dict, words: np.ndarray, marks: np.ndarray, cell: np.ndarray) -> None:
    """One pass of truncated backpropagation over documents given as words and
    their types."""
    token, doc = lanes(sizes)
    x, y, fresh = _inputs(types, token, doc, voc.start)
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    for here in windows(*x.shape):
        read = _marks_read(marks, words, token, fresh, here)
        states, h, tape = recur(p, x[here], fresh[here], h, True, read)
        some = (y[here] >= 0).ravel()  # every step has a token in some lane
        grad: dict = {}
        own = cell[words[token[here].ravel()[some]]]
        _, back = outputs(p, voc, states.reshape(-1, HIDDEN)[some], y[here].ravel()[some], grad, own)
        d = np.zeros((some.size, HIDDEN), np.float32)
        d[some] = back
        _backward(p, x[here], fresh[here], tape, d.reshape(states.shape), grad, read)
        moments["step"] += 1
        g = np.concatenate([grad[name].ravel() for name in SHAPES])  # Adam
        g *= 1 / np.float32(some.sum())
        np.clip(g, -CLIP, CLIP, out=g)
        m, v = moments.setdefault("mean", np.zeros_like(g)), moments.setdefault("square", np.zeros_like(g))
        m *= np.float32(0.9)
        m += np.float32(0.1) * g
        g *= g
        v *= np.float32(0.99)
        v += np.float32(0.01) * g
        s, at = moments["step"], 0
        np.sqrt(v / np.float32(1 - 0.99**s), out=g)
        g += np.float32(1e-6)
        np.divide(m, g, out=g)
        g *= np.float32(RATE / (1 - 0.9**s))
        for name in SHAPES:
            p[name] -= g[at : at + p[name].size].reshape(p[name].shape)
            at += p[name].size


def log_probability(p: dict, voc: Vocabulary, tokens, sizes, type_, within, base, marks=None, cell=None) -> np.ndarray:
    """Natural-log probability of each document under the mixed model; ``within``
    is a word's log share in its ``cell``, or in its type if no cells are given."""
    token, doc = lanes(sizes)
    x, y, fresh = _inputs(type_[tokens], token, doc, voc.start)
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    total = np.zeros(len(sizes))
    new, old = np.log(1 - BASE_SHARE), np.log(BASE_SHARE)
    vectors = None
    if marks is not None:  # of each word once, and last of the start
        vectors = _gates(p, np.concatenate([_read(p, type_, marks[:, None]), p["emb"][voc.start :]]))
        before = tokens[token[:-1]]
        x[0], x[1:] = len(type_), np.where(fresh[1:] | (token[:-1] < 0), len(type_), before)
    for here in windows(*x.shape):
        states, h, _ = recur(p, x[here], fresh[here], h, False, None, vectors)
        some = (token[here] >= 0).ravel()
        own = tokens[token[here].ravel()[some]]
        got, _ = outputs(p, voc, states.reshape(-1, HIDDEN)[some], y[here].ravel()[some], None, None if cell is None else cell[own])
        mixed = np.logaddexp(new + got + within[own], old + base[own])
        total += np.bincount(doc[here].ravel()[some], weights=mixed, minlength=len(sizes))
    return total


def _trainer(voc, weights):
    """Weights after a task's blocks, one row per parameter array."""

    def run(batches):
        v, p = Vocabulary.of(voc.value), {k: w.copy() for k, w in weights.value.items()}
        moments: dict = {"step": 0}
        learned = 0
        for row in rows_of(batches):
            tokens, sizes, type_, _, _, marks, cell, _ = _opened(row, v)
            flag = np.array(row["flag"], bool)
            own = np.repeat(flag, sizes)
            if own.any():
                learn(p, v, type_[tokens[own]], sizes[flag], moments, tokens[own], marks, cell)
                learned += int(own.sum())
        if learned:
            flat = [(p[k].astype(np.float64) * learned).ravel().tolist() for k in SHAPES]
            yield pa.RecordBatch.from_arrays([pa.array(SHAPES), pa.array(flat, pa.list_(pa.float64())), pa.array([learned] * len(SHAPES), pa.int64())], ["name", "w", "n"])

    return run


def _scorer(voc, weights):
    def run(batches):
        v, p = Vocabulary.of(voc.value), weights.value
        for row in rows_of(batches):
            tokens, sizes, type_, base, known, marks, cell, share = _opened(row, v)
            first = np.cumsum(sizes) - sizes
            score = log_probability(p, v, tokens, sizes, type_, share, base, marks, cell) / np.log(10)
            columns = [
                pa.array(row["doc_id"], pa.int64()), pa.array([not f for f in row["flag"]], pa.bool_()), pa.array(sizes, pa.int64()),
                pa.array(np.add.reduceat(known[tokens].astype(np.int64), first)), pa.array(np.full(len(sizes), v.n), pa.int64()),
                pa.array(np.add.reduceat(base[tokens], first) / np.log(10)), pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def vocabulary(table_: DataFrame, buckets: int) -> Vocabulary:
    """Counts over all training documents, reduced in Spark to the head words
    and one row per cell of a tail class."""
    words = stored(by_bucket(table_, buckets, _count_words, "word string, c long"), "lm-words")
    ends = table_.select(F.sum(F.size(F.filter("flag", lambda f: f)))).first()[0] or 0
    head = [(r["word"], r["c"]) for r in words.orderBy(F.desc("c"), "word").limit(HEAD).collect()]
    bin_, cell = F.least(F.length(F.bin("c")) - 1, F.lit(TAIL - 1)), F.crc32(F.col("word").cast("binary")) % CELLS
    got = words.groupBy(bin_.alias("b"), cell.alias("cell")).agg(F.sum(F.col("c") + 0.5).alias("mass"), F.count("*").alias("n"), F.sum("c").alias("c")).toArrow()
    b, cell, mass, number, count = (got.column(k).to_numpy() for k in ("b", "cell", "mass", "n", "c"))
    n, v = ends + int(count.sum()), int(number.sum()) + (ends > 0)
    cells, left = np.zeros((TAIL, CELLS)), np.bincount(b, weights=number, minlength=TAIL)
    cells[b, cell] = mass
    for w, c in head:
        own = min(c.bit_length() - 1, TAIL - 1)
        cells[own, zlib.crc32(w.encode()) % CELLS] -= c + 0.5  # halves: nothing is left of a cell with no other word
        left[own] -= 1
    return Vocabulary(head, {i: (float(cells[i].sum()), int(left[i])) for i in range(TAIL)}, ends, n, v, cells)


def score(docs: DataFrame, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES // 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row of ``docs`` (doc_id, text, flag: train on it)."""
    sc = docs.sparkSession.sparkContext
    made, buckets = blocks(docs, True, "lm-blocks", block_bytes, level=3)
    voc = vocabulary(made, buckets)
    shared = sc.broadcast(vars(voc))
    answers = by_bucket(made, buckets, _answer_counts, ANSWERS)
    pages = F.transform("pages", lambda p: F.struct(p["bucket"].alias("bucket"), p["words"].alias("words")))
    rows = stored(joined(made.withColumn("pages", pages), answers), "lm-counted")
    weights = initial(voc)
    shape = {k: w.shape for k, w in weights.items()}
    for i in range(rounds if voc.ends else 0):
        part = rows.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == i)
        got = part.mapInArrow(_trainer(shared, sc.broadcast(weights)), "name string, w array<double>, n long")
        got = got.select("name", F.posexplode("w").alias("i", "w"), "n").groupBy("name", "i").agg((F.sum("w") / F.sum("n")).alias("w"))
        mean = got.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("w")).collect()
        for r in mean:
            weights[r["name"]] = np.array([x["w"] for x in r["w"]], np.float32).reshape(shape[r["name"]])
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.mapInArrow(_scorer(shared, sc.broadcast(weights)), schema)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text", (~held_out(F.col("doc_id"), 5)).alias("flag")))
