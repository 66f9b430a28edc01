"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans.  The field adds spans that they miss, such as
a number beside which another one stands, so that a pattern takes both and then
fails its check.

Nodes are the tokens (runs without ASCII white space) that hold a digit, ``@`` or
``+``; labels are none, and begin and inside of every kind.  Three sorts of
potentials: of a node by its features, of neighbouring nodes by the gap between
them, and of *skip* pairs: a token and its last earlier occurrence in the
document, however distant, where tokens count as the same if their letters and
digits agree (their digits alone, if they have four or more).  A group of m such
tokens has m - 1 pairs, not all pairs.  Sum-product messages run over all edges
for a fixed number of rounds, so that labels of one entity agree across the
document.  A node has four edges at most, so a round is a few products of (nodes
x labels) with (labels x labels) for a whole batch of documents.

The field learns from base spans by the gradient of the loopy likelihood, on at
most ``SAMPLE`` distinct texts (those with the smallest hashes) and ``NODES``
tokens of them: the documented bound on fitting.  Texts in which numbers stand
beside each other are not learnt from, as the base spans miss them.  Everything else covers whole
texts of all rows.  The model is a few kilobytes; no text is shuffled but those
of the sample.

Defined results: a null text is empty; without nodes, or without any text to
learn from, there are only base spans; added spans never overlap base spans;
repeated rows are all returned; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import table

#: Fixed values of the contract: kinds in their order
KINDS = ("email", "ip", "card", "phone")
#: distinct texts and tokens the field is fitted on
SAMPLE, NODES = 4000, 10_000
#: steps of fitting, rounds of messages while fitting and after
STEPS, FIT_ROUNDS, ROUNDS = 60, 6, 12
#: least probability of the kind for every token of an added span
SURE = 0.5
#: tokens that are worked on at once
BATCH = 1 << 15

LABELS = 1 + 2 * len(KINDS)
#: kind of a label: 0 is none
KIND_OF = np.r_[0, np.repeat(np.arange(1, len(KINDS) + 1), 2)]
GAPS = 3

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# within a run of digits no later start can match what the first one cannot
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9@+][^\x20\x09-\x0D]*")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_NO_DIGIT = re.compile(r"[^0-9]+")
_NO_WORD = re.compile(r"[^a-z0-9]+")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_EMAIL_SHAPE = re.compile(r"[^@]+@[^@.]+(?:\.[^@.]+)+")
_SHAPE = [(re.compile(r"[a-zA-Z]+"), "a"), (re.compile(r"[0-9]"), "d"), (re.compile(r"[^\x00-\x7f]+"), "u"), (re.compile(r"d{9,}"), "D")]
_CUES = {w: i for i, ws in enumerate((("phone", "tel", "call", "mobile", "fax"), ("email", "mail", "e-mail"), ("ip", "host", "address"), ("card", "visa", "credit")), 1) for w in ws}
_DIGIT_BUCKETS = np.array([1, 2, 3, 4, 5, 7, 10, 12, 16, 17, 20])
#: sizes of the feature groups; a token has one feature of each
GROUPS = (len(_DIGIT_BUCKETS) + 1, 3, 4, 3, 6, 128, 5)
OFFSETS = tuple(int(x) for x in np.cumsum((0, *GROUPS))[:-1])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str):
    lo, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > lo and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            lo = domain.end()
        at = text.find("@", max(at + 1, lo))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the patterns, in order."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def run_together(text: str) -> bool:
    """Whether a match holds more digits than its kind can have: several numbers
    beside each other, of which the patterns tell nothing."""
    count = lambda m: len(_NO_DIGIT.sub("", m[0]))
    return any(count(m) > 19 for m in _CARD.finditer(text)) or any(count(m) > 15 for m in _PHONE.finditer(text))


def features(token: str) -> tuple[int, ...]:
    """One feature of each group but the last (the word before)."""
    core = token.strip(".,;:!?\"'|<>[]{}")
    digits = _NO_DIGIT.sub("", core)
    n = len(digits)
    at = 0 if "@" not in core else 1 if _EMAIL_SHAPE.fullmatch(core) else 2
    parts = core.split(".")
    quad = 3 if len(parts) > 4 else 0
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        quad = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else 2
    card = 0 if not 12 <= n <= 19 or core.replace("-", "") != digits else 1 if luhn(digits) else 2
    first = core[:1]
    head = 0 if first.isdigit() else 1 if first == "+" else 2 if first == "(" else 3 if first.isalpha() else 4 if first == "@" else 5
    shape = core[:64]
    for pattern, mark in _SHAPE:
        shape = pattern.sub(mark, shape)
    own = (int(np.searchsorted(_DIGIT_BUCKETS, n, "right")), at, quad, card, head, zlib.crc32(shape.encode()) % GROUPS[5])
    return tuple(o + x for o, x in zip(OFFSETS, own, strict=False))


def same_key(token: str) -> str | None:
    """Tokens with one key are taken for the same entity."""
    digits = _NO_DIGIT.sub("", token)
    if len(digits) >= 4:
        return digits
    word = _NO_WORD.sub("", token.lower())
    return word if len(word) >= 4 else None


class Nodes:
    """The nodes of documents, one after the other: features, gap to the node
    before (-1 at the start of a document), places of the skip pairs."""

    def __init__(self):
        self.feats, self.gap, self.skip, self.at, self.known = [], [], [], [], {}

    def add(self, text: str, most: int | None = None) -> tuple[int, int]:
        first, last, end = len(self.feats), {}, -1
        for m in _TOKEN.finditer(text):
            start, stop = m.span()
            while start and text[start - 1] not in _SPACE:
                start -= 1
            token = text[start:stop]
            known = self.known.get(token)
            if known is None:
                known = features(token), same_key(token)
                if len(self.known) < 100_000:
                    self.known[token] = known
            feats, key = known
            before = _WORDS.findall(text[max(0, start - 20) : start])
            cue = _CUES.get(before[-1].lower().strip(":.,"), 0) if before else 0
            here = len(self.feats)
            if end < 0:
                gap = -1
            elif start - end > 64:
                gap = GAPS - 1
            else:
                gap = min(len(_WORDS.findall(text[end:start])), GAPS - 1)
            self.feats.append((*feats, OFFSETS[6] + cue))
            self.gap.append(gap)
            self.skip.append(last.get(key, -1) if key else -1)
            self.at.append((start, stop))
            if key:
                last[key] = here
            end = stop
            if most and here + 1 - first >= most:
                break
        return first, len(self.feats)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feats, np.int32).reshape(-1, len(GROUPS)), np.array(self.gap, np.int8), np.array(self.skip, np.int64)


def labels_of(at: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Label of every token by the first span that touches it."""
    out, i = [], 0
    ends = np.maximum.accumulate([e for _, _, e in spans]) if spans else []
    for start, stop in at:
        while i < len(spans) and ends[i] <= start:
            i += 1
        own = next((s for s in spans[i : i + 8] if s[0] < stop and s[2] > start), None)
        out.append(0 if own is None else 1 + 2 * own[1] + (own[0] < start))
    return out


def _sent(x: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Log messages that leave nodes with log beliefs ``x``, scaled to a largest of 0."""
    y = np.log(np.exp(x - x.max(1, keepdims=True)) @ potential + 1e-30)
    return y - y.max(1, keepdims=True)


class Field:
    """Messages of the field over a batch of documents.

    fc, bc: messages into a node along the chain from before and from behind;
    fs, bs: along the skip pair to its earlier and to its later occurrence.
    """

    def __init__(self, weights: tuple, feats: np.ndarray, gap: np.ndarray, skip: np.ndarray):
        unary, chain, agree = weights
        self.u = unary[feats].sum(axis=1)
        self.chain = np.exp(chain)
        self.agree = np.exp(np.where(KIND_OF[:, None] == KIND_OF[None, :], agree[KIND_OF][:, None], 0.0))
        self.by_gap = [np.flatnonzero(gap == g) for g in range(GAPS)]
        self.later = np.flatnonzero(skip >= 0)
        self.earlier = skip[self.later]
        self.fc, self.bc, self.fs, self.bs = (np.zeros_like(self.u) for _ in range(4))

    def beliefs(self) -> np.ndarray:
        return self.u + self.fc + self.bc + self.fs + self.bs

    def run(self, rounds: int) -> Field:
        for _ in range(rounds):
            b = self.beliefs()
            forth, back, early, late = b - self.bc, b - self.fc, b - self.bs, b - self.fs
            for g, to in enumerate(self.by_gap):
                if len(to):
                    self.fc[to] = _sent(forth[to - 1], self.chain[g])
                    self.bc[to - 1] = _sent(back[to], self.chain[g].T)
            if len(self.later):
                # damped, since these edges close loops
                self.fs[self.later] = 0.5 * self.fs[self.later] + 0.5 * _sent(early[self.earlier], self.agree)
                self.bs[self.earlier] = 0.5 * self.bs[self.earlier] + 0.5 * _sent(late[self.later], self.agree)
        return self

    def marginals(self) -> np.ndarray:
        b = self.beliefs()
        p = np.exp(b - b.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def pairs(self, a: np.ndarray, b: np.ndarray, potential: np.ndarray) -> np.ndarray:
        """Sum over edges of the joint probability of their two labels."""
        total = np.zeros((LABELS, LABELS))
        for at in range(0, len(a), BATCH):
            x, y = a[at : at + BATCH], b[at : at + BATCH]
            p = np.exp(x - x.max(1, keepdims=True))[:, :, None] * potential * np.exp(y - y.max(1, keepdims=True))[:, None, :]
            total += (p / p.sum((1, 2), keepdims=True)).sum(0)
        return total

    def expected(self) -> tuple[np.ndarray, np.ndarray]:
        """Expected label pairs on chain edges by gap, and on skip pairs."""
        b = self.beliefs()
        chain = np.stack([self.pairs((b - self.bc)[to - 1], (b - self.fc)[to], self.chain[g]) for g, to in enumerate(self.by_gap)])
        return chain, self.pairs((b - self.bs)[self.earlier], (b - self.fs)[self.later], self.agree)


def nothing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros((sum(GROUPS), LABELS)), np.zeros((GAPS, LABELS, LABELS)), np.zeros(len(KINDS) + 1)


def _counted(feats: np.ndarray, p: np.ndarray) -> np.ndarray:
    out = np.zeros((sum(GROUPS), LABELS))
    for k in range(feats.shape[1]):
        for c in range(LABELS):
            out[:, c] += np.bincount(feats[:, k], p[:, c], minlength=len(out))
    return out


def _by_kind(pairs: np.ndarray) -> np.ndarray:
    return np.array([pairs[np.ix_(KIND_OF == k, KIND_OF == k)].sum() for k in range(len(KINDS) + 1)])


def gradient(weights: tuple, feats, gap, skip, labels, rounds: int = FIT_ROUNDS) -> tuple:
    """Of the loopy log-likelihood: observed less expected counts."""
    field = Field(weights, feats, gap, skip).run(rounds)
    seen = np.eye(LABELS)[labels]
    chain, pair = field.expected()
    observed = np.zeros_like(chain)
    for g, to in enumerate(field.by_gap):
        np.add.at(observed[g], (labels[to - 1], labels[to]), 1.0)
    agreed = np.zeros_like(pair)
    np.add.at(agreed, (labels[field.earlier], labels[field.later]), 1.0)
    return _counted(feats, seen - field.marginals()), observed - chain, _by_kind(agreed) - _by_kind(pair)


def learn(feats, gap, skip, labels, steps: int = STEPS, decay: float = 0.05) -> tuple:
    """Weights after ``steps`` of gradient ascent with a rate for each weight."""
    weights = nothing()
    size = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(steps):
        for w, g, s in zip(weights, gradient(weights, feats, gap, skip, labels), size, strict=True):
            g = g - decay * w
            s += g * g
            w += 0.5 * g / np.sqrt(s)
    return weights


_TRAIN = "h long, feats binary, gap binary, skip binary, labels binary"


def _training(most: int):
    def run(batches):
        for batch in batches:
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if run_together(text):
                    continue
                nodes = Nodes()
                nodes.add(text, most)
                feats, gap, skip = nodes.arrays()
                labels = np.array(labels_of(nodes.at, base_spans(text)), np.int8)
                data = [[h], [feats.tobytes()], [gap.tobytes()], [skip.tobytes()], [labels.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(data)], [c.split()[0] for c in _TRAIN.split(", ")])

    return run


def fit(docs: DataFrame, sample: int = SAMPLE, nodes: int = NODES) -> tuple:
    """Weights learnt from the base spans of at most ``sample`` distinct texts of
    ``docs`` (text) and ``nodes`` tokens, no more than a hundredth of them from
    one text."""
    texts = docs.select("text", F.xxhash64("text").alias("h")).where(F.col("text").rlike("[0-9@+]"))
    top = texts.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if top is None:
        return nothing()
    chosen = texts.where(F.col("h") <= top).groupBy("h").agg(F.min("text").alias("text"))
    got, total = [], 0
    for r in sorted(chosen.mapInArrow(_training(max(1, nodes // 100)), _TRAIN).collect(), key=lambda r: r["h"]):
        gap = np.frombuffer(r["gap"], np.int8)
        if total + len(gap) > nodes:
            break
        skip = np.frombuffer(r["skip"], np.int64)
        got.append((np.frombuffer(r["feats"], np.int32).reshape(-1, len(GROUPS)), gap, np.where(skip >= 0, skip + total, -1), np.frombuffer(r["labels"], np.int8)))
        total += len(gap)
    if not total:
        return nothing()
    feats, gap, skip, labels = (np.concatenate(c) for c in zip(*got, strict=True))
    return learn(feats, gap, skip, labels.astype(np.int64))


def _edges(text: str, start: int, stop: int) -> tuple[int, int]:
    """A span without the punctuation around it."""
    while start < stop and not (text[start] in "+(" or text[start].isalnum()):
        start += 1
    while stop > start and not (text[stop - 1] == ")" or text[stop - 1].isalnum()):
        stop -= 1
    return start, stop


def added_spans(text: str, base: list, at: list[tuple[int, int]], gap: np.ndarray, p: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of tokens that the field labels as one entity, apart from base spans."""
    label = p.argmax(1)
    sure = p @ (KIND_OF[:, None] == np.arange(len(KINDS) + 1)[None, :]) >= SURE
    out, i = [], 0
    while i < len(at):
        kind = int(KIND_OF[label[i]])
        if not kind or not sure[i, kind]:
            i += 1
            continue
        j = i + 1
        while j < len(at) and label[j] == 2 * kind and sure[j, kind] and gap[j] < GAPS - 1:
            j += 1
        start, stop = _edges(text, at[i][0], at[j - 1][1])
        if start < stop and not any(s < stop and e > start for s, _, e in base):
            out.append((start, kind - 1, stop))
        i = j
    return out


_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
_OUT = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"


def _finder(model):
    def flush(held, nodes):
        feats, gap, skip = nodes.arrays()
        p = Field(model.value, feats, gap, skip).run(ROUNDS).marginals() if len(gap) else np.zeros((0, LABELS))
        ids, spans = [], []
        for doc, text, base, lo, hi in held:
            more = added_spans(text, base, nodes.at[lo:hi], gap[lo:hi], p[lo:hi]) if hi > lo and model.value[0].any() else []
            ids.append(doc)
            spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": own} for s, k, e, own in sorted([(*x, True) for x in base] + [(*x, False) for x in more])])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, pa.list_(_FOUND))], ["doc_id", "spans"])

    def run(batches):
        known = {}
        for batch in batches:
            held, nodes = [], Nodes()
            nodes.known = known
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.append((doc, text, base_spans(text), *nodes.add(text)))
                if len(nodes.gap) >= BATCH:
                    yield flush(held, nodes)
                    held, nodes = [], Nodes()
                    nodes.known = known
            if held:
                yield flush(held, nodes)

    return run


def find(docs: DataFrame, weights: tuple | None = None) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, whether of a pattern) of
    every row of ``docs`` (doc_id, text); ``weights`` of ``fit``, learnt from
    ``docs`` if not given."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs) if weights is None else weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_finder(model), _OUT)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[of(k) for k in KINDS], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
