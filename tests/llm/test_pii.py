"""Personal data: patterns against plain regular expressions, the field against
exact enumeration, agreement of distant tokens, edge cases."""

import itertools
import random
import re
import time

import numpy as np
import pytest

pytest.importorskip("cohortix.llm")

from cohortix.llm import pii  # noqa: E402


def plain_patterns(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = digits(m)
        if 12 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_patterns_against_plain_regular_expressions():
    rng = random.Random(7)
    for alphabet in ("12a@.+- (0", "0123456789 -", "a@.b", "12.5", "+1 ().-23456"):
        for _ in range(6000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert pii.base_spans(t) == plain_patterns(t), t


def test_patterns_take_linear_time_on_long_runs():
    start = time.time()
    for t in ("x" * 2_000_000, "1" * 1_000_000, "1." * 500_000, "a@" * 500_000, "+1" * 500_000, "1 " * 500_000):
        pii.base_spans(t)
        pii.Nodes().add(t)
    assert time.time() - start < 60


def random_weights(rng, size):
    return tuple(size * rng.normal(size=w.shape) for w in pii.nothing())


def exact(weights, feats, gap, skip):
    """Marginals and log partition of a tiny document by enumeration."""
    unary, chain, agree = weights
    n = len(gap)
    u = unary[feats].sum(1)
    scores, states = [], list(itertools.product(range(pii.LABELS), repeat=n))
    for y in states:
        s = sum(u[i, y[i]] for i in range(n)) + sum(chain[gap[i], y[i - 1], y[i]] for i in range(1, n) if gap[i] >= 0)
        s += sum(agree[pii.KIND_OF[y[i]]] for i in range(n) if skip[i] >= 0 and pii.KIND_OF[y[i]] == pii.KIND_OF[y[skip[i]]])
        scores.append(s)
    scores = np.array(scores)
    top = scores.max()
    p = np.exp(scores - top)
    marg = np.zeros((n, pii.LABELS))
    for y, q in zip(states, p / p.sum(), strict=True):
        for i in range(n):
            marg[i, y[i]] += q
    return marg, top + np.log(p.sum())


def tiny(rng, gap, skip):
    feats = np.array([[o + rng.integers(g) for o, g in zip(pii.OFFSETS, pii.GROUPS, strict=True)] for _ in gap], np.int32)
    return feats, np.array(gap, np.int8), np.array(skip, np.int64)


def test_messages_are_exact_without_loops_and_close_with_them():
    rng = np.random.default_rng(2)
    w = random_weights(rng, 0.7)
    # a chain of two, and a skip pair into a second chain
    given = tiny(rng, [-1, 0, -1, 2], [-1, -1, 1, -1])
    assert np.abs(pii.Field(w, *given).run(80).marginals() - exact(w, *given)[0]).max() < 1e-6
    given = tiny(rng, [-1, 1, 0, 2], [-1, -1, -1, 0])
    assert np.abs(pii.Field(w, *given).run(80).marginals() - exact(w, *given)[0]).max() < 0.15


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(3)
    w = random_weights(rng, 0.3)
    given = tiny(rng, [-1, 0, -1, 1], [-1, -1, 1, -1])
    labels = np.array([1, 2, 1, 0])
    unary, chain, agree = pii.gradient(w, *given, labels, rounds=80)

    def likelihood(weights):
        u, c, a = weights
        s = sum(u[given[0][i], labels[i]].sum() for i in range(4)) + c[0, 1, 2] + c[1, 1, 0] + a[pii.KIND_OF[2]] * (pii.KIND_OF[2] == pii.KIND_OF[1])
        return s - exact(weights, *given)[1]

    for part, (g, at) in enumerate(((unary, (given[0][1, 0], 2)), (chain, (0, 1, 2)), (chain, (1, 0, 0)), (agree, (1,)))):
        k = (0, 1, 1, 2)[part]
        up, down = [x.copy() for x in w], [x.copy() for x in w]
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        assert abs((likelihood(up) - likelihood(down)) / 2e-4 - g[at]) < 1e-5


def card(rng):
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(body + str(k) for k in range(10) if pii.luhn(body + str(k)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    things = {
        "phone": lambda: f"+1 ({rng.randrange(100, 1000)}) 555-{rng.randrange(1000, 9999)}", "card": lambda: card(rng),
        "ip": lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)), "email": lambda: f"{word()}@{word()}.example.com",
        "none": lambda: rng.choice([str(rng.randrange(1990, 2030)), "4.0.", "3.", str(rng.randrange(10**7))]),
    }
    rows = [(i, " ".join([word(), word(), things[k](), word(), word(), things["none"](), word()])) for i, k in enumerate(list(things) * 60)]
    return rows, things, rng


def test_field_finds_what_patterns_miss_and_leaves_clean_texts(spark, corpus):
    rows, things, rng = corpus
    missed = []
    for i in range(20):
        a, b = things["phone"](), things["card"]()
        missed.append((1000 + i, f"abc def {a} {b} ghi", {a, b}))
    clean = [(2000 + i, f"chapter {i} of 20{i:02d} has {i * 37} rows, version {i}.0. abc") for i in range(20)]
    df = spark.createDataFrame(rows + [m[:2] for m in missed] + clean, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(df).collect()}
    texts = dict(rows + [m[:2] for m in missed] + clean)
    found = sum({texts[i][s["start"] : s["end"]] for s in got[i]} == want for i, _, want in missed)
    assert found >= 18
    assert not any(got[i] for i, _ in clean)
    for i, t in texts.items():
        assert [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in got[i] if s["base"]] == pii.base_spans(t)


def test_distant_same_tokens_agree():
    """A token that says little takes the label of its occurrence far away."""
    nodes = pii.Nodes()
    nodes.add("5551234567 " + "word " * 500 + "x5551234567")
    feats, gap, skip = nodes.arrays()
    assert skip.tolist() == [-1, 0] and gap.tolist() == [-1, 2]
    unary, chain, agree = pii.nothing()
    unary[sorted(set(feats[0].tolist()) - set(feats[1].tolist())), 7] = 3.0
    apart = pii.Field((unary, chain, agree), feats, gap, skip).run(20).marginals()[1]
    agree[4] = agree[0] = 3.0
    joined = pii.Field((unary, chain, agree), feats, gap, skip).run(20).marginals()[1]
    assert apart[[7, 8]].sum() < 0.3 and joined[[7, 8]].sum() > 0.8


def test_many_occurrences_make_no_pairs_of_all():
    nodes = pii.Nodes()
    nodes.add("12345 " * 5000)
    assert (nodes.arrays()[2] >= 0).sum() == 4999


def test_edges(spark, corpus):
    schema = "doc_id long, text string, spans int, kind string, h int, base int"
    data = [(1, None), (2, ""), (None, "a@b.cc"), (3, "a@b.cc"), (3, "a@b.cc"), (4, "é 1.2.3.4 " * 3000)]
    df = spark.createDataFrame([(*r, 0, "", 0, 0) for r in data], schema)
    got = pii.find(df).collect()
    assert sorted((str(r["doc_id"]), len(r["spans"])) for r in got) == sorted([("1", 0), ("2", 0), ("None", 1), ("3", 1), ("3", 1), ("4", 3000)])
    assert pii.find(df.limit(0)).count() == 0
    assert pii.find(df.where("text is null")).collect()[0]["spans"] == []
