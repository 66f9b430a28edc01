"""Fill-in-middle: brute force, exact round trip, edge cases."""

import hashlib
import re

import pytest

pytest.importorskip("cohortix.llm")

from cohortix.llm import fim  # noqa: E402

SCHEMA = "doc_id long, text string, row int, at int, seq int, piece string, n string, form int"
TEXTS = [None, "", "a", "<P>", "one<S>two", "x<M>", "<P", "ab<", ">M<S", "Ärger über alles", "a\x00b\nc\td", "word " * 4000, "é" * 3000, "\U0001f600 smile", "<<<PP>>"]


def expected(doc, text):
    text = text or ""
    units = re.findall("(?s)[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(x in text for x in fim.MARKS) or h[2] % 100 >= 90:
        return doc, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc, len(units), form, len(p), len(m), sha(out), sha(text)


@pytest.fixture(scope="module")
def data():
    rows = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(None, t) for t in TEXTS] + [(7, "same text")] * 5 + [(7, "other text")]
    return rows


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_digests_against_brute_force(spark, data, chunk):
    df = spark.createDataFrame([(*r, 0, 0, 0, "", "", 0) for r in data], SCHEMA).repartition(5)
    got = sorted(map(str, (tuple(r) for r in fim.digests(df, chunk=chunk).collect())))
    assert got == sorted(str(expected(*r)) for r in data)


def test_texts_come_back_from_output_and_form_alone(spark, data):
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = fim.transform(df, chunk=3).collect()
    assert sorted((str(r["doc_id"]), fim.restored(r["output"], r["form"])) for r in out) == sorted((str(i), t or "") for i, t in data)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_marks_split_between_pieces():
    reader = fim.Reader("spm")
    found = [x for c in "<S>tail<P><he<<M>ad" for x in reader.take(c)] + reader.end()
    text = {}
    for mark, part in found:
        text[mark] = text.get(mark, "") + part
    assert text == {"<S>": "tail", "<P>": "<he<", "<M>": "ad"}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(none).count() == 0 and fim.transform(none).count() == 0


def test_one_shuffle(spark, data):
    plan = fim.digests(spark.createDataFrame(data, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
