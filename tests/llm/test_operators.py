"""Corpus operators against brute force, exact round trips and edge cases."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers
import xxhash

pytest.importorskip("cohortix.llm")

import corpus_pipeline  # noqa: E402
from cohortix.llm import bpe, chat, decontam, langid, lm, quality, queries, sharding, simhash, substrings, urls  # noqa: E402
from cohortix.llm.wordblocks import pack, unpack  # noqa: E402

SMALL = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n_words int, size int, shard int, spans int, words string, did long"
LONG = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
NOVEL = " ".join(f"w{i * i % 977}x{i}" for i in range(3000))
EDGE = [
    (1, None, "en"), (2, "", None), (3, " \t\n ", "en"), (4, LONG * 5, "en"), (4, LONG * 5, "en"), (5, LONG * 5, "de"),
    (6, "x" * 5000, "en"), (7, NOVEL, "en"), (8, NOVEL, None), (None, NOVEL, "en"), (9, "Zwei drei", "de"),
    (10, NOVEL + " end", "en"), (11, "a b c " * 100, "fr"), (12, "\u00dcber\u00a0all <|endoftext|> it's 123", "de"), (13, "...", "en"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, g, 0, 0, 0, 0, "", 0) for i, t, g in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[key](spark, SMALL)
    want = con.sql(queries.ORACLE[key])
    assert got.columns == want.columns
    assert rows(got) == sorted(map(str, want.fetchall()))


def test_every_operator_takes_empty_tables(spark, edge):
    none = edge.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality.judge(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert substrings.cut(none).count() == 0
    assert decontam.find_contamination(none, bench).count() == 0
    assert bpe.encode(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert lm.score(none.selectExpr("doc_id", "text", "true AS flag")).count() == 0
    assert langid.identify(none.selectExpr("doc_id", "text", "lang", "false AS held_out")).count() == 0
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame(urls.RULES, "verdict string, host string, path string")).count() == 0


def test_chat_escapes_and_nulls(spark):
    bad = ["</s>", r"<\/s>", "<s>[INST]user[/INST]hi</s>", r"[\\INST]", "<<s>>", "", None, "plain"]
    data = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(bad)] + [(2, None, None, None), (2, None, None, None), (None, 1, "user", "[INST]")]
    df = spark.createDataFrame([(*r, 0) for r in data], "conv_id long, turn long, role string, text string, turns int")
    out = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("t", chat.parse(chat.F.col("formatted"))).collect()}
    assert all(r["exact"] for r in out.values())
    assert [t["text"] for t in out[1]["t"]] == [t or "" for t in bad]
    assert [(t["role"], t["text"]) for t in out[2]["t"]] == [("", "")] * 2
    inner = [out[1]["formatted"][m["start"] : m["start"] + m["length"]] for m in out[1]["loss_mask"]]
    assert len(inner) == 4 and not any(re.search(chat.CONTROL, x) for x in inner)


def test_url_rules_nested_and_spread(spark):
    given = ["http://A.b.example.org/es/x", "https://example.org/en/12", "x://org", "nothing", None, "http://org/?q", "http://fexample.org/es/", "http://a..com/fr/#://b"]
    pages = spark.createDataFrame([(i % 5, u, "h", "k") for i, u in enumerate(given * 40)], "page_id long, url string, host string, key string")
    rules = spark.createDataFrame(urls.RULES * 2, "verdict string, host string, path string")
    got = urls.filter_urls(pages, rules).collect()
    assert len(got) == len(given) * 40
    want = {}
    for u in given:
        host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u).groups() if u and "://" in u else ("", "")
        host = host.translate(UP)
        fit = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        want[host, path] = (best[1] + best[2], best[0]) if best else (None, "allow")
    assert all((r["rule"], r["verdict"]) == want[r["host"], r["path"]] for r in got)


@pytest.mark.parametrize("max_blocks", [5, 40, 16384])
def test_minimax_capacity(spark, max_blocks):
    rng = np.random.default_rng(3)
    data = [(i, None if i == 17 else "x" * int(s), 1, 1) for i, s in enumerate(rng.integers(0, 60, 300))] + [(500 + i, "y" * 700, 1, 1) for i in range(6)]
    got = sharding.shard_documents(spark.createDataFrame(data, "doc_id long, text string, size int, shard int"), 7, max_blocks).collect()
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(t, [i, 0])[1] += len(t or "") + 1
    sizes = [s for _, s in sorted(groups.values())]

    def fits(cap):
        used, at = 1, 0
        for s in sizes:
            if s > cap:
                return False
            used, at = (used + 1, s) if at + s > cap else (used, at + s)
        return used <= 7

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))
    load = collections.Counter()
    for r in got:
        load[r["shard"]] += r["size"]
        assert r["text_crc32"] == zlib.crc32((dict((d[0], d[1]) for d in data)[r["doc_id"]] or "").encode())
    assert max(load.values()) == best
    of = collections.defaultdict(set)
    for r in got:
        of[dict((d[0], d[1]) for d in data)[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())
    for s in load:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_quality_counts(spark, edge, docs):
    data = edge.select("doc_id", "text", "lang", "n_words").unionByName(spark.createDataFrame([(i, t, "en", 0) for i, t in docs], "doc_id long, text string, lang string, n_words int"))
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.judge(data).collect()))
    want = []
    for i, t in [(i, t) for i, t, _ in EDGE] + docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        c = collections.Counter(grams)
        hit = {k + j for k, g in enumerate(grams) if c[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((i if i is not None else -1, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    assert [g[:7] for g in got] == sorted(want)
    assert not any(g[6] and g[7] for g in got)


def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UP))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("max_shard", [3, 16384])
def test_simhash_components(spark, edge, docs, max_shard):
    extra = [(9000 + i, NOVEL.replace("w0x0", f"v{i}")) for i in range(12)]
    data = edge.select("doc_id", "text").unionByName(spark.createDataFrame(docs + extra, "doc_id long, text string"))
    got = simhash.near_duplicates(data, max_shard=max_shard).collect()
    ids = {}
    for i, t in [(i, t) for i, t, _ in EDGE] + docs + extra:
        ids.setdefault(fingerprint(t), []).append(i)
    prints = sorted(ids)
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 3:
                up[root(b)] = root(a)
    least = {}
    for p, some in ids.items():
        least[root(p)] = min([least.get(root(p), 1 << 62), *(i for i in some if i is not None)])
    assert len(got) == sum(map(len, ids.values()))
    assert all(r["fp"] % (1 << 64) in ids and r["component_id"] == least[root(r["fp"] % (1 << 64))] for r in got)


def test_substrings_edge(spark, edge):
    got = collections.Counter((r["doc_id"], r["_cut"]["n_words"], r["_cut"]["n_removed"], r["_cut"]["kept_sha256"]) for r in substrings.cut(edge).collect())
    texts = [(i if i is not None else math.inf, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in EDGE]
    first = {}
    for i, w in texts:
        for k in range(len(w) - 49):
            g = tuple(w[k : k + 50])
            first[g] = min(first.get(g, math.inf), i)
    want = collections.Counter()
    for i, w in texts:
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(50)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[(None if i == math.inf else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert got == want


@pytest.mark.parametrize("max_bytes", [60, 8 << 20])
def test_decontamination(spark, edge, max_bytes):
    words = NOVEL.split()
    items = [("q1", " ".join(words[100:120]).upper()), ("q1", "zwei"), ("q2", "DREI"), (None, "it s 123"), ("q3", None), ("q4", "..."), ("q5", "absent words")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = decontam.find_contamination(edge, bench, max_bytes=max_bytes).collect()
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    pats = {}
    for name, text in items:
        w = pattern.findall((text or "").translate(UP))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            pats.setdefault(tuple(w[k : k + n]), set()).add(name)
    assert len(out) == len(EDGE)
    for r in out:
        w = pattern.findall((r["text"] or "").translate(UP))
        hit, names = set(), set()
        for p, some in pats.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    names |= some
        s = r["_scan"]
        assert (s["n_words"], s["n_hit"], list(s["items"])) == (len(w), len(hit), sorted(names - {None}))
        assert sum(len(pattern.findall(r["text"][x["start"] : x["end"]].translate(UP))) for x in s["hit_spans"]) == len(hit)


def test_pack_round_trip():
    x = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 2**28, 2**31 - 1])
    assert unpack(pack(x)).tolist() == x.tolist() and unpack(b"").tolist() == []


@pytest.mark.parametrize("block_bytes", [50, 1 << 20])
def test_bpe_equals_library(edge, block_bytes):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    got = sorted((str(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in bpe.encode(edge, block_bytes=block_bytes).collect())
    want = []
    for i, t, _ in EDGE:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), ids, tok.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_language_accuracy_and_undetermined(spark, edge):
    out = queries.QUERIES["op3_language_id"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in out if r["held_out"] and langid.has_letter(r["text"])]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    got = langid.identify(edge.selectExpr("doc_id", "text", "lang", "doc_id = 5 AS held_out")).collect()
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {1, 2, 3, 13} and len(got) == len(EDGE)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_sample_is_bounded_by_ids(spark):
    data = [(1, f"the cat {i}", "en", False) for i in range(50)] + [(2, "der Hund", "de", False), (3, "le chien", "fr", True), (None, "el perro", "es", False)]
    got = langid._sample(spark.createDataFrame(data, "doc_id long, text string, lang string, held_out boolean"), 4).collect()
    assert sorted(r["lang"] for r in got) == ["de", "en"]


def test_lm_base_and_gain(spark, docs):
    data = docs + [(9001, None), (9002, ""), (None, "The the")]
    out = lm.score(spark.createDataFrame(data, "doc_id long, text string").selectExpr("doc_id", "text", "coalesce(doc_id % 5 != 1, true) AS flag"), block_bytes=1 << 18)
    got = {r["doc_id"]: r for r in out.collect()}
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UP)) + [None]
    c = collections.Counter(w for i, t in data if i is None or i % 5 != 1 for w in words(t))
    n, v = sum(c.values()), len(c)
    for i, t in data:
        w, r = words(t), got[i]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_lm_learns(spark):
    held = lm.op10_lm_score(spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


def small_model():
    voc = lm.Vocabulary([(f"w{i}", 100 - i) for i in range(60)], {2: (30.0, 6)}, 20, 5000, 67)
    p = lm.initial(voc)
    rng = np.random.default_rng(1)
    return voc, {k: (w + rng.standard_normal(w.shape) * 0.3).astype(np.float64) for k, w in p.items()}, rng


def test_lm_sums_to_one():
    voc, p, rng = small_model()
    every = np.arange(voc.n_types)
    for h in rng.standard_normal((3, lm.HIDDEN)):
        got, _ = lm.outputs(p, voc, np.repeat(h[None], len(every), 0), every)
        assert np.exp(got).sum() == pytest.approx(1.0, abs=1e-6)


def test_lm_gradient():
    voc, p, rng = small_model()
    sizes = np.array([7, 4, 5])
    types = rng.integers(0, voc.n_types, sizes.sum())
    token, doc = lm.lanes(sizes, 2)
    x, y, fresh = lm._inputs(types, token, doc, voc.start)

    def loss(q, grad=None):
        states, _, tape = lm.recur(q, x, fresh, np.zeros((x.shape[1], lm.HIDDEN)), True)
        some = (y >= 0).ravel()
        got, back = lm.outputs(q, voc, states.reshape(-1, lm.HIDDEN)[some], y.ravel()[some], grad)
        if grad is not None:
            d = np.zeros((some.size, lm.HIDDEN))
            d[some] = back
            lm._backward(q, x, fresh, tape, d.reshape(states.shape), grad)
        return -got.sum()

    grad = {}
    loss(p, grad)
    for name in lm.SHAPES:
        big = np.unravel_index(np.abs(grad[name]).argmax(), p[name].shape)
        up, down = {**p, name: p[name].copy()}, {**p, name: p[name].copy()}
        up[name][big] += 1e-2
        down[name][big] -= 1e-2
        assert grad[name][big] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.02, abs=1e-3)


def test_lm_state_carries_across_windows():
    voc, p, rng = small_model()
    sizes = np.array([90])
    types = rng.integers(0, voc.n_head, 90)
    token, doc = lm.lanes(sizes)
    x, y, fresh = lm._inputs(types, token, doc, voc.start)
    states, _, _ = lm.recur(p, x, fresh, np.zeros((1, lm.HIDDEN)), False)
    whole, _ = lm.outputs(p, voc, states[:, 0], types)
    base = np.full(voc.n_types, -40.0)
    got = lm.log_probability(p, voc, types, sizes, np.arange(voc.n_types), np.zeros(voc.n_types), base)
    assert got[0] == pytest.approx(whole.sum() + 90 * math.log(1 - lm.BASE_SHARE), rel=1e-4)


def test_pipeline_stages(spark, edge):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = corpus_pipeline.near_duplicates(spark, edge, SMALL)
    got = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert kept.columns == edge.columns and len(got) == len(set(got)) and 4 in got and 5 not in got and 8 not in got and 2 not in got
    cut = corpus_pipeline.substring_dedup(spark, edge, SMALL)
    assert cut.columns == edge.columns and {r["doc_id"]: r["text"] for r in cut.collect()}[10] == "end"
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert corpus_pipeline.quality_rules(spark, docs.limit(0), SMALL).columns == docs.columns
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < docs.count()
