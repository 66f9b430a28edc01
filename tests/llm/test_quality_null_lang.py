"""Clean texts without a language are not judged against a mixture of languages."""

import random

from cohortix.llm import quality


def text(rng, lang, n=200):
    common = quality.COMMON[lang].split()
    return " ".join(rng.choice(common) if rng.random() < 0.5 else f"{lang}{rng.randrange(10**6)}" for _ in range(n))


def test_clean_texts_without_a_language_are_kept(spark):
    rng = random.Random(5)
    data = [(i, text(rng, g), g) for i, g in enumerate(g for g in quality.COMMON for _ in range(40))]
    share = {"en": 60, "de": 8, "fr": 8, "es": 8}
    data += [(1000 + i, text(rng, g), None) for i, g in enumerate(g for g, k in share.items() for _ in range(k))]
    data.append((5000, " ".join(f"x{i}" for i in range(300)), None))
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert got.pop(5000) is False and all(got.values())


def test_without_any_known_reference_the_histograms_have_no_say(spark):
    rng = random.Random(5)
    data = [(i, text(rng, g), None) for i, g in enumerate(list(quality.COMMON) * 20)]
    assert all(r["kept"] for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect())
