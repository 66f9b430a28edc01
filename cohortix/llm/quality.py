"""Quality rules by distribution divergence (DataFrame functions only).

Base rules reject a text of fewer than 50 words or one in which more than half
of the words lie in 3-word windows that repeat within the text.  A text that
passes them is compared with its language: the histogram of its character
classes, and that of the language's common words among all its words, against
the pooled histograms of the documents of that language that pass the base
rules.  The distance is Jensen-Shannon (square root of the divergence in bits,
0 to 1).  Guards: a histogram has no say if the text has too few characters or
words to fill it, or if its language has too little text for a reference.

The repeated windows are found inside the row: 3-word hashes with their
position in the low bits are sorted as longs, neighbours with equal hash are
candidates, and candidates are compared word by word, so a hash collision
changes nothing.  Only counts (a few dozen longs a document) are stored and
summed by language; the texts are read once and never shuffled.

Defined results: a null text has no words; a null or empty language gets the
smallest distance over the references of the languages of ``COMMON``, each with
its own words (none of them has a reference: no say); any other language uses
its own pooled reference; empty texts fail
the base rules; repeated rows are judged alike and all kept; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import SPACE, let, stored, table

MIN_WORDS = 50
#: longest share of a text, in percent, that repeated windows may cover
MAX_REPEAT = 50
#: guards: code points for the class histogram, words for the word histogram
MIN_CHARS, MIN_COMMON = 200, 100
#: words that a language must have in documents that pass the base rules
MIN_REFERENCE = 5_000
#: largest distance to the language's reference
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.25, 0.28

#: fixed values: frequent function words of each language
COMMON = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine",
    "en": "the of and to in a is that for it on was be with as by at are",
    "es": "de la que el en y a los se del las un por con no una su para",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus",
}
N_COMMON = 18
#: fixed values: character classes in the order they are taken out of the text
CLASSES = [r"\p{Ll}+", "[ \\t\\n\\x0B\\f\\r]+", r"\p{Lu}+", r"\p{Nd}+", r"[.,;:!?'\"()\-]+", r"[\p{L}\p{M}]+"]


def _words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""

    def packed(bits: Column) -> Column:
        def one(_, i):
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long"))

        return F.sort_array(F.transform(F.slice(w, F.lit(1), n - 2), one))

    def twins(s: Column, same) -> Column:
        """Elements of a sorted array that equal a neighbour."""
        return let(F.size(s), lambda m: F.filter(
            s, lambda x, i: ((i > 0) & same(x, F.get(s, i - 1))) | ((i + 1 < m) & same(x, F.get(s, i + 1)))
        ))

    def exact(found: Column, bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def window(x):
            p = x.bitwiseAND(mask).cast("int")
            return F.struct(F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("w"), p.alias("p"))

        real = let(F.sort_array(F.transform(found, window)), lambda s: twins(s, lambda a, b: a["w"] == b["w"]))
        covered = F.flatten(F.transform(real, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.size(F.array_distinct(covered)).cast("long")

    def counted(bits: Column) -> Column:
        high = lambda x: F.call_function("shiftright", x, bits)
        found = let(packed(bits), lambda s: twins(s, lambda a, b: high(a) == high(b)))
        return let(found, lambda f: F.when(F.size(f) > 0, exact(f, bits)).otherwise(F.lit(0).cast("long")))

    bits = F.length(F.bin(n.cast("long"))).cast("int")
    return F.when(n >= 3, let(bits, counted)).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """doc_id, lang, base counts, class and common-word histograms (without a
    language: one after another for all of ``COMMON``): one row a document;
    ``_row`` has the columns ``carry``."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def classes(t: Column, done: tuple = ()) -> Column:
        """Length of the text left before each class is taken out, and at the end."""
        k = len(done)
        if k == len(CLASSES):
            symbols = F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))
            return F.array(*done, F.length(t), symbols)
        return let(F.regexp_replace(t, CLASSES[k], ""), lambda rest: classes(rest, (*done, F.length(t))))

    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    dup_lines = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    common = F.create_map(*[x for k, ws in COMMON.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in ws.split()]))])
    pooled = sorted({w for ws in COMMON.values() for w in ws.split()[:5]})[:N_COMMON]
    own = F.coalesce(F.get(F.map_values(F.map_filter(common, lambda k, _: k == F.col("lang"))), F.lit(0)), F.array(*[F.lit(w) for w in pooled]))

    known = F.coalesce("lang", F.lit("")) != ""

    def histogram(w: Column, listed: Column) -> Column:
        at = F.transform(w, lambda x: F.array_position(listed, x).cast("int"))
        return let(at, lambda p: F.array(*[F.size(p) - F.size(F.array_remove(p, k)) for k in range(N_COMMON + 1)]))

    def counts(w: Column) -> Column:
        return let(F.size(w), lambda n: F.struct(
            n.cast("long").alias("n_words"),
            _repeat_words(w, n).alias("n_repeat_words"),
            F.when(known, let(own, lambda listed: histogram(w, listed))).otherwise(F.concat(*[histogram(w, F.array(*[F.lit(x) for x in ws.split()])) for ws in COMMON.values()])).alias("common"),
        ))

    row = [F.struct(*carry).alias("_row")] if carry else []
    got = docs.select(*row, "doc_id", "lang", let(text, classes).alias("c"), dup_lines.cast("long").alias("n_dup_lines"), let(_words(text), counts).alias("w"))
    c = lambda i: F.get("c", F.lit(i)).cast("long")
    bins = [c(i) - c(i + 1) for i in range(len(CLASSES))] + [c(len(CLASSES))]
    return got.select(
        *(["_row"] if carry else []), "doc_id", "lang", F.col("w.n_words").alias("n_words"),
        (c(0) - bins[1]).alias("word_chars"), c(len(CLASSES) + 1).alias("n_symbols"), "n_dup_lines",
        F.col("w.n_repeat_words").alias("n_repeat_words"),
        F.array(*bins).alias("classes"), F.col("w.common").cast("array<long>").alias("common"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if one is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def of(n: Column, m: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: let(F.struct((a / n).alias("a"), (b / m).alias("b")), lambda s: (
            part(s["a"], (s["a"] + s["b"]) / 2) + part(s["b"], (s["a"] + s["b"]) / 2)
        )))
        return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0))))

    return let(total(p), lambda n: let(total(q), lambda m: of(n, m)))


def judge(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Base counts, base_failed, class_distance, word_distance and kept of every
    document; ``_row`` has the columns ``carry`` of ``docs``, which are then
    stored beside the counts rather than joined back."""
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT * n)
    rows = stored(features(docs, carry), "quality-counts").withColumn("base_failed", failed).withColumn("l", F.coalesce("lang", F.lit("")))
    bins = {"classes": len(CLASSES) + 1, "common": N_COMMON + 1}
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, k in bins.items() for i in range(k)]
    refs = rows.where(~F.col("base_failed") & (F.col("l") != "")).groupBy("l").agg(F.sum("n_words").alias("ref_words"), *sums)
    refs = refs.where(F.col("ref_words") >= MIN_REFERENCE).select(
        "l", *[F.array(*[F.col(f"{c}{i}") for i in range(k)]).alias(f"ref_{c}") for c, k in bins.items()]
    )
    # a row a language; that of texts without one has the references of all known languages (a handful)
    refs = stored(refs, "quality-references")
    one = F.struct((F.array_position(F.array(*map(F.lit, COMMON)), F.col("l")) - 1).cast("int").alias("i"), "ref_classes", "ref_common")
    of_all = refs.where(F.col("l").isin(*COMMON)).groupBy(F.lit("").alias("l")).agg(F.collect_list(one).alias("refs"))
    refs = refs.select("l", F.array(one).alias("refs")).unionByName(of_all)
    # a stored table has a known size: if small, Spark sends it to the rows and leaves them (and their texts) in place
    rows = rows.join(stored(refs, "quality-references-by-language"), "l", "left")
    k = bins["common"]
    own = lambda r: F.when(F.col("l") == "", F.slice("common", r["i"] * k + 1, F.lit(k))).otherwise(F.col("common"))
    least = lambda distance: F.array_min(F.transform("refs", distance))
    by_class = F.when(F.col("word_chars") >= MIN_CHARS, least(lambda r: js_distance(F.col("classes"), r["ref_classes"])))
    by_word = F.when(n >= MIN_COMMON, least(lambda r: let(own(r), lambda p: js_distance(p, r["ref_common"]))))
    rows = rows.withColumn("class_distance", by_class).withColumn("word_distance", by_word)
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return rows.select(
        *(["_row"] if carry else []), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")
