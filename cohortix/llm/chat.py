"""Chat formatting by a grammar round trip (DataFrame functions only).

A conversation is rendered turn by turn as ``<s>[INST]role[/INST]text</s>``.
The deterministic parser splits the rendered text at the four control strings
and takes pieces 4i+2 and 4i+3 as role and text of turn i, undoing escapes.
Rendering starts from the plain texts; a conversation whose recovered turns
differ from its source is rendered again with its contents escaped, and the
result is checked once more (``exact``).

Escape: a control string gets a backslash after its first character, and a
look-alike that already has n backslashes there gets one more.  The parser
takes one away, so escaping is one-to-one, and no escaped text holds a control
string: one escaping round always makes the recovered turns identical.

Defined results: null role or text is empty; turns sort by (turn, role, text)
with null turns first, so ties and repeated rows have one order and are all
kept; rows of a null conv_id form one conversation; an empty table gives no
rows; further columns are ignored.

A conversation is one value of the result, so its turns meet in one row; turn
structs are gathered map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import table

CONTROL = r"</?s>|\[/?INST\]"
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(text, r"\[(\\*/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1")
    return F.regexp_replace(text, r"\[\\(\\*/?INST\])", "[$1")


def _render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))
    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, escapes undone; null if the text
    doesn't follow the grammar (four control strings a turn)."""
    pieces = F.split(formatted, CONTROL)

    def recovered(p: Column) -> Column:
        n = ((F.size(p) - 1) / 4).cast("int")
        turn = lambda i: F.struct(
            unescape(F.get(p, i * 4 + 2)).alias("role"), unescape(F.get(p, i * 4 + 3)).alias("text")
        )
        whole = (n > 0) & (F.size(p) == n * 4 + 1)
        return F.when(whole, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), turn))

    return F.element_at(F.transform(F.array(pieces), recovered), 1)


def _mask(turns: Column) -> Column:
    """Spans (start, length in code points) of the loss role's texts."""
    span = "struct<start:int,length:int>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["role"]) + len(OPEN) + len(MIDDLE)
        own = F.array(F.struct(start.alias("start"), F.length(t["text"]).alias("length")))
        spans = F.when(t["loss"], F.concat(acc["spans"], own)).otherwise(acc["spans"])
        return F.struct((start + F.length(t["text"]) + len(CLOSE)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask, escaped, exact: one row per conversation."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select("conv_id", F.struct("turn", empty("role").alias("role"), empty("text").alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def shaped(f):
        return lambda t: F.struct(f(t["role"]).alias("role"), f(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss"))

    bare = lambda ts: F.transform(ts, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    convs = convs.select("conv_id", "turns", F.transform("turns", shaped(lambda x: x)).alias("plain"))
    convs = convs.withColumn("escaped", ~F.coalesce(parse(_render(F.col("plain"))) == bare(F.col("turns")), F.lit(False)))
    used = F.when(F.col("escaped"), F.transform("turns", shaped(escape))).otherwise(F.col("plain"))
    convs = convs.select("conv_id", "turns", "escaped", used.alias("used"))
    convs = convs.select("conv_id", "turns", "escaped", _render(F.col("used")).alias("formatted"), _mask(F.col("used")).alias("loss_mask"))
    exact = F.coalesce(parse(F.col("formatted")) == bare(F.col("turns")), F.lit(False))
    return convs.select("conv_id", "formatted", "loss_mask", "escaped", exact.alias("exact"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast("long").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    convs = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    out = format_conversations(convs.unionByName(extra)).withColumn("turns", parse(F.col("formatted")))
    said_by = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform("loss_mask", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    out = out.withColumn("loss", F.array_join(under, ""))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_by, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "exact",
    )


SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), esc AS (
  SELECT *, regexp_replace(regexp_replace(role || '', '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') AS erole,
    regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') AS etext
  FROM all_rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(length(erole) + length(etext) + length('<s>[INST][/INST]</s>'))::BIGINT AS formatted_chars,
  true AS exact
FROM esc GROUP BY conv_id
"""
