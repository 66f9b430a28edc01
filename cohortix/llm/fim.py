"""Fill-in-middle transformation by secondary-sort assembly.

A document's units are runs of ASCII letters and single other code points.  It
is cut into prefix, middle and suffix by numbers drawn from its id, and each
section into pieces of at most ``chunk`` units.  Pieces are keyed by document
and output position, dealt out by document and sorted within the partitions
(``repartition`` + ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``: one shuffle, sorted and spilled by the
JVM), so a task streams them, in order of output, into an incremental digest
and never needs a whole document.  The same stream is read back as a text with
marks: a reader that knows only the output and its form finds the sections,
whose pieces are sorted again, by place in the source, within the same
partitions, and streamed into the digest of the restored text.

Defined results: a null text is empty; an empty text or one that holds a mark
stays plain; a null id is drawn from as if it were written as nothing; repeated
rows are all returned (each row is a document of its own, told apart by a row
number, so rows with one id share no task); an empty table gives no rows;
further columns are ignored.  Input rows must come in the same order if a scan
is repeated, as they do from files.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import table

#: Fixed values of the contract: marks of prefix, suffix and middle, shares in per cent
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED, APPLIED, SUFFIX_FIRST = 1, 90, 20
#: units in a piece
CHUNK = 8192
#: order of the sections in the output, by form
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: place of a section in the source
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

#: (at, seq) orders the pieces of a document; the piece at -1 carries what is known of the whole document
_KEY = "row long, at int, seq int"
_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"{_KEY}, piece string, {_FACTS}"
READ = f"{PIECES}, output_sha256 string"
_DIGESTS = f"{_FACTS}, output_sha256 string, restored_sha256 string"
_TEXTS = f"{_FACTS}, output string"


def unit_starts(text: str) -> np.ndarray:
    """Offsets in code points at which the units of ``text`` start."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = code | 32
    letter = (folded >= 97) & (folded <= 122) & (code < 128)
    inner = letter.copy()
    inner[1:] &= letter[:-1]
    inner[:1] = False
    return np.flatnonzero(~inner)


def draws(doc_id, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def plan(doc_id, text: str, n: int, seed: int = SEED, applied: int = APPLIED, suffix_first: int = SUFFIX_FIRST) -> tuple[str, int, int]:
    """Form, units of the prefix, units of prefix and middle."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= applied:
        return "plain", 0, 0
    return "spm" if h4 % 100 < suffix_first else "psm", min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))


def _cut(chunk: int, seed: int, applied: int, suffix_first: int):
    names = PIECES_NAMES

    def run(batches):
        for batch in batches:
            ids, rows, texts = (batch.column(c).to_pylist() for c in ("doc_id", "row", "text"))
            out, held = [], 0
            for doc, row, text in zip(ids, rows, texts, strict=True):
                starts = unit_starts(text)
                n = len(starts)
                form, a, b = plan(doc, text, n, seed, applied, suffix_first)
                place = lambda u: int(starts[u]) if u < n else len(text)  # noqa: B023, E731
                plain = form == "plain"
                facts = (doc, n, form, None if plain else place(a), None if plain else place(b) - place(a))
                out.append((row, -1, 0, None, *facts))
                cuts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
                for at, (mark, (lo, hi)) in enumerate([("", (0, n))] if plain else [(m, cuts[m]) for m in ORDER[form]]):
                    for seq, u in enumerate(range(lo, max(hi, lo + 1), chunk)):
                        piece = text[place(u) : place(min(u + chunk, hi))] if u < hi else ""
                        out.append((row, at, seq, (mark if seq == 0 else "") + piece, *(None,) * 5))
                        held += len(piece)
                if held > 4 << 20:
                    yield batch_of(out, names, PIECES)
                    out, held = [], 0
            if out:
                yield batch_of(out, names, PIECES)

    return run


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


PIECES_NAMES, READ_NAMES = _names(PIECES), _names(READ)
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def batch_of(rows: list[tuple], names: list[str], ddl: str) -> pa.RecordBatch:
    kinds = [_KINDS[c.split()[1]] for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class Reader:
    """Finds the sections in a stream of pieces of an output of the given form.

    Marks may be split between pieces: the last two code points are held back
    until more is known.  ``take`` and ``end`` give (mark, text) in order.
    """

    def __init__(self, form: str):
        self.marks, self.mark, self.rest = list(ORDER.get(form, ())), "", ""

    def take(self, piece: str) -> list[tuple[str, str]]:
        out, self.rest = [], self.rest + piece
        while self.marks and (at := self.rest.find(self.marks[0])) >= 0:
            if at:
                out.append((self.mark, self.rest[:at]))
            self.mark, self.rest = self.marks[0], self.rest[at + len(self.marks.pop(0)) :]
        keep = 2 if self.marks else 0
        if len(self.rest) > keep:
            out.append((self.mark, self.rest[: len(self.rest) - keep]))
            self.rest = self.rest[len(self.rest) - keep :]
        return out

    def end(self) -> list[tuple[str, str]]:
        return [(self.mark, self.rest)] if self.rest else []


def restored(output: str, form: str) -> str:
    """The text behind an output, from output and form alone."""
    reader = Reader(form)
    found = reader.take(output) + reader.end()
    return "".join(text for _, text in sorted(found, key=lambda x: PLACE.get(x[0], 0)))


def _read_back(batches):
    """Sorted by output position: digest of every output, and its pieces by their
    place in the source.  The digest follows as a piece at -1."""
    facts, reader, digest, seq, out, held = None, None, None, 0, [], 0

    def put(found):
        nonlocal seq, held
        for mark, text in found:
            out.append((row, PLACE.get(mark, 0), seq, text, *(None,) * 6))
            seq, held = seq + 1, held + len(text)

    def done():
        put(reader.end())
        out.append((row, -1, 0, None, *facts, digest.hexdigest()))

    row = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in PIECES_NAMES]
        for key, at, _, piece, *known in zip(*columns, strict=True):
            if at == -1:
                if facts is not None:
                    done()
                row, facts, reader, digest, seq = key, known, Reader(known[2]), hashlib.sha256(), 0
                continue
            digest.update(piece.encode())
            put(reader.take(piece))
            if held > 4 << 20:
                yield batch_of(out, READ_NAMES, READ)
                out, held = [], 0
        if out:
            yield batch_of(out, READ_NAMES, READ)
            out, held = [], 0
    if facts is not None:
        done()
        yield batch_of(out, READ_NAMES, READ)


def _restored_digests(batches):
    facts, digest, out = None, None, []
    names = _names(_DIGESTS)
    for batch in batches:
        for at, piece, *known in zip(*[batch.column(c).to_pylist() for c in ("at", "piece", *READ_NAMES[4:])], strict=True):
            if at >= 0:
                digest.update(piece.encode())
                continue
            if facts is not None:
                out.append((*facts, digest.hexdigest()))
            facts, digest = known, hashlib.sha256()
        if out:
            yield batch_of(out, names, _DIGESTS)
            out = []
    if facts is not None:
        yield batch_of([(*facts, digest.hexdigest())], names, _DIGESTS)


def _joined(batches):
    facts, parts, out, held = None, [], [], 0
    names = _names(_TEXTS)
    for batch in batches:
        for at, piece, *known in zip(*[batch.column(c).to_pylist() for c in ("at", "piece", *PIECES_NAMES[4:])], strict=True):
            if at >= 0:
                parts.append(piece)
                held += len(piece)
                continue
            if facts is not None:
                out.append((*facts, "".join(parts)))
            facts, parts = known, []
            if held > 4 << 20:
                yield batch_of(out, names, _TEXTS)
                out, held = [], 0
    if facts is not None:
        out.append((*facts, "".join(parts)))
    if out:
        yield batch_of(out, names, _TEXTS)


def pieces(docs: DataFrame, chunk: int = CHUNK, seed: int = SEED, applied: int = APPLIED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text), in partitions by
    document and sorted there by output position."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(_cut(chunk, seed, applied, suffix_first), PIECES).repartition("row").sortWithinPartitions("row", "at", "seq")


def transform(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the whole output of every row."""
    return pieces(docs, **options).mapInArrow(_joined, _TEXTS)


def digests(docs: DataFrame, **options) -> DataFrame:
    """As ``transform`` with the SHA-256 of output and restored text in place of
    the output; no task holds more than a piece of a text."""
    read = pieces(docs, **options).mapInArrow(_read_back, READ)
    return read.sortWithinPartitions("row", "at", "seq").mapInArrow(_restored_digests, _DIGESTS)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(d, 1, 8) AS UBIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(d, 9, 8) AS UBIGINT) % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(d, 17, 8) AS UBIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(d, 25, 8) AS UBIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
