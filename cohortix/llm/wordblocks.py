"""Distinct-word tables by block of documents, and their join with what is
known about each word.

A block is a run of documents of one input partition (at most ``block_bytes``
of text, or one longer document).  Its distinct words, most frequent first, are
its word table; a text is kept as the positions of its words in that table.  So
a word crosses the network once per block that has it, not once per token.

Word tables are cut into pages by a hash of the word.  All pages of one hash
bucket meet in one group: every distinct word of the corpus is in exactly one
bucket and is worked on once there, and each page goes back to its block with
one answer per word.  A frequent word has one row per block, so no word is hot.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import stored

BLOCK_BYTES = 32 << 20
#: text that is split at once
_PIECE_BYTES = 4 << 20
#: input for each bucket of words
BUCKET_BYTES = 64 << 20

_PAGE = "struct<bucket:int,words:binary,counts:binary>"
_BLOCK = f"block long, doc_id array<long>, flag array<boolean>, size array<int>, packed binary, bucket binary, pages array<{_PAGE}>"
_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("flag", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())),
    ("packed", pa.binary()), ("bucket", pa.binary()),
    ("pages", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())]))),
])


def squeeze(data: bytes, level: int = 7) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


#: numbers or bytes that pack and unpack work on at once
_PIECE = 1 << 19


def pack(numbers: np.ndarray) -> bytes:
    """Seven bits a byte, the high bit set on all bytes of a number but the last."""
    return b"".join(_pack(numbers[at : at + _PIECE]) for at in range(0, len(numbers), _PIECE))


def _pack(numbers: np.ndarray) -> bytes:
    x = numbers.astype(np.uint32)
    size = 1 + (x >= 1 << 7) + (x >= 1 << 14).astype(np.int64) + (x >= 1 << 21) + (x >= 1 << 28)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for j in range(5):
        some = size > j
        if some.any():
            out[at[some] + j] = ((x[some] >> np.uint32(7 * j)) & 127) | np.where(size[some] > j + 1, 128, 0)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    out, at = [np.zeros(0, np.int32)], 0
    while at < len(data):
        stop = min(at + _PIECE, len(data))
        while data[stop - 1] > 127:
            stop -= 1
        out.append(_unpack(np.frombuffer(data, np.uint8, stop - at, at)).astype(np.int32))
        at = stop
    return np.concatenate(out)


def _unpack(b: np.ndarray) -> np.ndarray:
    last = b < 128
    first = np.r_[0, np.flatnonzero(last)[:-1] + 1]
    offset = np.arange(len(b)) - np.repeat(first, np.diff(np.r_[first, len(b)]))
    return np.add.reduceat((b & 127).astype(np.int64) << (7 * offset), first)


def _words(texts: pa.Array, fold: bool) -> tuple[np.ndarray, pa.Array]:
    """Number of words of every text, and all their words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if fold else texts)
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # blanks at either end of a text leave empty pieces
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return np.diff(np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))][offsets]), words.filter(some)


def _lines(words: pa.Array) -> bytes:
    """Words, which hold no line feed, in lines."""
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), b"\n")[0].as_py()


def _blocks(fold: bool, buckets: int, block_bytes: int, level: int = 7):
    def made(block: int, docs: list) -> pa.RecordBatch:
        sizes, flags = (np.concatenate([d[k] for d in docs]) for k in (2, 1))
        # pieces share one table of words, in the order of their first occurrence
        coded = pa.chunked_array([d[3] for d in docs]).unify_dictionaries()
        listed, docs_ids = coded.chunk(0).dictionary, [i for d in docs for i in d[0]]
        ids = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
        order = np.argsort(-np.bincount(ids, minlength=len(listed)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        counts = np.bincount(ids[np.repeat(flags, sizes)], minlength=len(listed))[order].astype(np.uint32)
        listed = listed.take(pa.array(order)).cast(pa.binary())
        words = _lines(listed).split(b"\n") if len(listed) else []
        bucket = (np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets).astype(np.uint16)
        place = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[place], prepend=-1, append=-1))
        pages = []
        for at in (place[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)):
            text = squeeze(_lines(listed.take(pa.array(at))), level)
            pages.append({"bucket": int(bucket[at[0]]), "words": text, "counts": squeeze(counts[at].tobytes(), level)})
        row = [block, docs_ids, flags, sizes.astype(np.int32), squeeze(pack(rank[ids]), level), squeeze(bucket.tobytes(), level), pages]
        pa.default_memory_pool().release_unused()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)

    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0
        docs, size = [], 0
        for batch in batches:
            lengths, at = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), 0
            while at < len(lengths):
                # as many texts as a piece and the block have room for, one at least
                room = int(np.searchsorted(np.cumsum(lengths[at:]), min(_PIECE_BYTES, block_bytes - size), "right"))
                if not room and docs and size + lengths[at] > block_bytes:
                    yield made((part << 24) + serial, docs)
                    docs, size, serial = [], 0, serial + 1
                    continue
                some = batch.slice(at, max(1, room))
                n, words = _words(some.column("text"), fold)
                flags = np.array([bool(f) for f in some.column("flag").to_pylist()], bool)
                docs.append((some.column("doc_id").to_pylist(), flags, n, words.dictionary_encode()))
                size += int(lengths[at : at + len(some)].sum())
                at += len(some)
        if docs:
            yield made((part << 24) + serial, docs)

    return run


def _planned_bytes(docs: DataFrame) -> int:
    """Size of ``docs`` as Spark's plan knows it from its files; 0 if it does not."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def blocks(docs: DataFrame, fold: bool, name: str, block_bytes: int = BLOCK_BYTES, level: int = 7) -> tuple[DataFrame, int]:
    """Stored blocks of ``docs`` (doc_id, flag, text) and the number of buckets,
    which follows the size of ``docs`` (and the session's shuffle partitions, if
    these are more).  ``fold`` lower-cases A-Z; a page's counts are of flagged
    documents.  Null texts have no words."""
    session = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(65536, max(16, session, _planned_bytes(docs) // BUCKET_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "flag", F.coalesce("text", F.lit("")).alias("text"))
    return stored(rows.mapInArrow(_blocks(fold, buckets, block_bytes, level), _BLOCK), name), buckets


def rows_of(batches):
    """Blocks one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def page_words(data: bytes) -> list[bytes]:
    return unsqueeze(data).split(b"\n")


def page_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(data), np.uint32).astype(np.int64)


def _pages(table: DataFrame, buckets: int) -> DataFrame:
    rows = table.select("block", F.explode("pages").alias("p")).select("block", "p.*")
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")


def by_bucket(table: DataFrame, buckets: int, solve: Callable, schema: str) -> DataFrame:
    """``solve(pages)`` for the list of (block, words, counts) of every bucket;
    it yields Arrow batches of ``schema``."""

    def run(batches):
        held, now = [], None
        for batch in batches:
            for block, bucket, words, counts in zip(*[batch.column(c).to_pylist() for c in ("block", "bucket", "words", "counts")], strict=True):
                if held and bucket != now:
                    yield from solve(now, held)
                    held = []
                now = bucket
                held.append((block, words, counts))
        if held:
            yield from solve(now, held)

    return _pages(table, buckets).mapInArrow(run, schema)


ANSWERS = "block long, bucket int, answer binary"


def answer_batch(block: int, bucket: int, answer: bytes) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([answer], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "bucket", "answer"])


def joined(table: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with their answers; further columns are kept, the pages' counts are not."""
    got = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
    return table.join(got, "block", "left")


def spread(bucket: bytes, pages: list[tuple[int, list]]) -> list:
    """Values of the pages (bucket, one value a word) in the order of the word table."""
    of = np.frombuffer(unsqueeze(bucket), np.uint16)
    out = np.empty(len(of), object)
    for b, values in pages:
        own = np.empty(len(values), object)
        own[:] = values
        out[of == b] = own
    return out.tolist()


def spread_numbers(bucket: bytes, pages: list[tuple[int, np.ndarray]]) -> np.ndarray:
    of = np.frombuffer(unsqueeze(bucket), np.uint16)
    out = np.zeros(len(of), np.int64)
    for b, values in pages:
        out[of == b] = values
    return out
