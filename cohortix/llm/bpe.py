"""BPE encoding and decoding through a distinct-word table.

Texts are split at ASCII white space, where this vocabulary's tokenizer never
lets a token cross: its special tokens hold no space, its normaliser (NFC,
spaces, lower case) works within words, and its splitter drops spaces.  Each
distinct word of the corpus is encoded once, by the library, in the hash bucket
it belongs to; ids go back to the blocks that have the word and are laid out by
the positions of the words (see wordblocks).  Decoding joins ids with the table
of pieces (the vocabulary file bounds it), once per distinct word, and joins
pieces by one space as the library does for a vocabulary without a decoder.

Defined results: a null text is empty, an empty text has no tokens; special
tokens written out in a text get their ids; repeated rows are all returned;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import table
from cohortix.llm.wordblocks import ANSWERS, BLOCK_BYTES, answer_batch, blocks, by_bucket, joined, pack, page_words, rows_of, spread_numbers, squeeze, unpack, unsqueeze

VOCABULARY = "word_bpe_49k.json"


def _encoder(vocabulary):
    """solve() for wordblocks.by_bucket: page -> ids of its words."""

    def solve(bucket, pages):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(vocabulary.value)
        tok.no_truncation()
        tok.no_padding()
        small = tok.get_vocab_size() <= 1 << 16
        # one page is open at a time; what is held is each distinct word of the bucket with its ids
        ids: dict[bytes, np.ndarray] = {}
        for block, words, _ in pages:
            own = page_words(words)
            new = [w for w in own if w not in ids]
            for at in range(0, len(new), 4096):
                some = new[at : at + 4096]
                for w, e in zip(some, tok.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                    ids[w] = np.array(e.ids, np.uint16 if small else np.int64)
            found = [ids[w] for w in own]
            sizes = np.array([len(x) for x in found], np.int64)
            data = pack(np.r_[len(own), sizes, np.concatenate(found).astype(np.int64)])
            yield answer_batch(block, bucket, squeeze(data))

    return solve


def pieces_of(vocabulary: str) -> list[str]:
    """Piece of every id."""
    model = json.loads(vocabulary)
    out = {i: p for p, i in model["model"]["vocab"].items()} | {t["id"]: t["content"] for t in model["added_tokens"]}
    return [out.get(i, "") for i in range(max(out) + 1)]


def _laid_out(pieces, digests: bool):
    def run(batches):
        for row in rows_of(batches):
            answers = [(a["bucket"], unpack(unsqueeze(a["answer"]))) for a in row["answers"] or ()]
            sizes = spread_numbers(row["bucket"], [(b, x[1 : 1 + x[0]]) for b, x in answers])
            first = np.cumsum(sizes) - sizes
            flat = np.zeros(int(sizes.sum()), "<u4")
            said = [b""] * len(sizes)
            of = np.frombuffer(unsqueeze(row["bucket"]), np.uint16)
            for b, x in answers:
                at, ids = 1 + int(x[0]), x.tolist()
                for i in np.flatnonzero(of == b).tolist():
                    n = int(sizes[i])
                    own = ids[at : at + n]
                    flat[first[i] : first[i] + n] = own
                    said[i] = " ".join([pieces.value[j] for j in own]).encode()
                    at += n
            answers = None
            tokens, out, at = unpack(unsqueeze(row["packed"])), [], 0
            for doc, n in zip(row["doc_id"], row["size"], strict=True):
                own = tokens[at : at + n]
                at += n
                many = sizes[own]
                own = own[many > 0]  # a word may have no tokens: then it leaves nothing to join
                many = many[many > 0]
                total = int(many.sum())
                own_ids = flat[np.repeat(first[own] - (np.cumsum(many) - many), many) + np.arange(total)]
                text = b" ".join([said[i] for i in own.tolist()])
                if digests:
                    out.append((doc, total, hashlib.sha256(own_ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()))
                else:
                    out.append((doc, own_ids.astype(np.int64).tolist(), text.decode()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] if digests else [pa.int64(), pa.list_(pa.int32()), pa.string()]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def encode(docs: DataFrame, vocabulary_path: str | None = None, digests: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text); with
    ``digests`` doc_id, n_tokens and the SHA-256 of both instead.  The vocabulary
    file (by default the installed package's) is read on the driver."""
    sc = docs.sparkSession.sparkContext
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path(VOCABULARY)
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    made, buckets = blocks(docs.withColumn("flag", F.lit(False)), False, "bpe-blocks", block_bytes)
    answers = by_bucket(made, buckets, _encoder(sc.broadcast(vocabulary)), ANSWERS)
    rows = joined(made.select("block", "doc_id", "size", "packed", "bucket"), answers)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string"
    return rows.mapInArrow(_laid_out(sc.broadcast(pieces_of(vocabulary)), digests), schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), digests=True)
