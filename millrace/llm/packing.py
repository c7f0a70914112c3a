"""Packing token sequences along a Hilbert curve.

A document's words vote, by hashed signs, on DIMS coordinates; the Hilbert index of these coordinates orders the
corpus, so that neighbours in a sequence are alike. The key is the index followed by bits of the identifier's
hash, which spreads equal texts over several parts. Documents are range-sorted by key into parts of about PART tokens and
laid end to end, parts follow each other, and the stream is cut every `size` tokens. Only the part totals, a row for
each PART tokens, are broadcast. All sequences are full but the last one.

Texts are read once, for tokens and keys together; these are written, sorted, and cut into pieces.

Tokens are those of the vocabulary's JSON file as the `tokenizers` library reads it: the strings of its added tokens are
these tokens wherever they stand in a text, and no other token is added but the end token.

Nulls: a null text is empty, a null id stays null. An empty text is its end token alone. Repeated rows are packed
each for itself. Empty tables give empty results. Only the two named columns are read, so other columns of any name do
not matter. A text is held whole by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import vec
from .common import Scratch, concurrency, slices

DIMS, BITS = 4, 10
#: Low bits of a key that come from the identifier, and tokens of a part.
TIE_BITS, PART = 23, 1 << 25
U = np.uint64


def hilbert(coords: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of points with integer coordinates of `bits` bits, by Gray-code transposition."""
    x = coords.T.astype(np.int64).copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    fix, q = np.zeros_like(x[0]), top
    while q > 1:
        fix ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= fix
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(col: pa.Array) -> np.ndarray:
    """The Hilbert index of each text's hashed, projected word vector."""
    data, offsets = vec.utf8(col)
    starts, ends, before = vec.words(data, offsets)
    names = vec.mix(vec.word_names(data, starts, ends, lower=True), 31)
    counts = np.diff(before)
    point = np.zeros((len(counts), DIMS))
    for j in range(DIMS):
        votes = ((names >> U(8 * j)) & U(1)).astype(np.int64) * 2 - 1
        sums = np.concatenate([[0], np.cumsum(votes)])
        point[:, j] = (sums[before[1:]] - sums[before[:-1]]) / np.sqrt(np.maximum(counts, 1))
    cells = 1 << BITS
    return hilbert(np.clip((point + 4) / 8 * cells, 0, cells - 1).astype(np.int64), BITS)


def _whole_keys(batch: pa.RecordBatch) -> np.ndarray:
    return (curve_keys(batch.column(1)) << TIE_BITS) | batch.column(2).to_numpy()


_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a public vocabulary, once per process: its ranks file with the added tokens of its JSON file."""
    if vocabulary not in _encoders:
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        _encoders[vocabulary] = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _encoders[vocabulary]


#: The pattern engine's stack ends near a million characters of white space; longer runs than this are cut out before it.
LONG_SPACE = 100_000
#: White space as the pattern has it (the Unicode property; Python's own class has four control characters more).
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def encode(encoding, text: str, longest: int = LONG_SPACE) -> np.ndarray:
    """The tokens of a text of any length. The pattern takes a run of white space as one piece, but for its last
    character when more text follows; runs over `longest` are cut out in the same way, between added tokens."""
    if len(text) <= longest:
        return encoding.encode_to_numpy(text, allowed_special="all")
    ids: list[int] = []
    for k, part in enumerate(re.split("(" + "|".join(map(re.escape, encoding.special_tokens_set)) + ")", text) if encoding.special_tokens_set else [text]):
        if k % 2:
            ids.append(encoding.encode_single_token(part))
            continue
        done = 0
        for run in re.finditer(f"(?<!{SPACE}){SPACE}{{{longest + 1},}}", part):
            end = run.end() - (run.end() < len(part))
            ids += encoding.encode_ordinary(part[done : run.start()])
            ids += encoding._encode_single_piece(part[run.start() : end])
            done = end
        ids += encoding.encode_ordinary(part[done:])
    return np.array(ids, np.uint32)


def _kind(vocabulary: str, end_id: int) -> type:
    """Tokens are written in two bytes where all of the vocabulary fit."""
    return np.uint16 if max(encoder(vocabulary).n_vocab, end_id + 1) <= 1 << 16 else np.uint32


def _tokenize(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, kind = encoder(vocabulary), _kind(vocabulary, end_id)
        for batch in slices(batches, "text"):
            ids = [np.append(encode(encoding, t or ""), np.uint32(end_id)).astype(kind) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_whole_keys(batch)), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "key", "n", "ids"],
            )

    return run


def _lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Offsets within the part, which is the task's partition."""
    from pyspark import TaskContext

    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(2).to_numpy()
        ends = total + np.cumsum(n)
        total = int(ends[-1]) if len(n) else total
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), batch.column(2), batch.column(3)], names=["doc_id", "part", "at", "n", "ids"])


def _pieces(size: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in slices(iter([batch]), "ids", 1 << 22):
                yield cut(sub)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        sequence = first // size
        doc = np.repeat(np.arange(len(n)), (first + n - 1) // size - sequence + 1)
        sequence = vec.ragged(sequence, np.bincount(doc, minlength=len(n)))
        start = np.maximum(sequence * size, first[doc])
        length = np.minimum((sequence + 1) * size, (first + n)[doc]) - start
        # The pieces follow each other as the documents' tokens do.
        ids = np.frombuffer(b"".join(batch.column(3).to_pylist()), kind).astype("<u4")
        ends = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int64)
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        cols = [pa.array(c, pa.int64()) for c in (start - first[doc], length, n[doc], sequence, start - sequence * size)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(doc, pa.int64())), *cols, blobs.cast(pa.binary())],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, vocabulary: str = "byte_bpe_50k", end_id: int = 1) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian 32-bit, as binary)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    id_ = F.col(f"`{id_col}`")
    tie = F.shiftrightunsigned(F.xxhash64(id_), 64 - TIE_BITS)
    own = docs.select(id_.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), tie.alias("tie"))
    id_field = own.schema["doc_id"]
    tokens = scratch.cut(own.mapInArrow(_tokenize(vocabulary, end_id), StructType([id_field]).add("key", "long").add("n", "long").add("ids", "binary")), "tokens")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranged = tokens.repartitionByRange(max(concurrency(spark), -(-total // PART)), "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
    laid = ranged.mapInArrow(_lay_out, StructType([id_field]).add("part", "integer").add("at", "long").add("n", "long").add("ids", "binary"))
    laid = scratch.cut(laid, "laid")
    totals = laid.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each part
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    placed = laid.join(F.broadcast(starts), "part").select("doc_id", (F.col("before") + F.col("at")).alias("first"), "n", "ids")
    out = StructType([id_field])
    for c in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        out = out.add(c, "long")
    return placed.mapInArrow(_pieces(size, _kind(vocabulary, end_id)), out.add("ids", "binary"))
