"""Substring deduplication by recompression.

Rounds of recompression rewrite every document's word sequence: maximal runs of one symbol and then
neighbouring (opening, closing) pairs become new symbols. A symbol's side in a round is a bit of its name, and
a new name is a hash of what it replaces, so the naming is global - equal substrings get equal interior symbols in
every document and partition - without a dictionary to shuffle.

Each symbol carries the range of words that its existence depends on (its own words plus the neighbours that
the rounds looked at). For every window of `window` words the anchor is the least name of such a range lying
within the window, at the highest level that has any; words themselves are level 0, so every window has an anchor, and
equal windows have equal anchors. Only windows whose anchor occurs elsewhere can repeat: these are verified over the
whole corpus by two independent 64-bit names of their word sequence, made from two independent names of each word, so
that 128 bits must agree before a word goes.

Both passes over the corpus exchange sorted names in hash buckets: a chunk of documents sends a name once, with a mark
if it holds it more often. Chunks meet in groups of at most FAN, and only the groups' distinct names meet in the bucket,
so a passage that every chunk holds is one entry per group there.

Words are [^\\x20\\x09-\\x0D]+. Nulls: a null text has no words; a null id stays null. Repeated rows count as
occurrences of each other's windows. Empty tables give empty results; texts shorter than the window lose nothing.
Only the two named columns are read, so other columns of any name do not matter. A text is held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from . import vec
from .common import Scratch, slices

ROUNDS = 4
#: Rounds that also name runs; a run needs both neighbours to be known, so these cost range.
RUN_ROUNDS = (0,)
#: Bytes of text in a chunk, names in a bucket, and chunks in a group.
CHUNK, BUCKET, FAN = 1 << 19, 1 << 20, 4096
U = np.uint64


def _name_runs(sym: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    head = np.ones(len(sym), bool)
    head[1:] = (sym[1:] != sym[:-1]) | (sym[1:] == 0)
    at = np.flatnonzero(head)
    size = np.diff(at, append=len(sym))
    out = sym[at].copy()
    long = size > 1
    out[long] = vec.mix(out[long] + size[long].astype(U) * U(0x9FB21C651E98DF25), salt)
    before, after = np.maximum(at - 1, 0), np.minimum(at + size, len(sym) - 1)
    mark = sym[at] == 0
    return out, np.where(mark, lo[at], lo[before]), np.where(mark, hi[at], hi[after])


def _name_pairs(sym: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word, opens = sym != 0, (vec.mix(sym, salt) >> U(63)).astype(bool)
    opens &= word
    closes = word & ~opens
    pair = np.zeros(len(sym), bool)
    pair[:-1] = opens[:-1] & closes[1:]
    second = np.zeros(len(sym), bool)
    second[1:] = pair[:-1]
    out, new_lo, new_hi = sym.copy(), lo.copy(), hi.copy()
    i = np.flatnonzero(pair)
    out[i] = vec.mix(sym[i] * U(0xD1342543DE82EF95) + sym[i + 1], salt + 1)
    new_hi[i] = hi[i + 1]
    i = np.flatnonzero(opens & ~pair)
    new_hi[i] = hi[np.minimum(i + 1, len(sym) - 1)]
    i = np.flatnonzero(closes & ~second)
    new_lo[i] = lo[np.maximum(i - 1, 0)]
    keep = ~second
    return out[keep], new_lo[keep], new_hi[keep]


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The place of the (first) minimum of values[first:last] for every pair, by doubling."""
    out, reach, best = first.copy(), 1, np.arange(len(values))
    span = last - first
    while reach <= span.max(initial=0):
        here = (span >= reach) & (span < 2 * reach)
        x, y = best[first[here]], best[last[here] - reach]
        out[here] = np.where(values[x] <= values[y], x, y)
        x, y = best[: len(best) - reach], best[reach:]
        best = np.where(values[x] <= values[y], x, y)
        reach *= 2
    return out


class Windows:
    """The windows of a batch of texts, with their anchors."""

    def __init__(self, col: pa.Array, window: int):
        self.data, self.offsets = vec.utf8(col)
        self.starts, self.ends, self.before = vec.words(self.data, self.offsets)
        counts = np.diff(self.before)
        names, self.other = vec.wide_names(self.data, self.starts, self.ends)
        names[names == 0] = U(1)
        rows = np.repeat(np.arange(len(counts)), counts)
        # Token positions have a separator (symbol 0) before, between and after the rows.
        tokens = np.zeros(len(names) + len(counts) + 1, U)
        tokens[np.arange(len(names)) + rows + 1] = names
        room = np.maximum(counts - window + 1, 0)
        self.first = vec.ragged(self.before[:-1], room)  # the word that each window starts with
        at = self.first + np.repeat(np.arange(len(counts)), room) + 1
        self.names, self.window = names, window
        self.anchors, self.occurrences = self._anchors(tokens, at)

    def _anchors(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name of each window's anchor, and which occurrence of that name it is."""
        place = np.arange(len(tokens), dtype=np.int32)
        levels = [(tokens, place, place + 1)]
        if len(at):
            for r in range(ROUNDS):
                level = levels[-1]
                if r in RUN_ROUNDS:
                    level = _name_runs(*level, salt=3 * r + 1)
                levels.append(_name_pairs(*level, salt=3 * r + 2))
        spans = vec.Spans(tokens)
        anchors, occurrences, open_ = np.zeros(len(at), U), np.zeros(len(at), np.int64), np.arange(len(at))
        for r in range(len(levels) - 1, -1, -1):
            sym, lo, hi = levels[r]
            first = np.searchsorted(lo, at[open_])
            last = np.searchsorted(hi, at[open_] + self.window, side="right")
            fits = first < last
            names, short = np.zeros(len(sym), U), hi - lo <= self.window  # longer ranges lie in no window
            names[short] = spans.names(lo[short], hi[short], 100 + r)
            i = _least(names, first[fits], last[fits])
            anchors[open_[fits]], occurrences[open_[fits]] = names[i], (np.int64(r) << 40) | i
            open_ = open_[~fits]
        return anchors, occurrences

    def marks(self) -> np.ndarray:
        """An anchor name for each occurrence."""
        _, one = np.unique(self.occurrences, return_index=True)
        return self.anchors[one]

    def sequences(self, which: np.ndarray) -> np.ndarray:
        """Two names of the whole word sequence of each window."""
        first = self.first[which]
        return np.column_stack([vec.span_names(lane, first, first + self.window, salt) for lane, salt in ((self.names, 7), (self.other, 8))])


def distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names (rows of one or two columns), whether each occurs more than once, and the place of every
    input among them."""
    order = np.lexsort(names.T[::-1])
    ranked = names[order]
    new = np.ones(len(names), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(names), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ranked[first], np.diff(first, append=len(names)) > 1, place


_NAMES = "chunk long, names binary, again binary"


def _names_batch(chunk: int, names: np.ndarray, payload: tuple[bytes, int] | None = None) -> pa.RecordBatch:
    found, again, _ = distinct(names)
    cols = {"chunk": pa.array([chunk], pa.int64())}
    if payload is not None:
        cols |= {"payload": pa.array(payload[:1], pa.binary()), "n_windows": pa.array(payload[1:], pa.int64())}
    return pa.RecordBatch.from_pydict(cols | {"names": pa.array([found.tobytes()], pa.binary()), "again": pa.array([np.packbits(again).tobytes()], pa.binary())})


def _mark_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", CHUNK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], schema=batch.schema))
            found = Windows(batch.column(1), window)
            yield _names_batch(chunk, found.marks()[:, None], (sink.getvalue().to_pybytes(), len(found.first)))
            chunk += 1

    return run


def _sent(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of names: the sorted distinct names, whether each occurs more than once in all, and every entry's place."""
    names = np.frombuffer(b"".join(table["names"].to_pylist()), U).reshape(-1, width)
    sizes = [len(x) // (8 * width) for x in table["names"].to_pylist()]
    again = [np.unpackbits(np.frombuffer(x, np.uint8))[:n] for x, n in zip(table["again"].to_pylist(), sizes, strict=True)]
    found, more, place = distinct(names)
    more |= np.bincount(place, np.concatenate(again), len(found)) > 0
    return found, more, place


def _answers(table: pa.Table, bits: np.ndarray, width: int) -> pa.Table:
    """A row for each row of names, with a bit for each name."""
    sizes = np.array([len(x) // (8 * width) for x in table["names"].to_pylist()], np.int64)
    cut = [np.packbits(x).tobytes() for x in np.split(bits, np.cumsum(sizes)[:-1])]
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "n": pa.array(sizes, pa.int32()), "bits": pa.array(cut, pa.binary())})


def shared_names(marks: DataFrame, n_names: int, n_chunks: int, scratch: Scratch, width: int) -> DataFrame:
    """For every chunk and bucket of its names: a bit for each, set if the name occurs elsewhere too."""
    bits = max(0, int(np.ceil(np.log2(max(1, n_names / BUCKET)))))
    n_groups = -(-n_chunks // FAN)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = np.frombuffer(row["names"], U).reshape(-1, width)
                again = np.unpackbits(np.frombuffer(row["again"], np.uint8))[: len(names)]
                bucket = (names[:, 0] >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
                at = np.searchsorted(bucket, np.arange((1 << bits) + 1)) if bits < 12 else np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
                cut = [(int(bucket[x]), slice(x, y)) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) if x < y]
                group = int(vec.mix(np.array([row["chunk"]], np.int64).view(U))[0] % U(max(1, n_groups)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b for b, _ in cut], pa.int32()),
                        "part": pa.array([group] * len(cut), pa.int32()),
                        "chunk": pa.array([row["chunk"]] * len(cut), pa.int64()),
                        "names": pa.array([names[s].tobytes() for _, s in cut], pa.binary()),
                        "again": pa.array([np.packbits(again[s]).tobytes() for _, s in cut], pa.binary()),
                    }
                )

    def answer(group: pa.Table) -> pa.Table:
        _, more, place = _sent(group, width)
        return _answers(group, more[place], width)

    def condense(group: pa.Table) -> pa.Table:
        found, more, _ = _sent(group, width)
        sent = {"names": pa.array([found.tobytes()], pa.binary()), "again": pa.array([np.packbits(more).tobytes()], pa.binary())}
        return pa.table({"bucket": group["bucket"][:1], "chunk": group["part"][:1].cast(pa.int64())} | sent)

    def spread(group: pa.Table, told: pa.Table) -> pa.Table:
        _, more, place = _sent(group, width)
        whole = np.unpackbits(np.frombuffer(told["bits"][0].as_py(), np.uint8))[: len(more)].astype(bool)
        return _answers(group, whole[place], width)

    kind = "chunk long, bucket int, n int, bits binary"
    dealt = marks.select("chunk", "names", "again").mapInArrow(deal, "bucket int, part int, chunk long, names binary, again binary")
    if n_groups <= 1:
        return dealt.groupBy("bucket").applyInArrow(answer, kind)
    dealt = scratch.cut(dealt, f"dealt{width}")
    groups = dealt.groupBy("bucket", "part").applyInArrow(condense, "bucket int, chunk long, names binary, again binary")
    told = groups.groupBy("bucket").applyInArrow(answer, kind).select("bucket", F.col("chunk").cast("int").alias("part"), "bits")
    return dealt.groupBy("bucket", "part").cogroup(told.groupBy("bucket", "part")).applyInArrow(spread, kind)


def _replies(shared: DataFrame, name: str) -> DataFrame:
    return shared.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "bits"))).alias(name))


def _bits(reply: list | None) -> np.ndarray:
    if not reply:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: r["n"]] for r in reply]).astype(bool)


def _unpack(payload: bytes) -> pa.RecordBatch:
    batches = list(pa.ipc.open_stream(payload))
    return batches[0]


def _candidates(row: dict, window: int) -> tuple[pa.RecordBatch, Windows, np.ndarray]:
    batch = _unpack(row["payload"])
    found = Windows(batch.column(1), window)
    _, _, place = distinct(found.anchors[:, None])
    bits = _bits(row["anchors"])
    return batch, found, np.flatnonzero(bits[place]) if len(place) else np.zeros(0, np.int64)


def _verify(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                _, found, which = _candidates(row, window)
                yield _names_batch(row["chunk"], found.sequences(which))

    return run


def _remove(window: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                docs, found, which = _candidates(row, window)
                _, _, place = distinct(found.sequences(which))
                bits = _bits(row["sequences"])
                first = found.first[which[bits[place]]] if len(place) else np.zeros(0, np.int64)
                change = np.zeros(len(found.names) + 1, np.int32)
                np.add.at(change, first, 1)
                np.add.at(change, first + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                yield _result(docs, found, gone, id_type)

    return run


def _result(docs: pa.RecordBatch, found: Windows, gone: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
    texts, spans, before = [], [], found.before
    total = np.concatenate([[0], np.cumsum(gone)])
    raw = found.data.tobytes()
    for k in range(docs.num_rows):
        a, b = before[k], before[k + 1]
        ws = raw[found.offsets[k] : found.offsets[k + 1]].split()
        if total[b] == total[a]:
            spans.append([])
        else:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
            keep = ~gone[a:b]
            ws = [w for w, k_ in zip(ws, keep.tolist(), strict=True) if k_]
        texts.append(b" ".join(ws).decode())
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [
            docs.column(0).cast(id_type),
            pa.array(np.diff(before), pa.int64()),
            pa.array(total[before[1:]] - total[before[:-1]], pa.int64()),
            pa.array(texts, pa.string()),
            pa.array(spans, kind),
        ],
        names=["doc_id", "n_words", "n_removed", "text", "removed"],
    )


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, text (the words that stay, joined by one space), removed (word ranges)."""
    from pyspark.sql.pandas.types import to_arrow_type

    scratch = Scratch(docs.sparkSession, "substring")
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_field = own.schema["doc_id"]
    chunks = scratch.cut(own.mapInArrow(_mark_anchors(window), "chunk long, payload binary, n_windows long, names binary, again binary"), "chunks")
    sizes = F.coalesce(F.sum(F.octet_length("names") / 8), F.lit(0)), F.coalesce(F.sum("n_windows"), F.lit(0)), F.count(F.lit(1))
    n_anchors, n_windows, n_chunks = chunks.agg(*sizes).first()
    anchors = _replies(shared_names(chunks, n_anchors, n_chunks, scratch, 1), "anchors")
    armed = chunks.select("chunk", "payload").join(anchors, "chunk", "left")
    marks = armed.mapInArrow(_verify(window), _NAMES)
    sequences = _replies(shared_names(marks, n_windows, n_chunks, scratch, 2), "sequences")
    out = StructType(
        [
            StructField("doc_id", id_field.dataType),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("text", StringType()),
            StructField("removed", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
        ]
    )
    return armed.join(sequences, "chunk", "left").mapInArrow(_remove(window, to_arrow_type(id_field.dataType)), out)
