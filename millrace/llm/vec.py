"""Vectorised text primitives: words, code-point runs and names of spans over whole Arrow batches.

Names are content hashes, so equal spans get equal names in every partition without a dictionary. A name chains
the bijective `mix` over its content, word bytes in blocks of eight and spans in blocks of powers of two, so no
structure of the content survives in it; two lanes of different salts make 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute available)

U = np.uint64
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 256
_LEFT, _RIGHT, _SIZE = U(0xD1342543DE82EF95), U(0x9FB21C651E98DF25), U(0xA0761D6478BD642F)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective avalanche of 64-bit values."""
    x = x ^ U((salt * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & _MASK)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Spans:
    """Names of the spans of a sequence of names. The block of 2**k values at each place is named from its two halves;
    a span is named by the two blocks that cover it and its length."""

    def __init__(self, values: np.ndarray, salt: int = 0):
        self.blocks, self.salt = [mix(values, salt)], salt

    def _block(self, k: int) -> np.ndarray:
        while len(self.blocks) <= k:
            half, last = 1 << (len(self.blocks) - 1), self.blocks[-1]
            self.blocks.append(mix((last[: max(0, len(last) - half)] * _LEFT) ^ (last[half:] * _RIGHT + _SIZE), self.salt))
        return self.blocks[k]

    def names(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        """One name for each values[start:end]; empty spans have one name too."""
        size = (ends - starts).astype(np.int64)
        out = mix(size.astype(U) * _SIZE, salt + 1)
        if not len(size):
            return out
        # The exact binary logarithm: lengths are far below 2**53.
        level = np.where(size > 0, np.frexp(np.maximum(size, 1).astype(float))[1] - 1, -1)
        low, high = int(level.min()), int(level.max())
        for k in range(max(0, low), high + 1):
            at = slice(None) if low == high else np.flatnonzero(level == k)
            block = self._block(k)
            out[at] = mix((block[starts[at]] * _LEFT + block[ends[at] - (1 << k)]) ^ out[at], salt)
        return out


def span_names(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """One name for each span values[start:end]; equal contents of equal length have equal names."""
    return Spans(values, salt).names(starts, ends, salt)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if col.null_count:
        col = pa.compute.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ and how many words stand before each row (with the total)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = inside[1:] != inside[:-1]
    first, last = edge & inside[1:], edge & inside[:-1]
    joints = offsets[1:-1]
    joints = joints[(joints > 0) & (joints < len(data))]
    cut = joints[inside[joints] & inside[joints + 1]]  # a word that would run over into the next row
    first[cut] = last[cut] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def byte_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: tuple[int, ...] = (0,)) -> list[np.ndarray]:
    """For each salt in `lanes` a name of every data[start:end]."""
    size = ends - starts
    out = [mix(size.astype(U) * _SIZE, lane) for lane in lanes]
    if not len(size):
        return out
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    short = size <= LONG_WORD
    left, done = np.flatnonzero(short & (size > 0)), 0
    while len(left):
        rest = size[left] - done
        block = eights[starts[left] + done]
        block &= U(_MASK) >> (U(8) * (8 - np.minimum(rest, 8)).astype(U))
        for lane, names in zip(lanes, out, strict=True):
            names[left] = mix((names[left] * _LEFT) ^ block, lane)
        left, done = left[rest > 8], done + 8
    if not short.all():
        import xxhash

        for i in np.flatnonzero(~short).tolist():
            word = data[starts[i] : ends[i]].tobytes()
            for lane, names in zip(lanes, out, strict=True):
                names[i] = xxhash.xxh3_64_intdigest(word, seed=lane)
    return out


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit names of words."""
    return byte_names(_LOWER[data] if lower else data, starts, ends)[0]


def wide_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> list[np.ndarray]:
    """Two independent names of each word."""
    return byte_names(_LOWER[data] if lower else data, starts, ends, (0, 1))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts and the row offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges start, start + 1, ... of the given counts."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)
