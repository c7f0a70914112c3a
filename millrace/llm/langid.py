"""Language identification by segmentation-marginalised unigrams.

Over the pieces of a fixed public vocabulary each language has a unigram distribution. The probability of a word
is the sum over all its segmentations into pieces of the product of their probabilities, by the forward
algorithm; a text's score is the product over its words (lower-cased runs of letters, with the vocabulary's word mark
before each). Distributions are learned by expectation maximisation, with the forward-backward algorithm, on word counts
of a bounded sample, one task for each language.

All lower-case letter pieces of the vocabulary count, however long, and runs of letters of any length are summed whole: the
sums are scaled as they go, so nothing underflows. A word's probability depends on the word alone, so a task computes it
once for each distinct word it meets (a cache of bounded size) and adds the logarithms over whole texts.

Bounds (for learning only): `max_docs` documents a language, least hash first, and runs cut at LEARN_RUN letters. Every
language is learned; the model has a row for each and grows with nothing else.

Nulls: a text that is null or has no letter is `und` with score 0; null languages do not train; null ids belong to the fold of the
empty string and do not train. Ties go to the language that sorts first. Repeated rows count each time. With nothing learned all is
`und`. Empty tables give empty results. Columns of the input keep their names; an added column whose name is taken has
more underscores in front (`added_names`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from . import vec
from .common import Scratch, fresh, slices
from .quality import held_out

#: Rounds of learning, counts added to every piece, and letters of a run that learning keeps together.
ROUNDS, ADDED, LEARN_RUN = 3, 0.05, 64
#: Numbers that a worker keeps for words it has met, and that one step of the forward sums holds.
CACHE, CELLS = 1_200_000, 1 << 20
#: Steps between scalings of the forward sums: a step loses some 1e-9 at most, and a piece has at most a few dozen letters.
SCALING = 8
#: Samples of up to this many documents, and as many languages, are broadcast; more are joined by shuffle.
BROADCAST_DOCS = 1_000_000
MARK = 0x2581
U = np.uint64


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter, its lower case, its name."""
    letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            letter[c] = True
            if len(low := ch.lower()) == 1:
                lower[c] = ord(low)
    return letter, lower, vec.mix(np.arange(0x110000, dtype=U), 61)


def _onward(suffix: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Names of suffixes with one more character in front."""
    return vec.mix((suffix * U(0xD1342543DE82EF95)) ^ char, 62)


class Pieces:
    """The lower-case letter pieces of a public vocabulary, found by their names from the last character on."""

    def __init__(self, strings: list[str]):
        self.size, self.longest = len(strings), max(map(len, strings))
        chars = np.zeros((self.size, self.longest), np.int64)  # from the last character on
        for i, piece in enumerate(strings):
            chars[i, : len(piece)] = [ord(c) for c in reversed(piece)]
        length, suffix, ends = np.array([len(p) for p in strings]), np.zeros(self.size, U), []
        for k in range(self.longest):
            live = length > k
            suffix[live] = _onward(suffix[live], _tables()[2][chars[live, k]])
            ends.append(suffix[live])
        self.index = {piece: i for i, piece in enumerate(strings)}
        self.ids = np.argsort(suffix)
        self.names = suffix[self.ids]
        # A bit for each name of a piece, and for each name of an end of a piece.
        self.is_piece, self.is_end = np.zeros(1 << 22, bool), np.zeros(1 << 22, bool)
        self.is_piece[self.names >> U(42)] = True
        self.is_end[np.concatenate(ends) >> U(42)] = True

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the names are pieces, and the pieces."""
        maybe = np.flatnonzero(self.is_piece[names >> U(42)])
        at = np.minimum(np.searchsorted(self.names, names[maybe]), len(self.names) - 1)
        same = self.names[at] == names[maybe]
        return maybe[same], self.ids[at[same]]

    def ending(self, chars: np.ndarray, j: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, rows, pieces) of the pieces that end before position j of the given rows of character names. A single
        character that is no piece is `size`, the unknown one."""
        suffix = np.zeros(len(rows), U)
        for k in range(1, min(self.longest, j) + 1):
            suffix = _onward(suffix, chars[rows, j - k])
            hit, piece = self.find(suffix)
            if k == 1:
                every = np.full(len(rows), self.size, np.int64)
                every[hit] = piece
                yield k, rows, every
            elif len(hit):
                yield k, rows[hit], piece
            more = self.is_end[suffix >> U(42)]
            rows, suffix = rows[more], suffix[more]
            if not len(rows):
                return


@lru_cache(2)
def vocabulary(name: str) -> Pieces:
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return Pieces(sorted(p for p in pieces if p == p.lower() and (p.replace(chr(MARK), "", 1) or "a").isalpha() and chr(MARK) not in p[1:]))


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points, starts and ends of the runs of letters, and how many stand before each text."""
    letter, lower, _ = _tables()
    cp, offsets = vec.code_points(texts)
    inside = np.zeros(len(cp) + 2, bool)
    inside[1:-1] = letter[cp]
    first, last = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(cp))]
    cut = cut[inside[cut] & inside[cut + 1]]
    first[cut] = last[cut] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return lower[cp], starts, ends, np.searchsorted(starts, offsets)


def _char_names(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word the names of its mark and its letters."""
    chars = np.full((len(starts), int((ends - starts).max(initial=0)) + 1), MARK, np.uint32)
    word = np.repeat(np.arange(len(starts)), ends - starts)
    chars[word, vec.ragged(np.ones(len(starts), np.int64), ends - starts)] = cp[vec.ragged(starts, ends - starts)]
    return _tables()[2][chars]


def _by_length(size: np.ndarray, wide: int) -> Iterator[np.ndarray]:
    """Words in order of length, as many at once as fit CELLS; `wide` numbers for each word."""
    order, at = np.argsort(size, kind="stable"), 0
    while at < len(order):
        take = int(np.clip(CELLS * 4 // max(1, wide), 1, 4096))
        while take > 1 and take * int(size[order[min(at + take, len(order)) - 1]]) > CELLS:
            take //= 2
        yield order[at : at + take]
        at += take


def word_logs(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Logarithms of the sums over all segmentations, words x languages; table: pieces (the unknown one last) x languages."""
    out = np.zeros((len(starts), table.shape[1]))
    room = pieces.longest + 1
    for some in _by_length(ends - starts + 1, room * table.shape[1]):
        chars, length = _char_names(cp, starts[some], ends[some]), (ends - starts)[some] + 1
        # The sums of the last positions, scaled for each word and language.
        ring, scale = np.zeros((room, len(some), table.shape[1])), np.zeros((len(some), table.shape[1]))
        ring[0] = 1
        for j in range(1, chars.shape[1] + 1):
            low = int(np.searchsorted(length, j))  # shorter words are done
            new = ring[j % room]
            new[low:] = 0
            for k, rows, piece in pieces.ending(chars, j, np.arange(low, len(some))):
                new[rows] += ring[(j - k) % room][rows] * table[piece]
            high = int(np.searchsorted(length, j, side="right"))
            if low < high:
                out[some[low:high]] = np.log(new[low:high]) + scale[low:high]
            if j % SCALING == 0 and high < len(some):
                most = ring[:, high:].max(axis=0)
                ring[:, high:] /= most
                scale[high:] += np.log(most)
    return out


def estimate(words: list[str], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation, the unknown character last; sums in logarithms."""
    cp, offsets = vec.code_points(words)
    starts, ends = offsets[:-1], offsets[1:]
    probs = np.full(pieces.size + 1, 1.0 / (pieces.size + 1))
    for _ in range(ROUNDS):
        seen, lp = np.full(len(probs), ADDED), np.log(probs)
        for some in _by_length(ends - starts + 1, 64 * pieces.longest):
            chars, length = _char_names(cp, starts[some], ends[some]), (ends - starts)[some] + 1
            width = chars.shape[1]
            arcs = [(j, *arc) for j in range(1, width + 1) for arc in pieces.ending(chars, j, np.arange(np.searchsorted(length, j), len(some)))]
            alpha, beta = np.full((width + 1, len(some)), -np.inf), np.full((width + 1, len(some)), -np.inf)
            alpha[0] = 0
            beta[length, np.arange(len(some))] = 0
            for j, k, rows, piece in arcs:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[j - k, rows] + lp[piece])
            for j, k, rows, piece in reversed(arcs):
                beta[j - k, rows] = np.logaddexp(beta[j - k, rows], beta[j, rows] + lp[piece])
            total = np.log(counts[some]) - beta[0]
            for j, k, rows, piece in arcs:
                seen += np.bincount(piece, np.exp(alpha[j - k, rows] + lp[piece] + beta[j, rows] + total[rows]), len(seen))
        probs = seen / seen.sum()
    return probs


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cp, starts, ends, _ = runs([text or ""])
            low = "".join(map(chr, cp.tolist()))
            words = [low[i : min(i + LEARN_RUN, b)] for a, b in zip(starts.tolist(), ends.tolist(), strict=True) for i in range(a, b, LEARN_RUN)]
            found, n = np.unique(np.array(words, object).astype(str), return_counts=True) if words else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(map(str, found)), pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, vocab: str, max_docs: int) -> tuple[list[str], np.ndarray]:
    """All languages of the training fold, and their piece probabilities."""
    id_, lang = F.col(f"`{id_col}`"), F.col(f"`{lang_col}`").cast("string")
    known = docs.where(~held_out(id_) & lang.isNotNull()).select(id_.alias("id"), lang.alias("lang"), F.xxhash64(id_).alias("h"))
    langs = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    scratch = Scratch(docs.sparkSession, "language")
    langs = scratch.cut(langs.select("lang", F.greatest(F.lit(1), F.floor(F.col("n") / (2 * max_docs))).cast("long").alias("span")), "langs")
    if langs.limit(BROADCAST_DOCS + 1).count() <= BROADCAST_DOCS:
        langs = F.broadcast(langs)  # else all rows would meet by language before the threshold
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    # A hash threshold leaves about twice the documents asked for, so that the ranks have a bounded input at any size.
    spread = known.join(langs, "lang").where(F.pmod("h", "span") == 0)
    sample = scratch.cut(spread.withColumn("nth", nth).where(F.col("nth") <= max_docs).select("id", "lang").distinct(), "sample")
    few = sample.limit(BROADCAST_DOCS + 1).count() <= BROADCAST_DOCS

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        probs = estimate(group["word"].to_pylist(), group["n"].to_numpy().astype(float), vocabulary(vocab))
        return pa.table({"lang": group["lang"][:1], "probs": pa.array([probs.tobytes()], pa.binary())})

    texts = docs.select(id_.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))
    counted = texts.join(F.broadcast(sample) if few else sample, ["id", "lang"]).select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    models = sorted(counted.groupBy("lang").applyInArrow(fit, "lang string, probs binary").collect())  # a row for each language
    return [r.lang for r in models], np.array([np.frombuffer(r.probs) for r in models])


class Scorer:
    """Sums of word scores over texts, with a cache of the words met."""

    def __init__(self, langs: list[str], probs: np.ndarray, vocab: str):
        self.langs, self.pieces = langs, vocabulary(vocab)
        self.table = np.ascontiguousarray(probs.T)
        self.at: dict[int, int] = {}
        self.logs = np.zeros((0, len(langs)))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of the texts by language, and their numbers of words."""
        cp, starts, ends, before = runs(texts)
        names = vec.byte_names(cp.view(np.uint8), 4 * starts, 4 * ends)[0]
        found, one, place = np.unique(names, return_index=True, return_inverse=True)
        if len(self.at) * len(self.langs) > CACHE:
            self.at, self.logs = {}, self.logs[:0]
        known = found.tolist()
        new = np.array([i for i, x in enumerate(known) if x not in self.at], np.int64)
        if len(new):
            for i, o in enumerate(new.tolist(), len(self.logs)):
                self.at[known[o]] = i
            self.logs = np.concatenate([self.logs, word_logs(cp, starts[one[new]], ends[one[new]], self.table, self.pieces)])
        rows = self.logs[np.fromiter(map(self.at.__getitem__, known), np.int64, len(known))]
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(rows[place], axis=0)])
        return sums[before[1:]] - sums[before[:-1]], np.diff(before)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        logs, n = self.scores(texts)
        best = logs.argmax(axis=1)
        share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if k else "und" for b, k in zip(best, n, strict=True)], np.where(n > 0, share, 0.0).tolist()


_scorers: dict[int, Scorer] = {}


def added_names(docs: DataFrame) -> list[str]:
    """What `identify` calls its columns __lang_pred and __score beside those of `docs`."""
    return fresh(docs.columns, "__lang_pred", "__score")


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    vocab: str = "piece_bpe_32k.model",
    max_docs: int = 500,
) -> DataFrame:
    """The columns of `docs` with __lang_pred and __score; learns from `docs` unless given a model."""
    langs, probs = model or learn(docs, id_col, text_col, lang_col, vocab, max_docs)
    shared = docs.sparkSession.sparkContext.broadcast((langs, probs))  # languages x pieces, whatever the corpus
    key, added = shared._jbroadcast.id(), added_names(docs)
    # Sums are languages wide: the more of them, the fewer texts at once.
    limit = max(1 << 14, (1 << 22) // max(8, len(langs)))

    # Numbered inside, so that no name of the input matters.
    names = [f"c{i}" for i in range(len(docs.columns) + 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (scorer := _scorers.get(key)) is None:
            _scorers.clear()
            scorer = _scorers[key] = Scorer(*shared.value, vocab)
        for batch in batches:
            for part in slices(iter([batch]), "text", limit):
                pred, score = scorer.predict([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=names)

    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=False)], F.col(f"`{text_col}`").cast("string").alias("text"))
    out = StructType([*own.schema.fields[:-1], StructField(names[-2], StringType()), StructField(names[-1], DoubleType())])
    return own.mapInArrow(run, out).toDF(*docs.columns, *added)
