"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A text's tokens are its runs of letters and digits and its runs of other visible characters; capitals and lower case
fall together, but runs of two capitals or more share a few names. Each distinct token and pair of neighbouring
tokens is a feature, and so are a pair of equal tokens and one with a token between, whatever they are; features are hashed to 2**bits places, with the value log(1 + count), and a text's values are scaled to unit length.
A score is the logistic function of the sparse dot product with the learned weights.

Training (FTRL-Proximal) runs at the driver over at most `max_rows` labelled rows, those of least hash of the
identifier, and of these over as many, in that order, as have `max_bytes` of text together; these bounds are parameters and
the only sampling. Scoring reads whole texts of all rows.

Nulls and empty texts have no features and score the bias alone. Null ids belong to the fold of the empty string. Rows with null labels
do not train. Repeated rows count each time. Without any labelled row all scores are one half. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import vec
from .common import slices

BITS = 20
#: FTRL-Proximal: learning rate, its offset, and the two regularisers; passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.5, 4
U = np.uint64
# Byte classes: 0 white space, 1 letters and digits (and all bytes beyond ASCII), 2 other characters.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_ECHO = [int(x) for x in vec.mix(np.arange(2, dtype=U), 45) >> U(64 - BITS)]
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all tokens and how many stand before each row (with the total)."""
    if not len(data):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    kind = _CLASS[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    word = kind[starts] > 0
    starts, ends = starts[word], ends[word]
    names = vec.word_names(data, starts, ends, lower=True)
    capital = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    shout = (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
    names[shout] = vec.mix(names[shout] & U(7), 41)
    return names, np.searchsorted(starts, offsets)


def feature_rows(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its feature places and values."""
    names, before = tokens(*vec.utf8(col))
    single = (vec.mix(names, 43) >> U(64 - BITS)).astype(np.int64)
    double = (vec.mix(names[:-1] * U(0xD1342543DE82EF95) + names[1:], 44) >> U(64 - BITS)).astype(np.int64)
    echo = [names[d:] == names[:-d] if len(names) > d else np.zeros(0, bool) for d in (1, 2)]
    rows = []
    for a, b in zip(before[:-1], before[1:], strict=True):
        again = [np.full(int(echo[d - 1][a : max(a, b - d)].sum()), _ECHO[d - 1]) for d in (1, 2)]
        place, count = np.unique(np.concatenate([single[a:b], double[a : max(a, b - 1)], *again]), return_counts=True)
        value = np.log1p(count)
        rows.append((place, value / max(1e-9, float(np.sqrt((value**2).sum())))))
    return rows


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-max(-35.0, min(35.0, x)))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-Proximal."""
    size = (1 << BITS) + 1  # the last place is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.Generator(np.random.PCG64(11))
    for _ in range(EPOCHS if rows else 0):
        for i in order.permutation(len(rows)):
            place, value = np.append(rows[i][0], size - 1), np.append(rows[i][1], 1.0)
            w = weights(place)
            g = (logistic(float(w @ value)) - labels[i]) * value
            z[place] += g - (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / ALPHA * w
            n[place] += g * g
    final = weights(np.arange(size))
    return final[:-1].astype(np.float32), float(final[-1])


def held_out(id_: Column) -> Column:
    """The fold that never trains: crc32 of the identifier as text is divisible by 5."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int, max_bytes: int) -> tuple[np.ndarray, float]:
    """Learn from labelled rows of the training fold; `labels` has the id and `label` (0 or 1)."""
    known = labels.where(F.col("label").isNotNull() & ~held_out(F.col(f"`{id_col}`"))).select(F.col(f"`{id_col}`").alias("__id"), F.col("label").cast("int").alias("label"))
    # A hash threshold leaves about twice the rows asked for, so that the sort has a bounded input at any size.
    span = max(1, known.count() // (2 * max_rows))
    spread = known.withColumn("h", F.xxhash64("__id")).where(F.pmod("h", F.lit(span)) == 0)
    sample = spread.orderBy("h", "__id", "label").limit(max_rows).select("__id", "label")
    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = feature_rows(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p.astype(np.int32).tobytes() for p, _ in rows], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary()),
                ],
                names=["label", "places", "values"],
            )

    found = texts.join(F.broadcast(sample), "__id").select("label", "text", F.xxhash64("__id").alias("h"))
    # Sizes of at most max_rows rows (and their repetitions) meet in one window; texts do not.
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    upto = F.sum("size").over(Window.orderBy("h").rangeBetween(Window.unboundedPreceding, 0))
    fits = texts.join(F.broadcast(sample), "__id").select(F.xxhash64("__id").alias("h"), size.alias("size")).withColumn("upto", upto)
    last = fits.where(F.col("upto") <= max_bytes).agg(F.max("h")).first()[0]
    found = found.where(F.col("h") <= F.lit(last).cast("long"))
    # Sorted, so that the updates come in the same order on every run.
    got = found.repartition("h").sortWithinPartitions("h").select("label", "text").mapInArrow(featurise, "label int, places binary, values binary").toArrow()
    rows = sorted(zip(got["places"].to_pylist(), got["values"].to_pylist(), got["label"].to_pylist(), strict=True))
    return train([(np.frombuffer(p, np.int32), np.frombuffer(v, np.float32).astype(float)) for p, v, _ in rows], [y for _, _, y in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in slices(batches, "text"):
            scores = [logistic(bias + float(weights[p] @ v)) for p, v in feature_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.mapInArrow(run, StructType([own.schema["doc_id"], StructField("score", DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.3, max_rows: int = 6_000, max_bytes: int = 1 << 26) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels, id_col, text_col, max_rows, max_bytes), id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
