"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Tokens are runs of word characters and runs of marks, case kept.  A
document's features are its hashed token unigrams and bigrams, and the
bigrams of token shapes, each with its share of the document's n-grams; a
token that repeats one of the two before it makes one common feature.  A
score is a sparse dot product put through the logistic function.

Training goes over a bounded sample of the labelled documents, one update of
the touched coordinates a document (FTRL-proximal, per-coordinate rates).
Scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm import tokens
from tiffin.llm.common import in_batches, staged, text_or_empty

#: Documented bound of the training sample, in rows; 2**BITS features.
MAX_TRAIN_ROWS = 6_000
BITS = 18
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
THRESHOLD = 0.3
#: The sum of a document's feature values.
MASS = 40.0


def token_table() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes: 1 word characters, 2 marks, 0 white space and controls."""
    codes = np.arange(256)
    alnum = ((codes >= 48) & (codes <= 57) | (codes >= 65) & (codes <= 90) | (codes >= 97) & (codes <= 122)
             | (codes >= 128))
    return np.where(alnum, 1, np.where((codes > 32) & (codes != 127), 2, 0)).astype(np.uint8), codes.astype(np.uint8)


def _shapes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A small code of each token's kind: first and last byte's kind and length class."""
    codes = np.arange(256)
    kind = np.select([(codes >= 48) & (codes <= 57), (codes >= 65) & (codes <= 90), (codes >= 97) & (codes <= 122),
                      codes >= 128], [1, 2, 3, 3], 4 + codes).astype(np.uint64)
    return (kind[data[start]] * np.uint64(512) + kind[data[start + length - 1]]) * np.uint64(4) + np.minimum(
        np.uint64(3), np.log2(length).astype(np.uint64))


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram of a piece, sorted by row."""
    classes, values = token_table()
    start, length, row = tokens.token_spans(data, offsets, classes)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = tokens.token_hashes(data, values, start, length)
    shape = _shapes(data, start, length)
    pair = row[1:] == row[:-1]
    bigram = tokens.mix(h[:-1] * np.uint64(3) ^ tokens.mix(h[1:]))
    bigram[h[1:] == h[:-1]] = 1
    two_back = (h[2:] == h[:-2])
    bigram[1:][two_back] = 2
    kinds = tokens.mix(shape[:-1] * np.uint64(1 << 20) ^ shape[1:] ^ np.uint64(7 << 50))
    rows = np.concatenate((row, row[1:][pair], row[1:][pair]))
    found = np.concatenate((h, bigram[pair], kinds[pair]))
    order = np.argsort(rows, kind="stable")
    return rows[order], (tokens.mix(found)[order] >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: z and n by feature and an unregularised bias."""

    def __init__(self, bits: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.alpha, self.beta, self.l1, self.l2, self.bias, self.bias_n = alpha, beta, l1, l2, 0.0, 0.0

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One update from distinct features ``at`` with values ``x``."""
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x + self.bias, -30, 30)))
        g = (p - label) * x
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g
        self.bias_n += (p - label) ** 2
        self.bias -= 0.1 * (p - label) / (1.0 + np.sqrt(self.bias_n))


def train(texts: pa.Array, labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights as float32, the bias last; from rows in the given order, shuffled alike every time."""
    rows = []
    for first, end, data, offsets in tokens.pieces(texts):
        row, f = features(data, offsets, bits)
        cut = np.searchsorted(row, np.arange(end - first + 1))
        for i in range(end - first):
            at, n = np.unique(f[cut[i]:cut[i + 1]], return_counts=True)
            rows.append((at.astype(np.int32), (n * (MASS / max(1, n.sum()))).astype(np.float32)))
    model = Ftrl(bits)
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            model.learn(rows[i][0], rows[i][1].astype(np.float64), int(labels[i]))
    return np.append(model.weights(), model.bias).astype(np.float32)


def scores(texts: pa.Array, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Scores in (0, 1) of whole texts; an empty text scores by the bias alone."""
    out = np.zeros(len(texts))
    for first, end, data, offsets in tokens.pieces(texts):
        row, f = features(data, offsets, bits)
        n = np.bincount(row, minlength=end - first)
        out[first:end] = np.bincount(row, weights[f], end - first) * MASS / np.maximum(1, n)
    return 1.0 / (1.0 + np.exp(-np.clip(out + float(weights[-1]), -30, 30)))


# ---- on Spark -----------------------------------------------------------------------------------

def remainder(id_col: Column, of: int) -> Column:
    """crc32 of an id's text modulo ``of``; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % of, F.lit(0))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", folds: int = 5, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled ids outside fold 0, by the order of an id hash: (h, text, label).

    Ids alone are ordered; texts join the chosen ones.  An id with several
    labels takes their rounded mean, null labels and ids are left out.
    """
    l = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
    l = l.where((remainder(F.col("id"), folds) != 0) & F.col("label").isNotNull() & F.col("id").isNotNull())
    l = l.groupBy("id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    have = docs.select(F.col(f"`{id_col}`").alias("have"))
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    chosen = staged(l.join(have, F.col("id") == F.col("have"), "left_semi").orderBy(*order).limit(max_rows),
                    "quality-chosen")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return staged(rows.join(chosen, F.col("doc_id") == F.col("id"))
                  .select(order[0].alias("h"), "id", "text", "label").orderBy("h", "id", "text").limit(max_rows),
                  "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", folds: int = 5, max_rows: int = MAX_TRAIN_ROWS) -> np.ndarray:
    """Weights (2**BITS + 1 floats) learned in one task from the bounded sample; zeros without labels."""
    sample = training_sample(docs, labels, id_col, text_col, label_col, folds, max_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        if rows.num_rows:
            weights = train(rows["text"].combine_chunks(), rows["label"].to_numpy())
            yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()]})
    ordered = sample.repartition(1).sortWithinPartitions("h", "id", "text").select("text", "label")
    learned = ordered.mapInArrow(learn, "weights binary").collect()
    return (np.frombuffer(bytes(learned[0]["weights"]), np.float32) if learned
            else np.zeros((1 << BITS) + 1, np.float32))


def scorer(spark, weights: np.ndarray):
    """A column function: text column -> score.  The weights, 1 MB, are broadcast."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(scores(texts, shared.value))
    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    ``held_out`` marks fold 0, whose labels are never learned; ``predicted``
    is 1 where the score is at least ``threshold``.  Null and empty texts
    score by the bias; without any label every score is 0.5.  Other columns
    are not read.
    """
    score = scorer(in_batches(docs).sparkSession, fit(docs, labels, id_col, text_col, label_col, folds))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), score(text_or_empty(text_col)).alias("score"))
    return rows.select("doc_id", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    score = scorer(in_batches(docs).sparkSession, fit(docs, labels, id_col, text_col, label_col, folds))
    mark = "score"
    while mark in docs.columns:
        mark += "_"
    return docs.withColumn(mark, score(text_or_empty(text_col))).where(F.col(mark) >= threshold).drop(mark)
