"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Features are hashes of words, word pairs, and runs of up to three word shapes (case, digits,
punctuation, same as the word before), each as its share of the text's n-grams. A score is a sparse dot product.

The model is fitted in one task on a bounded sample: of the labelled rows outside the
held-out third, those with the ``most_rows`` smallest hashes of their id. Scoring is a map over all rows.

Defined results: a null text counts as empty; an empty text has no features and gets the score of the intercept; a null
doc_id is never held out nor learnt from; labels that are null are not learnt from; a doc_id labelled twice takes part
with each of its labels; without any label every score is 0.5; rows repeated give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import binary_parts, pieces, shuffle_partitions, stored, whole_text
from meterlake.llm.word_hashes import LOWER, SPACES, hashes, mixed

BITS = 18
#: Most labelled rows that the model is fitted on.
MOST_ROWS = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 0.01
#: A text's features add up to this in each family.
SCALE = 10.0

# Kinds of bytes: 0 space, 1 part of a word, 2 other.
_KIND = np.full(256, 2, np.uint8)
_KIND[SPACES] = 0
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KIND[_a:_b] = 1
_UPPER, _LOWERCASE, _DIGIT = (np.zeros(256, np.int64) for _ in range(3))
_UPPER[0x41:0x5B] = _LOWERCASE[0x61:0x7B] = _DIGIT[0x30:0x3A] = 1


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and value of each n-gram of each text, and where each text's n-grams start."""
    data, bounds = binary_parts(column)
    texts = len(bounds) - 1
    if not len(data):
        return np.empty(0, np.int64), np.empty(0), np.zeros(texts + 1, np.int64)
    kind = _KIND[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(turn)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    token = hashes(LOWER[data], starts, ends)
    of = np.searchsorted(bounds, starts, "right") - 1
    counts = [np.add.reduceat(x[data], starts) if len(starts) else np.empty(0, np.int64) for x in (_UPPER, _LOWERCASE, _DIGIT)]
    upper, lower, digit = counts
    shape = np.where(kind[starts] == 2, token, ((upper > 1) * 4 + (lower > 0) * 2 + (digit > 0)).astype(np.uint64))
    word = np.flatnonzero(kind[starts] == 1)
    again = word[1:][(token[word[1:]] == token[word[:-1]]) & (of[word[1:]] == of[word[:-1]])]
    shape[again] = np.uint64(99)

    def grams(h: np.ndarray, n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
        m = max(0, len(h) - n + 1)
        out = np.full(m, family, np.uint64)
        for i in range(n):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + m])
        whole = of[:m] == of[n - 1 : n - 1 + m]
        return out[whole], of[:m][whole]

    slots, owners, values = [], [], []
    for h, n, family in ((token, 1, 1), (token, 2, 2), (shape, 1, 3), (shape, 2, 4), (shape, 3, 5)):
        gram, owner = grams(h, n, family)
        slots.append((gram >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(owner)
        values.append(SCALE / np.bincount(owner, minlength=texts)[owner])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(slots)[order], np.concatenate(values)[order], np.searchsorted(owner[order], np.arange(texts + 1))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's slots with their summed values."""
    for batch in pieces(batches, "text"):
        slots, values, first = features(batch.column(2))
        keys, sums = [], []
        for a, b in zip(first[:-1], first[1:], strict=True):
            slot, at = np.unique(slots[a:b], return_inverse=True)
            keys.append(slot.astype(np.int32))
            sums.append(np.bincount(at, values[a:b], len(slot)).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.float32()))],
            names=["place", "label", "slots", "vals"],
        )


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the weights after all epochs, the intercept last."""
    rows = []  # views of the Arrow data, four bytes for each slot and value
    for batch in batches:
        slots, vals = batch.column(2), batch.column(3)
        for i, label in enumerate(batch.column(1).to_pylist()):
            rows.append((float(label), slots[i].values.to_numpy(), vals[i].values.to_numpy()))
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for label, slots, vals in rows:
            at, x = np.append(slots, 1 << BITS), np.append(vals, 1.0)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[at] = ns + g * g
    yield pa.RecordBatch.from_arrays([pa.array([weights(z, n).astype(np.float32).tobytes()], pa.binary())], names=["weights"])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> np.ndarray:
    """The weights: 2**BITS + 1 numbers whatever the input."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    place = F.xxhash64("doc_id")
    chosen = usable.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"), place.alias("place"))
    chosen = stored(spark, chosen.orderBy("place", "id", "label").limit(most_rows), "quality-sample")
    texts = docs.select("doc_id", whole_text().alias("text")).join(chosen, F.col("doc_id") == F.col("id")).select("place", "label", "text")
    examples = texts.mapInArrow(_examples, "place long, label int, slots array<int>, vals array<float>")
    examples = stored(spark, examples, "quality-examples")
    one = examples.orderBy("place", "label", F.xxhash64("slots")).limit(most_rows)
    found = one.coalesce(1).mapInArrow(_fit, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros((1 << BITS) + 1, np.float32)


def scored(spark: SparkSession, docs: DataFrame, weights: np.ndarray, text: str, *carried: str) -> DataFrame:
    """The ``carried`` columns of every row, and the score of its column ``text``, which travels once."""
    held = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for batch in pieces(batches, text):
            slots, values, first = features(batch.column(batch.schema.get_field_index(text)))
            sums = np.concatenate([[0.0], np.cumsum(w[slots] * values)])
            margin = sums[first[1:]] - sums[first[:-1]] + float(w[-1])
            out = pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
            kept = batch.select(list(carried))
            yield pa.RecordBatch.from_arrays([*kept.columns, out], names=[*carried, "score"])

    rows = docs.select(*carried, *([] if text in carried else [text]))
    kinds = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in carried]
    return rows.mapInArrow(score, ", ".join([*kinds, "score double"]))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    out = scored(spark, docs, fit(spark, docs, labels, most_rows), "text", "doc_id")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def good_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """The rows of ``docs`` that the model accepts."""
    weights = fit(spark, docs, labels, most_rows)
    names = [f"c{i}" for i in range(len(docs.columns))]
    good = scored(spark, docs.toDF(*names), weights, names[docs.columns.index("text")], *names).where("score >= 0.5")
    return good.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
