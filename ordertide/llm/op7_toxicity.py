"""Operator 7: toxicity by FTRL-proximal logistic regression.

Features are hashed word n-grams (one and two words), skip-grams (two words
with one or two words between them) and the beginnings of words (``STEMS``
bytes, which inflected forms share), each counted once per document, so the
score does not fade with a text's length.  Training keeps per-coordinate
learning rates and L1 sparsity (FTRL-proximal), a document's features that no
other one has being one coordinate, since they move together; what is broadcast for scoring
are the non-zero weights only.

Training rows: labelled documents, at most ``MAX_TOXIC`` toxic and
``MAX_CLEAN`` others, chosen by a hash of doc_id (the documented bound of the
sample; fewer rows are all used).  Where a bound binds, the intercept is
corrected by the log ratio of all labels' class shares to the sample's, so a
score does not depend on how many rows were left out.  Every feature of the
sample takes part, L1 alone decides which stay.  Scoring covers all rows and
whole texts.

Defined results: a null or empty text has no feature and scores the intercept;
very long texts are hashed whole, piece by piece; rows without a label or
doc_id are not trained on; with conflicting labels of one doc_id toxic wins;
an empty table gives an empty result; without any training rows of both classes every score
is the smoothed share of toxic labels; repeated rows are scored alike.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C
from ordertide.llm.words import PUNCTUATION, mix, word_hashes

MAX_TOXIC, MAX_CLEAN = 2500, 5000
STEMS = (5, 7)  # bytes of the beginnings of words
BITS = 31  # hash space of the features
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 6.0, 0.0, 8


class Weights(NamedTuple):
    features: np.ndarray  # sorted hashes (int32)
    values: np.ndarray  # float32
    intercept: float


_INSIDE = b"[^" + re.escape(np.flatnonzero(PUNCTUATION).astype(np.uint8).tobytes()) + b"]"
_BEGINNING = {k: re.compile(b"(%s{%d})%s+" % (_INSIDE, k, _INSIDE)) for k in STEMS}


def features(words: np.ndarray, stems: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """Sorted distinct hashes (int32) of a document's n-grams, skip-grams and
    beginnings of words."""
    kinds = [words, *(mix(s + np.uint64(k)) for k, s in zip(STEMS, stems))]
    for gap in (1, 2, 3):
        if len(words) > gap:
            kinds.append(mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap)) + words[gap:])
    every = mix(np.concatenate(kinds)) >> np.uint64(64 - BITS)
    return np.unique(every.astype(np.int32))


def document_features(texts: list[bytes]) -> Iterator[np.ndarray | None]:
    """The features of every text; None for a text without words."""
    cut = [[_BEGINNING[k].sub(rb"\1", t) for t in texts] for k in STEMS]
    for words, *stems in zip(*(word_hashes(t, PUNCTUATION) for t in (texts, *cut))):
        yield features(words, tuple(stems)) if len(words) else None


def features_of(texts: pa.Array) -> Iterator[np.ndarray | None]:
    """``document_features`` of a column, holding copies of a piece of it."""
    for piece in C.pieces(texts):
        yield from document_features(piece.to_pylist())


def train(rows: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over documents: (features, weights, intercept), the
    weights that L1 leaves at zero left out."""
    every = np.concatenate(rows)
    every.sort()
    starts = np.append(True, every[1:] != every[:-1]) if len(every) else np.empty(0, bool)
    shared = every[starts & ~np.append(starts[1:], True)] if len(every) else every
    del every, starts
    # Features of one document only always move together: they are a single
    # coordinate that counts as often as there are of them.  Coordinate 0 is
    # the intercept, which L1 leaves alone; then come the documents' own
    # features, then the shared ones.
    own, places = np.zeros(len(rows), np.int64), []
    for k, row in enumerate(rows):
        at = np.searchsorted(shared, row)
        known = shared[np.minimum(at, len(shared) - 1)] == row if len(shared) else np.zeros(len(row), bool)
        own[k] = len(row) - np.count_nonzero(known)
        places.append((at[known] + len(rows) + 1).astype(np.int32))
    z, n = np.zeros(len(shared) + len(rows) + 1), np.zeros(len(shared) + len(rows) + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at > 0, L1, 0.0), 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            at = np.append(np.array([0, k + 1], np.int32), places[k])
            w = weight(at)
            total = float(w.sum()) + (int(own[k]) - 1) * float(w[1])
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, total)))) - toxic[k]
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    # Only coordinates beyond L1 have a weight; few of the many do.
    kept = np.flatnonzero((z > L1) | (z < -L1))
    kept = kept[kept > 0]
    values = weight(kept)
    found, weighs = [shared[kept[kept > len(rows)] - len(rows) - 1]], [values[kept > len(rows)]]
    for c, v in zip(kept[kept <= len(rows)], values):
        alone = np.setdiff1d(rows[c - 1], shared, assume_unique=True)
        found.append(alone)
        weighs.append(np.full(len(alone), v))
    hashes, values = np.concatenate(found), np.concatenate(weighs)
    by_hash = np.argsort(hashes)
    by_hash = by_hash[values[by_hash] != 0]
    return hashes[by_hash], values[by_hash], float(weight(np.array([0]))[0])


def _sample(labelled: DataFrame, toxic: int, bound: int) -> DataFrame:
    rows = labelled.filter(F.col("toxic") == toxic)
    return rows.orderBy(F.xxhash64("label_id", F.lit("sample")), "label_id").limit(bound)


def fit(docs: DataFrame, labels: DataFrame) -> Weights:
    """Train on ``labels`` (label_id, toxic) joined to ``docs``."""
    labelled = labels.filter("label_id IS NOT NULL AND toxic IS NOT NULL").groupBy("label_id").agg(F.max("toxic").cast("int").alias("toxic"))
    present = C.cut(labelled)
    rates = {r["toxic"]: r["n"] for r in present.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total1, total0 = rates.get(1, 0), rates.get(0, 0)
    # At most MAX_TOXIC + MAX_CLEAN rows of two numbers are broadcast.
    chosen = C.cut(_sample(present, 1, MAX_TOXIC).unionByName(_sample(present, 0, MAX_CLEAN)))
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(chosen), "label_id").select("label_id", "toxic", F.lower("text").cast("binary").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = np.empty(0, np.int32)
            rows = [(none if f is None else f).tobytes() for f in features_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["label_id", "toxic", "row"])

    def fitted(table: pa.Table) -> pa.Table:
        # The rows stay in the Arrow buffers; distinct ones, in a fixed order.
        classes, rows = table.column("toxic").to_numpy(), []
        for packed in table.column("row").chunks:
            ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            data = packed.buffers()[2]
            rows += [np.frombuffer(data, np.int32, (b - a) // 4, a) if b > a else np.empty(0, np.int32) for a, b in zip(ends[:-1], ends[1:])]
        texts = {(i, hashlib.blake2b(row).digest()): k for k, (i, row) in enumerate(zip(table.column("label_id").to_pylist(), rows))}
        order = [texts[key] for key in sorted(texts)]
        toxic = classes[order]
        if toxic.min() == toxic.max():
            return pa.table({"feature": pa.array([], pa.int64()), "weight": pa.array([], pa.float64())})
        known, values, intercept = train([rows[k] for k in order], toxic)
        return pa.table({"feature": pa.array(np.append(known.astype(np.int64), -1)), "weight": pa.array(np.append(values, intercept))})

    one = texts.mapInArrow(featured, "label_id long, toxic int, row binary").groupBy(F.lit("sample").alias("sample"))
    # The bounded sample is one group; its non-zero weights come back.
    with C.small_batches(docs.sparkSession):
        found = one.applyInArrow(fitted, "feature long, weight double").toPandas().sort_values("feature")
    prior = math.log((total1 + 0.5) / (total0 + 0.5)) if total1 + total0 else -3.0
    if not len(found):
        return Weights(np.empty(0, np.int32), np.empty(0, np.float32), min(prior, -1.0))
    known, values = found["feature"].to_numpy()[1:].astype(np.int32), found["weight"].to_numpy()
    seen1, seen0 = min(total1, MAX_TOXIC), min(total0, MAX_CLEAN)
    corrected = float(values[0]) + math.log(total1 / total0) - math.log(seen1 / seen0)
    return Weights(known, values[1:].astype(np.float32), corrected)


def scorer(spark: SparkSession, weights: Weights):
    """Arrow UDF text -> score; null counts as empty."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        known, values, intercept = shared.value
        seen = np.zeros(1 << 20, bool)  # most features are unknown: one look each
        seen[known & 0xFFFFF] = True
        out = []
        for row in features_of(texts):
            total = intercept
            if row is not None and len(known):
                row = row[seen[row & 0xFFFFF]]
                at = np.minimum(np.searchsorted(known, row), len(known) - 1)
                total += float(values[at[known[at] == row]].sum())
            out.append(1 / (1 + math.exp(-max(-35.0, min(35.0, total)))))
        return pa.array(out, pa.float64())

    return lambda text: score(F.lower(F.coalesce(text, F.lit(""))).cast("binary"))


def is_held_out(doc_id: Column) -> Column:
    """Documents whose label is never learnt: crc32 of the id as text, mod 5
    (an absent id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(~is_held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("label_id"), "toxic")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    weights = fit(docs, training_labels(C.table(spark, sf_dir, "labels")))
    rows = docs.select("doc_id", scorer(spark, weights)(F.col("text")).alias("score"))
    return rows.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic, all columns kept."""
    score = scorer(docs.sparkSession, fit(docs, training_labels(labels)))
    flag = C.fresh(docs.columns, "_score")
    return docs.withColumn(flag, score(F.col("text"))).filter(F.col(flag) < 0.5).select(*docs.columns)
