"""Operator 5: packing into length buckets that minimise padding.

The global histogram of lengths (words) is aggregated in Spark.  Dynamic
programming over it chooses at most ``buckets`` boundaries so that padding
every document to its bucket's boundary costs the fewest words in total.
Inside a bucket documents, ordered by length and doc_id, are cut into batches
of ``budget // boundary`` documents, so a padded batch stays within the token
budget (a document longer than the budget is a batch of its own, whole).

The histogram that reaches the driver is bounded whatever the data: lengths up
to 4096 are counted singly, longer ones in steps of 1/256 of their power of
two (at most 4096 + 256 * 50 bins); a bin's boundary is its longest document.
The number of a document inside its bucket comes from range-dealt runs, so a
bucket with most rows is spread over many tasks.

Defined results: a null or empty text has length 0; repeated rows are packed
separately; ties are ordered by doc_id; an empty table gives no batch; extra
columns are kept by ``packed_documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C

BUCKETS = 16
BUDGET = 65_536
SINGLE = 12  # lengths below 2^12 have a bin each
STEPS = 8  # longer ones 2^8 bins a power of two


def length_bin(length: Column) -> Column:
    """Monotone bin number of a length."""
    power = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int"), F.lit(SINGLE))
    # The logarithm may round up to the next power; the shift corrects it.
    power = F.when((power > SINGLE) & (F.call_function("shiftleft", F.lit(1).cast("long"), power) > length), power - 1).otherwise(power)
    step = F.call_function("shiftright", length, power - STEPS)
    return F.when(length < (1 << SINGLE), length).otherwise(
        F.lit(1 << SINGLE) + (power - SINGLE).cast("long") * (1 << STEPS) + step - (1 << STEPS)
    )


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest length, documents and words of every bin, in order."""
    rows = (
        lengths.groupBy(length_bin(F.col("length")).alias("bin"))
        .agg(F.max("length").alias("top"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("words"))
        .collect()
    )
    rows.sort(key=lambda r: r["bin"])
    return tuple(np.array([r[c] for r in rows], dtype=np.int64) for c in ("top", "n", "words"))  # type: ignore[return-value]


def boundaries(top: np.ndarray, n: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Boundaries (longest length of each bucket) of least padding.

    cost(i, j) = top[j] * documents(i..j) - words(i..j); the words are the
    same for every choice.  Row by row, least[j] = min over i of
    least_before[i - 1] + cost(i, j), by divide and conquer: the best i grows
    with j.
    """
    m = len(top)
    if not m:
        return []
    buckets = min(buckets, m)
    docs = np.concatenate([[0], np.cumsum(n)]).astype(np.float64)
    tops = top.astype(np.float64)
    least = tops * docs[1:]  # one bucket over bins 0..j
    cuts = [np.zeros(m, np.int64)]
    for _ in range(1, buckets):
        before = np.concatenate([[0.0], least])
        now, cut = np.empty(m), np.zeros(m, np.int64)
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(first, min(mid, last) + 1)
            cost = before[i] + tops[mid] * (docs[mid + 1] - docs[i])
            best = int(np.argmin(cost))
            now[mid], cut[mid] = cost[best], i[best]
            todo += [(lo, mid - 1, first, cut[mid]), (mid + 1, hi, cut[mid], last)]
        least = now
        cuts.append(cut)
    found, j = [], m - 1
    for cut in reversed(cuts):
        found.append(int(top[j]))
        j = int(cut[j]) - 1
        if j < 0:
            break
    return sorted(found)


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per document: doc_id, length, bucket (number), padded_length,
    batch (number inside the bucket), place (inside the batch)."""
    lengths = C.cut(docs.select("doc_id", C.word_count(F.col("text")).alias("length")))
    top, n, _ = histogram(lengths)
    tops = boundaries(top, n, buckets)
    if not tops:
        empty = F.lit(0).cast("long")
        return lengths.select("doc_id", "length", *[empty.alias(c) for c in ("bucket", "padded_length", "batch", "place")])
    edges = F.array(*[F.lit(t).cast("long") for t in tops])  # at most ``buckets`` values
    bucket = F.size(F.filter(edges, lambda t: t < F.col("length"))).cast("long")
    rows = lengths.withColumn("bucket", bucket).withColumn("padded_length", F.element_at(edges, (F.col("bucket") + 1).cast("int")))
    rows = C.ranked(rows, ["bucket"], [F.col("length"), F.col("doc_id")])
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("padded_length", F.lit(1))), F.lit(1))
    number = F.col("rank") - 1
    return rows.select(
        "doc_id", "length", "bucket", "padded_length", F.floor(number / room).alias("batch"), (number % room).cast("long").alias("place")
    )


def batches(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per batch: its documents, words and padded words."""
    rows = pack(docs, buckets, budget)
    return rows.groupBy("bucket", "batch").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("length").alias("words"), F.sum("padded_length").alias("padded_words")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(C.table(spark, sf_dir, "documents"))
