"""Operator 9: near-dedup with HyperMinHash sketches, confirmed on full sets.

A document's set is its distinct word shingles.  Documents link when
100 * |A and B| >= percent * |A or B|; components are the link graph's.

1. Documents with the same set (size and 128-bit set hash) form a class; its
   smallest doc_id represents it, so groups of copies cost one sketch row.
2. Representatives' HyperMinHash registers are banded.  Of the documents that
   share a band key the one with the most neighbours is the key's pivot, and
   every other one is paired with it: one row per document and pivot, never
   all pairs of a key.
3. Pairs whose collision-corrected estimate leaves room for the threshold are
   confirmed on the full shingle sets, recomputed from the whole texts; the
   confirmed links give first components.
4. Two documents of one band key share its pivot, so any link still missing
   joins two first components inside one pivot's cluster.  The documents of
   keys that hold several components are compared exactly, pivot by pivot:
   those outside the pivot's component against all others, in blocks of
   bounded size (a block pair is one task's work; the members of the pivot's
   own component, the bulk of a hot group, are never compared with each
   other).
5. Components of all confirmed links; a class takes its representative's.

Texts are shuffled only for documents that take part in step 3 or 4 (a
fixed-size bitmap drops the others first).  A pair at the threshold is missed
with odds of about 2e-9 (no shared band) plus 1e-9 (estimate).

Defined results: a null or empty text has the empty set and links with
nothing; a text of fewer words than a shingle has its whole sequence as one;
repeated rows with one doc_id are one document (rows that share a doc_id must
share the text); a row without doc_id links with nothing and is kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C
from ordertide.llm import hyperminhash as H
from ordertide.llm.words import mix, shingles, word_hashes

WIDTH, PERCENT = 3, 85  # the registered query's contract
BLOCK_SHINGLES, BLOCK_DOCS = 150_000, 512  # most of one side of a block pair, on average


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def sketch_rows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (set hash), regs (registers)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in C.pieces(whole)):
            n, s1, s2, regs = [], [], [], []
            for words in word_hashes(_texts(batch.column(1))):
                found = shingles(words, width)
                n.append(len(found))
                s1.append(int(mix(found).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0)
                s2.append(int(np.bitwise_xor.reduce(mix(found ^ np.uint64(0xA5A5A5A5))).astype(np.int64)) if len(found) else 0)
                regs.append(H.registers(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(regs, pa.binary())],
                ["doc_id", "n", "s1", "s2", "regs"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(sketch, "doc_id long, n long, s1 long, s2 long, regs binary")


def band_rows(reps: DataFrame) -> DataFrame:
    """(key, id): one row per band of every representative."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in C.pieces(whole)):
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, H.REGISTERS)
            keys = H.band_keys(regs)
            ids = np.repeat(batch.column(0).to_numpy(), H.BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "id"])

    return reps.select("id", "regs").mapInArrow(bands, "key long, id long")


def hubs_of(shared: DataFrame) -> DataFrame:
    """(key, pivot): of a key's documents the one that shares its keys with
    the most others, ties by the smallest id.

    The original of a group of near copies is such a document, so the keys of
    a group mostly have one pivot, and a document few pivots.  Weight and id
    are packed into one decimal, so the maximum is combined map-side.
    """
    weight = shared.groupBy("id").agg(F.sum("holders").alias("weight"))
    packed = F.expr("cast(weight as decimal(17,0)) * 100000000000000000000BD + (9223372036854775807BD - id)").cast("decimal(38,0)")
    best = shared.join(weight, "id").groupBy("key").agg(F.max(packed).alias("hub"))
    return best.select("key", F.expr("cast(9223372036854775807BD - hub % 100000000000000000000BD as bigint)").alias("pivot"))


def estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (pivot, id) with ``near``: the estimate leaves room."""
    threshold = percent / 100

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in C.pieces(whole)):
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, H.REGISTERS) for k in (3, 5))
            near = H.may_link(a, b, batch.column(2).to_numpy(), batch.column(4).to_numpy(), threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near)], ["pivot", "id", "near"])

    left = reps.select(F.col("id").alias("pivot"), F.col("n").alias("n_p"), F.col("regs").alias("regs_p"))
    both = pairs.join(left, "pivot").join(reps.select("id", "n", "regs"), "id")
    return both.select("pivot", "id", "n_p", "regs_p", "n", "regs").mapInArrow(judge, "pivot long, id long, near boolean")


def _links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) whose full sets meet the threshold.

    Intersections are counted by products of 0/1 matrices over the shingles
    both sides hold, some thousand shingles at a time.
    """
    sizes_l, sizes_r = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    all_l, all_r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(all_l, all_r)
    owner_l, owner_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)

    def placed(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    at_l, own_l = placed(all_l, owner_l)
    at_r, own_r = placed(all_r, owner_r)
    both = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    for lo in range(0, len(shared), step):
        parts = []
        for at, own, count in ((at_l, own_l, len(left)), (at_r, own_r, len(right))):
            a, b = np.searchsorted(at, (lo, lo + step))
            m = np.zeros((count, min(step, len(shared) - lo)), np.float32)
            m[own[a:b], at[a:b] - lo] = 1
            parts.append(m)
        both += parts[0] @ parts[1].T
    union = sizes_l[:, None] + sizes_r[None, :] - both
    return np.nonzero((100 * both >= percent * union) & (both > 0))


def confirmed(members: DataFrame, texts: DataFrame, width: int, percent: int, among: bool) -> DataFrame:
    """Links (a, b) confirmed on full sets.

    ``members``: pivot, id, n, label, side.  Inside a pivot's cluster, members
    of side 1 are compared with those of side 0 and, if ``among``, with each
    other, wherever their labels differ.  Members are dealt to blocks by hash, as many as the size
    of the cluster's sides asks for; every pair of blocks is one group.
    """
    weight = F.greatest(F.col("n") / F.lit(BLOCK_SHINGLES), F.lit(1.0 / BLOCK_DOCS))
    sides = members.groupBy("pivot").agg(
        F.ceil(F.coalesce(F.sum(F.when(F.col("side") == 0, weight)), F.lit(0.0))).cast("long").alias("n0"),
        F.ceil(F.coalesce(F.sum(F.when(F.col("side") == 1, weight)), F.lit(0.0))).cast("long").alias("n1"),
    )
    # Cut, so that both sides of the join are plain shuffles, which Spark can
    # split where a pivot has many members.
    dealt = members.join(C.cut(sides.filter("n1 > 0")), "pivot")
    blocks = F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), blocks))
    every = "explode(sequence(0L, {} - 1))"
    # Block pair (i, j): i < n0 is a block of side 0, n0 + i one of side 1.
    zero = dealt.filter("side = 0").selectExpr("pivot", "id", "label", "block AS i", f"{every.format('n1')} AS j", "0 AS part")
    one = dealt.filter("side = 1")
    against = one.filter("n0 > 0").selectExpr("pivot", "id", "label", f"{every.format('n0')} AS i", "block AS j", "1 AS part")
    own = one.selectExpr("pivot", "id", "label", "n0", "block", f"{every.format('n1')} AS other")
    own = own.selectExpr(
        "pivot", "id", "label", "n0 + least(block, other) AS i", "greatest(block, other) AS j", "CASE WHEN block <= other THEN 0 ELSE 1 END AS part"
    )
    rows = zero.unionByName(against)
    rows = (rows.unionByName(own) if among else rows).join(texts, "id")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "id"], kind="stable")
        sets = [shingles(w, width) for w in word_hashes(list(pdf["text"]))]
        ids, labels, part = pdf["id"].to_numpy(), pdf["label"].to_numpy(), pdf["part"].to_numpy()
        left = np.flatnonzero(part == 0)
        right = np.flatnonzero(part == 1) if (part == 1).any() else left
        if not len(left) or (labels == labels[0]).all():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        x, y = _links_between([sets[k] for k in left], [sets[k] for k in right], percent)
        a, b = left[x], right[y]
        cross = labels[a] != labels[b]
        a, b = ids[a[cross]], ids[b[cross]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    groups = rows.select("pivot", "i", "j", "id", "label", "part", "text").groupBy("pivot", "i", "j")
    return groups.applyInPandas(compare, "a long, b long")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""

    def cut(df: DataFrame) -> DataFrame:
        with C.small_batches(docs.sparkSession):
            return C.cut(df)

    rows = cut(sketch_rows(docs, width))
    classes = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"))
    found = C.cut(rows.join(classes.withColumnRenamed("id", "rep"), ["n", "s1", "s2"]).select("doc_id", "n", "rep"))
    reps = rows.withColumnRenamed("doc_id", "id").join(classes, ["n", "s1", "s2", "id"]).select("id", "n", "regs")
    reps = C.cut(reps.dropDuplicates(["id", "n"]))

    bands = band_rows(reps)
    counted = bands.groupBy("key").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = cut(bands.join(counted, "key"))
    hubs = C.cut(hubs_of(shared))
    pairs = shared.join(hubs, "key").filter("id <> pivot").select("pivot", "id").distinct()
    pairs = cut(estimated(pairs, reps, percent))

    raw = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    sizes = reps.select("id", "n")

    def texts_of(members: DataFrame) -> DataFrame:
        wanted = members.select(F.col("id").alias("want")).distinct()
        return C.flag_maybe(raw, "id", wanted, "want").filter("_maybe").drop("_maybe").dropDuplicates(["id"])

    near = pairs.filter("near")
    heads = near.select("pivot").distinct().select("pivot", F.col("pivot").alias("id"), F.lit(0).alias("side"))
    first = near.select("pivot", "id", F.lit(1).alias("side"))
    members = heads.unionByName(first).withColumn("label", F.col("side").cast("long")).join(sizes, "id")
    members = C.cut(members)
    links = cut(confirmed(members, texts_of(members), width, percent, among=False).distinct())
    labels = C.components(links, "a", "b")

    # Keys whose documents are not in one component yet, by their pivots.
    named = labels.select(F.col("node").alias("id"), "component")
    held = shared.select("key", "id").join(named, "id", "left").select("key", "id", F.coalesce("component", "id").alias("label"))
    mixed = held.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    cluster = held.join(mixed, "key").join(hubs, "key").select("pivot", "id", "label").distinct()
    home = labels.select(F.col("node").alias("pivot"), F.col("component").alias("home"))
    cluster = cluster.filter("id <> pivot").join(home, "pivot", "left")
    cluster = cluster.withColumn("side", (F.col("label") != F.coalesce("home", "pivot")).cast("int"))
    # A single member outside the pivot's component, and none inside but the
    # pivot: they were compared before.
    rest = C.cut(cluster.join(sizes, "id").select("pivot", "id", "n", "label", "side"))
    open_ = rest.groupBy("pivot").agg(F.sum("side").alias("outside"), F.count(F.lit(1)).alias("all")).filter("outside > 0 AND all > 1")
    rest = C.cut(rest.join(C.cut(open_.select("pivot")), "pivot"))
    more = cut(confirmed(rest, texts_of(rest), width, percent, among=True).distinct())
    labels = C.components(links.unionByName(more), "a", "b").withColumnRenamed("node", "rep")

    grouped = found.join(labels, "rep", "left").select("doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return grouped.filter("doc_id IS NOT NULL").unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each component.

    Where a doc_id has several rows, each row is a document of its own, so a
    text that is linked with nothing stays whatever other texts share its id;
    of equal rows one stays.  Rows without a doc_id stay.
    """
    if docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        groups = near_groups(docs, width, percent)
        return C.without_ids(docs, "doc_id", C.cut(groups.filter("NOT kept").select("doc_id")), "doc_id")
    # Rows numbered by doc_id take the place of the ids.
    number, everything = (C.fresh(docs.columns, c) for c in ("_row", "_all"))
    one = docs.withColumn(everything, F.lit(0))
    rows = C.cut(C.ranked(one, [everything], [F.col("doc_id").asc_nulls_last()], number))
    own = F.when(F.col("doc_id").isNotNull(), F.col(number))
    groups = near_groups(rows.select(own.alias("doc_id"), "text"), width, percent)
    left = C.without_ids(rows, number, C.cut(groups.filter("NOT kept").select("doc_id")), "doc_id")
    return left.select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(C.table(spark, sf_dir, "documents"), WIDTH, PERCENT)
