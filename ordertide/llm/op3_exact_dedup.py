"""Operator 3: exact dedup over an extendible-hash index on shared files.

Texts are equal when identical after lower-casing A-Z.  The index keeps one
link per distinct normalised text under a 64-bit key:

1. *entries* - every document's (doc_id, key, sha256), written once;
2. *directory* - keys are counted per leading-bit slot (a Spark aggregate of
   at most 2^depth rows) and the directory is doubled, splitting every bucket
   that holds more than ``bucket_keys`` keys; when the counted slots are too
   coarse for a bucket, the keys are counted again with more bits;
3. *owners* - a bucket is a range of keys and belongs to one task.  Documents
   whose key may have several entries bring their text (a fixed-size bitmap
   tells the others, whose entry is their link); the task that reads them
   chains its own first, so a group with a third of all rows costs its owner
   some rows per task.  The owner walks its keys in order and compares each
   text's bytes with the links in the key's chain: an equal one is counted
   there, another one starts a link;
4. *lookup* - an entry finds its bucket in the directory and its link in the
   bucket's chains, by key and, where texts collide, sha256 (an owner makes
   sure that the links of a chain differ in it); of a group the largest doc_id
   stays.

Memory: a reading task holds ``HELD`` bytes of texts and one batch, an owner
the distinct texts of one key and one batch, whatever the group or text sizes.

Defined results: a null text counts as empty; a very long text is compared
whole; rows with a null doc_id take part (any doc_id is larger than null); of
repeated rows with one doc_id all carry the group's keep_id, and
``distinct_documents`` keeps one; rows of one doc_id with different texts
belong to different groups, and one going doesn't take the others along; an
empty table gives an empty result; extra columns are kept by
``distinct_documents``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ordertide import fs
from ordertide.llm import common as C

BUCKET_KEYS = 20_000  # keys a bucket holds before it is split
DEPTH_STEP = 8  # directory bits counted at a time
MAX_DEPTH = 20  # the directory has at most 2^20 slots; buckets beyond simply hold more keys
HELD = 32 << 20  # bytes of texts a reading task chains before it hands them on
BATCH = 4_096  # links of an output batch


def split_buckets(counts: dict[int, int], depth: int, bucket_keys: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Split overfull buckets on counted slots: ``(buckets, too_coarse)``,
    each a list of (prefix, local depth).  ``too_coarse`` buckets are overfull
    although they are single slots of the given depth."""
    sums = [dict(counts)]
    for _ in range(depth):
        up: dict[int, int] = {}
        for slot, n in sums[-1].items():
            up[slot >> 1] = up.get(slot >> 1, 0) + n
        sums.append(up)
    sums.reverse()  # sums[d][prefix] = keys under a prefix of d bits
    buckets, coarse, todo = [], [], [(0, 0)]
    while todo:
        prefix, local = todo.pop()
        if sums[local].get(prefix, 0) <= bucket_keys:
            buckets.append((prefix, local))
        elif local == depth:
            coarse.append((prefix, local))
        else:
            todo += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
    return sorted(buckets), sorted(coarse)


def build_directory(keys: DataFrame, key: str, bucket_keys: int = BUCKET_KEYS, max_depth: int = MAX_DEPTH) -> tuple[int, list[tuple[int, int]]]:
    """Global depth and buckets (prefix, local depth) for the distinct keys.

    The counts that reach the driver are one per directory slot, at most
    2^max_depth; a bucket still overfull then simply holds more keys.
    """
    depth = 0
    while True:
        depth = min(depth + DEPTH_STEP, max_depth)
        slot = F.shiftrightunsigned(F.col(key), 64 - depth).alias("slot")
        counts = {r["slot"]: r["n"] for r in keys.groupBy(slot).agg(F.count(F.lit(1)).alias("n")).collect()}
        buckets, coarse = split_buckets(counts, depth, bucket_keys)
        if not coarse or depth == max_depth:
            buckets = sorted(buckets + coarse)
            return max((d for _, d in buckets), default=0), buckets


def directory_rows(global_depth: int, buckets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(slot, bucket number) for every slot of the doubled directory."""
    rows = []
    for number, (prefix, local) in enumerate(sorted(buckets, key=lambda b: b[0] << (64 - b[1]))):
        span = global_depth - local
        rows += [((prefix << span) + i, number) for i in range(1 << span)]
    return rows


class Chains:
    """Collision chains: per key the links [text, keep_id, group_size]."""

    def __init__(self) -> None:
        self.by_key: dict[int, list[list]] = {}
        self.held = 0

    def add(self, key: int, text: bytes, doc_id, count: int) -> None:
        chain = self.by_key.setdefault(key, [])
        for link in chain:
            if link[0] == text:  # whole bytes
                if link[1] is None or (doc_id is not None and doc_id > link[1]):
                    link[1] = doc_id
                link[2] += count
                return
        chain.append([text, doc_id, count])
        self.held += len(text)


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    for piece in C.pieces(batch):
        yield from zip(*[piece.column(piece.schema.get_field_index(n)).to_pylist() for n in names])


def chain_read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, doc_id) of a reading task as links (key, text,
    keep_id, group_size) of bounded chains."""
    chains, id_type = Chains(), None

    def hand_on() -> Iterator[pa.RecordBatch]:
        links = [(key, *link) for key, chain in chains.by_key.items() for link in chain]
        for at in range(0, len(links), BATCH):
            keys, texts, ids, counts = zip(*links[at : at + BATCH])
            columns = [pa.array(keys, pa.int64()), pa.array(texts, pa.binary()), pa.array(ids, id_type), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "text", "keep_id", "group_size"])

    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for key, text, doc_id in _columns(batch, "key", "text", "doc_id"):
            chains.add(key, text, doc_id, 1)
            if chains.held > HELD:
                yield from hand_on()
                chains = Chains()
    yield from hand_on()


def chain_owned_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of an owner's buckets, in the order of their keys, as finished
    chains (bucket, key, chain, sha, keep_id, group_size)."""
    names = ["bucket", "key", "chain", "sha", "keep_id", "group_size"]
    chains, current, id_type = Chains(), None, None
    done: list[tuple] = []

    def finish() -> None:
        for (bucket, key), chain in [(current, c) for c in chains.by_key.values()]:
            links = [(hashlib.sha256(text).hexdigest(), keep, size) for text, keep, size in chain]
            links.sort(key=lambda link: link[0])
            if len({sha for sha, _, _ in links}) < len(links):
                raise ValueError(f"different texts of key {key} share a sha256")
            done.extend((bucket, key, place, *link) for place, link in enumerate(links, 1))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), id_type, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        id_type = batch.schema.field("keep_id").type
        for bucket, key, text, doc_id, count in _columns(batch, "bucket", "key", "text", "keep_id", "group_size"):
            if (bucket, key) != current:
                finish()
                chains, current = Chains(), (bucket, key)
                if len(done) >= BATCH:
                    yield batch_of(done)
                    done.clear()
            chains.add(key, text, doc_id, count)
    finish()
    if done:
        yield batch_of(done)


def directory_table(spark: SparkSession, global_depth: int, buckets: list[tuple[int, int]]) -> DataFrame:
    """The doubled directory as (slot, bucket).  From an Arrow table Spark
    makes a local relation; a list of rows would go through a job whose Python
    workers every executor keeps beside those of the Arrow steps."""
    slots, numbers = zip(*directory_rows(global_depth, buckets))
    return spark.createDataFrame(pa.table({"slot": pa.array(slots, pa.int64()), "bucket": pa.array(numbers, pa.int64())}))


def _in_bucket(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket that the directory names for their key.  Spark
    broadcasts the directory (at most 2^MAX_DEPTH rows) only if it is small."""
    slot: Column = F.shiftrightunsigned(F.col("key"), 64 - depth) if depth else F.lit(0).cast("long")
    return rows.withColumn("slot", slot).join(directory, "slot").drop("slot")


def build_index(docs: DataFrame, path: str, bucket_keys: int = BUCKET_KEYS, key_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Write the index under ``path``; returns (entries, links).

    entries: doc_id, bucket, key, sha; links: bucket, key, chain (place in the
    collision chain), sha, keep_id, group_size - one row per distinct
    normalised text.  ``key_bits`` below 64 weakens the key (to exercise
    collisions).
    """
    spark = docs.sparkSession
    norm = C.ascii_lower(F.col("text"))
    key = F.shiftleft(F.xxhash64(norm), 64 - key_bits) if key_bits < 64 else F.xxhash64(norm)
    docs.select("doc_id", key.alias("key"), F.sha2(norm, 256).alias("sha")).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    counted = C.cut(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    depth, buckets = build_directory(counted, "key", bucket_keys)
    directory_table(spark, depth, buckets).write.parquet(f"{path}/directory")
    directory = spark.read.parquet(f"{path}/directory")
    entries = _in_bucket(entries, directory, depth)

    # The bitmap is a function of the key alone: all entries of a key are on
    # the same side of it, and those not flagged are alone under their key.
    shared = counted.filter("n > 1").select(F.col("key").alias("shared_key"))
    alone = C.flag_maybe(entries, "key", shared, "shared_key").filter("NOT _maybe")
    one = F.lit(1).cast("long")
    alone.select("bucket", "key", one.alias("chain"), "sha", F.col("doc_id").alias("keep_id"), one.alias("group_size")).write.parquet(f"{path}/links")

    rows = C.flag_maybe(docs.select("doc_id", key.alias("key"), norm.cast("binary").alias("text")), "key", shared, "shared_key")
    id_field = T.StructField("keep_id", docs.schema["doc_id"].dataType)
    long, text = T.LongType(), T.StructField("text", T.BinaryType())
    read = T.StructType([T.StructField("key", long), text, id_field, T.StructField("group_size", long)])
    owned = T.StructType([*[T.StructField(c, long) for c in ("bucket", "key", "chain")], T.StructField("sha", T.StringType()), id_field, read[3]])
    links = rows.filter("_maybe").select("key", "text", "doc_id").mapInArrow(chain_read_rows, read)
    dealt = _in_bucket(links, directory, depth).repartition("bucket").sortWithinPartitions("bucket", "key")
    with C.small_batches(spark):
        dealt.mapInArrow(chain_owned_keys, owned).write.mode("append").parquet(f"{path}/links")
    return entries, spark.read.parquet(f"{path}/links")


def dedup(docs: DataFrame, bucket_keys: int = BUCKET_KEYS, key_bits: int = 64, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.
    The result reads the index under ``path`` (by default a new folder in the
    shared one), which its owner removes when done with it."""
    entries, links = build_index(docs, path or C.scratch(docs.sparkSession, "exact-index"), bucket_keys, key_bits)
    found = entries.join(links.drop("chain"), ["bucket", "key", "sha"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return found.select("doc_id", "keep_id", "group_size", kept, F.col("sha").alias("text_sha256"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies: per text the row with the largest doc_id
    stays (one of them, if rows repeat).  Rows without a doc_id stay only if
    no row of their text has one, one per text."""
    path = C.scratch(docs.sparkSession, "exact-index")
    groups = C.cut(dedup(docs, path=path).select("doc_id", "keep_id", "group_size", "text_sha256"))
    fs.remove(docs.sparkSession, path)
    named = docs.filter(F.col("doc_id").isNotNull())
    flag, nth, sha, named_sha = (C.fresh(docs.columns, c) for c in ("_maybe", "_nth", "_sha", "_named_sha"))
    gone_id, gone_sha = (C.fresh(docs.columns, c) for c in ("_gone_id", "_gone_sha"))
    digest = F.sha2(C.ascii_lower(F.col("text")), 256)
    # A row goes by its doc_id and its text: another text of the same doc_id
    # is no copy.  The bitmap keeps most rows out of the join.
    gone = groups.filter("doc_id IS NOT NULL AND doc_id <> keep_id").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha))
    held = C.flag_maybe(named, "doc_id", gone, gone_id, flag=flag)
    on = (F.col("doc_id") == F.col(gone_id)) & (F.col(sha) == F.col(gone_sha))
    unsure = held.filter(F.col(flag)).withColumn(sha, digest).join(gone.distinct(), on, "left_anti")
    left = held.filter(~F.col(flag)).select(*docs.columns).unionByName(unsure.select(*docs.columns))
    # Rows that repeat under one doc_id are rare; only they are shuffled.
    again = groups.filter("group_size > 1 AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    seen = C.flag_maybe(left, "doc_id", again, "doc_id", flag=flag)
    first = F.row_number().over(Window.partitionBy("doc_id", sha).orderBy("doc_id"))
    some = seen.filter(F.col(flag)).withColumn(sha, digest).withColumn(nth, first).filter(F.col(nth) == 1)
    bare = docs.filter(F.col("doc_id").isNull()).withColumn(sha, digest)
    has_id = groups.filter("doc_id IS NULL AND keep_id IS NOT NULL").select(F.col("text_sha256").alias(named_sha)).distinct()
    bare = bare.join(has_id, F.col(sha) == F.col(named_sha), "left_anti").withColumn(nth, first).filter(F.col(nth) == 1)
    out = seen.filter(~F.col(flag)).select(*docs.columns)
    return out.unionByName(some.select(*docs.columns)).unionByName(bare.select(*docs.columns))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(C.table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{C.UPPER}', '{C.LOWER}') AS norm FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
"""
