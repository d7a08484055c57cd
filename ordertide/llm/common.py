"""Helpers shared by the training-data operators.

Nothing here moves an unbounded set through the driver or one task:

* ``ranked``        global rank inside a group without a window over the group
                    (range partitioning splits a hot group);
* ``key_bitmap``    fixed-size bitmap of a key set, small enough to broadcast
                    whatever the number of keys, used to skip rows before a
                    shuffle (false positives only cost a little extra work);
* ``components``    connected components by minimum-label spreading with
                    pointer jumping, the lineage cut by written tables;
* ``small_batches`` and ``pieces`` bound what an executor and its Python
                    workers hold of a task's rows at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordertide import fs
from ordertide.session import shared_dir

# Words of a text: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_RECORDS = 500  # rows handed to a Python step at once, about a megabyte of texts
PIECE_BYTES = 1 << 18  # of a batch that Python objects and arrays are made of at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of the whole text (null: 0)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: materialise in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python steps that run inside get ``BATCH_RECORDS`` rows at once, unless
    the caller set a number.

    An executor keeps a batch twice outside its heap, in buffers that double
    as they grow, and its Python worker once more; Spark's 10,000 documents
    are often a whole task's input.  For steps whose rows don't depend on
    where batches end.
    """
    default = spark.conf.get(RECORDS, None) is None
    if default:
        spark.conf.set(RECORDS, str(BATCH_RECORDS))
    try:
        yield
    finally:
        if default:
            spark.conf.unset(RECORDS)


def pieces(batch: pa.RecordBatch | pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch | pa.Array]:
    """``batch`` as slices of at most ``most`` bytes or a single row, in order;
    an empty one as it is."""
    if len(batch) < 2 or batch.nbytes <= most:
        yield batch
        return
    half = len(batch) // 2
    yield from pieces(batch.slice(0, half), most)
    yield from pieces(batch.slice(half), most)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/ordertide-llm/{tag}-{uuid.uuid4().hex}"


def fresh(columns: list[str], name: str) -> str:
    """``name``, prefixed until no column (case-insensitively) has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """``df`` plus its 1-based ``rank`` by ``order`` inside ``group``.

    Rows are dealt by range over (group, order), so a group that holds most
    rows is spread over many tasks; each task numbers its own run, and the
    offsets come from one count per (group, task).  Rows that tie on every
    order column are numbered arbitrarily among themselves.  The result is
    cut: both uses of the dealt rows read the same files.
    """
    keys = [F.col(g) for g in group] + order
    at, pid, first, before = "_row_at", "_part", "_first", "_before"
    rows = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    rows = rows.withColumn(pid, F.shiftrightunsigned(F.col(at), 33))
    runs = rows.groupBy(*group, pid).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias(first))
    earlier = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(pid).alias("_p"),
        first,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before),
    )
    on = F.col(pid) == F.col("_p")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = rows.join(runs, on)
    return out.select(*[F.col(c) for c in df.columns], (F.col(at) - F.col(first) + F.col(before) + 1).alias(rank))


def _slot(key: Column, bits: int) -> Column:
    return F.xxhash64(key, F.lit("slot")).bitwiseAND(F.lit((1 << bits) - 1))


def key_bitmap(keys: DataFrame, column: str, bits: int = 22) -> DataFrame:
    """Bitmap of 2^bits slots with the slots of ``keys`` set: at most
    2^(bits-6) rows of two longs, whatever the number of keys."""
    s = _slot(F.col(column), bits)
    return keys.groupBy(F.shiftright(s, 6).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), s.bitwiseAND(F.lit(63)).cast("int"))).alias("_bits")
    )


def flag_maybe(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = 22, flag: str = "_maybe") -> DataFrame:
    """``df`` with ``flag``: False means surely not in ``keys``.

    The bitmap is broadcast: 16 bytes times at most 2^(bits-6) rows, a bound
    that does not depend on the data (1 MB at the default).
    """
    slot, word, set_bits = (fresh([*df.columns, flag], c) for c in ("_slot", "_word", "_bits"))
    bitmap = key_bitmap(keys, key, bits).withColumnsRenamed({"_word": word, "_bits": set_bits})
    marked = df.withColumn(slot, _slot(F.col(column), bits))
    out = marked.join(F.broadcast(bitmap), F.shiftright(F.col(slot), 6) == F.col(word), "left")
    hit = F.getbit(F.coalesce(F.col(set_bits), F.lit(0).cast("long")), F.col(slot).bitwiseAND(F.lit(63)).cast("int")) == 1
    return out.withColumn(flag, hit).drop(slot, word, set_bits)


def without_ids(docs: DataFrame, column: str, dropped: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``column`` is in ``dropped[key]``.

    Only rows that the bitmap cannot clear take part in the exact anti join,
    so texts of the other rows are not shuffled.
    """
    flag = fresh(docs.columns, "_maybe")
    seen = flag_maybe(docs, column, dropped, key, flag=flag)
    sure = seen.filter(~F.col(flag)).select(*docs.columns)
    name = fresh(docs.columns, "_gone")
    gone = dropped.select(F.col(key).alias(name)).distinct()
    unsure = seen.filter(F.col(flag)).select(*docs.columns)
    return sure.unionByName(unsure.join(gone, F.col(column) == F.col(name), "left_anti"))


def components(links: DataFrame, left: str, right: str, max_rounds: int = 200) -> DataFrame:
    """Connected components of undirected ``links``: (node, component), the
    component being its smallest node.  Nodes without a link are absent.

    Each round every node takes the smallest label among itself and its
    neighbours, then the label of its label (pointer jumping), until no label
    changes; the minimum is combined map-side, so a node with a third of all
    links costs one row per task.  Raises if the labels have not settled
    after ``max_rounds``.
    """
    spark = links.sparkSession
    folder = scratch(spark, "components")

    def kept(df: DataFrame, name: str) -> DataFrame:
        # A written table: a checkpoint would carry the constraints of the
        # plan it cuts into the next round, and they double every round.
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    a, b = F.col(left).alias("src"), F.col(right).alias("dst")
    edges = links.select(a, b).unionByName(links.select(b.alias("src"), a.alias("dst"))).filter("src <> dst").distinct()
    edges = kept(edges, "edges")
    first = edges.groupBy("src").agg(F.min("dst").alias("low"))
    labels = kept(first.select(F.col("src").alias("node"), F.least("low", "src").alias("component"), F.lit(True).alias("moved")), "labels0")
    for done in range(1, max_rounds + 1):
        near = edges.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("component").alias("best"))
        spread = labels.join(near, F.col("node") == F.col("src"), "left").select(
            "node", "component", F.least("component", F.coalesce("best", "component")).alias("lower")
        )
        up = labels.select(F.col("node").alias("_up"), F.col("component").alias("_jump"))
        lowest = F.least("lower", F.coalesce("_jump", "lower"))
        jumped = spread.join(up, F.col("lower") == F.col("_up"), "left")
        labels = kept(jumped.select("node", lowest.alias("component"), (lowest != F.col("component")).alias("moved")), f"labels{done}")
        fs.remove(spark, f"{folder}/labels{done - 1}")
        if labels.filter("moved").isEmpty():
            fs.remove(spark, f"{folder}/edges")
            return labels.select("node", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
