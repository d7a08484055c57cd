"""Raw inputs with broken records, and their ingest (S1-S3, S7, S8 rejects).

Every order whose key is 0 modulo ``BROKEN`` adds one unreadable record to
each format, beside the good files: a short fixed-width line, delimited lines
with a field too many, a cut JSON document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators.versioned import VersionedTable
from ordertide.plans import fixtures, ingest
from ordertide.plans.gate import source_of
from ordertide.plans.workspace import Workspace
from ordertide.schemas import COMMA_SEPARATED_HEADER, RAW_ORDER_COLUMNS, REJECTS_SCHEMA
from ordertide.streaming.orders import OrderStream

# Fixed value: every so-manieth order key brings broken records.
BROKEN = 29


def _delimited(keys: DataFrame, header: list[str], sep: str, path: str) -> None:
    """Lines with one field more than the header, which every file has.

    Written as one column, named like the header line, with a separator that
    doesn't occur, so that nothing is quoted.
    """
    line = F.concat(F.format_string("broken %d", "k"), F.lit(sep * (len(header) - 1) + f"a{sep}b"))
    writer = keys.select(line.alias(sep.join(header))).write
    writer.option("header", True).option("sep", "\u0002").option("quote", "\u0000").csv(path)


def write_broken(w: Workspace, root: str) -> dict[str, list[str] | str]:
    """Write the broken files; returns the inputs, good and broken, by kind."""
    good = w.raw_paths()
    keys = fixtures.table(w.spark, w.sf_dir, "orders").filter(F.col("o_orderkey") % BROKEN == 0).select(F.col("o_orderkey").alias("k"))
    own = {kind: f"{root}/raw/{kind}" for kind in (*ingest.BATCH_KINDS, "stream")}
    keys.select(F.format_string("short line %d", "k").alias("value")).write.text(own["fixed_width"])
    _delimited(keys, RAW_ORDER_COLUMNS, "\t", own["tab_separated"])
    _delimited(keys, COMMA_SEPARATED_HEADER, ",", own["comma_separated"])
    # The stream reads one folder: a copy of the good documents lies with them.
    cut = keys.select(F.format_string('{"orderId": "%d", "products": [{', "k").alias("value"))
    w.spark.read.text(good["stream"]).select("value").unionByName(cut).hint("rebalance").write.options(**fixtures.COMPACT).text(own["stream"])
    return {kind: path if kind == "stream" else [good[kind], path] for kind, path in own.items()}


def build(w: Workspace, root: str) -> None:
    """Ingest the batch files and stream the documents, rejects apart."""
    inputs = write_broken(w, root)
    stream = inputs.pop("stream")
    ingest.write_raw_batches(w.spark, inputs, f"{root}/raw_batched", f"{root}/raw_rejects")
    _stream(w, root, stream).run_available()


def _stream(w: Workspace, root: str, source: str) -> OrderStream:
    tables = [VersionedTable(w.spark, f"{root}/{name}", name) for name in ("orders", "line_items", "rejects")]
    return OrderStream(w.spark, source, tables[0], tables[1], f"{root}/checkpoints", query_name="broken", rejects=tables[2])


def rejects(w: Workspace) -> DataFrame:
    """All rejected records: source folder and whole text."""
    root = w.phase("broken", lambda d: build(w, d))
    batch = w.spark.read.schema(REJECTS_SCHEMA).parquet(f"{root}/raw_rejects")
    streamed = VersionedTable(w.spark, f"{root}/rejects", "rejects").read()
    return batch.unionByName(streamed).select(source_of("ingest_file_name").alias("source"), "text")


def counts(w: Workspace) -> DataFrame:
    """Per source: lines (without headers), accepted and rejected records."""
    spark = w.spark
    root = w.phase("broken", lambda d: build(w, d))
    good = w.raw_paths()
    lines = None
    for kind in (*ingest.BATCH_KINDS, "stream"):
        own = f"{root}/raw/{kind}"
        text = spark.read.text(own if kind == "stream" else [good[kind], own])
        head = {"tab_separated": "\t".join(RAW_ORDER_COLUMNS), "comma_separated": ",".join(COMMA_SEPARATED_HEADER)}.get(kind)
        counted = (text.filter(F.col("value") != head) if head else text).agg(F.count(F.lit(1)).alias("n"))
        row = counted.select(F.lit(kind).alias("source"), F.lit("lines").alias("what"), "n")
        lines = row if lines is None else lines.unionByName(row)
    accepted = spark.read.parquet(f"{root}/raw_batched").select(source_of("ingest_file_name").alias("source"))
    documents = VersionedTable(spark, f"{root}/orders", "orders").read().select(source_of("ingest_file_name").alias("source"))
    kept = accepted.unionByName(documents).groupBy("source").agg(F.lit("accepted").alias("what"), F.count(F.lit(1)).alias("n"))
    bad = rejects(w).groupBy("source").agg(F.lit("rejected").alias("what"), F.count(F.lit(1)).alias("n"))
    found = lines.unionByName(kept.select("source", "what", "n")).unionByName(bad.select("source", "what", "n"))
    return found.groupBy("source").agg(*[F.sum(F.when(F.col("what") == x, F.col("n"))).alias(x) for x in ("lines", "accepted", "rejected")])
