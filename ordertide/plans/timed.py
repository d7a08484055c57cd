"""A throttled stream on a timed trigger, with its progress stored.

The documents are dealt over ``FILES`` files and read ``THROTTLE`` at a time,
at fixed intervals, until the source is drained.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators import quality as dq
from ordertide.operators.versioned import VersionedTable
from ordertide.plans.workspace import Workspace
from ordertide.streaming.orders import OrderStream, explode_line_items, flatten_orders
from ordertide.streaming.progress import PROGRESS_SCHEMA, ProgressLog, trigger_check

# Files of the run, files a trigger may read, the bound that the
# number of triggers must stay below.
FILES, THROTTLE, TRIGGERS_BELOW = 7, 2, 100
TRIGGERS = -(-FILES // THROTTLE)
QUERY = "timed_orders"


def build(w: Workspace, root: str) -> None:
    source = f"{root}/raw/stream"
    w.spark.read.text(w.raw_paths()["stream"]).repartition(FILES).write.text(source)
    progress = ProgressLog(w.spark, f"{root}/progress", QUERY)
    orders, items = (VersionedTable(w.spark, f"{root}/{name}", name) for name in ("orders", "line_items"))
    stream = OrderStream(w.spark, source, orders, items, f"{root}/checkpoints", QUERY, max_files_per_trigger=THROTTLE, progress=progress)
    try:
        stream.run_drained(interval="200 milliseconds")
    finally:
        progress.close()


def _root(w: Workspace) -> str:
    return w.phase("timed", lambda d: build(w, d))


def stored_progress(w: Workspace) -> DataFrame:
    return w.spark.read.schema(PROGRESS_SCHEMA).json(f"{_root(w)}/progress")


def progress(w: Workspace) -> DataFrame:
    """Triggers, rows, and whether the stored run was started and ended."""
    stored = stored_progress(w)
    source = w.spark.read.text(f"{_root(w)}/raw/stream").groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    # What the throttle lets through: at most the rows of its largest files.
    largest = source.agg(F.max("n")).first()[0] or 0
    checked = trigger_check(stored, TRIGGERS, TRIGGERS_BELOW, THROTTLE * largest)
    ends = stored.groupBy("query_name").agg(
        F.count_if(F.col("event") == "started").alias("started"),
        F.count_if((F.col("event") == "ended") & F.col("error").isNull()).alias("ended"),
    )
    return checked.join(ends, "query_name").select("query_name", "triggers", "input_rows", "over_throttle", "in_bounds", "started", "ended")


def throttled(w: Workspace, docs: DataFrame) -> DataFrame:
    """The throttled tables against the documents read at once."""
    root = _root(w)
    out = None
    for name, want in (("orders", flatten_orders(docs)), ("line_items", explode_line_items(docs))):
        table = VersionedTable(w.spark, f"{root}/{name}", name)
        got, want = (x.drop("ingest_file_name", "ingested_at") for x in (table.read(), want))
        row = dq.scalar_row(
            {
                "rows": got.agg(F.count(F.lit(1))),
                "differing_rows": dq.multiset_diff(got, want).agg(F.count(F.lit(1))),
                "batches": table.commit_counts().agg(F.count(F.lit(1))),
            }
        ).select(F.lit(name).alias("table_name"), "rows", "differing_rows", "batches")
        out = row if out is None else out.unionByName(row)
    return out
