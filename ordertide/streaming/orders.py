"""Stream order documents into the versioned orders and line-items tables.

One streaming query reads each document once and feeds both tables from the
same micro-batch (``foreachBatch``): the batch is persisted, flattened into
orders rows and exploded into line-item rows, and each is committed to its
versioned table with the commit id ``<query>-g<generation>-b<batchId>``.  A
replayed batch id rewrites only its own partition (exactly-once).  Records that
can't be read never become rows: with a ``rejects`` table they are committed
there, file and text, by the same micro-batch.  The
checkpoint lives under ``checkpoints/<query>/g<generation>`` and a restore of
either table raises the generation, so restored tables are streamed again from
the start instead of being silently skipped.  The two tables are a pair: a new
generation only starts when neither holds batches of this stream; otherwise
documents would be loaded twice or missed, and the start is refused.

``toTable`` into a Parquet table that already holds batch rows would hide
those rows behind the sink's ``_spark_metadata`` log; writing through the
versioned commit avoids that.

A run is driven by the trigger: ``run_available`` takes what is there and ends,
``run_drained`` fires at fixed intervals, throttled or not, until the source's
offsets are drained.  A :class:`~ordertide.streaming.progress.ProgressLog` keeps
a row per trigger of either.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordertide.functions.clean import month_key, try_cast, with_lineage
from ordertide.operators.versioned import VersionedTable
from ordertide.plans.jobs import run_concurrently
from ordertide.schemas import LINE_ITEMS_SCHEMA, ORDERS_JSON_SCHEMA, ORDERS_SCHEMA, REJECTS_SCHEMA
from ordertide.sources.files import CORRUPT, accepted, rejected, stream_orders_json
from ordertide.streaming.progress import ProgressLog


def flatten_orders(docs: DataFrame) -> DataFrame:
    """Order documents (with lineage columns) to the orders schema.

    The same function serves static and streaming frames."""
    return docs.select(
        F.col("submittedAt").alias("submitted_at"),
        month_key("submittedAt").alias("submitted_yyyy_mm"),
        F.col("orderId").alias("order_id"),
        F.col("customerId").alias("customer_id"),
        F.col("salesRepId").alias("sales_rep_id"),
        F.col("shippingAddress.attention").alias("shipping_address_attention"),
        F.col("shippingAddress.address").alias("shipping_address_address"),
        F.col("shippingAddress.city").alias("shipping_address_city"),
        F.col("shippingAddress.state").alias("shipping_address_state"),
        try_cast("shippingAddress.zip", "int").alias("shipping_address_zip"),
        "ingest_file_name",
        "ingested_at",
    ).select(ORDERS_SCHEMA.names)


def explode_line_items(docs: DataFrame) -> DataFrame:
    """Order documents to line-item rows (T3); empty or NULL product arrays
    produce no rows."""
    return docs.select(
        F.col("orderId").alias("order_id"),
        F.explode("products").alias("product"),
        "ingest_file_name",
        "ingested_at",
    ).select(
        "order_id",
        F.col("product.productId").alias("product_id"),
        F.col("product.quantity").cast("int").alias("product_quantity"),
        F.col("product.soldPrice").cast("decimal(10,2)").alias("product_sold_price"),
        "ingest_file_name",
        "ingested_at",
    ).select(LINE_ITEMS_SCHEMA.names)


class RestoreConflict(RuntimeError):
    """The tables were restored to states the stream can't continue from."""


class StreamTimeout(RuntimeError):
    """The stream was stopped before it had read all documents."""


@dataclass
class OrderStream:
    spark: SparkSession
    source_path: str
    orders: VersionedTable
    line_items: VersionedTable
    checkpoint_root: str
    query_name: str = "orders_stream"
    max_files_per_trigger: int | None = None
    coalesce_to: int | None = None
    rejects: VersionedTable | None = None
    progress: ProgressLog | None = None

    def generation(self) -> int:
        return self.orders.restore_count() + self.line_items.restore_count()

    def _check_pair(self) -> None:
        """Batches that are live must be of the current generation, and the
        same ones in both tables."""
        mine = f"{self.query_name}-g"
        live = [[c for c in t.live_commits() if c.startswith(mine)] for t in (self.orders, self.line_items)]
        old = [c for commits in live for c in commits if not c.startswith(self.commit_prefix())]
        if old:
            raise RestoreConflict(
                f"{self.query_name}: a restored table still holds streamed batches ({old[0]}, ...); "
                "restore both tables to a version before the stream"
            )

    def checkpoint(self) -> str:
        return f"{self.checkpoint_root}/{self.query_name}/g{self.generation()}"

    def commit_prefix(self) -> str:
        return f"{self.query_name}-g{self.generation()}-b"

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        commit_id = f"{self.commit_prefix()}{batch_id}"
        batch = batch.persist()
        try:
            docs = accepted(batch) if CORRUPT in batch.columns else batch
            orders_rows = flatten_orders(docs)
            item_rows = explode_line_items(docs)
            if self.coalesce_to:
                orders_rows = orders_rows.coalesce(self.coalesce_to)
                item_rows = item_rows.coalesce(self.coalesce_to)
            # The tables from the same cached batch, committed side by side.
            writes = [
                lambda: self.orders.append_conforming(orders_rows, commit_id),
                lambda: self.line_items.append_conforming(item_rows, commit_id),
            ]
            if self.rejects is not None and CORRUPT in batch.columns:
                bad = rejected(batch).select(REJECTS_SCHEMA.names)
                writes.append(lambda: self.rejects.append_conforming(bad, commit_id))
            run_concurrently(*writes)
        finally:
            batch.unpersist()

    def start(self, available_now: bool = True, processing_time: str = "1 second") -> StreamingQuery:
        self._check_pair()
        keep = self.rejects is not None
        stream = with_lineage(
            stream_orders_json(self.spark, self.source_path, ORDERS_JSON_SCHEMA, self.max_files_per_trigger, keep)
        )
        writer = (
            stream.writeStream.queryName(self.query_name)
            .option("checkpointLocation", self.checkpoint())
            .foreachBatch(self._process)
        )
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
        if self.progress is not None:
            self.progress.listen()
        return writer.start()

    def _ended(self, query: StreamingQuery) -> None:
        """Stop the query and wait for its last event."""
        if query.isActive:
            query.stop()
        if self.progress is not None:
            self.progress.wait_for(str(query.runId))

    def run_drained(self, interval: str = "1 second", timeout_s: float | None = None) -> StreamingQuery:
        """Fire at fixed intervals until every file present is processed, then
        stop.  With ``timeout_s`` a run that takes longer is stopped and
        raises; its finished batches stay."""
        query = self.start(available_now=False, processing_time=interval)
        late = threading.Event()

        def give_up() -> None:
            late.set()
            query.stop()

        alarm = threading.Timer(timeout_s, give_up) if timeout_s is not None else None
        try:
            if alarm is not None:
                alarm.start()
            query.processAllAvailable()
            if late.is_set():
                raise StreamTimeout(f"{self.query_name}: not drained after {timeout_s} s")
        finally:
            if alarm is not None:
                alarm.cancel()
            self._ended(query)
        return query

    def run_available(self, timeout_s: float | None = None) -> StreamingQuery:
        """Process everything present now, then stop (tests, scheduled runs).

        With ``timeout_s`` a run that takes longer is stopped and raises; its
        finished batches stay, and the next run goes on from its checkpoint.
        """
        query = self.start(available_now=True)
        try:
            ended = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
            if query.exception() is not None:
                raise query.exception()
            if timeout_s is not None and not ended:
                raise StreamTimeout(f"{self.query_name}: not finished after {timeout_s} s")
        finally:
            self._ended(query)
        return query

    def batch_commits(self) -> DataFrame:
        """Rows of every micro-batch (T7), counted in the two tables' data
        rather than kept in an in-memory progress list."""
        prefix = f"{self.query_name}-g"

        def per_table(t: VersionedTable, label: str) -> DataFrame:
            return t.commit_counts().filter(F.col("commit_id").startswith(prefix)).withColumnRenamed("rows", label)

        o = per_table(self.orders, "order_rows")
        li = per_table(self.line_items, "line_item_rows")
        return o.join(li, "commit_id", "full").select(
            F.regexp_extract("commit_id", r"-g(\d+)-b", 1).cast("bigint").alias("generation"),
            F.regexp_extract("commit_id", r"-b(\d+)$", 1).cast("bigint").alias("batch_id"),
            F.coalesce("order_rows", F.lit(0)).alias("order_rows"),
            F.coalesce("line_item_rows", F.lit(0)).alias("line_item_rows"),
        )
