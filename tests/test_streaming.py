import pytest
from pyspark.sql import functions as F

from ordertide.functions.clean import with_lineage
from ordertide.operators.versioned import VersionedTable
from ordertide.sources.files import read_orders_json
from ordertide.plans.workspace import Workspace
from ordertide.streaming.orders import OrderStream, RestoreConflict, StreamTimeout, explode_line_items, flatten_orders


def test_stream_appends_once_and_restart_reads_nothing(spark, sf_dir, tmp_path):
    ws = Workspace.get(spark, sf_dir)
    src = ws.raw_paths()["stream"]
    o = VersionedTable(spark, str(tmp_path / "o"), "orders", partition_by=["submitted_yyyy_mm"])
    li = VersionedTable(spark, str(tmp_path / "li"), "line_items")
    o.commit(ws.orders(version=0), "overwrite", "batch-0")
    li.commit(ws.line_items(version=0), "overwrite", "batch-0")
    base_o, base_li = o.read().count(), li.read().count()
    s = OrderStream(spark, src, o, li, str(tmp_path / "ck"), query_name="t", max_files_per_trigger=2)
    s.run_available()
    static = with_lineage(read_orders_json(spark, src))
    n_o, n_li = flatten_orders(static).count(), explode_line_items(static).count()
    assert o.read().count() == base_o + n_o
    assert li.read().count() == base_li + n_li
    batches = s.batch_commits().collect()
    assert len(batches) >= 1 and sum(b.order_rows for b in batches) == n_o
    v = o.current_version()
    s.run_available()  # restart on the same checkpoint: nothing new
    assert o.current_version() == v and o.read().count() == base_o + n_o
    # a restore raises the generation: the stream runs again from the start
    o.restore(0)
    li.restore(0)
    assert s.generation() == 2
    s.run_available()
    assert o.read().count() == base_o + n_o
    assert o.read().filter(F.col("ingest_file_name").contains("/stream/")).count() == n_o


def test_flatten_and_explode_shapes(spark, sf_dir):
    from ordertide.schemas import LINE_ITEMS_SCHEMA, ORDERS_SCHEMA

    ws = Workspace.get(spark, sf_dir)

    docs = with_lineage(read_orders_json(spark, ws.raw_paths()["stream"]))
    assert flatten_orders(docs).columns == ORDERS_SCHEMA.names
    items = explode_line_items(docs)
    assert items.columns == LINE_ITEMS_SCHEMA.names
    assert dict(items.dtypes)["product_sold_price"] == "decimal(10,2)"


def _small_stream(spark, sf_dir, tmp_path, files=4):
    """A stream over a few files of documents, next to base tables."""
    ws = Workspace.get(spark, sf_dir)
    src = str(tmp_path / "docs")
    spark.read.text(ws.raw_paths()["stream"]).repartition(files).write.text(src)
    o = VersionedTable(spark, str(tmp_path / "o"), "orders", partition_by=["submitted_yyyy_mm"])
    li = VersionedTable(spark, str(tmp_path / "li"), "line_items")
    o.commit(ws.orders(version=0).limit(3), "overwrite", "batch-0")
    li.commit(ws.line_items(version=0).limit(5), "overwrite", "batch-0")
    s = OrderStream(spark, src, o, li, str(tmp_path / "ck"), query_name="t", max_files_per_trigger=1)
    static = with_lineage(read_orders_json(spark, src))
    return s, o, li, 3 + flatten_orders(static).count(), 5 + explode_line_items(static).count()


def test_a_timeout_raises_and_the_next_run_completes(spark, sf_dir, tmp_path):
    s, o, li, n_o, n_li = _small_stream(spark, sf_dir, tmp_path)
    with pytest.raises(StreamTimeout):
        s.run_available(timeout_s=0.01)
    s.run_available()
    assert o.read().count() == n_o and li.read().count() == n_li
    assert o.read().select("order_id").distinct().count() == n_o


def test_a_stopped_stream_is_not_published(spark, sf_dir, tmp_path, monkeypatch):
    ws = Workspace(spark, sf_dir, str(tmp_path / "ws"))
    built = Workspace.get(spark, sf_dir)
    built.tables_dir()
    monkeypatch.setattr(ws, "tables_dir", lambda: str(tmp_path / "tables"))
    monkeypatch.setattr(ws, "raw_paths", built.raw_paths)

    def stop(*_):
        raise StreamTimeout("stopped")

    monkeypatch.setattr(OrderStream, "run_available", stop)
    with pytest.raises(StreamTimeout):
        ws.streamed()
    assert not (tmp_path / "ws" / "stream.ok").exists()


@pytest.mark.parametrize("back_to", [0, 2, "last"])
@pytest.mark.parametrize("which", ["both", "orders", "line_items"])
def test_restore_then_stream_neither_repeats_nor_loses(spark, sf_dir, tmp_path, back_to, which):
    """Every restore either streams to the full result or is refused."""
    s, o, li, n_o, n_li = _small_stream(spark, sf_dir, tmp_path, files=2)
    s.run_available()
    for name, t in (("orders", o), ("line_items", li)):
        if which in ("both", name):
            t.restore(t.current_version() if back_to == "last" else back_to)
    if which == "both" and back_to == 0:
        s.run_available()
        assert o.read().count() == n_o and li.read().count() == n_li
        assert o.read().select("order_id").distinct().count() == n_o
    else:
        with pytest.raises(RestoreConflict):
            s.run_available()
