"""The raw files made from the tables: whole, and small on disk."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from ordertide.plans import fixtures
from ordertide.plans.ingest import BATCH_KINDS, read_batch
from ordertide.schemas import FIXED_WIDTH_LAYOUT
from ordertide.session import configure
from ordertide.sources.files import read_orders_json, read_products_xml

LINES = 3000  # of order 1


def _write_tables(spark, d):
    day = {y: dt.datetime(y, 3, 4, 5, 6, 7) for y in (1996, 1998, 2000, 2001)}
    orders = [
        (1, 1, day[1996]), (2, 1, day[1998]), (3, 2, day[2000]), (4, 1, day[2001]),
        (4, 1, day[2001]),  # the same row again
        (4, 2, day[2001]),  # its key again
        (5, 2, day[2001]),  # no line items: streamed all the same
        (6, 1, day[1996]),  # no line items: in no file
        (7, None, day[1996]), (None, 1, day[1998]), (8, 1, None),
    ]
    items = [(1, p % 7, 1, p, 2.0, 10.25) for p in range(LINES)]
    items += [(2, 5, 2, 2, 3.0, 1.5), (2, 6, 1, 1, 1.0, 2.5), (3, 5, 1, 1, 1.0, 1.0), (3, 5, 1, 1, 1.0, 1.0)]
    items += [(4, 8, 1, 1, 4.0, 7.75), (4, 9, 1, 2, 5.0, 8.5), (8, 1, 1, 1, 6.0, 9.0), (None, 1, 1, 1, 1.0, 1.0), (99, 1, 1, 1, 1.0, 1.0)]
    frames = {
        "nation": ([(1, "N1"), (7, "N7")], "n_nationkey int, n_name string"),
        "customer": ([(1, "Customer#1", 1), (2, "Customer#2", 7)], "c_custkey bigint, c_name string, c_nationkey int"),
        "supplier": ([(1, "Supplier#1", 1), (2, "Supplier#2", 7)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "lineitem": (items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"),
        "part": ([(k, f"red m{k}", "B", 30 if k % 2 else 20, 9.5) for k in range(50)], "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    d, root = tmp_path_factory.mktemp("tables"), tmp_path_factory.mktemp("raw")
    configure(spark)
    _write_tables(spark, str(d))
    before = fixtures.COMPACT["maxRecordsPerFile"]
    fixtures.COMPACT["maxRecordsPerFile"] = "500"
    try:
        return root, fixtures.write_fixtures(spark, str(d), str(root))
    finally:
        fixtures.COMPACT["maxRecordsPerFile"] = before


def test_every_line_item_is_in_the_file_of_its_year(spark, written):
    _, paths = written
    found = {k: read_batch(spark, k, paths[k], keep_rejects=True) for k in BATCH_KINDS}
    rows = {
        k: sorted((r.order_id, r.product_id, r.product_quantity, r.product_sold_price, r.sales_rep_id, r.shipping_address_state) for r in df.collect())
        for k, df in found.items()
    }
    assert rows["fixed_width"] == sorted(("1", str(p % 7), "2", "10.25", "1", "AB") for p in range(LINES))
    # The rep is the supplier of the lowest line number.
    assert rows["tab_separated"] == [("2", "5", "3", "1.50", "1", "AB"), ("2", "6", "1", "2.50", "1", "AB")]
    assert rows["comma_separated"] == [("3", "5", "1", "1.00", "1", "BC")] * 2


def test_documents_hold_the_items_of_their_order(spark, written):
    _, paths = written
    docs = read_orders_json(spark, paths["stream"]).collect()
    got = sorted((r.orderId, r.customerId, sorted((p.productId, p.quantity, str(p.soldPrice)) for p in r.products)) for r in docs if r.orderId != "8")
    items = [("8", 4, "7.75"), ("9", 5, "8.50")]
    assert got == [("4", "1", items), ("4", "1", items), ("4", "2", items), ("5", "2", [])]


def test_raw_files_are_small_and_no_scratch_is_left(spark, written):
    root, paths = written
    folder = pathlib.Path(paths["fixed_width"])
    size = sum(f.stat().st_size for f in folder.glob("part-*"))
    text = LINES * (sum(w for _, _, w in FIXED_WIDTH_LAYOUT) + 1)
    assert size < text / 8, "a line of 409 characters is mostly blanks"
    # One task reads a compressed file: none holds many rows.
    per_file = [r["count"] for r in spark.read.text(str(folder)).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(per_file) == LINES and max(per_file) <= 500
    assert read_products_xml(spark, paths["products_xml"]).count() == 50
    assert sorted(p.name for p in root.iterdir() if not p.name.startswith(".")) == ["raw"]


def test_line_items_are_shuffled_once_for_all_files(spark, written, tmp_path):
    _write_tables(spark, str(tmp_path))
    orders = fixtures.enriched_orders(spark, str(tmp_path)).select(*fixtures.ORDER_COLUMNS, F.monotonically_increasing_id().alias(fixtures.ORDER_ROW))
    orders.write.parquet(str(tmp_path / "o"))
    fixtures.order_lines(spark, str(tmp_path), spark.read.parquet(str(tmp_path / "o"))).write.parquet(str(tmp_path / "l"))
    lines = spark.read.parquet(str(tmp_path / "l"))
    for route in fixtures.BATCH_ROUTES:
        plan = fixtures.raw_order_rows(lines, route)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_tables_are_written_with_zstd_unless_the_caller_chose(spark):
    key = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert configure(spark).conf.get(key) == "zstd"
        spark.conf.set(key, "gzip")
        assert configure(spark).conf.get(key) == "gzip"
    finally:
        spark.conf.set(key, before)
