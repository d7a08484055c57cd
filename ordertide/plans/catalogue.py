"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole of the
given tables (through the raw files and typed tables derived from them).
Outputs use comparison-friendly types: timestamps as epoch seconds, money as
double (cast from exact decimals), counts as bigint, file paths reduced to
their source folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.clean import clean_all, epoch_to_timestamp, ssn_to_long_in_pandas, ssn_format_error, ssn_to_long, try_cast
from ordertide import fs
from ordertide.operators import quality as dq
from ordertide.operators.versioned import SchemaMismatch, VersionedTable
from ordertide.plans import broken, defects, gate, ingest, managed, normalize, questions, questions_sql, timed
from ordertide.plans.fixtures import ROUTES, STREAM_ROUTE
from ordertide.plans.gate import EXPECTED_LENGTHS, EXPECTED_MONTHS, source_of
from ordertide.plans.workspace import Workspace
from ordertide.schemas import (
    LINE_ITEMS_SCHEMA,
    ORDERS_SCHEMA,
    PRODUCTS_SCHEMA,
    RAW_ORDER_COLUMNS,
    SALES_REPS_SCHEMA,
)
from ordertide.sources.files import file_inventory, read_orders_json, read_products_xml
from ordertide.streaming.orders import explode_line_items, flatten_orders

# Parameters of the registered business questions.
Q2_COLOR = "red"
Q2_STATE = "AA"
MONTH_RANGE = ("1997-01", "1997-06")
MONTH_STATE = "AC"


def ws(spark: SparkSession, sf_dir: str) -> Workspace:
    return Workspace.get(spark, sf_dir)


def _raw_out(df: DataFrame) -> DataFrame:
    return df.select(*RAW_ORDER_COLUMNS, source_of("ingest_file_name").alias("source"))


def _money(c: str) -> Column:
    return F.col(c).cast("double")


# -- S1-S4, U1, K1/K2 ---------------------------------------------------------------
def fixed_width_ingest(spark, sf_dir):
    return _raw_out(ingest.read_batch(spark, "fixed_width", ws(spark, sf_dir).raw_paths()["fixed_width"]))


def tsv_ingest(spark, sf_dir):
    return _raw_out(ingest.read_batch(spark, "tab_separated", ws(spark, sf_dir).raw_paths()["tab_separated"]))


def csv_positional_rename(spark, sf_dir):
    return _raw_out(ingest.read_batch(spark, "comma_separated", ws(spark, sf_dir).raw_paths()["comma_separated"]))


def batch_append(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    return raw.groupBy(F.year(epoch_to_timestamp("submitted_at")).cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# -- P2/P3, A5, P9 --------------------------------------------------------------------
def clean_strings(spark, sf_dir):
    paths = ws(spark, sf_dir).raw_paths()
    dirty = ingest.read_all_batches(spark, paths, clean=False)
    cleaned = clean_all(dirty, RAW_ORDER_COLUMNS)
    return cleaned.select(
        source_of("ingest_file_name").alias("source"), "order_id", "product_id", "shipping_address_attention"
    )


def null_profile(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched().withColumn("source", source_of("ingest_file_name"))
    return dq.null_profile(raw, RAW_ORDER_COLUMNS, by=["source"])


def lineage_columns(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    ext = {"fixed_width": ".txt", "tab_separated": ".csv", "comma_separated": ".csv"}
    expected_ext = F.create_map(*[x for k, v in ext.items() for x in (F.lit(k), F.lit(v))])
    src = source_of("ingest_file_name")
    plain = F.regexp_replace("ingest_file_name", r"\.gz$", "")  # the files are kept compressed
    return raw.groupBy(src.alias("source")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(plain.endswith(expected_ext[src])).alias("suffix_ok"),
        F.bool_and(F.col("ingested_at").isNotNull()).alias("ingested_at_set"),
    )


# -- P12/P13, X1, P10 --------------------------------------------------------------------
def ssn_error_flag(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    return raw.groupBy("sales_rep_id", source_of("ingest_file_name").alias("source")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ssn_format_error("sales_rep_ssn")).cast("bigint").alias("flagged_rows"),
    )


def ssn_to_long_q(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    return raw.select("sales_rep_id", "sales_rep_ssn", ssn_to_long("sales_rep_ssn").alias("ssn_long")).distinct()


def ssn_to_long_vectorized(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    return raw.select(
        "sales_rep_id", "sales_rep_ssn", ssn_to_long_in_pandas("sales_rep_ssn").alias("ssn_long")
    ).distinct()


def epoch_to_timestamp_q(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    ts = epoch_to_timestamp("submitted_at")
    return raw.select(
        "order_id",
        F.unix_seconds(ts).alias("submitted_epoch"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("submitted_text"),
    ).distinct()


def type_conform(spark, sf_dir):
    raw = ws(spark, sf_dir).raw_batched()
    return raw.select(
        "order_id",
        "product_id",
        try_cast("product_quantity", "int").cast("bigint").alias("product_quantity"),
        try_cast("product_sold_price", "decimal(10,2)").cast("double").alias("product_sold_price"),
        try_cast("shipping_address_zip", "int").cast("bigint").alias("shipping_address_zip"),
        try_cast("sales_rep_zip", "int").cast("bigint").alias("sales_rep_zip"),
    )


# -- A7, P11, K4/K5, F2 ---------------------------------------------------------------------
def sales_reps_dedupe(spark, sf_dir):
    reps = ws(spark, sf_dir).sales_reps()
    return reps.select(
        "sales_rep_id",
        "sales_rep_ssn",
        "sales_rep_first_name",
        "sales_rep_last_name",
        "sales_rep_address",
        "sales_rep_city",
        "sales_rep_state",
        F.col("sales_rep_zip").cast("bigint").alias("sales_rep_zip"),
        source_of("ingest_file_name").alias("source"),
        "_error_ssn_format",
    )


def _orders_out(df: DataFrame) -> DataFrame:
    return df.select(
        F.unix_seconds("submitted_at").alias("submitted_epoch"),
        "submitted_yyyy_mm",
        "order_id",
        "customer_id",
        "sales_rep_id",
        "shipping_address_attention",
        "shipping_address_address",
        "shipping_address_city",
        "shipping_address_state",
        F.col("shipping_address_zip").cast("bigint").alias("shipping_address_zip"),
        source_of("ingest_file_name").alias("source"),
    )


def orders_dedupe(spark, sf_dir):
    return _orders_out(ws(spark, sf_dir).orders(version=0))


def orders_by_month_partition(spark, sf_dir):
    return ws(spark, sf_dir).orders().groupBy("submitted_yyyy_mm").agg(F.count(F.lit(1)).alias("orders"))


def month_pruned_scan(spark, sf_dir):
    o = ws(spark, sf_dir).orders()
    lo, hi = MONTH_RANGE
    return o.filter(
        F.col("submitted_yyyy_mm").between(lo, hi) & (F.col("shipping_address_state") == MONTH_STATE)
    ).select("order_id", "customer_id", "submitted_yyyy_mm")


def _items_out(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id",
        "product_id",
        F.col("product_quantity").cast("bigint").alias("product_quantity"),
        _money("product_sold_price").alias("product_sold_price"),
        source_of("ingest_file_name").alias("source"),
    )


def line_items_typed(spark, sf_dir):
    return _items_out(ws(spark, sf_dir).line_items(version=0))


# -- S6, P7, F1, D8, J3 ------------------------------------------------------------------------
def _products_out(df: DataFrame) -> DataFrame:
    return df.select(*PRODUCTS_SCHEMA.names)


def xml_products(spark, sf_dir):
    xml = read_products_xml(spark, ws(spark, sf_dir).raw_paths()["products_xml"])
    return _products_out(normalize.products(xml, priced_only=False))


def priced_products(spark, sf_dir):
    return _products_out(ws(spark, sf_dir).products())


def product_adj_range(spark, sf_dir):
    return dq.value_range(ws(spark, sf_dir).products(), ["color_adj", "size_adj"])


def product_line_items(spark, sf_dir):
    w = ws(spark, sf_dir)
    wide = normalize.product_line_items(w.line_items(), w.products())
    return wide.select(
        "product_id",
        "order_id",
        F.col("product_quantity").cast("bigint").alias("product_quantity"),
        _money("product_sold_price").alias("product_sold_price"),
        "color",
        "model_name",
        "model_number",
        _money("base_price").alias("base_price"),
        _money("color_adj").alias("color_adj"),
        _money("size_adj").alias("size_adj"),
        _money("price").alias("price"),
        "size",
    )


# -- S7/P8, streaming -----------------------------------------------------------------------------
def _stream_docs(spark, sf_dir) -> DataFrame:
    from ordertide.functions.clean import with_lineage

    return with_lineage(read_orders_json(spark, ws(spark, sf_dir).raw_paths()["stream"]))


def json_static_explode(spark, sf_dir):
    return _items_out(explode_line_items(_stream_docs(spark, sf_dir)))


def stream_orders(spark, sf_dir):
    o = ws(spark, sf_dir).orders()
    return _orders_out(o.filter(source_of("ingest_file_name") == STREAM_ROUTE))


def stream_line_items(spark, sf_dir):
    li = ws(spark, sf_dir).line_items()
    return _items_out(li.filter(source_of("ingest_file_name") == STREAM_ROUTE))


def stream_batch_rows(spark, sf_dir):
    """Rows over all micro-batches; how they split into batches varies."""
    w = ws(spark, sf_dir)
    w.streamed()
    return w.order_stream().batch_commits().agg(
        F.sum("order_rows").cast("bigint").alias("order_rows"),
        F.sum("line_item_rows").cast("bigint").alias("line_item_rows"),
        (F.count(F.lit(1)) >= 1).alias("has_batches"),
        (F.min("order_rows") > 0).alias("no_empty_batch"),
    )


def _orders_by_source(o: DataFrame) -> DataFrame:
    return o.groupBy(source_of("ingest_file_name").alias("source")).agg(F.count(F.lit(1)).alias("orders"))


def stream_restart(spark, sf_dir):
    """Restart the finished stream on its checkpoint: nothing new is read."""
    w = ws(spark, sf_dir)
    w.streamed()
    w.order_stream().run_available()
    return _orders_by_source(w.orders())


def _scratch(w: Workspace, name: str) -> str:
    return f"{w.root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def _settled(w: Workspace, df: DataFrame, folder: str) -> DataFrame:
    """Materialise a query's result and remove the scratch copy it came from."""
    out = df.checkpoint(eager=True)
    fs.remove(w.spark, folder)
    return out


def stream_replay(spark, sf_dir):
    """Feed the same micro-batch id twice to the batch writer: one copy lands."""
    from ordertide.streaming.orders import OrderStream

    w = ws(spark, sf_dir)
    base = _scratch(w, "replay")
    o = VersionedTable(spark, f"{base}/orders", "orders", partition_by=["submitted_yyyy_mm"])
    li = VersionedTable(spark, f"{base}/line_items", "line_items")
    s = OrderStream(spark, w.raw_paths()["stream"], o, li, f"{base}/checkpoints", query_name="replay")
    docs = _stream_docs(spark, sf_dir)
    s._process(docs, 0)
    s._process(docs, 0)
    return _settled(w, _orders_out(o.read()), base)


def stream_reconcile(spark, sf_dir):
    """Base rows + new documents = table rows, for both tables."""
    w = ws(spark, sf_dir)
    w.streamed()
    docs = _stream_docs(spark, sf_dir)
    out = None
    for name, table, new in (
        ("orders", w.orders_table(), flatten_orders(docs)),
        ("line_items", w.line_items_table(), explode_line_items(docs)),
    ):
        row = dq.scalar_row(
            {
                "base_rows": table.read(0).agg(F.count(F.lit(1))),
                "new_rows": new.agg(F.count(F.lit(1))),
                "actual_rows": table.read().agg(F.count(F.lit(1))),
            }
        ).select(
            F.lit(name).alias("table_name"),
            "base_rows",
            "new_rows",
            "actual_rows",
            (F.col("base_rows") + F.col("new_rows") == F.col("actual_rows")).alias("ok"),
        )
        out = row if out is None else out.unionByName(row)
    return out


# -- versioned tables ---------------------------------------------------------------------------
def snapshot_history(spark, sf_dir):
    w = ws(spark, sf_dir)
    w.streamed()
    return w.orders_table().history().groupBy("op").agg(F.sum("rows").cast("bigint").alias("rows"))


def snapshot_as_of(spark, sf_dir):
    w = ws(spark, sf_dir)
    w.streamed()
    return w.orders_table().read(0).groupBy("submitted_yyyy_mm").agg(F.count(F.lit(1)).alias("orders"))


def snapshot_restore(spark, sf_dir):
    """Batch items, then streamed items appended, then restored to version 0."""
    w = ws(spark, sf_dir)
    base = _scratch(w, "restore")
    t = VersionedTable(spark, base, "line_items")
    t.commit(w.line_items(version=0), "overwrite")
    t.commit(explode_line_items(_stream_docs(spark, sf_dir)), "append")
    t.restore(0)
    rows = t.read().groupBy(source_of("ingest_file_name").alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    return _settled(w, rows, base)


def schema_enforced_append(spark, sf_dir):
    """Appends must conform by name and type; a mismatch is refused."""
    w = ws(spark, sf_dir)
    base = _scratch(w, "conform")
    t = VersionedTable(spark, base, "products")
    products = w.products()
    t.commit(products, "overwrite")
    bad = products.withColumn("price", F.col("price").cast("string"))
    try:
        t.append_conforming(bad)
    except SchemaMismatch:
        pass
    else:
        raise AssertionError("a non-conforming append was accepted")
    t.append_conforming(products.select(*reversed(products.columns)))
    copies = t.read().groupBy("product_id").agg(F.count(F.lit(1)).alias("copies"), F.max("price").alias("price"))
    return _settled(w, copies, base)


# -- business questions -------------------------------------------------------------------------
def _tables(spark, sf_dir):
    w = ws(spark, sf_dir)
    return w.line_items(), w.products(), w.orders(), w.sales_reps()


def orders_by_state(spark, sf_dir):
    return questions.orders_per_state(ws(spark, sf_dir).orders())


def price_stats(spark, sf_dir):
    li, p, o, r = _tables(spark, sf_dir)
    q = questions.price_stats(li, p, o, r, Q2_COLOR, Q2_STATE)
    return q.select(
        F.col("`avg(product_sold_price)`").cast("double").alias("avg_price"),
        F.col("`min(product_sold_price)`").cast("double").alias("min_price"),
        F.col("`max(product_sold_price)`").cast("double").alias("max_price"),
    )


def profit_by_rep(spark, sf_dir):
    li, p, o, r = _tables(spark, sf_dir)
    return questions.profit_by_rep(li, p, o, r).select(
        "sales_rep_id", "sales_rep_first_name", "sales_rep_last_name",
        F.col("`sum(total_profit)`").cast("double").alias("total_profit"),
    )


def top_rep_by_profit(spark, sf_dir):
    li, p, o, r = _tables(spark, sf_dir)
    top = questions.top_rep_by_profit(questions.profit_by_rep(li, p, o, r))
    return top.select(
        "sales_rep_id", "sales_rep_first_name", "sales_rep_last_name",
        F.col("`sum(total_profit)`").cast("double").alias("total_profit"),
    )


def join_using(spark, sf_dir):
    li, p, o, r = _tables(spark, sf_dir)
    j = questions.join_using(li, p, o, r)
    return j.groupBy("sales_rep_id", "shipping_address_state").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("product_quantity").cast("bigint").alias("quantity"),
        F.sum("product_sold_price").cast("double").alias("sold"),
    )


# -- data quality ---------------------------------------------------------------------------------
def dq_cleanliness(spark, sf_dir):
    """D3 on the raw files of all three formats (before cleaning) and on the
    cleaned raw dataset (after): injected defects and the padding of
    fixed-width fields are found, and none survive."""
    w = ws(spark, sf_dir)
    paths = w.raw_paths()
    before = ingest.read_all_batches(spark, paths, clean=False)
    before = before.withColumn("dataset", F.concat(F.lit("raw:"), source_of("ingest_file_name")))
    after = w.raw_batched().withColumn("dataset", F.lit("ingested"))
    cols = RAW_ORDER_COLUMNS
    return dq.string_hygiene(before.select("dataset", *cols), cols, by=["dataset"]).unionByName(
        dq.string_hygiene(after.select("dataset", *cols), cols, by=["dataset"])
    )


def dq_lengths(spark, sf_dir):
    return dq.length_violations(ws(spark, sf_dir).raw_batched(), EXPECTED_LENGTHS)


def _route_years(spark) -> DataFrame:
    rows, first = [], 0
    for name, last in ROUTES:
        rows.append((name, first, last))
        first = last + 1
    return spark.createDataFrame(rows, "source string, first_year int, last_year int")


def dq_file_year(spark, sf_dir):
    """The year of every row agrees with the file it came from."""
    raw = ws(spark, sf_dir).raw_batched()
    years = _route_years(spark)  # one row per file format (bounded)
    y = F.year(epoch_to_timestamp("submitted_at"))
    return (
        raw.select(source_of("ingest_file_name").alias("source"), y.alias("year"))
        .join(F.broadcast(years), "source", "left")
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(~F.coalesce(F.col("year").between(F.col("first_year"), F.col("last_year")), F.lit(False)))
            .cast("bigint").alias("violations"),
        )
    )


def dq_ingest_today(spark, sf_dir):
    """Every row was ingested on the day its build ran."""
    w = ws(spark, sf_dir)
    built_on = w.built_on()
    return dq.date_violations(w.raw_batched(), "ingested_at", built_on, source_of("ingest_file_name"))


def dq_non_null(spark, sf_dir):
    return dq.null_profile(ws(spark, sf_dir).orders(), ORDERS_SCHEMA.names)


def dq_flag_count(spark, sf_dir):
    reps = ws(spark, sf_dir).sales_reps()
    return reps.agg(
        F.count(F.lit(1)).alias("reps"),
        F.count_if("_error_ssn_format").cast("bigint").alias("flagged_reps"),
        F.count_if(F.col("sales_rep_ssn").isNull()).cast("bigint").alias("ssn_missing"),
    )


def dq_cast_failures(spark, sf_dir):
    casts = {
        "submitted_at": "bigint",
        "sales_rep_ssn": "bigint",
        "sales_rep_zip": "int",
        "shipping_address_zip": "int",
        "product_quantity": "int",
        "product_sold_price": "decimal(10,2)",
    }
    raw = ws(spark, sf_dir).raw_batched().withColumn("sales_rep_ssn", F.translate("sales_rep_ssn", "-", ""))
    return dq.cast_failures(raw, casts)


def dq_schema(spark, sf_dir):
    """D1 for every table: columns expected, differences found in the footers
    of its files, and rows."""
    w = ws(spark, sf_dir)
    w.streamed()
    tables = {
        "sales_reps": (w.sales_reps(), w.sales_reps().schema, SALES_REPS_SCHEMA),
        "orders": (w.orders(), w.orders_table().written_schema(), ORDERS_SCHEMA),
        "line_items": (w.line_items(), w.line_items_table().written_schema(), LINE_ITEMS_SCHEMA),
        "products": (w.products(), w.products().schema, PRODUCTS_SCHEMA),
    }
    out = None
    for name, (df, found, expected) in tables.items():
        diffs = dq.schema_check(spark, found, expected).agg(F.count(F.lit(1)).alias("differences"))
        row = dq.scalar_row({"differences": diffs, "rows": df.agg(F.count(F.lit(1)))}).select(
            F.lit(name).alias("table_name"), F.lit(len(expected.fields)).cast("bigint").alias("columns"), "differences", "rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


def dq_partitions(spark, sf_dir):
    """Month partitions present, and expected months that are missing."""
    return dq.month_coverage(ws(spark, sf_dir).orders(), expected=gate.months_between(*EXPECTED_MONTHS))


def dq_result_diff(spark, sf_dir):
    """Q1 by SQL text on the views against Q1 from the source tables."""
    w = ws(spark, sf_dir)
    names = w.register_views()
    via_sql = spark.sql(
        f"SELECT shipping_address_state, count(1) AS count FROM {names[0]} GROUP BY shipping_address_state"
    )
    for name in names:  # the plan above is resolved; the names aren't needed any more
        spark.catalog.dropTempView(name)
    expected = gate.expected_orders_per_state(spark, sf_dir)
    diff = dq.multiset_diff(via_sql, expected)
    return dq.scalar_row(
        {"rows": via_sql.agg(F.count(F.lit(1))), "differing_rows": diff.agg(F.count(F.lit(1)))}
    )


def dq_result_order(spark, sf_dir):
    """Q1 comes in descending order of its count."""
    q1 = questions.orders_per_state(ws(spark, sf_dir).orders())
    return dq.disorder(q1, "count", ascending=False)


def _expected_counts(spark, sf_dir) -> DataFrame:
    """The manifest: expected counts computed straight from the source tables.

    One aggregate over the enriched orders: an order has line items exactly
    when its rep (the supplier of its first line) was found, batch orders
    without items never reach a file, and streamed orders always do.
    """
    from ordertide.plans.fixtures import enriched_orders, table

    eo = enriched_orders(spark, sf_dir)
    batch = (F.col("route") != STREAM_ROUTE) & F.col("s_suppkey").isNotNull()
    orders_and_reps = eo.agg(
        F.count_if(batch | (F.col("route") == STREAM_ROUTE)).cast("bigint").alias("orders"),
        F.count_distinct(F.when(batch, F.col("s_suppkey"))).cast("bigint").alias("sales_reps"),
    ).unpivot([], ["orders", "sales_reps"], "table_name", "expected")
    items = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).cast("bigint").alias("expected")).select(
        F.lit("line_items").alias("table_name"), "expected")
    products = table(spark, sf_dir, "part").agg(
        F.count_if(F.col("p_size") > 25).cast("bigint").alias("expected")).select(
        F.lit("products").alias("table_name"), "expected")
    return orders_and_reps.unionByName(items).unionByName(products)


def dq_count_reconcile(spark, sf_dir):
    w = ws(spark, sf_dir)
    actual = {"orders": w.orders(), "line_items": w.line_items(), "products": w.products(), "sales_reps": w.sales_reps()}
    return dq.reconcile_counts(actual, _expected_counts(spark, sf_dir))


def dq_xml_count(spark, sf_dir):
    """XML rows, priced products and products not yet for sale."""
    w = ws(spark, sf_dir)
    xml = normalize.products(read_products_xml(spark, w.raw_paths()["products_xml"]), priced_only=False)
    return xml.agg(
        F.count(F.lit(1)).alias("xml_rows"),
        F.count("price").alias("priced"),
        F.count_if(F.col("price").isNull()).cast("bigint").alias("unpriced"),
    )


def check_results(spark, sf_dir) -> DataFrame:
    """All stages' check rows ``(suite, check_id, status, violations, total)``,
    run once per workspace and persisted; later calls only read them."""
    w = ws(spark, sf_dir)

    def run(folder: str) -> None:
        gate.write_results(
            w, folder, price_stats(spark, sf_dir), top_rep_by_profit(spark, sf_dir), questions.orders_per_state(w.orders()), stream_reconcile(spark, sf_dir)
        )

    return gate.read_results(spark, w.checked(run))


def dq_check_results(spark, sf_dir):
    return check_results(spark, sf_dir)


def dq_stage_rollup(spark, sf_dir):
    return dq.stage_rollup(check_results(spark, sf_dir))


def dq_final_gate(spark, sf_dir):
    return dq.final_gate(check_results(spark, sf_dir), gate.STAGES)


# -- the same checks on data with injected defects ---------------------------------------------
def dq_lengths_defects(spark, sf_dir):
    return defects.lengths(ws(spark, sf_dir).raw_batched())


def dq_file_year_defects(spark, sf_dir):
    return defects.file_years(ws(spark, sf_dir).raw_batched())


def dq_cast_failures_defects(spark, sf_dir):
    return defects.cast_failures(ws(spark, sf_dir).raw_batched())


def dq_non_null_defects(spark, sf_dir):
    return defects.null_profile(ws(spark, sf_dir).orders())


def dq_partitions_defects(spark, sf_dir):
    return defects.months(ws(spark, sf_dir).orders())


def dq_schema_defects(spark, sf_dir):
    return defects.schemas(ws(spark, sf_dir))


def dq_result_diff_defects(spark, sf_dir):
    return defects.result_differences(questions.orders_per_state(ws(spark, sf_dir).orders()))


def _defect_rows(spark, sf_dir):
    return defects.check_rows(ws(spark, sf_dir), gate.expected_counts(spark, sf_dir))


def dq_check_results_defects(spark, sf_dir):
    return _defect_rows(spark, sf_dir).select("suite", "check_id", "status", "violations", "total")


def dq_stage_rollup_defects(spark, sf_dir):
    return dq.stage_rollup(_defect_rows(spark, sf_dir))


def dq_final_gate_defects(spark, sf_dir):
    """Two stages with failing checks, the other four without results."""
    return dq.final_gate(_defect_rows(spark, sf_dir), gate.STAGES)


def dq_ingest_today_defects(spark, sf_dir):
    w = ws(spark, sf_dir)
    return defects.ingest_dates(w.raw_batched(), w.built_on())


def product_adj_check(spark, sf_dir):
    """Least and greatest adjustments equal the expected ones."""
    ranges = dq.value_range(ws(spark, sf_dir).products(), list(gate.EXPECTED_RANGES))
    return dq.range_check(ranges, gate.EXPECTED_RANGES)


def product_adj_check_defects(spark, sf_dir):
    return defects.adjustments(ws(spark, sf_dir).products())


def dq_flag_check(spark, sf_dir):
    """Every rep's flag is that of its raw records."""
    w = ws(spark, sf_dir)
    return gate.flag_check(w.sales_reps(), w.raw_batched())


def dq_flag_check_defects(spark, sf_dir):
    w = ws(spark, sf_dir)
    return defects.flags(w.sales_reps(), w.raw_batched())


def dq_result_positions(spark, sf_dir):
    """Every row of Q1 with its place in the ordered result."""
    return dq.numbered(questions.orders_per_state(ws(spark, sf_dir).orders()))


def dq_result_positions_defects(spark, sf_dir):
    return defects.positions(questions.orders_per_state(ws(spark, sf_dir).orders()))


# -- rejected records, timed stream, managed orders, SQL text ------------------------------------
def rejected_records(spark, sf_dir):
    """The records that the five readers could not read."""
    return broken.rejects(ws(spark, sf_dir))


def rejected_counts(spark, sf_dir):
    """Accepted + rejected = lines, per source."""
    return broken.counts(ws(spark, sf_dir))


def stream_throttled(spark, sf_dir):
    """A throttled, timed run, stopped when drained: its tables
    equal the documents read at once, in files / throttle batches."""
    return timed.throttled(ws(spark, sf_dir), _stream_docs(spark, sf_dir))


def stream_progress(spark, sf_dir):
    """The run's stored progress: triggers in bounds, rows as throttled."""
    return timed.progress(ws(spark, sf_dir))


def orders_managed_by_month(spark, sf_dir):
    return managed.orders_by_month(spark, ws(spark, sf_dir).orders())


def dq_months_in_catalog(spark, sf_dir):
    return managed.months_in_catalog(spark, ws(spark, sf_dir).orders())


def insert_by_name(spark, sf_dir):
    return managed.inserts(spark, ws(spark, sf_dir).orders())


def _question_tables(spark, sf_dir):
    w = ws(spark, sf_dir)
    return {"orders": w.orders(), "line_items": w.line_items(), "sales_reps": w.sales_reps(), "products": w.products()}


def price_stats_sql(spark, sf_dir):
    """Q2 by SQL text on a view on a view, its values bound to markers."""
    with questions_sql.question_views(spark, _question_tables(spark, sf_dir), f"q{uuid.uuid4().hex[:8]}_") as prefix:
        q = questions_sql.price_stats(spark, prefix, Q2_COLOR, Q2_STATE)
    return q.select(*[_money(c).alias(c) for c in q.columns])


def top_rep_by_profit_sql(spark, sf_dir):
    """Q3 by SQL text, as above."""
    with questions_sql.question_views(spark, _question_tables(spark, sf_dir), f"q{uuid.uuid4().hex[:8]}_") as prefix:
        q = questions_sql.top_reps(spark, prefix, 1)
    return q.withColumn("total_profit", _money("total_profit"))


# -- inventory and catalog ------------------------------------------------------------------------
def file_inventory_q(spark, sf_dir):
    """Files and bytes of every raw input, the stream checkpoint and
    the tables' data folders (listing only; contents are never read)."""
    w = ws(spark, sf_dir)
    w.streamed()
    tables = w.tables_dir()
    paths = dict(w.raw_paths())
    paths.update(
        {
            "checkpoint": f"{tables}/checkpoints",
            "orders_data": w.orders_table().data_path,
            "line_items_data": w.line_items_table().data_path,
            "sales_reps_data": f"{tables}/sales_reps",
            "products_data": f"{tables}/products",
        }
    )
    found = file_inventory(spark, paths)
    return found.select("source", (F.col("files") > 0).alias("has_files"), (F.col("bytes") >= F.col("files")).alias("has_bytes"))


def catalog_objects(spark, sf_dir):
    """A database with two managed tables (one partitioned
    by month), a view, a cached view; listed from the catalog, with the
    tables' rows.  Everything created here is dropped again."""
    from ordertide.operators import catalog

    w = ws(spark, sf_dir)
    db = f"ordertide_{uuid.uuid4().hex[:12]}"
    previous = spark.catalog.currentDatabase()
    view = f"{db}_reps"
    catalog.use_database(spark, db)
    try:
        catalog.save_managed(w.products().select("product_id", "price"), f"`{db}`.products")
        monthly = w.orders().groupBy("submitted_yyyy_mm").agg(F.count(F.lit(1)).alias("orders"))
        catalog.save_managed(monthly, f"`{db}`.orders_by_month", ["submitted_yyyy_mm"])
        catalog.cache_view(spark, w.sales_reps().select("sales_rep_id"), view)
        described = {r.col_name for r in catalog.describe(spark, f"`{db}`.orders_by_month").collect()}
        listed = {r.tableName for r in catalog.list_tables(spark, db).collect()}
        rows = [
            (
                t.name.replace(view, "reps_view"),
                t.tableType,
                bool(t.isTemporary),
                t.name in listed,
                spark.catalog.isCached(t.name if t.isTemporary else f"`{db}`.{t.name}"),
                "submitted_yyyy_mm" in described,
                spark.table(t.name if t.isTemporary else f"`{db}`.{t.name}").count(),
            )
            for t in spark.catalog.listTables(db)
            if t.name in ("products", "orders_by_month", view)
        ]
    finally:
        if spark.catalog.tableExists(view):
            spark.catalog.uncacheTable(view)
            spark.catalog.dropTempView(view)
        spark.catalog.setCurrentDatabase(previous)
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    return spark.createDataFrame(
        rows,
        "name string, table_type string, is_temporary boolean, in_show_tables boolean, is_cached boolean, month_described boolean, rows bigint",
    )


QUERIES = {
    "fixed_width_ingest": fixed_width_ingest,
    "tsv_ingest": tsv_ingest,
    "csv_positional_rename": csv_positional_rename,
    "batch_append": batch_append,
    "clean_strings": clean_strings,
    "null_profile": null_profile,
    "lineage_columns": lineage_columns,
    "ssn_error_flag": ssn_error_flag,
    "ssn_to_long": ssn_to_long_q,
    "ssn_to_long_vectorized": ssn_to_long_vectorized,
    "epoch_to_timestamp": epoch_to_timestamp_q,
    "type_conform": type_conform,
    "sales_reps_dedupe": sales_reps_dedupe,
    "orders_dedupe": orders_dedupe,
    "orders_by_month_partition": orders_by_month_partition,
    "month_pruned_scan": month_pruned_scan,
    "line_items_typed": line_items_typed,
    "xml_products": xml_products,
    "priced_products": priced_products,
    "product_adj_range": product_adj_range,
    "product_line_items": product_line_items,
    "json_static_explode": json_static_explode,
    "stream_orders": stream_orders,
    "stream_line_items": stream_line_items,
    "stream_batch_rows": stream_batch_rows,
    "stream_restart": stream_restart,
    "stream_replay": stream_replay,
    "stream_reconcile": stream_reconcile,
    "snapshot_history": snapshot_history,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_restore": snapshot_restore,
    "schema_enforced_append": schema_enforced_append,
    "orders_by_state": orders_by_state,
    "price_stats": price_stats,
    "profit_by_rep": profit_by_rep,
    "top_rep_by_profit": top_rep_by_profit,
    "join_using": join_using,
    "dq_cleanliness": dq_cleanliness,
    "dq_lengths": dq_lengths,
    "dq_file_year": dq_file_year,
    "dq_ingest_today": dq_ingest_today,
    "dq_non_null": dq_non_null,
    "dq_flag_count": dq_flag_count,
    "dq_cast_failures": dq_cast_failures,
    "dq_schema": dq_schema,
    "dq_partitions": dq_partitions,
    "dq_result_diff": dq_result_diff,
    "dq_count_reconcile": dq_count_reconcile,
    "dq_xml_count": dq_xml_count,
    "dq_result_order": dq_result_order,
    "dq_check_results": dq_check_results,
    "dq_lengths_defects": dq_lengths_defects,
    "dq_file_year_defects": dq_file_year_defects,
    "dq_cast_failures_defects": dq_cast_failures_defects,
    "dq_non_null_defects": dq_non_null_defects,
    "dq_partitions_defects": dq_partitions_defects,
    "dq_schema_defects": dq_schema_defects,
    "dq_result_diff_defects": dq_result_diff_defects,
    "dq_check_results_defects": dq_check_results_defects,
    "dq_stage_rollup_defects": dq_stage_rollup_defects,
    "dq_final_gate_defects": dq_final_gate_defects,
    "dq_stage_rollup": dq_stage_rollup,
    "dq_final_gate": dq_final_gate,
    "file_inventory": file_inventory_q,
    "catalog_objects": catalog_objects,
    "rejected_records": rejected_records,
    "rejected_counts": rejected_counts,
    "stream_throttled": stream_throttled,
    "stream_progress": stream_progress,
    "orders_managed_by_month": orders_managed_by_month,
    "dq_months_in_catalog": dq_months_in_catalog,
    "insert_by_name": insert_by_name,
    "price_stats_sql": price_stats_sql,
    "top_rep_by_profit_sql": top_rep_by_profit_sql,
    "dq_ingest_today_defects": dq_ingest_today_defects,
    "product_adj_check": product_adj_check,
    "product_adj_check_defects": product_adj_check_defects,
    "dq_flag_check": dq_flag_check,
    "dq_flag_check_defects": dq_flag_check_defects,
    "dq_result_positions": dq_result_positions,
    "dq_result_positions_defects": dq_result_positions_defects,
}
