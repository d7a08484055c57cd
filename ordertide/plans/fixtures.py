"""Raw input files derived from the test tables.

The order pipeline consumes files (fixed-width, tab- and comma-separated,
order JSON documents, product XML).  They are produced here, with Spark, from
the star-schema tables so every downstream query does work proportional to
those tables.  The mapping is a pure function of the table rows; the oracle
SQL in :mod:`ordertide.plans.oracle` restates it independently.

Mapping (one raw row per line item):

* order     ``o_orderkey`` / ``o_custkey`` / ``o_orderdate`` (epoch seconds)
* sales rep the supplier of the order's first line (lowest line number, then
  lowest supplier key) - one rep per order, as the order tables require
* shipping  the customer and the customer's nation
* product   ``l_partkey``, ``l_quantity``, ``l_extendedprice``
* route     the order year decides the file format (see ``ROUTES``)

Dirty values are injected on ``shipping_address_attention`` by order key so
the cleaning and quality operators have exact counts to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import fs
from ordertide.plans.jobs import run_concurrently
from ordertide.schemas import COMMA_SEPARATED_HEADER, FIXED_WIDTH_LAYOUT, RAW_ORDER_COLUMNS, camel  # noqa: F401

# Order year -> file route.  Years after the last batch route
# arrive as streamed JSON documents.
ROUTES = [
    ("fixed_width", 1996),  # years <= 1996
    ("tab_separated", 1998),  # 1997-1998
    ("comma_separated", 2000),  # 1999-2000
]
STREAM_ROUTE = "stream"
BATCH_ROUTES = [name for name, _ in ROUTES]

# Dirty-value injection on shipping_address_attention by
# o_orderkey % 7: 0 -> blank, 1 -> literal "null", 2 -> padded with spaces.
DIRTY_MODULUS = 7

# The order columns that the raw files are made of, and the number of an
# order's row (keys may repeat).
ORDER_ROW = "_order_row"
ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "epoch", "route", "c_name", "c_nationkey", "c_nation", "s_suppkey", "s_name", "s_nationkey", "s_nation",
]

# Raw text is kept compressed (a fixed-width line is mostly
# blanks).  A compressed file is read by one task, so a file holds few rows.
COMPACT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "50000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def route_of(year: Column) -> Column:
    expr = F.lit(STREAM_ROUTE)
    for name, last_year in reversed(ROUTES):
        expr = F.when(year <= last_year, F.lit(name)).otherwise(expr)
    return expr


def state_code(nationkey: Column) -> Column:
    """Two-letter region code of a nation key (AA, AB, ... EE)."""
    return F.concat(
        F.chr(F.lit(65) + F.floor(nationkey / 5).cast("int")),
        F.chr(F.lit(65) + (nationkey % 5)),
    )


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer, shipping nation and sales rep.

    The rep per order is a partial+final aggregate on ``l_orderkey`` (a hot
    order key is combined map-side, never collected), then joined 1:1.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    rep = lineitem.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_suppkey")).alias("first_line")
    ).select(F.col("l_orderkey").alias("o_orderkey"), F.col("first_line.l_suppkey").alias("rep_suppkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"))
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"))
    epoch = (
        F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400
        + F.hour("o_orderdate") * 3600
        + F.minute("o_orderdate") * 60
        + F.second("o_orderdate")
    )
    return (
        orders.join(rep, "o_orderkey", "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(cn, "c_nationkey")
        .join(supplier, F.col("rep_suppkey") == F.col("s_suppkey"), "left")
        .join(sn, "s_nationkey", "left")
        .withColumns({"epoch": epoch, "route": route_of(F.year("o_orderdate"))})
    )


def _zeros(number: Column, width: int) -> Column:
    """Leading zeros up to ``width`` digits; a longer number stays whole."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def _ssn(route: Column) -> Column:
    digits = _zeros(F.col("s_suppkey"), 9)
    hyphenated = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4))
    wrong = ((F.col("s_suppkey") % 3) == 0) | (((F.col("s_suppkey") % 3) == 1) & (route == "tab_separated"))
    return F.when(wrong, hyphenated).otherwise(digits)


def _attention() -> Column:
    k = F.col("o_orderkey") % DIRTY_MODULUS
    name = F.col("c_name")
    return (
        F.when(k == 0, F.lit(""))
        .when(k == 1, F.lit("null"))
        .when(k == 2, F.concat(F.lit("  "), name, F.lit("  ")))
        .otherwise(name)
    )


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Every line item with its order, for the files of all routes at once, so
    that the line items are shuffled once and not for each format.

    A merge join whatever the sizes: the rows of an order come out together
    (their files compress well), and AQE splits a hot order key.
    """
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return lineitem.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey")


def raw_order_rows(lines: DataFrame, route: str) -> DataFrame:
    """The :func:`order_lines` of one file as the 19 raw string columns plus
    ``route``."""
    joined = lines.filter(F.col("route") == route)
    s = lambda c: F.col(c).cast("string")
    return joined.select(
        s("epoch").alias("submitted_at"),
        s("o_orderkey").alias("order_id"),
        s("o_custkey").alias("customer_id"),
        s("s_suppkey").alias("sales_rep_id"),
        _ssn(F.col("route")).alias("sales_rep_ssn"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("sales_rep_first_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("sales_rep_last_name"),
        F.concat(s("s_suppkey"), F.lit(" Commerce St")).alias("sales_rep_address"),
        F.col("s_nation").alias("sales_rep_city"),
        state_code(F.col("s_nationkey")).alias("sales_rep_state"),
        F.lpad(((F.col("s_suppkey") * 7919) % 100000).cast("string"), 5, "0").alias("sales_rep_zip"),
        _attention().alias("shipping_address_attention"),
        F.concat(s("o_custkey"), F.lit(" Main St")).alias("shipping_address_address"),
        F.col("c_nation").alias("shipping_address_city"),
        state_code(F.col("c_nationkey")).alias("shipping_address_state"),
        F.lpad(((F.col("o_custkey") * 104729) % 100000).cast("string"), 5, "0").alias("shipping_address_zip"),
        s("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").cast("string").alias("product_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("product_sold_price"),
        F.col("route"),
    )


def order_documents(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Streamed orders as nested documents, one per order.

    Only line items of streamed orders are gathered, with a partial aggregate
    on the order's row; the format itself holds one order per document.
    """
    orders = orders.filter(F.col("route") == STREAM_ROUTE)
    items = lines.filter(F.col("route") == STREAM_ROUTE).groupBy(ORDER_ROW).agg(
        F.collect_list(
            F.struct(
                F.col("l_partkey").cast("string").alias("productId"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("l_extendedprice").cast("decimal(10,2)").alias("soldPrice"),
            )
        ).alias("products")
    )
    docs = orders.join(items, ORDER_ROW, "left")
    return docs.select(
        F.col("o_custkey").cast("string").alias("customerId"),
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.col("s_suppkey").cast("string").alias("salesRepId"),
        F.timestamp_seconds("epoch").alias("submittedAt"),
        F.coalesce("products", F.array().cast("array<struct<productId:string,quantity:int,soldPrice:decimal(10,2)>>")).alias("products"),
        F.struct(
            F.col("c_name").alias("attention"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St")).alias("address"),
            F.col("c_nation").alias("city"),
            state_code(F.col("c_nationkey")).alias("state"),
            F.lpad(((F.col("o_custkey") * 104729) % 100000).cast("string"), 5, "0").alias("zip"),
        ).alias("shippingAddress"),
    )


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in the XML row shape (attributes prefixed with ``_``).

    Parts with ``p_size <= 25`` are not yet for sale: no ``usd`` price.
    """
    part = table(spark, sf_dir, "part")
    ck = F.col("p_partkey") % 11
    sk = F.col("p_size") % 11
    color_adj = F.when(ck == 10, F.lit("1.10")).otherwise(F.concat(F.lit("1.0"), ck.cast("string")))
    size_adj = F.when(sk == 10, F.lit("1.00")).otherwise(F.concat(F.lit("0.9"), sk.cast("string")))
    return part.select(
        F.col("p_partkey").cast("string").alias("_product_id"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("model_name"),
        F.col("p_brand").alias("model_number"),
        F.struct(
            F.col("p_retailprice").alias("_base_price"),
            color_adj.cast("double").alias("_color_adj"),
            size_adj.cast("double").alias("_size_adj"),
            F.when(F.col("p_size") > 25, F.col("p_retailprice")).alias("usd"),
        ).alias("price"),
        F.col("p_size").cast("string").alias("size"),
    )


def fixed_width_lines(rows: DataFrame) -> DataFrame:
    """Render raw rows as fixed-width lines (``value`` column).  A value that
    is wider than its field fails the job instead of being cut."""

    def field(name: str, width: int) -> Column:
        value = F.coalesce(F.col(name), F.lit(""))
        wide = F.raise_error(F.concat(F.lit(f"{name} is wider than {width}: "), value)).cast("string")
        return F.when(F.length(value) > width, wide).otherwise(F.rpad(value, width, " "))

    return rows.select(F.concat(*[field(n, length) for n, _, length in FIXED_WIDTH_LAYOUT]).alias("value"))


def write_fixtures(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write every raw input under ``root``; returns the paths by role."""
    paths = {
        "fixed_width": f"{root}/raw/orders/batch/fixed_width",
        "tab_separated": f"{root}/raw/orders/batch/tab_separated",
        "comma_separated": f"{root}/raw/orders/batch/comma_separated",
        "stream": f"{root}/raw/orders/stream",
        "products_xml": f"{root}/raw/products",
    }
    # The order-grain join (customer, nations, rep) and then the line items
    # with their orders are materialized once, as columnar files in the shared
    # folder: lineage is cut, a lost executor recomputes neither, and each file
    # below is a selection of the rows.
    scratch = f"{root}/scratch"
    numbered = enriched_orders(spark, sf_dir).select(*ORDER_COLUMNS, F.monotonically_increasing_id().alias(ORDER_ROW))
    numbered.write.mode("overwrite").parquet(f"{scratch}/orders")
    orders = spark.read.schema(numbered.schema).parquet(f"{scratch}/orders")
    joined = order_lines(spark, sf_dir, orders)
    joined.write.mode("overwrite").parquet(f"{scratch}/lines")
    lines = spark.read.schema(joined.schema).parquet(f"{scratch}/lines")

    def fixed_width() -> None:
        rows = raw_order_rows(lines, "fixed_width")
        fixed_width_lines(rows).write.mode("overwrite").options(**COMPACT).text(paths["fixed_width"])

    def tab_separated() -> None:
        raw_order_rows(lines, "tab_separated").select(RAW_ORDER_COLUMNS).write.mode("overwrite").options(**COMPACT).option(
            "header", True
        ).option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(paths["tab_separated"])

    def comma_separated() -> None:
        raw_order_rows(lines, "comma_separated").select(
            [F.col(c).alias(h) for c, h in zip(RAW_ORDER_COLUMNS, COMMA_SEPARATED_HEADER)]
        ).write.mode("overwrite").options(**COMPACT).option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(paths["comma_separated"])

    def documents() -> None:
        # As many files as the data's size asks for.
        order_documents(orders, lines).hint("rebalance").write.mode("overwrite").options(**COMPACT).json(paths["stream"])

    def products() -> None:
        product_rows(spark, sf_dir).write.mode("overwrite").options(**COMPACT).format("xml").option(
            "rootTag", "products"
        ).option("rowTag", "product").save(paths["products_xml"])

    run_concurrently(fixed_width, tab_separated, comma_separated, documents, products)
    fs.remove(spark, scratch)
    return paths
