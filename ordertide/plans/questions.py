"""Business questions over the four tables.

Results keep the specification's column names (``count``,
``avg(product_sold_price)``, ``sum(total_profit)``); callers that need plain
names alias them.  Sorting is done at the consumer: an ORDER BY inside a
reusable view is lost by later shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_per_state(orders: DataFrame) -> DataFrame:
    """Q1: orders per shipping state, most first, ties by state."""
    return (
        orders.groupBy("shipping_address_state")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("shipping_address_state"))
    )


def _four_way(line_items: DataFrame, products: DataFrame, orders: DataFrame, sales_reps: DataFrame) -> DataFrame:
    li = line_items.alias("li")
    p = products.alias("p")
    o = orders.alias("o")
    r = sales_reps.alias("r")
    return (
        li.join(p, F.col("li.product_id") == F.col("p.product_id"))
        .join(o, F.col("li.order_id") == F.col("o.order_id"))
        .join(r, F.col("o.sales_rep_id") == F.col("r.sales_rep_id"))
    )


def price_stats(
    line_items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    sales_reps: DataFrame,
    color: str,
    state: str,
    ssn_error_only: bool = True,
) -> DataFrame:
    """Q2: avg / min / max sold price of one colour shipped to one state,
    optionally only for reps who submitted a malformed SSN.  The filters
    reach the three scans (pushed down), so only matching rows are joined."""
    cond = (F.col("p.color") == color) & (F.col("o.shipping_address_state") == state)
    if ssn_error_only:
        cond = cond & F.col("r._error_ssn_format")
    price = F.col("li.product_sold_price")
    return (
        _four_way(line_items, products, orders, sales_reps)
        .filter(cond)
        .agg(
            F.avg(price).alias("avg(product_sold_price)"),
            F.min(price).alias("min(product_sold_price)"),
            F.max(price).alias("max(product_sold_price)"),
        )
    )


def profit_by_rep(
    line_items: DataFrame, products: DataFrame, orders: DataFrame, sales_reps: DataFrame, exact: bool = True
) -> DataFrame:
    """A3: total profit per rep, ``(sold - price) * quantity`` summed.

    Grouped by rep id as well as the names (two reps may share a name).
    With ``exact`` (default) the catalogue price is taken as a cents decimal
    like the sold price, so the sum is exact and independent of how rows are
    partitioned; otherwise decimal - double gives a double (order-dependent
    rounding in the last bits).

    The profit is first summed per order (partial aggregation right after
    the product join), so the shuffle join with ``orders`` moves one row per
    order instead of one per line item; with exact sums this is the same
    answer.  Each order row then contributes its order's total, as in the
    plain four-way join.
    """
    li = line_items.alias("li")
    p = products.alias("p")
    price = F.col("p.price").cast("decimal(10,2)") if exact else F.col("p.price")
    profit = (F.col("li.product_sold_price") - price) * F.col("li.product_quantity")
    per_order = (
        li.join(p, F.col("li.product_id") == F.col("p.product_id"))
        .groupBy(F.col("li.order_id").alias("order_id"))
        .agg(F.sum(profit).alias("order_profit"))
        .alias("po")
    )
    o = orders.alias("o")
    r = sales_reps.alias("r")
    return (
        per_order.join(o, F.col("po.order_id") == F.col("o.order_id"))
        .join(r, F.col("o.sales_rep_id") == F.col("r.sales_rep_id"))
        .groupBy(
            F.col("r.sales_rep_id").alias("sales_rep_id"),
            F.col("r.sales_rep_first_name").alias("sales_rep_first_name"),
            F.col("r.sales_rep_last_name").alias("sales_rep_last_name"),
        )
        .agg(F.sum("po.order_profit").alias("sum(total_profit)"))
    )


def top_rep_by_profit(profit: DataFrame, n: int = 1) -> DataFrame:
    """Q3: the rep(s) with the largest profit; ties broken by rep id.
    ``orderBy().limit(n)`` is planned as a top-k, not a full sort."""
    return profit.orderBy(F.col("sum(total_profit)").desc(), F.col("sales_rep_id")).limit(n)


def join_using(line_items: DataFrame, products: DataFrame, orders: DataFrame, sales_reps: DataFrame) -> DataFrame:
    """The same four-way join on shared column names (keys coalesced)."""
    return (
        line_items.drop("ingest_file_name", "ingested_at")
        .join(products, "product_id")
        .join(orders.drop("ingest_file_name", "ingested_at"), "order_id")
        .join(sales_reps.drop("ingest_file_name", "ingested_at"), "sales_rep_id")
    )
