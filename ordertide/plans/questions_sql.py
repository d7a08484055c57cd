"""The business questions as SQL text: views on views, and queries with
parameter markers whose values are bound as typed literals (U2, K8)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A view of the sold lines, and on it one that adds the reps.
SOLD_LINES = """
CREATE OR REPLACE TEMPORARY VIEW {0}sold_lines AS
SELECT li.order_id, li.product_id, li.product_quantity, li.product_sold_price, p.color, p.price,
       o.shipping_address_state, o.sales_rep_id
FROM {0}line_items li
JOIN {0}products p ON li.product_id = p.product_id
JOIN {0}orders o ON li.order_id = o.order_id
"""
REP_LINES = """
CREATE OR REPLACE TEMPORARY VIEW {0}rep_lines AS
SELECT s.*, r.sales_rep_first_name, r.sales_rep_last_name, r._error_ssn_format,
       (s.product_sold_price - CAST(s.price AS DECIMAL(10,2))) * s.product_quantity AS profit
FROM {0}sold_lines s JOIN {0}sales_reps r ON s.sales_rep_id = r.sales_rep_id
"""
ORDERS_PER_STATE = """
SELECT shipping_address_state, count(1) AS count FROM {0}orders
GROUP BY shipping_address_state ORDER BY count DESC, shipping_address_state
"""
PRICE_STATS = """
SELECT avg(product_sold_price) AS avg_price, min(product_sold_price) AS min_price, max(product_sold_price) AS max_price
FROM {0}rep_lines WHERE _error_ssn_format AND color = :color AND shipping_address_state = :state
"""
TOP_REPS = """
SELECT sales_rep_id, sales_rep_first_name, sales_rep_last_name, sum(profit) AS total_profit
FROM {0}rep_lines GROUP BY sales_rep_id, sales_rep_first_name, sales_rep_last_name
ORDER BY total_profit DESC, sales_rep_id LIMIT :n
"""


@contextmanager
def question_views(spark: SparkSession, tables: dict[str, DataFrame], prefix: str) -> Iterator[str]:
    """The four tables and the two views on them as temporary views named
    ``<prefix><name>``; dropped at the end (plans made meanwhile stay valid)."""
    names = [f"{prefix}{t}" for t in tables]
    try:
        for name, df in zip(names, tables.values()):
            df.createOrReplaceTempView(name)
        for text in (SOLD_LINES, REP_LINES):
            spark.sql(text.format(prefix))
        yield prefix
    finally:
        for name in [f"{prefix}rep_lines", f"{prefix}sold_lines", *names]:
            spark.catalog.dropTempView(name)


def orders_per_state(spark: SparkSession, prefix: str) -> DataFrame:
    return spark.sql(ORDERS_PER_STATE.format(prefix))


def price_stats(spark: SparkSession, prefix: str, color: str, state: str) -> DataFrame:
    return spark.sql(PRICE_STATS.format(prefix), args={"color": color, "state": state})


def top_reps(spark: SparkSession, prefix: str, n: int = 1) -> DataFrame:
    return spark.sql(TOP_REPS.format(prefix), args={"n": n})
