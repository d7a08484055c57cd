"""Typed tables from the raw dataset: sales reps, orders, line items,
products and the wide product line items (A7, P10-P13, S6/P7/F1, J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.clean import (
    epoch_to_timestamp,
    month_key,
    ssn_to_long_in_pandas,
    ssn_format_error,
    ssn_to_long,
    try_cast,
)
from ordertide.operators.dedupe import dedupe_earliest
from ordertide.schemas import ORDER_KEYS, ORDERS_SCHEMA, SALES_REP_KEYS


def sales_reps(raw: DataFrame, vectorized: bool = False) -> DataFrame:
    """One row per distinct rep record; ``_error_ssn_format`` is true when
    any copy of the record carried a hyphenated SSN."""
    ssn = ssn_to_long_in_pandas if vectorized else ssn_to_long
    typed = raw.select(
        "sales_rep_id",
        ssn("sales_rep_ssn").alias("sales_rep_ssn"),
        "sales_rep_first_name",
        "sales_rep_last_name",
        "sales_rep_address",
        "sales_rep_city",
        "sales_rep_state",
        try_cast("sales_rep_zip", "int").alias("sales_rep_zip"),
        "ingest_file_name",
        "ingested_at",
        ssn_format_error("sales_rep_ssn").alias("_error_ssn_format"),
    )
    return dedupe_earliest(typed, SALES_REP_KEYS, any_true=["_error_ssn_format"])


def orders(raw: DataFrame) -> DataFrame:
    """One row per distinct order record, with the month partition key."""
    typed = raw.select(
        epoch_to_timestamp("submitted_at").alias("submitted_at"),
        "order_id",
        "customer_id",
        "sales_rep_id",
        "shipping_address_attention",
        "shipping_address_address",
        "shipping_address_city",
        "shipping_address_state",
        try_cast("shipping_address_zip", "int").alias("shipping_address_zip"),
        "ingest_file_name",
        "ingested_at",
    )
    deduped = dedupe_earliest(typed, ORDER_KEYS)
    return deduped.withColumn("submitted_yyyy_mm", month_key("submitted_at")).select(ORDERS_SCHEMA.names)


def line_items(raw: DataFrame) -> DataFrame:
    """Line items, typed (no dedupe: identical lines are real repeats)."""
    return raw.select(
        "order_id",
        "product_id",
        try_cast("product_quantity", "int").alias("product_quantity"),
        try_cast("product_sold_price", "decimal(10,2)").alias("product_sold_price"),
        "ingest_file_name",
        "ingested_at",
    )


def products(xml: DataFrame, priced_only: bool = True) -> DataFrame:
    """Flatten the XML rows; products without a price are not for sale."""
    flat = xml.select(
        F.col("_product_id").cast("string").alias("product_id"),
        "color",
        "model_name",
        "model_number",
        F.col("price._base_price").cast("double").alias("base_price"),
        F.col("price._color_adj").cast("double").alias("color_adj"),
        F.col("price._size_adj").cast("double").alias("size_adj"),
        F.col("price.usd").cast("double").alias("price"),
        F.col("size").cast("string").alias("size"),
    )
    return flat.filter(F.col("price").isNotNull()) if priced_only else flat


def product_line_items(line_items_df: DataFrame, products_df: DataFrame) -> DataFrame:
    """Line items widened with their product (the declared wide table).

    An equi-join on ``product_id``; Spark broadcasts the product side only
    when its measured size is under the broadcast threshold, otherwise it
    shuffles both sides (and AQE splits a skewed product key).
    """
    joined = line_items_df.join(products_df, "product_id")
    return joined.select(
        "product_id",
        "order_id",
        "product_quantity",
        "product_sold_price",
        "color",
        "model_name",
        "model_number",
        try_cast("base_price", "decimal(10,2)").alias("base_price"),
        try_cast("color_adj", "decimal(10,1)").alias("color_adj"),
        try_cast("size_adj", "decimal(10,2)").alias("size_adj"),
        try_cast("price", "decimal(10,2)").alias("price"),
        "size",
    )
