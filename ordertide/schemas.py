"""Layouts and table contracts of the order pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# The fixed-width order layout, (name, 1-based start, length).
# They must equal the source file format exactly; the line length is 409.
FIXED_WIDTH_LAYOUT: list[tuple[str, int, int]] = [
    ("submitted_at", 1, 15),
    ("order_id", 16, 40),
    ("customer_id", 56, 40),
    ("sales_rep_id", 96, 40),
    ("sales_rep_ssn", 136, 15),
    ("sales_rep_first_name", 151, 15),
    ("sales_rep_last_name", 166, 15),
    ("sales_rep_address", 181, 40),
    ("sales_rep_city", 221, 20),
    ("sales_rep_state", 241, 2),
    ("sales_rep_zip", 243, 5),
    ("shipping_address_attention", 248, 30),
    ("shipping_address_address", 278, 40),
    ("shipping_address_city", 318, 20),
    ("shipping_address_state", 338, 2),
    ("shipping_address_zip", 340, 5),
    ("product_id", 345, 40),
    ("product_quantity", 385, 5),
    ("product_sold_price", 390, 20),
]

RAW_ORDER_COLUMNS: list[str] = [name for name, _, _ in FIXED_WIDTH_LAYOUT]


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


# Header of the comma-separated files: its names differ from the target's and
# are replaced by position.
COMMA_SEPARATED_HEADER: list[str] = [camel(name) for name in RAW_ORDER_COLUMNS]
LINEAGE_COLUMNS = ["ingest_file_name", "ingested_at"]

RAW_BATCH_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_ORDER_COLUMNS]
    + [
        T.StructField("ingest_file_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

SALES_REP_KEYS = [
    "sales_rep_id",
    "sales_rep_ssn",
    "sales_rep_first_name",
    "sales_rep_last_name",
    "sales_rep_address",
    "sales_rep_city",
    "sales_rep_state",
    "sales_rep_zip",
]

SALES_REPS_SCHEMA = T.StructType(
    [
        T.StructField("sales_rep_id", T.StringType()),
        T.StructField("sales_rep_ssn", T.LongType()),
        T.StructField("sales_rep_first_name", T.StringType()),
        T.StructField("sales_rep_last_name", T.StringType()),
        T.StructField("sales_rep_address", T.StringType()),
        T.StructField("sales_rep_city", T.StringType()),
        T.StructField("sales_rep_state", T.StringType()),
        T.StructField("sales_rep_zip", T.IntegerType()),
        T.StructField("ingest_file_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("_error_ssn_format", T.BooleanType()),
    ]
)

ORDER_KEYS = [
    "submitted_at",
    "order_id",
    "customer_id",
    "sales_rep_id",
    "shipping_address_attention",
    "shipping_address_address",
    "shipping_address_city",
    "shipping_address_state",
    "shipping_address_zip",
]

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("submitted_at", T.TimestampType()),
        T.StructField("submitted_yyyy_mm", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("sales_rep_id", T.StringType()),
        T.StructField("shipping_address_attention", T.StringType()),
        T.StructField("shipping_address_address", T.StringType()),
        T.StructField("shipping_address_city", T.StringType()),
        T.StructField("shipping_address_state", T.StringType()),
        T.StructField("shipping_address_zip", T.IntegerType()),
        T.StructField("ingest_file_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
ORDERS_PARTITION = "submitted_yyyy_mm"

LINE_ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_quantity", T.IntegerType()),
        T.StructField("product_sold_price", T.DecimalType(10, 2)),
        T.StructField("ingest_file_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_number", T.StringType()),
        T.StructField("base_price", T.DoubleType()),
        T.StructField("color_adj", T.DoubleType()),
        T.StructField("size_adj", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.StringType()),
    ]
)

# Wide product line item table (declared by the specification).
PRODUCT_LINE_ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_quantity", T.IntegerType()),
        T.StructField("product_sold_price", T.DecimalType(10, 2)),
        T.StructField("color", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_number", T.StringType()),
        T.StructField("base_price", T.DecimalType(10, 2)),
        T.StructField("color_adj", T.DecimalType(10, 1)),
        T.StructField("size_adj", T.DecimalType(10, 2)),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("size", T.StringType()),
    ]
)

# XML products as read: attributes carry the "_" prefix, price is nested.
PRODUCTS_XML_SCHEMA = T.StructType(
    [
        T.StructField("_product_id", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_number", T.StringType()),
        T.StructField(
            "price",
            T.StructType(
                [
                    T.StructField("_base_price", T.DoubleType()),
                    T.StructField("_color_adj", T.DoubleType()),
                    T.StructField("_size_adj", T.DoubleType()),
                    T.StructField("usd", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("size", T.StringType()),
    ]
)

# Streamed order documents.  soldPrice is read as an exact decimal: a float
# loses cents (e.g. 0.145 would round to 0.14).
STREAM_PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("productId", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("soldPrice", T.DecimalType(10, 2)),
    ]
)
STREAM_ADDRESS_SCHEMA = T.StructType(
    [
        T.StructField("attention", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
    ]
)
ORDERS_JSON_SCHEMA = T.StructType(
    [
        T.StructField("customerId", T.StringType()),
        T.StructField("orderId", T.StringType()),
        T.StructField("salesRepId", T.StringType()),
        T.StructField("submittedAt", T.TimestampType()),
        T.StructField("products", T.ArrayType(STREAM_PRODUCT_SCHEMA)),
        T.StructField("shippingAddress", STREAM_ADDRESS_SCHEMA),
    ]
)

# What a reader could not read: the file, when it was read, the record's text.
REJECTS_SCHEMA = T.StructType(
    [
        T.StructField("ingest_file_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("text", T.StringType()),
    ]
)
