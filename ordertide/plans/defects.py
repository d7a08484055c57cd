"""Copies of the typed data with known defects, and the checks run on them.

A check that can't fail says nothing: these queries inject defects by order
key, so the exact number each check must report follows from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators import quality as dq
from ordertide.plans import gate
from ordertide.schemas import LINE_ITEMS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA, SALES_REPS_SCHEMA

# A defect on every order whose key is 0 modulo the number.
LONG_ZIP, WRONG_YEAR, NO_NUMBER, NO_CUSTOMER, PADDED = 11, 13, 17, 19, 23
LATE, UNDATED, TURNED = 31, 37, 5
WRONG_EPOCH = "1900000000"  # in 2030, ten digits
DROPPED_MONTHS = ["1995-01", "1998-03", "2001-08"]  # first, inner and last


def _every(n: int):
    return F.col("order_id").cast("bigint") % n == 0


def defective_raw(raw: DataFrame) -> DataFrame:
    """Overlong zips, wrong years, numbers that aren't, padded cities."""
    changed = {
        "sales_rep_zip": F.when(_every(LONG_ZIP), F.concat("sales_rep_zip", F.lit("9"))).otherwise(F.col("sales_rep_zip")),
        "submitted_at": F.when(_every(WRONG_YEAR), F.lit(WRONG_EPOCH)).otherwise(F.col("submitted_at")),
        "product_quantity": F.when(_every(NO_NUMBER), F.lit("x")).otherwise(F.col("product_quantity")),
        "shipping_address_city": F.when(_every(PADDED), F.concat("shipping_address_city", F.lit(" "))).otherwise(F.col("shipping_address_city")),
    }
    return raw.withColumns(changed)


def defective_orders(orders: DataFrame) -> DataFrame:
    """Missing customers, and three months gone."""
    kept = orders.filter(~F.col("submitted_yyyy_mm").isin(DROPPED_MONTHS))
    return kept.withColumn("customer_id", F.when(~_every(NO_CUSTOMER), F.col("customer_id")))


def lengths(raw: DataFrame) -> DataFrame:
    return dq.length_violations(defective_raw(raw), gate.EXPECTED_LENGTHS)


def file_years(raw: DataFrame) -> DataFrame:
    bad = defective_raw(raw)
    source = gate.source_of("ingest_file_name")
    year = F.year(gate.epoch_to_timestamp("submitted_at"))
    fits = F.coalesce(gate.year_fits_route(F.col("source"), F.col("year")), F.lit(False))
    rows = bad.select(source.alias("source"), year.alias("year"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_if(~fits).cast("bigint").alias("violations"))


def cast_failures(raw: DataFrame) -> DataFrame:
    return dq.cast_failures(defective_raw(raw), {"product_quantity": "int", "sales_rep_zip": "int"})


def null_profile(orders: DataFrame) -> DataFrame:
    return dq.null_profile(defective_orders(orders), ["order_id", "customer_id", "submitted_yyyy_mm"])


def months(orders: DataFrame) -> DataFrame:
    return dq.month_coverage(defective_orders(orders), expected=gate.months_between(*gate.EXPECTED_MONTHS))


def schemas(w) -> DataFrame:
    """Drifted columns: one retyped, one renamed, one dropped, one added."""
    spark = w.spark
    drifted = {
        "sales_reps": w.sales_reps().withColumnRenamed("sales_rep_zip", "zip"),
        "orders": w.orders().drop("shipping_address_city"),
        "line_items": w.line_items().withColumn("extra", F.lit(1)),
        "products": w.products().withColumn("price", F.col("price").cast("string")),
    }
    want = {"sales_reps": SALES_REPS_SCHEMA, "orders": ORDERS_SCHEMA, "line_items": LINE_ITEMS_SCHEMA, "products": PRODUCTS_SCHEMA}
    out = None
    for name, df in drifted.items():
        found = dq.schema_check(spark, df.schema, want[name]).agg(F.count(F.lit(1)).alias("differences"))
        # The rows are counted too: the drifted data is read, not only its schema.
        rows = dq.scalar_row({"differences": found, "rows": df.agg(F.count(F.lit(1)))}).select(F.lit(name).alias("table_name"), "differences", "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def result_differences(q1: DataFrame) -> DataFrame:
    """Q1 against copies of it: changed by one in state AA, by 0.005 in all
    (within a tolerance of 0.01, and without one)."""
    one_off = q1.withColumn("count", F.col("count") + F.when(F.col("shipping_address_state") == "AA", 1).otherwise(0))
    a = q1.withColumn("count", F.col("count").cast("double"))
    near = a.withColumn("count", F.col("count") + 0.005)
    found = {
        "changed_rows": dq.multiset_diff(q1, one_off),
        "outside_tolerance": dq.tolerant_diff(a, near, ["shipping_address_state"], 0.01),
        "unequal_without_tolerance": dq.tolerant_diff(a, near, ["shipping_address_state"], 0.0),
    }
    return dq.scalar_row({k: v.agg(F.count(F.lit(1))) for k, v in found.items()})


def ingest_dates(raw: DataFrame, built_on: str) -> DataFrame:
    """Rows ingested on another day than the build's: every order whose key is
    0 modulo ``LATE`` a day later, 0 modulo ``UNDATED`` without a time."""
    late = F.when(_every(LATE), F.col("ingested_at") + F.expr("interval 1 day")).otherwise(F.col("ingested_at"))
    bad = raw.withColumn("ingested_at", F.when(~_every(UNDATED), late))
    return dq.date_violations(bad, "ingested_at", built_on, gate.source_of("ingest_file_name"))


def adjustments(products: DataFrame) -> DataFrame:
    """D8 on products whose greatest colour and least size adjustment moved."""
    moved = products.withColumns(
        {
            "color_adj": F.when(F.col("color_adj") == 1.1, 1.09).otherwise(F.col("color_adj")),
            "size_adj": F.when(F.col("size_adj") == 0.9, 0.85).otherwise(F.col("size_adj")),
        }
    )
    return dq.range_check(dq.value_range(moved, ["color_adj", "size_adj"]), gate.EXPECTED_RANGES)


def flags(reps: DataFrame, raw: DataFrame) -> DataFrame:
    """D9 on reps whose flag was turned over: every id that is 0 modulo
    ``TURNED``."""
    turned = F.when(F.col("sales_rep_id").cast("bigint") % TURNED == 0, ~F.col("_error_ssn_format")).otherwise(F.col("_error_ssn_format"))
    return gate.flag_check(reps.withColumn("_error_ssn_format", turned), raw)


def positions(q1: DataFrame) -> DataFrame:
    """D12 by position: copies of Q1 with rows 1 and 2 swapped, with a wrong
    first row, with a wrong last row; the places reported for each."""
    rows = dq.numbered(q1)
    last = dq.first_and_last(q1).agg(F.max("position")).first()[0]
    at, state = F.col("position"), F.col("shipping_address_state")
    damaged = {
        "swapped": rows.withColumn("position", F.when(at == 1, 2).when(at == 2, 1).otherwise(at)),
        "first": rows.withColumn("count", F.col("count") + F.when(at == 0, 1).otherwise(0)),
        "last": rows.withColumn("shipping_address_state", F.when(at == last, F.concat(state, F.lit("?"))).otherwise(state)),
    }
    out = None
    for name, df in damaged.items():
        found = dq.position_diff(q1, df.orderBy("position").select(*q1.columns)).select(F.lit(name).alias("defect"), "position")
        out = found if out is None else out.unionByName(found)
    return out


def check_rows(w, expected: DataFrame) -> DataFrame:
    """The gate's own check rows of two stages, on the defective data."""
    rows = gate.ingest_checks(defective_raw(w.raw_batched()), w.built_on())
    return rows.unionByName(
        gate.normalize_checks(defective_orders(w.orders()), w.line_items(), w.sales_reps(), expected, gate.months_between(*gate.EXPECTED_MONTHS))
    )


