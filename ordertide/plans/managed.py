"""Orders as a managed table by month: its months from the catalog, inserts
by name (K3, K5, K6, D10)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators import catalog
from ordertide.operators import quality as dq
from ordertide.plans.gate import EXPECTED_MONTHS, months_between
from ordertide.session import shared_dir

MONTH = "submitted_yyyy_mm"
# The month dropped to see that its loss shows, the first month
# that is inserted later, the month that is overwritten.
DROPPED, LATER_FROM, REWRITTEN = "1997-05", "1999-01", "2000-02"


@contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database of its own, dropped with its tables at the end."""
    name = f"ordertide_{uuid.uuid4().hex[:12]}"
    shared_dir(spark)
    spark.sql(f"CREATE DATABASE `{name}`")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def orders_by_month(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """The orders saved as a managed table by month: rows of each month, and
    whether the catalog lists it."""
    with scratch_database(spark) as db:
        catalog.save_managed(orders, f"`{db}`.orders", [MONTH])
        table = spark.table(f"`{db}`.orders")
        listed = catalog.partition_values(spark, f"`{db}`.orders", MONTH).withColumn("in_catalog", F.lit(True))
        rows = table.groupBy(MONTH).agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("order_id").alias("order_ids"))
        out = rows.join(listed, MONTH, "full").select(MONTH, "orders", "order_ids", F.coalesce("in_catalog", F.lit(False)).alias("in_catalog"))
        return out.checkpoint(eager=True)


def months_in_catalog(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """D10 from the catalog alone, before and after a month is dropped."""
    expected = months_between(*EXPECTED_MONTHS)
    with scratch_database(spark) as db:
        name = f"`{db}`.orders"
        catalog.save_managed(orders, name, [MONTH])

        def covered(state: str) -> DataFrame:
            found = dq.month_coverage(catalog.partition_values(spark, name, MONTH), MONTH, expected)
            return found.select(F.lit(state).alias("state"), "present_months", "missing_months").checkpoint(eager=True)

        whole = covered("whole")
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({MONTH} = '{DROPPED}')")
        return whole.unionByName(covered("one dropped"))


def inserts(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Inserts into the managed table: earlier months at first, later ones
    with their columns in another order, one month written again; a column of
    a wrong type is refused by Spark."""
    with scratch_database(spark) as db:
        name = f"`{db}`.orders"
        catalog.save_managed(orders.filter(F.col(MONTH) < LATER_FROM), name, [MONTH])
        later = orders.filter(F.col(MONTH) >= LATER_FROM)
        swapped = later.select(*reversed(later.columns))
        catalog.insert_by_name(swapped, name)
        catalog.insert_by_name(swapped.filter(F.col(MONTH) == REWRITTEN), name, overwrite_partitions=True)
        refused = False
        try:
            catalog.insert_by_name(later.withColumn("shipping_address_zip", F.col("shipping_address_zip").cast("string")), name)
        except AnalysisException:
            refused = True
        rows = spark.table(name).groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
            F.min("shipping_address_state").alias("least_state"),
        )
        return rows.withColumn("bad_type_refused", F.lit(refused)).checkpoint(eager=True)
